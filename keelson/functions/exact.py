"""Sums of doubles that depend neither on the order nor on the partitioning of the rows.

Each double is taken as the decimal it prints as, with 18 places after the point; such decimals add without rounding, so
partial sums merge in any order and a part can be subtracted again exactly. Where a value or a sum does not fit (1e20 and
beyond, NaN, infinities) the group falls back to the plain sum of doubles. Places beyond the 18th are rounded off each value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"


def _decimal(c: Column) -> Column:
    return F.when(F.abs(c) < 1e19, c).try_cast(DECIMAL)


def exact_sum(value: str, less: Column | None = None) -> Column:
    """Aggregate: the sum of ``value``; with ``less`` (an aggregate of the group, a double) that much less."""
    c = F.col(value)
    total, plain = F.try_sum(_decimal(c)), F.sum(c)
    whole = F.count(_decimal(c)) == F.count(c)
    if less is not None:
        total, plain = F.try_subtract(total, _decimal(less)), plain - less
    return F.coalesce(F.when(whole, total.cast("double")), plain)


SMALL = 1e8  # below it, 1e12 terms of 18 places fit in a decimal(38,18)


def exact_term(c: Column) -> Column:
    """``c`` as a decimal for running sums that can't overflow; null where it is not below ``SMALL`` in size."""
    return F.when(F.abs(c) < SMALL, c).try_cast(DECIMAL)

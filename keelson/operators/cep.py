"""Sequence patterns: an event followed by the next event of the same key.

``a -> b`` with ``b`` the next event of ``a``'s key (gaps allowed; every event can be both an
``a`` and a ``b``) is a one-row lead per key. The lead uses the bucketed shift from
``keelson.plans.ordered`` so a key with a large share of the events is still spread over many
tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.plans.ordered import DEFAULT_BUCKET_WIDTH, shift


def followed_by(df: DataFrame, key_cols: Sequence[str], order_col: str, cols: Sequence[str],
                predicate: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
                bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Pairs (a, b) of consecutive events per key. Output columns: keys, ``a_<c>`` and ``b_<c>``
    for ``order_col`` and each of ``cols``. ``predicate(a, b)`` receives two accessors
    (``a("speed")`` is a column of the earlier event) and filters the pairs."""
    cols = list(dict.fromkeys([order_col, *cols]))
    nxt = shift(df.select(*key_cols, *cols), key_cols, order_col, cols, direction=-1,
                prefix="_n_", bucket_width=bucket_width)
    nxt = nxt.filter(F.col("_n_" + order_col).isNotNull())
    out = nxt.select(*key_cols, *[F.col(c).alias("a_" + c) for c in cols],
                     *[F.col("_n_" + c).alias("b_" + c) for c in cols])
    if predicate is not None:
        out = out.filter(predicate(lambda c: F.col("a_" + c), lambda c: F.col("b_" + c)))
    return out


def speed_change(avgs: DataFrame, threshold: float = 20.0, inclusive: bool = False,
                 key_cols: Sequence[str] = ("sensor_id",), order_col: str = "window_start_ms",
                 value_col: str = "avg_speed_kmh", bucket_width: int = 10_000 * 4096) -> DataFrame:
    """Each average paired with the next emitted average of the same sensor, kept when
    ``|current - previous| > threshold`` (``>=`` with ``inclusive``). Output: keys,
    ``previous_window_ms, window_ms, previous_speed, current_speed``."""
    def jump(a, b):
        d = F.abs(b(value_col) - a(value_col))
        return d >= threshold if inclusive else d > threshold

    pairs = followed_by(avgs, key_cols, order_col, [value_col], jump, bucket_width)
    return pairs.select(*key_cols,
                        F.col("a_" + order_col).alias("previous_window_ms"),
                        F.col("b_" + order_col).alias("window_ms"),
                        F.col("a_" + value_col).alias("previous_speed"),
                        F.col("b_" + value_col).alias("current_speed"))

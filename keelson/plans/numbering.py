"""Dense numbers 0, 1, 2 ... for rows in an order, without a single task.

Two passes: the rows are cut into sorted ranges by (keys, order), each written with its place in its range; the counts of
the ranges (a row for each range and key) are summed up, and each row's number is its place plus the rows of the ranges
before. The ranges also cut through rows of one order value and through copies of one row, so a hot value spreads too.
The ranges are written before they are counted: a retry or another number of tasks cannot mix two cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.plans import stages
from keelson.plans.stages import materialize


SMALL = 100_000  # ranges sent to every task; more are joined by a shuffle


def placed(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """``df`` (``_at``: increasing along each group; ``group[-1]``: the group's order within the other group columns) with
    ``_base``, the rows of the groups before with the same other columns, ``_all``, the rows of all groups before, and
    ``_first``, the group's least ``_at``. The rows are not shuffled while the groups are few."""
    *keys, last = group

    def before(w):
        return F.coalesce(F.sum("_n").over(w.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    counts = df.groupBy(*group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    bases = stages.materialize(counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_first",
                                      before(Window.partitionBy(*keys)).alias("_base"),
                                      before(Window.partitionBy()).alias("_all")), force=True)
    if bases.count() <= SMALL:
        bases = F.broadcast(bases)
    on = F.lit(True)
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(bases, on).select(*df.columns, "_base", "_all", "_first")


def numbered(df: DataFrame, order_cols: Sequence[str], keys: Sequence[str] = (), out: str = "number",
             ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``: the row's place (from 0) in ``order_cols`` order, nulls first, among the rows of its ``keys``.
    Rows of one order value follow each other by their hash, so any partitioning gives the same numbers, but for rows
    that differ in nothing. Null keys are a key. An empty table gives an empty result."""
    keys, order = list(keys), [*keys, *order_cols, "_tie", "_id"]
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    marked = df.withColumn("_tie", F.xxhash64(*names)).withColumn("_id", F.monotonically_increasing_id())
    cut = marked.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    cut = cut.select(*names, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    rows = placed(materialize(cut, force=True), [*keys, "_range"])
    return rows.select(*names, (F.col("_base") + F.col("_at") - F.col("_first")).alias(out))

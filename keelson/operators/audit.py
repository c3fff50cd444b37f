"""Audit of a read-process-write run: counts, offsets and duplicate message ids.

All results are aggregates (one shuffle of small partial results at most); none collects rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import formats

BLANK_LINE_RE = r"^\s*$"
MAX_PER_POLL = 500  # fixed: records per poll / transaction of the original loop


def next_offsets(records: DataFrame) -> DataFrame:
    """Per topic partition the offset to resume from: last offset + 1."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def end_offset_sum(offsets: DataFrame) -> DataFrame:
    """Sum of end offsets over partitions (0 when there are none): a progress bound."""
    return offsets.agg(F.coalesce(F.sum("next_offset"), F.lit(0)).cast("long").alias("end_offset_sum"))


def batch_progress(routed: DataFrame, batch_col: str | None = None, max_per_batch: int = MAX_PER_POLL) -> DataFrame:
    """Per commit: records, out, bad and partitions touched. Without a batch column the batch is
    ``offset div max_per_batch`` (the poll size of the original loop)."""
    b = F.col(batch_col) if batch_col else F.floor(F.col("offset") / max_per_batch).cast("long")
    return routed.groupBy(b.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("route") == "OUT").alias("out"),
        F.count_if(F.col("route") == "BAD").alias("bad"),
        F.countDistinct("topic", "partition").alias("partitions"))


def union_outputs(out: DataFrame, bad: DataFrame) -> DataFrame:
    """OUT followed by BAD (UNION ALL; order is not kept by Spark and not needed by the audit)."""
    return out.unionByName(bad)


def nonblank_count(lines: DataFrame, value_col: str = "value", alias: str = "lines") -> DataFrame:
    return lines.agg(F.count_if(~F.col(value_col).rlike(BLANK_LINE_RE)).alias(alias))


def reconcile_counts(inputs: DataFrame, out: DataFrame, bad: DataFrame, value_col: str = "value") -> DataFrame:
    """One row ``input_lines, output_lines, bad_lines, total, counts_match``: all input lines,
    non-blank OUT and BAD lines. One aggregate over a tagged union (no join)."""
    tagged = (inputs.select(F.lit("in").alias("_src"), F.col(value_col).alias("_v"))
              .unionByName(out.select(F.lit("out").alias("_src"), F.col(value_col).alias("_v")))
              .unionByName(bad.select(F.lit("bad").alias("_src"), F.col(value_col).alias("_v"))))
    nonblank = ~F.coalesce(F.col("_v"), F.lit("")).rlike(BLANK_LINE_RE)
    agg = tagged.agg(F.count_if(F.col("_src") == "in").alias("input_lines"),
                     F.count_if((F.col("_src") == "out") & nonblank).alias("output_lines"),
                     F.count_if((F.col("_src") == "bad") & nonblank).alias("bad_lines"))
    total = F.col("output_lines") + F.col("bad_lines")
    return agg.select("input_lines", "output_lines", "bad_lines", total.alias("total"),
                      (total == F.col("input_lines")).alias("counts_match"))


def duplicate_mids(outputs: DataFrame, value_col: str = "value") -> DataFrame:
    """Message ids that occur more than once in the outputs: ``mid, copies``."""
    mids = outputs.select(formats.extract_message_id(F.col(value_col)).alias("mid"))
    # Lines without a MID are not counted inside the aggregate: a filter on the extracted MID
    # would be pushed below the projections and re-evaluate the whole line expression there.
    return (mids.groupBy("mid").agg(F.count_if(F.col("mid") != "").alias("copies"))
            .filter(F.col("copies") > 1))


def mid_audit(outputs: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: lines, lines with a MID, distinct MIDs, duplicated MIDs and ``ok`` (some MID
    present and none duplicated). Two-level aggregate: per MID, then overall."""
    m = outputs.select(formats.extract_message_id(F.col(value_col)).alias("mid"))
    per = m.groupBy("mid").agg(F.count(F.lit(1)).alias("n"))
    agg = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
                  F.coalesce(F.sum(F.when(F.col("mid") != "", F.col("n"))), F.lit(0)).alias("lines_with_mid"),
                  F.count_if(F.col("mid") != "").alias("distinct_mids"),
                  F.count_if((F.col("mid") != "") & (F.col("n") > 1)).alias("duplicate_mids"))
    return agg.withColumn("ok", (F.col("lines_with_mid") > 0) & (F.col("duplicate_mids") == 0))


def dedupe_by_mid(outputs: DataFrame, mid_col: str = "mid") -> DataFrame:
    """Keep one row per message id: the consumer-side guard for at-least-once sinks."""
    return outputs.dropDuplicates([mid_col])

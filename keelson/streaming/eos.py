"""Exactly-once read-process-write of traffic lines into OUT and BAD.

The source's offsets are recorded in the query checkpoint before a micro-batch runs; the file
sink writes the batch's files and then records them in its commit log (``_spark_metadata``).
Readers of the sink directory only see committed files, so a batch that fails half-way leaves
nothing visible and is re-run from the same offsets on restart: every record lands exactly once
in OUT or BAD. Both routes go to one sink partitioned by ``route``, so they commit together.

A Kafka sink is at-least-once; when writing to Kafka, consumers drop repeats by message id
(``keelson.operators.audit.dedupe_by_mid``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.operators.routing import route_traffic


def routed_stream(records: DataFrame, fail_at_offset: int | None = None) -> DataFrame:
    """Route a stream of topic records. ``fail_at_offset`` makes the task that processes that
    offset fail (fault-injection for recovery tests; never set in production)."""
    out = route_traffic(records)
    if fail_at_offset is not None:
        boom = F.raise_error(F.lit(f"forced failure at offset {fail_at_offset}"))
        out = out.withColumn("value", F.when(F.col("offset") == fail_at_offset, boom.cast("string"))
                             .otherwise(F.col("value")))
    return out


def start_routing(records: DataFrame, out_path: str, checkpoint: str, fail_at_offset: int | None = None,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the read-process-write query: file sink ``out_path`` partitioned by ``route``."""
    w = (routed_stream(records, fail_at_offset).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).partitionBy("route").outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(out_path)


def dedupe_stream(outputs: DataFrame, delay: str = "10 minutes", mid_col: str = "mid",
                  ts_col: str = "timestamp") -> DataFrame:
    """Consumer-side guard for at-least-once sinks: drop repeated message ids that arrive within
    ``delay`` of each other (state is bounded by the watermark, unlike a plain dropDuplicates)."""
    return outputs.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([mid_col])


def eos_read_process_write(records: DataFrame, out_path: str, checkpoint: str, **kwargs) -> StreamingQuery:
    """The exactly-once read-process-write loop (``start_routing``)."""
    return start_routing(records, out_path, checkpoint, **kwargs)

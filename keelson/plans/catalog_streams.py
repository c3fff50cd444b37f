"""Registered queries of the carried-state streams: the log is written in three parts, in order, and read as micro-batches;
the tables a user would read are returned, with what is still open closed as the batch operators do."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import lidar as ld
from keelson.plans.catalog import ORACLE, _traffic, r6, register
from keelson.plans import views as V
from keelson.session import fresh_path
from keelson.streaming import carried


def _replayed(spark: SparkSession, rows: DataFrame, root: str, order: str = "seq", parts: int = 3) -> DataFrame:
    """``rows`` as a stream of ``parts`` micro-batches in ``order``."""
    lo, hi = rows.agg(F.min(order), F.max(order)).first()
    for i in range(parts):
        part = F.least(F.floor((F.col(order) - F.lit(lo)) * parts / F.lit((hi or 0) - (lo or 0) + 1)), F.lit(parts - 1)) == i
        rows.filter(part).coalesce(1).write.mode("append").parquet(os.path.join(root, "in"))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "in"))


@register("lidar_pipeline_stream", ORACLE["lidar_chain"])
def q_lidar_pipeline_stream(spark, sf):
    root = fresh_path(spark, "lidar-stream")
    readings = ld.lidar_quality_filter(V.lidar(V.events(spark, sf))).select("seq", "angle", "distance")
    out = os.path.join(root, "out")
    carried.start_lidar_totals(_replayed(spark, readings, root), out, os.path.join(root, "checkpoint")).awaitTermination()
    return carried.lidar_totals(spark, out, with_open=True).withColumn("distance", r6("distance"))


@register("anchored_batch_avg_speed_with_idle_stream", ORACLE["anchored_batch_avg_speed_with_idle"])
def q_anchored_idle_stream(spark, sf):
    root = fresh_path(spark, "anchored-stream")
    events = _traffic(spark, sf).select("seq", "sensor_id", "ts", "speed_ms")
    out = os.path.join(root, "out")
    carried.start_anchored_averages(_replayed(spark, events, root), out, os.path.join(root, "checkpoint")).awaitTermination()
    carried.close_anchored(spark, out)
    return carried.anchored_means(spark, out).withColumn("avg_speed_kmh", r6("avg_speed_kmh"))

"""Registered queries of the topic sources and sinks: each writes its stand-in input (rows or files made from ``events``)
through the library's own sink, reads it back through the source, and returns what a user would see."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from keelson.functions import codecs, formats
from keelson.operators import routing as rt, traffic as tr
from keelson.plans import views as V
from keelson.plans.catalog import SQL_VIEWS, _sql, _traffic, register
from keelson.session import fresh_path
from keelson.sources import commitlog, topics

_LINES = """lines AS (
        SELECT event_id, strftime(make_timestamp((1759468960000 + event_id * 500) * 1000), '%Y-%m-%dT%H:%M:%S') || '.'
               || lpad(CAST((1759468960000 + event_id * 500) % 1000 AS VARCHAR), 3, '0') || 'Z ' || (user_id % 10) AS head
        FROM events)"""
SQL_VIEWS["heads"] = _LINES


def _ordered_files(df, path, *order, files=4):
    """Text files whose path order is the order of the rows."""
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).select("value").write.text(path)


def _simple_lines(spark, sf):
    ev = V.events(spark, sf)
    ms = F.lit(V.TRAFFIC_BASE_MS) + F.col("event_id") * V.TRAFFIC_STEP_MS
    ts = F.timestamp_millis(ms)
    value = F.concat(F.date_format(ts, V.ISO_MILLIS), F.lit(" "), (F.col("user_id") % V.TRAFFIC_SENSORS).cast("string"))
    return ev.select("event_id", value.alias("value"), ts.alias("ts"))


@register("traffic_line_source", _sql(["heads"], """
    SELECT row_number() OVER (ORDER BY event_id) - 1 AS "offset", 0 AS "partition", head AS "value",
           1759468960000 + event_id * 500 AS ts_ms
    FROM lines"""))
def q_traffic_line_source(spark, sf):
    path = fresh_path(spark, "traffic-files")
    _ordered_files(_simple_lines(spark, sf), path, "event_id")
    recs = topics.traffic_line_source(spark, path)
    return recs.select("offset", "partition", "value", F.unix_millis("timestamp").alias("ts_ms"))


@register("lidar_scan_source", """
    WITH r AS (SELECT event_id, CAST(event_id % 360 AS DOUBLE) AS angle, CAST(user_id % 100 AS DOUBLE) / 4 AS distance,
                      event_id % 3 AS file_no FROM events)
    SELECT file_no, row_number() OVER (PARTITION BY file_no ORDER BY event_id) - 1 AS seq, angle, distance, 20 AS quality
    FROM r""")
def q_lidar_scan_source(spark, sf):
    ev = V.events(spark, sf)
    scans = ev.select("event_id", (F.col("event_id") % 360).cast("double").alias("angle"),
                      (F.col("user_id") % 100).cast("double").alias("distance"), (F.col("event_id") % 3).alias("file_no"))
    lines = codecs.encode_lidar(scans.withColumn("distance", F.col("distance") / 4).withColumn("quality", F.lit(20)))
    path = fresh_path(spark, "scan-files")
    lines.repartition("file_no").sortWithinPartitions("file_no", "event_id").select("file_no", "value").write.partitionBy("file_no").text(path)
    got = topics.lidar_scan_source(spark, path)
    number = F.regexp_extract("file", r"file_no=(\d+)", 1).cast("long")
    return got.select(number.alias("file_no"), "seq", "angle", "distance", F.col("quality").cast("int").alias("quality"))


_SINK_SQL = _sql(["heads"], """
    SELECT row_number() OVER (ORDER BY event_id) - 1 AS "offset", head AS "value" FROM lines""")


def _published(spark, sf, root, commits=1, **how):
    """The lines of ``events`` in a topic; with several commits, one after the other by event id."""
    lines = _simple_lines(spark, sf)
    if commits == 1:
        topics.topic_sink(lines, root, "traffic-data", order_col="event_id", **how)
        return
    half = lines.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY event_id)")).first()[0]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        topics.topic_sink(lines.filter(part), root, "traffic-data", order_col="event_id", **how)


@register("topic_sink", _SINK_SQL)
def q_topic_sink(spark, sf):
    root = fresh_path(spark, "topic")
    _published(spark, sf, root)
    return commitlog.read(spark, root, "traffic-data").select("offset", "value")


@register("topic_source", _SINK_SQL)
def q_topic_source(spark, sf):
    """Two appends, read as one topic from the earliest offset."""
    root = fresh_path(spark, "topic")
    _published(spark, sf, root, commits=2)
    return topics.topic_source(spark, root, "traffic-data").select("offset", "value")


@register("topic_sink_with_event_time", _sql(["heads"], """
    SELECT row_number() OVER (ORDER BY event_id) - 1 AS "offset", head AS "value", 1759468960000 + event_id * 500 AS ts_ms
    FROM lines"""))
def q_topic_sink_with_event_time(spark, sf):
    root = fresh_path(spark, "topic")
    topics.topic_sink_with_event_time(_simple_lines(spark, sf), root, "traffic-data", ts_col="ts", order_col="event_id")
    return topics.topic_source(spark, root, "traffic-data").select("offset", "value", F.unix_millis("timestamp").alias("ts_ms"))


@register("topic_sink_partitions", """
    WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events)
    SELECT CAST(place % 3 AS INTEGER) AS "partition", place // 3 AS "offset", CAST(event_id AS VARCHAR) AS "value" FROM r""")
def q_topic_sink_partitions(spark, sf):
    """Dense offsets in three partitions."""
    root = fresh_path(spark, "topic")
    ev = V.events(spark, sf).select("event_id", F.col("event_id").cast("string").alias("value"))
    topics.topic_sink(ev, root, "numbers", order_col="event_id", partitions=3)
    return topics.topic_source(spark, root, "numbers").select("partition", "offset", "value")


@register("topic_source_committed", _SINK_SQL)
def q_topic_source_committed(spark, sf):
    """Two commits and an append that failed before its commit, read as a stream of micro-batches of bounded size."""
    root, out = fresh_path(spark, "topic"), fresh_path(spark, "polled")
    _published(spark, sf, root, commits=2)

    def lost():
        raise _Lost

    rows = _simple_lines(spark, sf).select(F.lit(None).cast("string").alias("key"), "value", F.col("ts").alias("timestamp"))
    try:
        commitlog.append(rows, root, "traffic-data", before_claim=lost)
    except _Lost:
        pass
    checkpoint = os.path.join(out, "checkpoint")
    # so that the number of micro-batches does not grow with the table
    limit = max(topics.MAX_RECORDS_PER_POLL, rows.count() // 5)
    stream = topics.topic_source_committed(spark, root, "traffic-data", max_per_trigger=limit, checkpoint=checkpoint)
    q = (stream.select("offset", "value").writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .start(os.path.join(out, "data")))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema("offset long, value string").parquet(os.path.join(out, "data"))


class _Lost(Exception):
    """An append that ends before its commit."""


@register("windowed_text_sink", _sql(["traffic"], """
    SELECT (epoch_ms(ts) // 10000) * 10000 AS window_start, count(DISTINCT sensor_id) AS n_lines
    FROM traffic WHERE speed_ms >= 0 AND NOT isnan(speed_ms) GROUP BY ALL"""))
def q_windowed_text_sink(spark, sf):
    """The means' text lines by window, counted as read back from their shards (their averages are rounded texts)."""
    path = fresh_path(spark, "averages")
    avgs = tr.tumbling_avg_speed(_traffic(spark, sf))
    line = formats.format_average("window_start_ms", "window_end_ms", "sensor_id", "avg_speed_kmh")
    topics.windowed_text_sink(avgs.select(F.col("window_start_ms").alias("window_start"), line.alias("line")), path)
    return topics.read_windowed_text(spark, path).groupBy("window_start").agg(F.count("*").alias("n_lines"))


@register("dual_sink", """
    SELECT route, count(*) AS n FROM (SELECT CASE WHEN event_id % 7 = 0 THEN 'BAD' ELSE 'OUT' END AS route FROM events)
    GROUP BY route""")
def q_dual_sink(spark, sf):
    """Lines of a sensor and a speed, every seventh without a number, routed and read back."""
    head = _simple_lines(spark, sf)
    speed = F.when(F.col("event_id") % 7 == 0, F.lit("none")).otherwise(F.lit("12.5"))
    lines = head.select(
        F.lit(None).cast("string").alias("key"), F.concat_ws(" ", "value", speed).alias("value"), F.lit("traffic-data").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.current_timestamp().alias("timestamp"))
    path = fresh_path(spark, "routed")
    topics.dual_sink(rt.route_traffic(lines), path)
    return spark.read.parquet(path).groupBy("route").agg(F.count("*").alias("n"))

"""Topic sources and sinks.

A topic is a table in the Kafka source layout ``key, value, topic, partition, offset, timestamp``.
With the Kafka connector on the classpath the same functions read and write Kafka; without it
(this image) a topic is a Parquet *file log* under ``<root>/<topic>``: ``publish`` and the sinks append
commits with dense offsets (``sources.commitlog``), ``write_topic`` plain files with given offsets. Operators
downstream only see the DataFrame, so they are identical for all.

Exactly-once on the file log comes from Structured Streaming: source progress lives in the
checkpoint, and the file sink's commit log hides files of failed attempts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.plans.numbering import placed
from keelson.plans.stages import materialize
from keelson.session import local_folder
from keelson.sources import commitlog
from keelson.sources.shards import TextShards

TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
TOPIC_COLS = [f.name for f in TOPIC_SCHEMA.fields]
MAX_RECORDS_PER_POLL = 500  # fixed: the original consumer's poll limit


def _kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def _require_kafka(spark: SparkSession) -> None:
    if not _kafka_available(spark):
        raise RuntimeError("the Kafka connector (spark-sql-kafka) is not on the classpath; "
                           "use the file topic log (kafka_servers=None) instead")


def _kafka_frame(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                     F.col("partition").cast("int"), F.col("offset").cast("long"), "timestamp")


def read_topic(spark: SparkSession, root: str, topic: str, kafka_servers: str | None = None) -> DataFrame:
    """All records of a topic from the earliest offset (batch)."""
    if kafka_servers:
        _require_kafka(spark)
        df = (spark.read.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
              .option("subscribe", topic).option("startingOffsets", "earliest").load())
        return _kafka_frame(df)
    if commitlog.has_commits(spark, root, topic):
        return commitlog.read(spark, root, topic)
    return spark.read.schema(TOPIC_SCHEMA).parquet(os.path.join(root, topic))


def read_topic_stream(spark: SparkSession, root: str, topic: str, kafka_servers: str | None = None,
                      max_per_trigger: int | None = None, committed_only: bool = True,
                      checkpoint: str | None = None) -> DataFrame:
    """Streaming read from the earliest offset. Progress is kept in the query checkpoint (no
    consumer group). ``max_per_trigger`` caps records per micro-batch (Kafka, and topics written by
    ``publish``; these need ``checkpoint``, the query's own, when it is started again) or files per
    micro-batch (plain files of ``write_topic``); ``committed_only`` reads only committed transactional records."""
    if kafka_servers:
        _require_kafka(spark)
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", topic).option("startingOffsets", "earliest"))
        if committed_only:
            r = r.option("kafka.isolation.level", "read_committed")
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return _kafka_frame(r.load())
    if commitlog.has_commits(spark, root, topic):
        return commitlog.read_stream(spark, root, topic, max_per_trigger or MAX_RECORDS_PER_POLL, checkpoint)
    r = spark.readStream.schema(TOPIC_SCHEMA)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.parquet(os.path.join(root, topic))


def topic_end(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """Per partition the next offset to write (0 for a new topic)."""
    from keelson.session import path_exists

    path = os.path.join(root, topic)
    if commitlog.has_commits(spark, root, topic):
        return commitlog.ends(spark, root, topic)
    if not path_exists(spark, path):
        return spark.createDataFrame([], "partition int, next_offset long")
    return (spark.read.schema(TOPIC_SCHEMA).parquet(path).groupBy("partition")
            .agg((F.max("offset") + 1).alias("next_offset")))


def as_records(df: DataFrame, topic: str, value_col: str = "value", ts_col: str | None = None,
               order_col: str | None = None, base_offset: int = 0) -> DataFrame:
    """Shape rows as topic records: NULL key, one partition, ``offset = base + order``. With
    ``ts_col`` the record timestamp is the row's own event time (publish with event time);
    otherwise the current time."""
    ts = F.col(ts_col) if ts_col else F.current_timestamp()
    off = (F.col(order_col) if order_col else F.monotonically_increasing_id()) + F.lit(base_offset)
    return df.select(F.lit(None).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"),
                     F.lit(topic).alias("topic"), F.lit(0).alias("partition"), off.cast("long").alias("offset"),
                     ts.cast("timestamp").alias("timestamp"))


def write_topic(records: DataFrame, root: str, topic: str, kafka_servers: str | None = None,
                files: int | None = None) -> None:
    """Append records (topic layout) to a topic. Kafka ignores key/partition/offset given here."""
    if kafka_servers:
        _require_kafka(records.sparkSession)
        # acks=all + idempotent producer, as the original publisher; Spark's Kafka sink is still
        # at-least-once across task retries, so consumers deduplicate by message id
        (records.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", kafka_servers).option("topic", topic)
         .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())
        return
    out = records.select(*TOPIC_COLS)
    if files:
        out = out.repartitionByRange(files, "partition", "offset")
    out.write.mode("append").parquet(os.path.join(root, topic))


def publish(df: DataFrame, root: str, topic: str, value_col: str = "value", ts_col: str | None = None,
            order_col: str | None = None, kafka_servers: str | None = None, partitions: int = 1,
            key_col: str | None = None, commit_id: str | None = None) -> None:
    """Append string values to a topic (NULL key unless ``key_col``) as one commit of the topic's log
    (``sources.commitlog``): dense offsets after the topic's end in ``order_col`` order, all visible at once, once for a
    ``commit_id``. ``ts_col`` publishes with the row's own event time."""
    if kafka_servers:
        write_topic(as_records(df, topic, value_col, ts_col, order_col), root, topic, kafka_servers)
        return
    ts = F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()
    key = F.col(key_col) if key_col else F.lit(None)
    order = [F.col(order_col).alias("order")] if order_col else []
    rows = df.select(key.cast("string").alias("key"), F.col(value_col).alias("value"), ts.alias("timestamp"), *order)
    commitlog.append(rows, root, topic, "order" if order_col else None, partitions, commit_id)


# ---------------------------------------------------------------- text files

def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``file``, ``seq`` (line of the file, from 0), ``line`` (line of all files in path order) and
    ``value``. The lines are written once with their byte range and place in it; the ranges' counts are summed up
    (``plans.numbering``), so the numbers are dense and do not depend on how the files are split."""
    df = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
                                      F.monotonically_increasing_id().alias("_at"), "value")
    lines = placed(materialize(df, force=True), ["file", "_start"])
    at = F.col("_at") - F.col("_first")
    return lines.select("file", (F.col("_base") + at).alias("seq"), (F.col("_all") + at).alias("line"), "value")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in a stable order: ``file, seq, value``; (file, seq) names a line."""
    return text_lines(spark, path).select("file", "seq", "value")


def read_lidar_scans(spark: SparkSession, path: str) -> DataFrame:
    """Scan file (JSON lines) -> ``file, seq, angle, distance, quality, decode_error``."""
    from keelson.functions.codecs import decode_lidar

    return decode_lidar(read_text_lines(spark, path))


def read_traffic_file(spark: SparkSession, path: str, topic: str = "traffic-data") -> DataFrame:
    """Traffic text files as topic records with the line's own instant as record timestamp
    (lines whose instant does not parse get NULL); offsets count the lines of all files in path order."""
    from keelson.functions.parsing import parse_instant

    lines = text_lines(spark, path)
    first = F.get(F.split(F.col("value"), r"\s+", -1), 0)
    return lines.select(F.lit(None).cast("string").alias("key"), "value", F.lit(topic).alias("topic"),
                        F.lit(0).alias("partition"), F.col("line").alias("offset"),
                        parse_instant(first).alias("timestamp"))


# ---------------------------------------------------------------- sinks

def windowed_text_sink(lines: DataFrame, path: str, window_col: str = "window_start", line_col: str = "line") -> None:
    """One text shard per window (``<path>/window_start=<value>/part-*.txt``): rows are
    hash-partitioned by window so each window is written by one task, in one file. The work is in the
    number of shards, so tasks of few bytes are not merged; on a mounted folder ``sources.shards`` writes them."""
    spark = lines.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (lines.select(F.col(window_col).cast("string").alias(window_col), F.col(line_col).cast("string").alias("value"))
            .repartition(files, window_col))
    folder = local_folder(spark, path)
    if folder is None:
        rows.write.mode("append").partitionBy(window_col).text(path)
        return
    spark.dataSource.register(TextShards)
    (rows.sortWithinPartitions(window_col).write.format("text_shards").mode("append").option("path", folder)
     .option("column", window_col).save())


def read_windowed_text(spark: SparkSession, path: str, window_col: str = "window_start", window_type: str = "long") -> DataFrame:
    """The lines of ``windowed_text_sink``: ``value`` and the window."""
    folder = local_folder(spark, path)
    if folder is None:
        return spark.read.schema(f"value string, `{window_col}` {window_type}").text(path)
    spark.dataSource.register(TextShards)
    back = (spark.read.format("text_shards").option("path", folder).option("column", window_col)
            .option("tasks", spark.conf.get("spark.sql.shuffle.partitions")).load())
    return back.select("value", F.col(window_col).cast(window_type).alias(window_col))


def dual_sink(routed: DataFrame, path: str) -> None:
    """OUT and BAD in one write partitioned by ``route``: both routes commit together."""
    routed.write.mode("append").partitionBy("route").parquet(path)


# ---------------------------------------------------------------- operation names of the blueprint

def lidar_scan_source(spark: SparkSession, path: str) -> DataFrame:
    """Scan file of JSON lines, in file order (``read_lidar_scans``)."""
    return read_lidar_scans(spark, path)


def traffic_line_source(spark: SparkSession, path: str, topic: str = "traffic-data") -> DataFrame:
    """Traffic text lines as topic records (``read_traffic_file``)."""
    return read_traffic_file(spark, path, topic)


def topic_source(spark: SparkSession, root: str, topic: str, kafka_servers: str | None = None) -> DataFrame:
    """All records of a topic from the earliest offset, re-read on every run (``read_topic``)."""
    return read_topic(spark, root, topic, kafka_servers)


def topic_source_committed(spark: SparkSession, root: str, topic: str, kafka_servers: str | None = None,
                           max_per_trigger: int = MAX_RECORDS_PER_POLL, checkpoint: str | None = None) -> DataFrame:
    """Committed records only, at most ``max_per_trigger`` per micro-batch, progress in the
    query checkpoint, which a restarted query names here (``commitlog.read_stream``)."""
    if kafka_servers:
        return read_topic_stream(spark, root, topic, kafka_servers, max_per_trigger, committed_only=True)
    return commitlog.read_stream(spark, root, topic, max_per_trigger, checkpoint)


def topic_sink(df: DataFrame, root: str, topic: str, value_col: str = "value",
               kafka_servers: str | None = None, **how) -> None:
    """Append string values with a NULL key (``publish``, which takes ``how``)."""
    publish(df, root, topic, value_col, kafka_servers=kafka_servers, **how)


def topic_sink_with_event_time(df: DataFrame, root: str, topic: str, ts_col: str, value_col: str = "value",
                               kafka_servers: str | None = None, **how) -> None:
    """Append values with each row's own event time as record timestamp (``publish``, which takes ``how``)."""
    publish(df, root, topic, value_col, ts_col=ts_col, kafka_servers=kafka_servers, **how)

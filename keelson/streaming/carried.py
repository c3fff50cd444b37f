"""Streams whose state is a small table written by each micro-batch.

``Carried`` names the tables of one query under a folder of shared storage: ``<name>/batch=<number>``. A micro-batch reads
the state that the batch before left and overwrites its own tables, so a batch that is run again (a failure, a restart)
starts from the same state and leaves the same rows: once in the result, whatever was lost on the way. States of older
batches are deleted.

``start_lidar_totals`` — the LiDAR chain over one log, with or without keys: the batch operators' two-level scan runs on
each micro-batch, with one carried row a scanner (last reading, its rotation, the open rotation's sum), so that a log of one
scanner, or without keys, is spread over its buckets. ``start_anchored_averages`` — means of batches anchored at the first
event, with the zero rows of sensors that fell silent. Both set rows aside that come too late, in the table ``late``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.operators.lidar import scan_points
from keelson.plans.ordered import DEFAULT_BUCKET_WIDTH
from keelson.plans.stages import materialize, materialized_mark, release_materialized
from keelson.session import path_exists

LOG = "_log"  # the one key of a log without keys


class Carried:
    def __init__(self, spark: SparkSession, path: str, batch: int):
        self.spark, self.path, self.batch = spark, path, batch

    def before(self, name: str, schema: str) -> DataFrame:
        """Table ``name`` as the micro-batch before left it; empty before the first one."""
        if self.batch == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/batch={self.batch - 1}")

    def leave(self, **tables: DataFrame) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={self.batch}")

    def forget(self, *states: str) -> None:
        """Deletes the states no batch can be run from any more."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in states:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/batch={self.batch - 2}")
            p.getFileSystem(conf).delete(p, True)


def start(stream: DataFrame, path: str, checkpoint: str, step: Callable[[DataFrame, Carried], None], **trigger) -> StreamingQuery:
    def run(batch, number):
        spark = batch.sparkSession
        mark = materialized_mark(spark)
        try:
            step(batch, Carried(spark, path, number))
        finally:
            release_materialized(spark, since=mark)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """All rows of a result table so far."""
    if not path_exists(spark, f"{path}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}").select(*[c.split()[0] for c in schema.split(", ")])


# ---------------------------------------------------------------- LiDAR

_READING = "seq long, angle double, distance double"
_LIDAR_STATE = _READING + ", scan long, open_sum double, open_n long"


def _key_ddl(readings: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"{k} {readings.schema[k].dataType.simpleString()}, " for k in keys) or f"{LOG} int, "


def lidar_step(readings: DataFrame, at: Carried, key_cols: Sequence[str] = (), bucket_width: int = DEFAULT_BUCKET_WIDTH) -> None:
    keys, ddl = list(key_cols) or [LOG], _key_ddl(readings, key_cols)
    rows = (readings if key_cols else readings.withColumn(LOG, F.lit(0))).select(*keys, "seq", "angle", "distance")
    state = at.before("state", ddl + _LIDAR_STATE)
    last = state.select(*keys, F.col("seq").alias("c_seq"), F.col("scan").alias("c_scan"), F.col("angle").alias("c_angle"))
    known = materialize(rows.join(last, keys, "left"), force=True)
    late = known.filter("seq <= c_seq")
    seeds = state.select(*keys, "seq", "angle", "distance", F.col("seq").alias("c_seq"), F.col("scan").alias("c_scan"),
                         F.col("angle").alias("c_angle"), F.lit(True).alias("seed"))
    fresh = known.filter("c_seq IS NULL OR seq > c_seq").withColumn("seed", F.lit(False))
    points = scan_points(fresh.unionByName(seeds), keys, bucket_width=bucket_width)
    # the scan counts from the carried reading, which is in rotation 0 of this pass, or 1 with a negative angle
    first = F.when(F.col("c_scan").isNotNull() & (F.col("c_angle") < 0), 1).otherwise(0)
    points = materialize(points.withColumn("scan", F.coalesce("c_scan", F.lit(0)) + F.col("scan") - first), force=True)
    segments = points.filter("segment IS NOT NULL AND NOT seed").select(*keys, "scan", "seq", F.col("segment").alias("distance"))
    sums = segments.groupBy(*keys, "scan").agg(F.sum("distance").alias("s"), F.count("*").alias("n"))
    sums = sums.unionByName(state.filter("open_n > 0").select(*keys, "scan", F.col("open_sum").alias("s"), F.col("open_n").alias("n")))
    sums = sums.groupBy(*keys, "scan").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    ends = materialize(points.groupBy(*keys).agg(F.max_by(F.struct("seq", "angle", "distance", "scan"), F.col("seq")).alias("e"))
                       .select(*keys, "e.*"), force=True)
    heads = ends.select(*keys, F.col("scan").alias("head"))
    sums = materialize(sums.join(heads, keys), force=True)
    open_ = sums.filter("scan = head").select(*keys, F.col("s").alias("open_sum"), F.col("n").alias("open_n"))
    new = ends.join(open_, keys, "left").na.fill({"open_sum": 0.0, "open_n": 0})
    at.leave(segments=segments, totals=sums.filter("scan < head").select(*keys, "scan", F.col("s").alias("distance")),
             late=late.select(*keys, "seq", "angle", "distance"), state=new.select(*keys, *[c.split()[0] for c in _LIDAR_STATE.split(", ")]))
    at.forget("state")


def start_lidar_totals(readings: DataFrame, path: str, checkpoint: str, key_cols: Sequence[str] = (),
                       bucket_width: int = DEFAULT_BUCKET_WIDTH, **trigger) -> StreamingQuery:
    """Quality-filtered readings ``seq, angle, distance`` (and ``key_cols``) into the tables ``segments`` (scan, seq,
    distance), ``totals`` (scan, distance of each rotation once a later one has begun) and ``late`` (readings at or behind
    their scanner's last one of earlier micro-batches, set aside). Readings of one micro-batch may come in any order."""
    return start(readings, path, checkpoint, lambda b, at: lidar_step(b, at, key_cols, bucket_width), **trigger)


def lidar_totals(spark: SparkSession, path: str, key_ddl: str = "", with_open: bool = False) -> DataFrame:
    """``totals`` so far; ``with_open`` adds the rotations that are still open (what the batch chain reports last)."""
    keys = [c.split()[0] for c in key_ddl.split(", ") if c] or [LOG]
    ddl = key_ddl + ", " if key_ddl else f"{LOG} int, "
    out = table(spark, path, "totals", ddl + "scan long, distance double")
    if with_open:
        states = spark.read.schema(ddl + _LIDAR_STATE + ", batch long").parquet(f"{path}/state")
        newest = states.filter(F.col("batch") == states.select(F.max("batch")).scalar()).filter("open_n > 0")
        out = out.unionByName(newest.select(*keys, "scan", F.col("open_sum").alias("distance")))
    return out if key_ddl else out.drop(LOG)


# ---------------------------------------------------------------- anchored means with idle rows

_OPEN = "sensor_id int, b long, total double, n long, first long, last long"
_MEAN = "sensor_id int, batch_start_ms long, avg_speed_kmh double, window_start_ms long, window_end_ms long"
_META = "origin long, closed long"


def anchored_step(events: DataFrame, at: Carried, width_ms: int = 10_000, flush: bool = False) -> None:
    spark = at.spark
    rows = materialize(events.select("sensor_id", F.unix_millis("ts").alias("ms"), "speed_ms"), force=True)
    meta = at.before("meta", _META).first()
    origin = meta["origin"] if meta else rows.agg(F.min("ms")).first()[0]
    closed = meta["closed"] if meta else -1
    if origin is None:
        at.leave(means=spark.createDataFrame([], _MEAN), late=rows, meta=at.before("meta", _META), open=at.before("open", _OPEN),
                 seen=at.before("seen", "sensor_id int, b long"))
        return
    b = F.floor((F.col("ms") - F.lit(origin)) / F.lit(width_ms)).cast("long")
    rows = rows.withColumn("b", b)
    now = rows.filter(F.col("b") > closed).groupBy("sensor_id", "b").agg(
        F.sum("speed_ms").alias("total"), F.count("*").alias("n"), F.min("ms").alias("first"), F.max("ms").alias("last"))
    both = now.unionByName(at.before("open", _OPEN)).groupBy("sensor_id", "b").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    both = materialize(both, force=True)
    head = both.agg(F.max("b")).first()[0]
    head = closed if head is None else head + 1 if flush else head
    done = both.filter(F.col("b") < head)
    # sensors of each closed batch, and of the last one closed before, against the next batch that has any event
    seen = at.before("seen", "sensor_id int, b long").unionByName(done.select("sensor_id", "b"))
    steps = seen.select("b").distinct().select("b", F.lead("b").over(Window.orderBy("b")).alias("next"))  # a row for each closed batch
    idle = seen.join(steps.filter("next IS NOT NULL"), "b").select("sensor_id", F.col("next").alias("b"))
    idle = idle.join(done.select("sensor_id", "b"), ["sensor_id", "b"], "left_anti")
    none = F.lit(None).cast("long")
    begin = (F.lit(origin) + F.col("b") * width_ms).alias("batch_start_ms")
    means = done.select("sensor_id", begin, (F.col("total") / F.col("n") * 3.6).alias("avg_speed_kmh"),
                        F.col("first").alias("window_start_ms"), F.col("last").alias("window_end_ms"))
    means = means.unionByName(idle.select("sensor_id", begin, F.lit(0.0).alias("avg_speed_kmh"), none.alias("window_start_ms"),
                                          none.alias("window_end_ms")))
    newest = max(closed, done.agg(F.max("b")).first()[0] or closed) if head > closed else closed
    last = seen.filter(F.col("b") == seen.select(F.max("b")).scalar())
    at.leave(means=means, late=rows.filter(F.col("b") <= closed).drop("b"), open=both.filter(F.col("b") >= head),
             seen=last, meta=spark.createDataFrame([(origin, max(newest, head - 1))], _META))
    at.forget("open", "seen", "meta")


def start_anchored_averages(events: DataFrame, path: str, checkpoint: str, width_ms: int = 10_000, **trigger) -> StreamingQuery:
    """Events ``sensor_id, ts, speed_ms`` into the table ``means``: one row for each sensor and batch with events, and a zero
    row for each sensor of the batch with events before that has none. Batches are anchored at the least instant of the
    first micro-batch with events; one is closed, and written, when an event of a later one has come. Events of closed
    batches, and those before the anchor, go to ``late``."""
    return start(events, path, checkpoint, lambda b, at: anchored_step(b, at, width_ms), **trigger)


def anchored_means(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "means", _MEAN)


def close_anchored(spark: SparkSession, path: str, width_ms: int = 10_000) -> None:
    """Closes the open batches of a stream that has ended; a micro-batch of its own, after the last."""
    states = spark.read.schema(_META + ", batch long").parquet(f"{path}/meta")
    number = states.agg(F.max("batch")).first()[0] + 1
    none = spark.createDataFrame([], "sensor_id int, ts timestamp, speed_ms double")
    anchored_step(none, Carried(spark, path, number), width_ms, flush=True)

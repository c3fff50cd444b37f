"""Streams with a carried state: stream = batch, replays, late rows."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from keelson.operators import lidar as ld, traffic as tr
from keelson.plans import views as V
from keelson.streaming import carried

LIDAR = "seq long, angle double, distance double, scanner int"


def r6(rows):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)


def batches(spark, path, rows, schema, cuts):
    for a, b in zip(cuts, cuts[1:]):
        part = rows[a:b]
        random.Random(a).shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("keys", [[], ["scanner"]])
def test_lidar_stream_equals_batch(spark, keys):
    root, rnd = tempfile.mkdtemp(prefix="carried-"), random.Random(len(keys))
    rows = [(i, rnd.choice([-5.0, 0.0, 10.0, 90.0, 180.0, 270.0]), rnd.uniform(0, 9), rnd.choice([0, 0, 0, 1, 2])) for i in range(400)]
    rows[170] = (170, -3.0, 1.0, 2)
    batches(spark, f"{root}/in", rows, LIDAR, [0, 3, 90, 91, 171, 300, 400])
    batches(spark, f"{root}/in", [(5, 1.0, 1.0, 0), (399, 2.0, 2.0, rows[399][3])], LIDAR, [0, 2])  # late
    boom = [2, 4]
    step = carried.lidar_step

    def fails(df, at):
        step(df, at, keys, 16)
        if at.batch in boom:  # after everything is written: the batch is run again
            boom.remove(at.batch)
            raise RuntimeError("lost")

    stream = spark.readStream.schema(LIDAR).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    for _ in range(3):
        q = carried.start(stream, f"{root}/out", f"{root}/checkpoint", fails)
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost" in str(e)
    df = spark.createDataFrame(rows, LIDAR)
    points = ld.scan_points(df, keys)
    want = ld.segments_of(points, keys)
    ddl = "scanner int" if keys else ""
    got = carried.lidar_totals(spark, f"{root}/out", ddl, with_open=True)
    assert r6(got.collect()) == r6(ld.scan_total_distance(want, keys).select(got.columns).collect())
    seg = carried.table(spark, f"{root}/out", "segments", f"{keys[0] if keys else '_log'} int, scan long, seq long, distance double")
    cols = [*keys, "scan", "seq", "distance"]
    assert r6(seg.select(cols).collect()) == r6(want.select(cols).collect())
    late = carried.table(spark, f"{root}/out", "late", "seq long, angle double, distance double")
    assert sorted(r.seq for r in late.collect()) == [5, 399]
    assert len(os.listdir(f"{root}/out/state")) <= 2  # old states are gone


def test_lidar_stream_spreads_an_unkeyed_log(spark):
    """No window of a micro-batch holds more than a bucket."""
    root = tempfile.mkdtemp(prefix="buckets-")
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 360).cast("double").alias("angle"), F.lit(1.0).alias("distance"))
    seen, keep = [], carried.scan_points
    carried.scan_points = lambda d, k, bucket_width: seen.append((d, k, bucket_width)) or keep(d, k, bucket_width=bucket_width)
    try:
        carried.lidar_step(df, carried.Carried(spark, f"{root}/out", 0), bucket_width=64)
    finally:
        carried.scan_points = keep
    assert seen[0][1] == [carried.LOG] and seen[0][2] == 64
    plan = keep(seen[0][0], [carried.LOG], bucket_width=64)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x and "_chg" in x]
    assert windows and all("_bkt" in x for x in windows)
    assert carried.lidar_totals(spark, f"{root}/out", with_open=True).count() == 3


def test_anchored_stream_with_idle_rows_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="anchored-")
    ev = V.traffic(V.events(spark, "/root/testdata/sf0.001")).filter("sensor_id < 3 OR seq % 90 < 9").filter("seq % 200 < 120")
    rows = [tuple(r) for r in ev.select("sensor_id", "ts", "speed_ms").orderBy("seq").collect()]
    schema = "sensor_id int, ts timestamp, speed_ms double"
    batches(spark, f"{root}/in", rows, schema, [0, 40, 41, 200, 330, len(rows)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    boom, step = [1, 3], carried.anchored_step

    def fails(df, at):
        step(df, at)
        if at.batch in boom:
            boom.remove(at.batch)
            raise RuntimeError("lost")

    for _ in range(3):
        q = carried.start(stream, f"{root}/out", f"{root}/checkpoint", fails)
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost" in str(e)
    carried.close_anchored(spark, f"{root}/out")
    want = tr.anchored_batch_avg_speed(spark.createDataFrame(rows, schema).withColumn("seq", F.lit(0)), with_idle=True)
    got = carried.anchored_means(spark, f"{root}/out")
    assert want.filter("window_start_ms IS NULL").count() > 5
    key = lambda d: sorted((r.sensor_id, r.batch_start_ms, round(r.avg_speed_kmh, 6), r.window_start_ms or 0, r.window_end_ms or 0) for r in d.collect())
    assert key(got) == key(want)
    late = spark.createDataFrame([rows[0]], schema)
    n = max(int(x[6:]) for x in os.listdir(f"{root}/out/meta"))
    carried.anchored_step(late, carried.Carried(spark, f"{root}/out", n + 1))
    assert carried.table(spark, f"{root}/out", "late", "sensor_id int, ms long, speed_ms double").count() == 1
    assert key(carried.anchored_means(spark, f"{root}/out")) == key(want)

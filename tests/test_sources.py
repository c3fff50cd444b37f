"""Topic log, ordered text reading and sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from keelson.operators import routing
from keelson.plans import views as V
from keelson.sources import topics


def test_text_lines_keep_file_order(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    lines = [f'{{"winkel": {a}, "distanz": 1.0, "qualitaet": 20}}' for a in (10, 20, 5, 7, 1)]
    with open(os.path.join(d, "scan.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    df = topics.read_lidar_scans(spark, d)
    assert [r.angle for r in df.orderBy("seq").collect()] == [10.0, 20.0, 5.0, 7.0, 1.0]
    again = topics.read_lidar_scans(spark, d)
    assert [r.seq for r in df.orderBy("seq").collect()] == [r.seq for r in again.orderBy("seq").collect()]


def test_traffic_file_as_records(spark):
    d = tempfile.mkdtemp(prefix="traffic-")
    with open(os.path.join(d, "t.txt"), "w") as f:
        f.write("2025-10-03T05:22:40.000Z 7 10\nbad line\n")
    recs = topics.read_traffic_file(spark, d).orderBy("offset").collect()
    assert recs[0].timestamp is not None and recs[1].timestamp is None


def test_topic_log_roundtrip_and_dual_sink(spark):
    root = tempfile.mkdtemp(prefix="log-")
    lines = V.traffic_lines(V.events(spark, "/root/testdata/sf0.001"))
    topics.write_topic(lines, root, "traffic-data", files=3)
    back = topics.read_topic(spark, root, "traffic-data")
    assert back.count() == 1000
    assert topics.topic_end(spark, root, "traffic-data").first().next_offset == 1000
    out = os.path.join(root, "routed")
    topics.dual_sink(routing.route_traffic(back), out)
    routed = spark.read.parquet(out)
    assert {r.route for r in routed.select("route").distinct().collect()} == {"OUT", "BAD"}
    assert routed.count() == 1000


def test_as_records_and_windowed_sink(spark):
    root = tempfile.mkdtemp(prefix="win-")
    t = V.traffic(V.events(spark, "/root/testdata/sf0.001"))
    rec = topics.as_records(t.withColumn("value", F.col("speed_ms").cast("string")), "x", ts_col="ts", order_col="seq")
    assert rec.columns == topics.TOPIC_COLS and rec.filter("timestamp IS NULL").count() == 0
    from keelson.functions import formats
    from keelson.operators import traffic as tr
    avgs = tr.tumbling_avg_speed(t)
    txt = avgs.select(F.col("window_start_ms").alias("window_start"),
                      formats.format_average("window_start_ms", "window_end_ms", "sensor_id", "avg_speed_kmh").alias("line"))
    topics.windowed_text_sink(txt, os.path.join(root, "avg"))
    windows = [p for p in os.listdir(os.path.join(root, "avg")) if p.startswith("window_start=")]
    assert len(windows) == avgs.select("window_start_ms").distinct().count()
    back = spark.read.text(os.path.join(root, "avg"))
    assert back.count() == avgs.count()
    assert back.first().value.startswith("[2025-10-03T")


def test_publish_continues_offsets(spark):
    root = tempfile.mkdtemp(prefix="pub-")
    df = spark.createDataFrame([(i, f"line {i}") for i in range(5)], "i long, value string")
    topics.publish(df, root, "t", order_col="i")
    topics.publish(df, root, "t", order_col="i")
    offs = sorted(r.offset for r in topics.read_topic(spark, root, "t").collect())
    assert offs == list(range(10))
    import pytest
    with pytest.raises(RuntimeError):
        topics.read_topic(spark, root, "t", kafka_servers="localhost:9092")


def test_text_line_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="splits-")
    n = 5000
    with open(os.path.join(d, "big.txt"), "w") as f:
        for i in range(n):
            f.write(f"line-{i:06d}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = topics.read_text_lines(spark, d)
        assert df.rdd.getNumPartitions() > 5
        got = [r.value for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"line-{i:06d}" for i in range(n)]


def test_blueprint_named_sources_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="named-")
    df = spark.createDataFrame([(1, "a", "2025-10-03 05:22:40"), (2, "b", "2025-10-03 05:22:41")],
                               "seq long, value string, t string").withColumn("ts", F.to_timestamp("t"))
    topics.topic_sink(df, root, "plain")
    topics.topic_sink_with_event_time(df, root, "timed", ts_col="ts")
    assert sorted(r.value for r in topics.topic_source(spark, root, "plain").collect()) == ["a", "b"]
    timed = topics.topic_source(spark, root, "timed").orderBy("value").collect()
    assert [str(r.timestamp) for r in timed] == ["2025-10-03 05:22:40", "2025-10-03 05:22:41"]
    assert topics.topic_source_committed(spark, root, "plain").isStreaming


def test_windowed_shards_as_spark_lays_them_out(spark):
    """Folders, lines and nulls are those of ``partitionBy().text``, without a checksum file (and its processes) for each shard."""
    root = tempfile.mkdtemp(prefix="shards-")
    rows = [(w, f"{w} é {i}") for i, w in enumerate(["5", "2025-10-03 05:22:40", "a/b=c%d", "", None, "5"])] + [("5", None), ("5", "")]
    rows += [(str(100 + i % 700), f"l{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "w string, line string").repartition(7)
    ours, spark_s = os.path.join(root, "ours"), os.path.join(root, "spark")
    for times in (1, 2):
        topics.windowed_text_sink(df, ours, "w")
        df.select("w", F.col("line").alias("value")).repartition("w").write.mode("append").partitionBy("w").text(spark_s)

        def tree(path):
            out = {}
            for d in os.listdir(path):
                if not os.path.isdir(os.path.join(path, d)):
                    continue
                files = [f for f in os.listdir(os.path.join(path, d)) if not f.startswith(".")]
                # null and empty windows share a folder
                assert (len(files) == times or "__HIVE" in d) and all(f.startswith("part-") and f.endswith(".txt") for f in files)
                lines = []
                for f in files:
                    with open(os.path.join(path, d, f), encoding="utf-8") as h:
                        lines += h.read().split("\n")[:-1]
                out[d] = sorted(lines)
            return out
        assert tree(ours) == tree(spark_s) and not os.path.exists(os.path.join(ours, "_temporary"))
        back = topics.read_windowed_text(spark, ours, "w", "string")
        want = [(w or None, line or "") for w, line in rows] * times
        assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((line, w)) for w, line in want)
    assert not [f for _, _, fs in os.walk(ours) for f in fs if f.endswith(".crc")]


def test_failed_windowed_sink_leaves_no_shard(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shards-"), "avg")
    bad = spark.range(100).select(F.col("id").alias("w"), F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("line"))
    import pytest
    with pytest.raises(Exception, match="lost"):
        topics.windowed_text_sink(bad, path, "w")
    assert not os.path.exists(path) or not os.listdir(path)
    topics.windowed_text_sink(bad.filter("id < 0"), path, "w")
    assert topics.read_windowed_text(spark, path, "w").count() == 0

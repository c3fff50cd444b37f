"""Dense numbering, the committed topic log and line numbers."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from keelson.plans.numbering import numbered
from keelson.sources import commitlog, topics


def rows_of(rnd, n):
    return [(rnd.choice([None, 1, 1, 1, 2, rnd.randint(3, 50)]), rnd.choice("ab"), f"v{rnd.randint(0, 5)}") for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_numbers_are_dense_ordered_and_stable(spark, seed):
    rnd = random.Random(seed)
    rows = rows_of(rnd, rnd.choice([0, 1, 7, 300]))
    seen = []
    for parts, ranges in ((1, 1), (4, 3), (7, 16)):
        df = spark.createDataFrame(rows, "o long, k string, v string").repartition(parts)
        got = [tuple(r) for r in numbered(df, ["o"], ["k"], "n", ranges).collect()]
        seen.append(sorted(got, key=str))
        for k in {r[1] for r in rows}:
            mine = sorted((r for r in got if r[1] == k), key=lambda r: r[3])
            assert [r[3] for r in mine] == list(range(sum(r[1] == k for r in rows)))
            assert [-1 if r[0] is None else r[0] for r in mine] == sorted(-1 if r[0] is None else r[0] for r in mine)
        assert sorted((r[:3] for r in got), key=str) == sorted(rows, key=str)
    assert seen[0] == seen[1] == seen[2]


def test_hot_value_is_cut_into_ranges(spark):
    df = spark.range(4000).select(F.lit(5).alias("o"), F.lit("same").alias("v"))
    from keelson.plans import numbering
    held = {}
    keep, numbering.materialize = numbering.materialize, lambda d, force: held.setdefault("cut", keep(d, force))
    try:
        got = sorted(r.number for r in numbered(df, ["o"], ranges=8).collect())
    finally:
        numbering.materialize = keep
    assert got == list(range(4000))
    assert held["cut"].groupBy("_range").count().agg(F.max("count")).first()[0] < 2000


def records(spark, values, **cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, value string")
    return df.select("i", "value", F.lit(None).cast("string").alias("key"), F.lit("2025-01-01 00:00:00").cast("timestamp").alias("timestamp"))


def test_appenders_never_share_offsets_and_failed_ones_stay_invisible(spark):
    root = tempfile.mkdtemp(prefix="log-")
    first = records(spark, [f"a{i}" for i in range(30)])
    # a second appender commits while the first has written its data but not claimed its offsets
    other = lambda: commitlog.append(records(spark, [f"b{i}" for i in range(20)]), root, "t", "i")
    assert commitlog.append(first, root, "t", "i", commit_id="one", before_claim=other) == {0: (20, 30)}
    got = [(r.offset, r.value) for r in topics.read_topic(spark, root, "t").orderBy("offset").collect()]
    assert got == [(i, f"b{i}") for i in range(20)] + [(20 + i, f"a{i}") for i in range(30)]
    # the number is taken between reading the end and the rename: the claim fails and nothing is overwritten
    assert not commitlog._claim(spark, os.path.join(root, "t", "_commits"), 1, {"number": 1})
    assert commitlog.append(first, root, "t", "i", commit_id="one") == {0: (20, 30)}  # a retry does nothing

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        commitlog.append(first, root, "t", "i", commit_id="two", before_claim=fail)
    assert topics.read_topic(spark, root, "t").count() == 50
    assert commitlog.append(first, root, "t", "i", commit_id="two") == {0: (50, 30)}
    assert topics.topic_end(spark, root, "t").first().next_offset == 80
    assert topics.read_topic(spark, root, "t").select("offset").distinct().count() == 80
    commitlog.append(first.limit(0), root, "t", "i")
    assert topics.topic_end(spark, root, "t").first().next_offset == 80


def test_several_partitions_are_dense_and_in_order(spark):
    root = tempfile.mkdtemp(prefix="parts-")
    df = spark.createDataFrame([(i, f"v{i}", None if i % 3 else f"k{i % 6}") for i in range(100)], "i long, value string, k string").repartition(5)
    for _ in range(2):
        topics.publish(df, root, "t", order_col="i", partitions=4, key_col="k")
    rows = topics.read_topic(spark, root, "t").collect()
    assert len(rows) == 200 and len({r.partition for r in rows if r.key == "k0"}) == 1
    for p in {r.partition for r in rows}:
        mine = sorted((r for r in rows if r.partition == p), key=lambda r: r.offset)
        assert [r.offset for r in mine] == list(range(len(mine)))
        half = [int(r.value[1:]) for r in mine][:len(mine) // 2]
        assert half == sorted(half)


def test_stream_reads_committed_records_in_bounded_batches_and_resumes(spark):
    root, out = tempfile.mkdtemp(prefix="poll-"), tempfile.mkdtemp(prefix="out-")
    checkpoint = os.path.join(out, "checkpoint")
    for n in range(3):
        commitlog.append(records(spark, [f"c{n}-{i}" for i in range(70)]), root, "t", "i", partitions=2 if n == 1 else 1)

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        commitlog.append(records(spark, ["hidden"] * 9), root, "t", "i", before_claim=fail)
    sizes, boom = [], [2]

    def run():
        def sink(batch, number):
            sizes.append(batch.count())
            batch.write.mode("overwrite").parquet(os.path.join(out, f"data/batch={number}"))
            if number in boom:
                boom.remove(number)
                raise RuntimeError("stopped after its data was written")

        stream = topics.topic_source_committed(spark, root, "t", max_per_trigger=40, checkpoint=checkpoint)
        q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    with pytest.raises(Exception, match="stopped"):
        run()
    run()
    commitlog.append(records(spark, [f"d{i}" for i in range(95)]), root, "t", "i")
    run()
    got = spark.read.parquet(os.path.join(out, "data"))
    assert max(sizes) == 40 and got.count() == 305 and got.select("value").distinct().count() == 305
    assert got.select("partition", "offset").distinct().count() == 305
    want = sorted((r.partition, r.offset, r.value, str(r.timestamp)) for r in topics.read_topic(spark, root, "t").collect())
    assert sorted((r.partition, r.offset, r.value, str(r.timestamp)) for r in got.collect()) == want


def test_stream_into_a_topic_commits_each_batch_once(spark):
    root = tempfile.mkdtemp(prefix="into-")
    src = os.path.join(root, "src")
    for n in range(3):
        records(spark, [f"s{n}-{i}" for i in range(10)]).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("i long, value string, key string, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    for checkpoint in ("a", "a", "b"):  # started again, and from a lost checkpoint: the commit ids are known
        commitlog.start_append(stream, root, "t", os.path.join(root, checkpoint), "copy", "i").awaitTermination()
    rows = topics.read_topic(spark, root, "t").collect()
    assert sorted(r.offset for r in rows) == list(range(30)) and len({r.value for r in rows}) == 30


def test_line_numbers_do_not_depend_on_splits(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    want = []
    for name, n in (("b.txt", 900), ("a.txt", 2500), ("c.txt", 1)):
        lines = [f"{name} {i} " + "x" * (i % 37) for i in range(n)]
        lines[n // 2] = ""
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
        want += [(name, i, v) for i, v in enumerate(lines)]
    open(os.path.join(d, "empty.txt"), "w").close()
    order = {x[:2]: n for n, x in enumerate(sorted(want, key=lambda x: x[:2]))}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "10k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = [(os.path.basename(r.file), r.seq, r.line, r.value) for r in topics.text_lines(spark, d).collect()]
            assert sorted(got) == sorted((f, i, order[f, i], v) for f, i, v in want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    offsets = [r.offset for r in topics.traffic_line_source(spark, d).collect()]
    assert sorted(offsets) == list(range(len(want)))

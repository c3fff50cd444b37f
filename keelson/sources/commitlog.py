"""Topics as a committed log of Parquet files.

An append writes its records under ``<topic>/data/batch=<commit id>`` with their places in the append (dense in each
partition), then claims the next number of ``<topic>/_commits`` with a manifest: the batch, and for each partition its
count and the offset its places begin at, the end of the manifest before. A claim is a rename that fails when the number is
taken; the appender then reads the new end and claims the next number, its written data stays as it is. So offsets are
dense, two appenders never share one, and a batch without a manifest (a failed append) is invisible. An append repeated
under its commit id (a retry, or a micro-batch run again) finds its manifest and does nothing.

``CommittedTopic`` is the streaming reader: a micro-batch is a range of at most ``limit`` records of committed manifests.
Its files are read with pyarrow's file systems (local and mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from keelson.plans.numbering import numbered
from keelson.session import path_exists

MANIFEST = "number long, commit_id string, topic string, parts array<struct<partition:int,base:long,count:long>>"
ROW = "key string, value string, partition int, place long, timestamp timestamp"
TOPIC = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def _commits(root: str, topic: str) -> str:
    return os.path.join(root, topic, "_commits")


def has_commits(spark: SparkSession, root: str, topic: str) -> bool:
    return path_exists(spark, _commits(root, topic))


def manifests(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """number, commit_id, topic, parts: a row for each commit."""
    if not has_commits(spark, root, topic):
        return spark.createDataFrame([], MANIFEST)
    # one by one, or the reader hides paths that begin with an underscore
    return spark.read.schema(MANIFEST).json(os.path.join(_commits(root, topic), "*.json"))


def ends(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """partition, next_offset: where the next append begins."""
    parts = manifests(spark, root, topic).select(F.inline("parts"))
    return parts.groupBy("partition").agg(F.max(F.col("base") + F.col("count")).alias("next_offset"))


def read(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The committed records (batch), in the topic layout."""
    commits = manifests(spark, root, topic)
    if not path_exists(spark, os.path.join(root, topic, "data")):
        return spark.createDataFrame([], TOPIC)
    rows = spark.read.schema(ROW + ", batch string").parquet(os.path.join(root, topic, "data"))
    parts = commits.select(F.col("commit_id").alias("batch"), F.inline("parts")).select("batch", "partition", "base")
    return rows.join(parts, ["batch", "partition"]).select(
        "key", "value", F.lit(topic).alias("topic"), "partition", (F.col("base") + F.col("place")).alias("offset"), "timestamp")


def _claim(spark: SparkSession, folder: str, number: int, manifest: dict) -> bool:
    """Publishes the manifest under ``number``; False when the number is taken."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    path = jvm.org.apache.hadoop.fs.Path
    final, draft = path(f"{folder}/{number:020d}.json"), path(f"{folder}/.{uuid.uuid4().hex}.draft")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs = draft.getFileSystem(conf)
    out = fs.create(draft, True)
    out.write(bytearray((json.dumps(manifest) + "\n").encode("utf-8")))
    out.close()
    try:
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        files.rename(draft, final, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))  # never over a file
        return True
    except Exception as e:
        if not fs.exists(final):
            raise e
        return False
    finally:
        fs.delete(draft, False)


def append(records: DataFrame, root: str, topic: str, order_col: str | None = None, partitions: int = 1,
           commit_id: str | None = None, before_claim=None) -> dict[int, tuple[int, int]]:
    """Appends ``key, value, timestamp`` (and ``order_col``) as one commit; returns partition -> (first offset, count).

    Offsets follow ``order_col`` (ties by the rows' hashes), or else the rows as they come. With several partitions a
    record's partition is its key's hash, or its place in the order where it has no key, so that each partition is in
    order. ``before_claim`` is called when the data is written but not yet visible."""
    spark, commit_id = records.sparkSession, commit_id or uuid.uuid4().hex
    folder = _commits(root, topic)
    done = manifests(spark, root, topic).filter(F.col("commit_id") == commit_id).first()
    if done:
        return {p["partition"]: (p["base"], p["count"]) for p in done["parts"]}
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    rows = records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          F.col("timestamp").cast("timestamp").alias("timestamp"), order.alias("_order"))
    rows = numbered(rows, ["_order"], out="place")
    if partitions > 1:
        by_key = F.pmod(F.xxhash64("key"), F.lit(partitions))
        rows = rows.withColumn("partition", F.when(F.col("key").isNull(), F.col("place") % partitions).otherwise(by_key).cast("int"))
        rows = numbered(rows.drop("_order").withColumnRenamed("place", "_order"), ["_order"], ["partition"], "place")
    else:
        rows = rows.withColumn("partition", F.lit(0))
    path = os.path.join(root, topic, "data", f"batch={commit_id}")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.select("key", "value", "partition", "place", "timestamp").repartitionByRange(files, "partition", "place")
     .sortWithinPartitions("partition", "place").write.mode("overwrite").parquet(path))
    counts = {r["partition"]: r["n"] for r in spark.read.schema(ROW).parquet(path).groupBy("partition")
              .agg(F.count("*").alias("n")).collect()}  # a row for each partition
    if before_claim:
        before_claim()
    while True:
        base = {r["partition"]: r["next_offset"] for r in ends(spark, root, topic).collect()}
        number = manifests(spark, root, topic).agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        parts = [{"partition": p, "base": base.get(p, 0), "count": n} for p, n in sorted(counts.items())]
        if _claim(spark, folder, number, {"number": number, "commit_id": commit_id, "topic": topic, "parts": parts}):
            return {p["partition"]: (p["base"], p["count"]) for p in parts}


# ---------------------------------------------------------------- streaming

class _Range(InputPartition):
    def __init__(self, batch: str, partition: int, base: int, start: int, stop: int):
        self.batch, self.partition, self.base, self.start, self.stop = batch, partition, base, start, stop


class _Reader(DataSourceStreamReader):
    """An offset is {"commit": n, "taken": k}: all commits before n, and k records of commit n (its partitions one after the
    other, each in order). Numbers have no gaps, so the next manifest is known by its name."""

    def __init__(self, options):
        self.root, self.topic = options["root"], options["topic"]
        self.limit = int(options.get("limit", "500"))
        self.at = json.loads(options["resume"]) if options.get("resume") else None
        self.known: dict[int, dict] = {}

    def _manifest(self, number: int) -> dict | None:
        if number not in self.known:
            from pyarrow import fs

            files, path = _file_system(self.root)
            try:
                with files.open_input_file(f"{path}/{self.topic}/_commits/{number:020d}.json") as f:
                    self.known[number] = json.loads(f.read())
            except FileNotFoundError:
                return None
        return self.known[number]

    def _next(self, at: dict) -> dict:
        """The offset at most ``limit`` records further."""
        commit, taken, room = at["commit"], at["taken"], self.limit
        while room and (m := self._manifest(commit)) is not None:
            total = sum(p["count"] for p in m["parts"])
            step = min(room, total - taken)
            taken, room = taken + step, room - step
            if taken == total:
                commit, taken = commit + 1, 0
        return {"commit": commit, "taken": taken}

    def initialOffset(self) -> dict:
        return {"commit": 0, "taken": 0}

    def latestOffset(self) -> dict:
        self.at = self._next(self.at or self.initialOffset())
        return self.at

    def _seen(self, offset: dict) -> None:
        here = self.at or self.initialOffset()
        if (offset["commit"], offset["taken"]) > (here["commit"], here["taken"]):
            self.at = offset

    def commit(self, end: dict) -> None:
        self._seen(end)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._seen(end)
        out = []
        for number in range(start["commit"], end["commit"] + 1):
            lo = start["taken"] if number == start["commit"] else 0
            hi = end["taken"] if number == end["commit"] else None
            if hi == 0 or (m := self._manifest(number)) is None:
                continue
            before = 0
            for p in m["parts"]:
                a, b = max(lo - before, 0), min(p["count"], p["count"] if hi is None else hi - before)
                if a < b:
                    out.append(_Range(m["commit_id"], p["partition"], p["base"], a, b))
                before += p["count"]
        return out or [_Range("", 0, 0, 0, 0)]

    def read(self, part: _Range) -> Iterator:
        if part.start >= part.stop:
            return
        import pyarrow as pa
        import pyarrow.dataset as ds

        files, path = _file_system(self.root)
        data = ds.dataset(f"{path}/{self.topic}/data/batch={part.batch}", filesystem=files, format="parquet")
        place = ds.field("place")
        rows = data.to_table(filter=(ds.field("partition") == part.partition) & (place >= part.start) & (place < part.stop)).sort_by("place")
        n = rows.num_rows
        offset = pa.array([part.base + x for x in rows.column("place").to_pylist()], pa.int64())
        times = rows.column("timestamp").cast(pa.timestamp("us", "UTC"))
        yield from pa.table([rows.column("key"), rows.column("value"), pa.array([self.topic] * n, pa.string()), rows.column("partition"),
                             offset, times], names=["key", "value", "topic", "partition", "offset", "timestamp"]).to_batches()


def _file_system(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(root))


class CommittedTopic(DataSource):
    """Streaming source of a committed topic: options root, topic, limit (records of a micro-batch), resume (the end
    offset last planned in the query's checkpoint)."""

    @classmethod
    def name(cls) -> str:
        return "committed_topic"

    def schema(self) -> str:
        return TOPIC

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def planned_end(spark: SparkSession, checkpoint: str) -> str | None:
    """The end offset (JSON) of the last micro-batch planned in a checkpoint of a query with this source alone."""
    if not path_exists(spark, os.path.join(checkpoint, "offsets")):
        return None
    logs = spark.read.text(os.path.join(checkpoint, "offsets"), wholetext=True)
    number = F.regexp_extract("_metadata.file_name", r"^(\d+)$", 1)
    last = logs.filter(number != "").orderBy(number.cast("long").desc()).first()
    return last["value"].strip().split("\n")[2] if last else None  # version, query metadata, then a line for each source


def read_stream(spark: SparkSession, root: str, topic: str, limit: int = 500, checkpoint: str | None = None) -> DataFrame:
    """Committed records from the earliest offset, at most ``limit`` a micro-batch. A query that is started again must name
    its ``checkpoint`` here: the source is not told where a restarted query stands before it plans the next range."""
    spark.dataSource.register(CommittedTopic)
    r = spark.readStream.format("committed_topic").option("root", root).option("topic", topic).option("limit", str(limit))
    resume = planned_end(spark, checkpoint) if checkpoint else None
    return (r.option("resume", resume) if resume else r).load()


def start_append(records: DataFrame, root: str, topic: str, checkpoint: str, query: str, order_col: str | None = None,
                 partitions: int = 1, **trigger):
    """A stream (``key, value, timestamp``) into a topic: each micro-batch is a commit named by the query and its number."""
    def write(batch, number):
        append(batch, root, topic, order_col, partitions, f"{query}-{number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

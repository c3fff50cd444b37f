"""Snapshot admission as a stream: each micro-batch of pending commands is judged against the
read model left by all earlier batches (the stale-read semantics of a command handler that reads
the read side), and the commands it emits are appended to the command log.

The read model is kept as a snapshot table of history rows, one partition per batch:
batch ``N`` reads the latest snapshot below ``N``, judges its commands against it, and writes
its verdicts, its emitted commands (the event log) and the next snapshot
(``apply_commands``: live history + this batch's commands, never the whole log) to partitions
``batch_id=N`` with dynamic partition overwrite. A batch replayed after a failure therefore reads
the same snapshot, computes the same result and overwrites its own partitions: exactly-once
without a transactional sink.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.operators.admission import admit_commands_snapshot
from keelson.operators.vehicles import apply_commands, project_vehicles
from keelson.plans.stages import materialized_mark, release_materialized
from keelson.session import path_exists

LOG_COLS = ["seq", "type", "name", "x", "y"]
HISTORY_SCHEMA = "name string, pos_idx long, x double, y double"
SUB_SEQ_SLOTS = 2  # emitted commands of one pending command: obstacle removes (0), then the move (1)


def _write_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's folder itself, so that an empty frame also leaves a readable table."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Batch ids present in a table partitioned by ``batch_id`` (a directory listing)."""
    if not path_exists(spark, path):
        return []
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    ids = []
    for st in fs.listStatus(p):
        m = re.fullmatch(r"batch_id=(-?\d+)", st.getPath().getName())
        if m and st.isDirectory():
            ids.append(int(m.group(1)))
    return ids


def snapshot_before(spark: SparkSession, snapshot_path: str, batch_id: int) -> DataFrame:
    """History rows of the read model as left by the last batch before ``batch_id``."""
    earlier = [b for b in _batches(spark, snapshot_path)
               if b < batch_id and path_exists(spark, f"{snapshot_path}/batch_id={b}/_SUCCESS")]
    if not earlier:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(f"{snapshot_path}/batch_id={max(earlier)}")


def judge_batch(pending: DataFrame, snapshot_path: str, log_path: str, verdict_path: str, batch_id: int) -> None:
    """Judge one micro-batch against the snapshot of earlier batches and record the outcome."""
    spark = pending.sparkSession
    mark = materialized_mark(spark)
    history = snapshot_before(spark, snapshot_path, batch_id)
    verdicts = admit_commands_snapshot(pending.select(*LOG_COLS), history).persist()
    try:
        _write_partition(verdicts, verdict_path, batch_id)
        emitted = verdicts.filter(F.col("type").isNotNull()).select(
            (F.col("seq") * SUB_SEQ_SLOTS + F.col("sub_seq")).alias("seq"), "type", "name", "x", "y")
        _write_partition(emitted, log_path, batch_id)
        new_history = apply_commands(history, spark.read.schema(emitted.schema).parquet(f"{log_path}/batch_id={batch_id}"))
        _write_partition(new_history.select("name", "pos_idx", "x", "y"), snapshot_path, batch_id)
    finally:
        verdicts.unpersist()
        release_materialized(spark, since=mark)  # this batch's intermediate tables


def start_snapshot_admission(pending: DataFrame, root: str, checkpoint: str,
                             initial_log: DataFrame | None = None,
                             available_now: bool = True) -> StreamingQuery:
    """Stream ``pending`` commands (``seq, type, name, x, y``) through snapshot admission.
    Tables under ``root``: ``verdicts``, ``log`` (emitted commands; ``seq * 2 + sub_seq`` keeps
    their order) and ``snapshot`` (history rows after each batch). ``initial_log`` (commands
    already applied) becomes batch ``-1`` of the log and of the snapshot."""
    snapshot_path, log_path, verdict_path = f"{root}/snapshot", f"{root}/log", f"{root}/verdicts"
    if initial_log is not None:
        start = initial_log.select((F.col("seq") * SUB_SEQ_SLOTS).alias("seq"), "type", "name", "x", "y")
        _write_partition(start, log_path, -1)
        _write_partition(project_vehicles(start), snapshot_path, -1)
    w = (pending.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: judge_batch(df, snapshot_path, log_path, verdict_path, bid)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()

"""Text shards of windows on a mounted folder: ``<path>/<column>=<value>/part-*.txt``, as ``partitionBy(column).text`` lays
them out.

A table of short windows has a shard for every few lines, so its time is the time to make and list files. Hadoop's local
file system starts two ``chmod`` processes for each file, and ``spark.read`` keeps a file status of each shard in the
driver. Here a task makes the shards of its windows under ``_temporary`` and the driver moves those of the committed
attempts into place when all are written (a failed job leaves none visible); the reader deals names of shards to the tasks.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import unquote

from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

NULL = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}  # as Spark's partition folders
BATCH = 8192  # lines handed on at once


def folder(column: str, value: str | None) -> str:
    return f"{column.translate(ESCAPED)}={value.translate(ESCAPED) if value else NULL}"


@dataclass
class _Written(WriterCommitMessage):
    attempt: str


class _Writer(DataSourceArrowWriter):
    """Rows (window, line) that come sorted by window."""

    def __init__(self, options, column: str):
        self.path, self.column, self.job = options["path"], column, uuid.uuid4().hex
        self.staging = os.path.join(self.path, "_temporary", self.job)

    def write(self, iterator: Iterator) -> _Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        mine = os.path.join(self.staging, str(task.taskAttemptId()))
        name = f"part-{task.partitionId():05d}-{self.job}.txt"
        os.makedirs(mine)
        now, out = None, None
        try:
            for b in iterator:
                rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                for window, lines in groupby(rows, key=lambda r: r[0]):
                    if out is None or window != now:
                        if out is not None:
                            out.close()
                        shard = os.path.join(mine, folder(self.column, window))
                        os.makedirs(shard, exist_ok=True)  # null and empty are one folder
                        now, out = window, open(os.path.join(shard, name), "ab")
                    out.write("".join([(line or "") + "\n" for _, line in lines]).encode("utf-8"))
        finally:
            if out is not None:
                out.close()
        return _Written(mine)

    def commit(self, messages: list) -> None:
        for m in messages:
            for name in os.listdir(m.attempt):
                shard, place = os.path.join(m.attempt, name), os.path.join(self.path, name)
                try:
                    os.rename(shard, place)
                except OSError:  # the window has shards: appended to
                    for f in os.listdir(shard):
                        os.rename(os.path.join(shard, f), os.path.join(place, f))
        self._clear()
        open(os.path.join(self.path, "_SUCCESS"), "wb").close()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
        try:
            os.rmdir(os.path.dirname(self.staging))
        except OSError:  # another job is writing, or nothing was written
            pass


class _Names(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, options, column: str):
        self.path, self.column, self.tasks = options["path"], column, int(options["tasks"])

    def partitions(self) -> list[InputPartition]:
        start = self.column.translate(ESCAPED) + "="
        names = [n for n in os.listdir(self.path) if n.startswith(start)]
        return [_Names(names[i::self.tasks]) for i in range(min(self.tasks, len(names)))] or [_Names([])]

    def read(self, partition: _Names) -> Iterator:
        import pyarrow as pa

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(windows, pa.string())], names=["value", self.column])

        values, windows = [], []
        for name in partition.names:
            window = name.partition("=")[2]
            window = None if window == NULL else unquote(window)
            with os.scandir(os.path.join(self.path, name)) as files:
                shards = [f.path for f in files if not f.name.startswith(("_", "."))]
            for shard in shards:
                with open(shard, encoding="utf-8", errors="replace") as f:
                    for line in f:
                        values.append(line.removesuffix("\n"))
                        windows.append(window)
                        if len(values) >= BATCH:
                            yield batch()
                            values, windows = [], []
        if values:
            yield batch()


class TextShards(DataSource):
    """Options path, column (of the window), tasks (of a read). Reads ``value`` and the column, both strings."""

    @classmethod
    def name(cls) -> str:
        return "text_shards"

    def schema(self) -> str:
        return f"value string, `{self.options['column']}` string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, self.options["column"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("shards are appended")
        return _Writer(self.options, self.options["column"])

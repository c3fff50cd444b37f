"""Compute things once: expensive columns within a plan, and whole inputs read twice.

``computed_once`` — Catalyst pushes a filter through a projection by substituting the projected expressions into
the filter, so a filter on a parsed column (``decode_error IS NULL``) re-runs the parser below
the projection, and the projection runs it again. Producing the columns with a one-element
``inline`` generator stops that: a filter on generator output stays above the generator, and
the parse runs once per row (the generator is part of whole-stage codegen).

``materialize`` — a DataFrame read by two branches of a plan is computed twice; inputs that are
the result of shuffles or parsing are written once to the shared checkpoint folder instead.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """``df`` plus the given columns, evaluated exactly once per row."""
    row = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select("*", F.inline(F.array(row)))


# Logical operators whose recomputation costs a shuffle, or a parse (``Generate`` is how
# ``computed_once`` runs JSON / text parsing). A plan without any of them is a scan plus cheap
# per-row work, which is cheaper to read twice than to write and read back.
_COSTLY = ("Join", "Aggregate", "Window", "Repartition", "RebalancePartitions", "Sort", "Union",
           "Expand", "Distinct", "Deduplicate", "TransformWithState", "FlatMapGroups", "MapInPandas",
           "ArrowEvalPython", "BatchEvalPython", "CoGroup", "Generate")


def _operators(df: DataFrame) -> set[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    names = set()
    for line in plan.splitlines():
        token = line.lstrip(" :+-!").split(" ", 1)[0]
        if token:
            names.add(token)
    return names


def is_costly(df: DataFrame) -> bool:
    """True when recomputing ``df`` would re-run shuffles (joins, aggregates, windows...).
    When the plan cannot be inspected (e.g. a Spark Connect client) the answer is True, so the
    caller materializes, which is always correct."""
    try:
        ops = _operators(df)
    except Exception:
        return True
    return any(op.startswith(c) for op in ops for c in _COSTLY)


# tables written by ``materialize``, per (application, thread): a job or micro-batch releases only
# what its own thread wrote
_WRITTEN: dict[tuple[str, int], list[str]] = {}


def _owner(spark) -> tuple[str, int]:
    return spark.sparkContext.applicationId, threading.get_ident()


def materialize(df: DataFrame, force: bool = False) -> DataFrame:
    """Cut lineage before ``df`` is consumed more than once.

    Spark plans are trees: a DataFrame read by two branches is computed twice unless both
    branches end in an identical exchange, which column pruning usually prevents. Two-level
    scans read their input twice, so chaining them would multiply the upstream work. Writing
    the input once as a Parquet table in the shared ``spark.checkpoint.dir``
    (``keelson.session.checkpoint_root``) keeps the cost linear, survives executor loss, and lets
    each reader scan only the columns it needs (Parquet is columnar; an RDD checkpoint is not).
    ``release_materialized`` deletes the tables of a session when its job is done.

    Skipped for streaming frames, for inputs that are only scans and per-row work (unless
    ``force``), and when the session sets ``keelson.materialize=never``."""
    from keelson.session import fresh_path

    if df.isStreaming:
        return df
    spark = df.sparkSession
    mode = spark.conf.get("keelson.materialize", "auto")
    if mode == "never" or (not force and not is_costly(df)):
        return df
    if mode == "checkpoint":
        from keelson.session import checkpoint_root
        checkpoint_root(spark)
        return df.checkpoint(eager=True)
    path = fresh_path(spark, "materialized")
    df.write.parquet(path)
    _WRITTEN.setdefault(_owner(spark), []).append(path)
    return spark.read.parquet(path)


def materialized_mark(spark) -> int:
    """A marker for ``release_materialized(spark, since=...)``: tables written from now on."""
    return len(_WRITTEN.get(_owner(spark), []))


def release_materialized(spark, since: int = 0) -> int:
    """Delete the tables ``materialize`` wrote in this thread after the ``since`` marker
    (default: all of them); returns how many were deleted."""
    written = _WRITTEN.get(_owner(spark), [])
    paths, written[since:] = written[since:], []
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)

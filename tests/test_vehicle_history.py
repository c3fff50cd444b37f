"""Exact positions, the vehicle stream with history and late commands, crowded cells."""

import random
import tempfile
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.operators import proximity, vehicles as vh
from keelson.streaming import vehicles as sv
from tests.test_streaming import _drain, _write_chunks

DDL = "seq long, type string, name string, x double, y double"


def _log(n, seed, values=(0.1, 0.2, 0.3, -0.7, 1e-7, 12345.678901, 3.0)):
    rnd = random.Random(seed)
    kinds = ["create", "move", "move", "move", "move", "move", "remove"]
    return [(i, k := rnd.choice(kinds), f"v{rnd.randrange(5)}", *((None, None) if k == "remove" else (rnd.choice(values), rnd.choice(values))))
            for i in range(n)]


def _history(rows):
    """name -> exact positions, by the sequential fold."""
    live = {}
    for _, kind, name, x, y in rows:
        if kind == "create":
            live[name] = [(Fraction(repr(x)), Fraction(repr(y)))]
        elif kind == "remove":
            live.pop(name, None)
        elif name in live:
            a, b = live[name][-1]
            live[name].append((a + Fraction(repr(x)), b + Fraction(repr(y))))
    return sorted((n, i, float(x), float(y)) for n, ps in live.items() for i, (x, y) in enumerate(ps))


def _rows(df):
    return sorted(map(tuple, df.select("name", "pos_idx", "x", "y").collect()))


@pytest.mark.parametrize("width,parts", [(1 << 18, 1), (7, 5)])
def test_positions_are_exact_for_any_partitioning(spark, width, parts):
    rows = _log(300, 1)
    cmds = spark.createDataFrame(rows, DDL).repartition(parts)
    assert _rows(vh.project_vehicles(cmds, width)) == _history(rows)
    older, newer = cmds.filter("seq < 150"), cmds.filter("seq >= 150")
    assert _rows(vh.apply_commands(vh.project_vehicles(older, width), newer, width)) == _history(rows)


def test_large_numbers_have_plain_sums(spark):
    rows = [(0, "create", "a", 1e300, 0.5), (1, "move", "a", 1.0, 0.25), (2, "create", "b", 1.0, 1.0), (3, "move", "b", 5e8, float("nan"))]
    cmds = spark.createDataFrame(rows, DDL)
    for got in (_rows(vh.project_vehicles(cmds)), _rows(sv.live_history(sv.vehicle_history_stream(cmds)))):
        assert got[:3] == [("a", 0, 1e300, 0.5), ("a", 1, 1e300, 0.75), ("b", 0, 1.0, 1.0)]
        assert got[3][2] == 500000001.0 and (got[3][3] is None or got[3][3] != got[3][3])  # NaN is null in the stream


@pytest.mark.parametrize("seed", [2, 3])
def test_history_stream_equals_read_model_and_keeps_late_commands_out(spark, seed):
    rows = _log(240, seed)
    late = [(s, "move", n, 100.0, 100.0) for s, _, n, _, _ in rows[:120:10]] + [(-1, "create", "v0", 9.0, 9.0)]
    random.Random(seed).shuffle(late)
    frame = lambda rs: pd.DataFrame(rs, columns=["seq", "type", "name", "x", "y"])
    folder = tempfile.mkdtemp(prefix="hist-")
    _write_chunks(frame(rows[:120]).sample(frac=1, random_state=1), folder, 1, stamp=0, name="a")
    _write_chunks(frame(late), folder, 1, stamp=1, name="b")
    _write_chunks(frame(rows[120:]), folder, 3, stamp=2, name="c")
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder)
    got = _drain(spark, sv.vehicle_history_stream(stream), f"hist_{seed}")
    names = {n for _, _, n, _, _ in rows[:120]}
    assert _rows(sv.live_history(got)) == _history(rows)
    assert sorted(map(tuple, sv.late_commands(got).collect())) == sorted((n, s) for s, _, n, _, _ in late if n in names)
    newest = {}
    for r in _drain(spark, sv.project_vehicles_stream(stream), f"fold_{seed}", mode="update").collect():
        if r.name not in newest or (r.last_seq or -1) >= (newest[r.name].last_seq or -1):
            newest[r.name] = r
    want = {}
    for n, i, x, y in _history(rows):
        want[n] = (x, y, i)
    assert {n: (r.x, r.y, r.moves) for n, r in newest.items() if r.live} == want


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_crowded_cells_equal_brute_force_and_are_shared(spark, keys):
    rnd = random.Random(5)
    pts = [(i, i % 2, rnd.uniform(0.0, 0.4) if i < 400 else rnd.uniform(-3, 3), rnd.uniform(0.0, 0.4) if i < 400 else rnd.uniform(-3, 3))
           for i in range(600)]
    a = spark.createDataFrame(pts, "ia int, k int, ax double, ay double")
    b = spark.createDataFrame(pts, "ib int, k int, bx double, by double")
    if not keys:
        a, b = a.drop("k"), b.drop("k")
    got = proximity.proximity_join(a, b, 0.5, ("ax", "ay"), ("bx", "by"), keys=keys, block=50)
    pairs = [(r.ia, r.ib) for r in got.collect()]
    want = {(p[0], q[0]) for p in pts for q in pts
            if (not keys or p[1] == q[1]) and ((p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2) ** 0.5 <= 0.5}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert got.columns == ["ia", *keys, "ax", "ay", "ib", "bx", "by"] or set(got.columns) == {"ia", *keys, "ax", "ay", "ib", "bx", "by"}


def test_a_crowded_cell_spreads_over_tasks(spark):
    """100,000 points in one cell against 40: the rows of the join are shared evenly among blocks."""
    a = spark.range(100_000).select(F.col("id").alias("ia"), (F.rand(1) * 0.4).alias("ax"), (F.rand(2) * 0.4).alias("ay"))
    b = spark.range(40).select(F.col("id").alias("ib"), (F.col("id") / 100).alias("bx"), F.lit(0.2).alias("by"))
    L = proximity.with_neighbour_cells(a, "ax", "ay", 0.5, "_lc")
    R = proximity.with_cell(b, "bx", "by", 0.5, "_rc")
    heavy = proximity._heavy_cells(L, R, [], 5_000)
    dealt = proximity._dealt(L, heavy, [], "_lc", "_lblock", "_lblocks", "_rblock", "_rblocks")
    sizes = [r["count"] for r in dealt.groupBy("_lcx", "_lcy", "_lblock").count().collect()]
    assert len(sizes) == 9 * 20 and max(sizes) < 5_600
    got = proximity.proximity_join(a, b, 0.5, ("ax", "ay"), ("bx", "by"), block=5_000)
    flat = a.join(F.broadcast(b), F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2) <= 0.5)
    assert got.count() == flat.count()

"""Distance range join of points as a grid equi-join.

Points are binned in square cells of side ``radius``; a pair within ``radius`` always lies in the
same or adjacent cells, so one side is replicated to its 3x3 neighbourhood (9 rows per point)
and the sides are equi-joined on ``(extra keys, cell)`` before the exact distance test. This
replaces a nested-loop join with a hash/sort-merge join whose output is the near pairs only.

Crowded cells: the ``HEAVY`` fullest cells of each side are counted; where one holds more than ``BLOCK``
rows, both sides of it are dealt to blocks by a hash of the row and meet block by block, so its pairs are
shared among tasks. Any other cell holds at most 1 in ``HEAVY`` of a side's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import geometry
from keelson.plans.stages import materialize

HEAVY, BLOCK = 4096, 20_000

_NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _cell_size(radius: float) -> float:
    # a hair above the radius so float rounding of x / size never puts a pair 2 cells apart
    return radius * (1 + 1e-9)


def _cell(x: str, size: float) -> Column:
    """Cell number, held within long range; distances are checked exactly afterwards."""
    return F.floor(F.greatest(F.least(F.col(x) / size, F.lit(4e18)), F.lit(-4e18))).cast("long")


def with_cell(df: DataFrame, x: str, y: str, radius: float, prefix: str = "_c") -> DataFrame:
    size = _cell_size(radius)
    return (df.withColumn(prefix + "x", _cell(x, size))
            .withColumn(prefix + "y", _cell(y, size)))


def with_neighbour_cells(df: DataFrame, x: str, y: str, radius: float, prefix: str = "_c") -> DataFrame:
    size = _cell_size(radius)
    cx = _cell(x, size)
    cy = _cell(y, size)
    cells = F.array(*[F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in _NEIGHBOURS])
    return (df.withColumn("_cell", F.explode(cells))
            .withColumn(prefix + "x", F.col("_cell.x")).withColumn(prefix + "y", F.col("_cell.y"))
            .drop("_cell"))


def within(lx: Column, ly: Column, rx: Column, ry: Column, radius: float, metric: str = "euclid",
           strict: bool = False) -> Column:
    if metric == "euclid":
        d = geometry.vector_distance(lx, ly, rx, ry)
        return d < radius if strict else d <= radius
    if metric == "box":
        ax, ay = F.abs(lx - rx), F.abs(ly - ry)
        return (ax < radius) & (ay < radius) if strict else (ax <= radius) & (ay <= radius)
    raise ValueError(metric)


def proximity_join(left: DataFrame, right: DataFrame, radius: float,
                   left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y"),
                   keys: Sequence[str] = (), metric: str = "euclid", strict: bool = False,
                   block: int = BLOCK) -> DataFrame:
    """All pairs of ``left`` and ``right`` rows (equal ``keys``) within ``radius``. Column names
    of the two sides must be distinct except ``keys`` (kept once)."""
    left, right = materialize(left), materialize(right)
    L = with_neighbour_cells(left, *left_xy, radius, prefix="_lc")
    R = with_cell(right, *right_xy, radius, prefix="_rc")
    heavy = _heavy_cells(L, R, list(keys), block)
    cond = [F.col("_lcx") == F.col("_rcx"), F.col("_lcy") == F.col("_rcy")]
    if heavy is not None:
        L = _dealt(L, heavy, list(keys), "_lc", "_lblock", "_lblocks", "_rblock", "_rblocks").withColumnRenamed("_rblock", "_lother")
        R = _dealt(R, heavy, list(keys), "_rc", "_rblock", "_rblocks", "_lblock", "_lblocks").withColumnRenamed("_lblock", "_rother")
        cond += [F.col("_lblock") == F.col("_rother"), F.col("_lother") == F.col("_rblock")]
    cond += [L[k] == R[k] for k in keys]
    cond.append(within(F.col(left_xy[0]), F.col(left_xy[1]), F.col(right_xy[0]), F.col(right_xy[1]),
                       radius, metric, strict))
    return L.join(R, on=cond, how="inner").drop(*[R[k] for k in keys]).drop(
        "_lcx", "_lcy", "_rcx", "_rcy", "_lblock", "_lother", "_rblock", "_rother")


def _heavy_cells(L: DataFrame, R: DataFrame, keys: list[str], block: int) -> DataFrame | None:
    """Cells of more than ``block`` rows on a side, with the number of blocks of either side; at most ``2 * HEAVY`` rows."""
    blocks, size = {}, len(keys) + 2
    for side, df, p in ((0, L, "_lc"), (1, R, "_rc")):
        cells = df.groupBy(*keys, p + "x", p + "y").agg(F.count("*").alias("_n"))
        cells = cells.orderBy(F.desc("_n"), *cells.columns[:-1]).limit(HEAVY).filter(F.col("_n") > block)
        for r in cells.collect():
            blocks.setdefault(tuple(r[:size]), [1, 1])[side] = -(-r["_n"] // block)
    if not blocks:
        return None
    ddl = "".join(f"_h{i} {L.schema[k].dataType.simpleString()}, " for i, k in enumerate(keys))
    return L.sparkSession.createDataFrame([(*c, *n) for c, n in blocks.items()],
                                          ddl + "_hx long, _hy long, _lblocks int, _rblocks int")


def _dealt(df: DataFrame, heavy: DataFrame, keys: list[str], p: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
    """Each row in one block of its side, by a hash of all its columns, and once for every block of the other side."""
    at = [F.col(p + "x") == F.col("_hx"), F.col(p + "y") == F.col("_hy")] + [df[k] == F.col(f"_h{i}") for i, k in enumerate(keys)]
    names = df.columns
    out = df.join(F.broadcast(heavy), at, "left")
    out = out.withColumn(own, F.pmod(F.xxhash64(*names), F.coalesce(own_n, F.lit(1))).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(other_n, F.lit(1)) - 1))
    return out.withColumn(other, every).select(*names, own, other)


def proximity_exists(left: DataFrame, right: DataFrame, radius: float, flag: str, id_cols: Sequence[str],
                     left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y"),
                     keys: Sequence[str] = (), extra: Callable[[], Column] | None = None,
                     left_cols: Sequence[str] = (), probe: Column | None = None) -> DataFrame:
    """``left`` plus a boolean ``flag``: some ``right`` row with equal ``keys`` (and the optional
    ``extra()`` condition over both sides; it sees other ``right`` columns as ``_r_<name>``)
    lies within ``radius`` (inclusive). ``id_cols`` must
    identify a ``left`` row; ``left_cols`` are further left columns ``extra`` may use. Only
    rows matching ``probe`` (default all) are tested; the others get False. The test is a semi join over the 9 neighbour cells, so pairs are
    never materialised; the per-cell answers are merged by a distinct on the row id."""
    ids = list(id_cols)
    left = materialize(left)
    carried = list(dict.fromkeys([*ids, *keys, *left_cols, *left_xy]))
    probing = left if probe is None else left.filter(probe)
    L = with_neighbour_cells(probing.select(*carried),
                             *left_xy, radius, prefix="_lc")
    R = with_cell(right, *right_xy, radius, prefix="_rc")
    rk = {k: f"_rk_{k}" for k in keys}

    def rname(c):
        if c in rk:
            return rk[c]
        if c in right_xy:
            return "_r" + c
        return c if c.startswith("_rc") else "_r_" + c
    R = R.select(*[F.col(c).alias(rname(c)) for c in R.columns])
    cond = [F.col("_lcx") == F.col("_rcx"), F.col("_lcy") == F.col("_rcy")]
    cond += [F.col(k) == F.col(rk[k]) for k in keys]
    cond.append(within(F.col(left_xy[0]), F.col(left_xy[1]),
                       F.col("_r" + right_xy[0]), F.col("_r" + right_xy[1]), radius))
    if extra is not None:
        cond.append(extra())
    hits = L.join(R, on=cond, how="left_semi").select(*ids).distinct().withColumn(flag, F.lit(True))
    return (left.join(hits, on=ids, how="left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def box_collision_pairs(state: DataFrame, radius: float = 0.5) -> DataFrame:
    """Pairs of vehicles (``name_a < name_b``) whose positions differ by less than ``radius``
    in both x and y (strict)."""
    state = materialize(state)  # read by both sides of the self-join
    a = state.select(F.col("name").alias("name_a"), F.col("x").alias("_ax"), F.col("y").alias("_ay"))
    b = state.select(F.col("name").alias("name_b"), F.col("x").alias("_bx"), F.col("y").alias("_by"))
    pairs = proximity_join(a, b, radius, ("_ax", "_ay"), ("_bx", "_by"), metric="box", strict=True)
    return pairs.filter(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")

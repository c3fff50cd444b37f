"""Event-sourced vehicle read model, folded from a command log.

Commands: ``seq, type ('create'|'move'|'remove'), name, x, y`` (start position for create,
move vector for move). Fold per name in log order: create puts the vehicle (an existing one is
replaced and its history restarts), move appends ``last + vector``, move of an absent vehicle is
ignored, remove deletes, remove of an absent vehicle is a no-op.

Set-based form: create/remove commands are epoch markers. The live vehicles are the names whose
last marker is a create; their history is that create's position followed by the running sums
of the moves after it. History is kept as rows ``(name, pos_idx, x, y)`` — never as one array
per vehicle — so a vehicle with a very long history is still spread over many tasks.

Positions are exact sums of the start and the vectors as decimals of 17 places, rounded to a double once
(``functions/exact``): they depend neither on bucket width nor partitioning. A life that holds a number
of 1e8 or more, or no number, has plain sums of doubles instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import geometry
from keelson.functions.exact import DECIMAL, exact_term
from keelson.plans.ordered import DEFAULT_BUCKET_WIDTH, running_sum
from keelson.plans.stages import materialize

CLOSENESS = 0.5  # fixed: distance at or below which two positions are "the same place"
KINDS = ("create", "move", "remove")


def well_formed(cmds: DataFrame) -> DataFrame:
    """Commands of a known type with a name and, unless they remove, a position or vector; the
    others are ignored by the read model and by admission alike."""
    placed = (F.col("type") == "remove") | (F.col("x").isNotNull() & F.col("y").isNotNull())
    return cmds.filter(F.col("type").isin(*KINDS) & F.col("name").isNotNull() & placed)


def live_epochs(cmds: DataFrame) -> DataFrame:
    """One row per live vehicle: ``name, start_seq, x0, y0`` of the create that opened its
    current life (the name's last create/remove is a create)."""
    markers = well_formed(cmds).filter(F.col("type").isin("create", "remove"))
    last = markers.groupBy("name").agg(
        F.max_by(F.struct("seq", "type", "x", "y"), F.col("seq")).alias("m"))
    return last.filter(F.col("m.type") == "create").select(
        "name", F.col("m.seq").alias("start_seq"), F.col("m.x").alias("x0"), F.col("m.y").alias("y0"))


def project_vehicles(cmds: DataFrame, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """History rows of the live vehicles: ``name, pos_idx, x, y`` (pos_idx 0 = start).

    The moves that count are those after the create that opened the vehicle's current life
    (``seq > start_seq``): by construction no create/remove follows it. Their positions are one
    bucketed running sum per name, so a vehicle with a very long history is not one task."""
    cmds = well_formed(materialize(cmds))
    live = materialize(live_epochs(cmds))
    moves = (cmds.filter(F.col("type") == "move").select("name", "seq", "x", "y")
             .join(live, on="name", how="inner")
             .filter(F.col("seq") > F.col("start_seq")))
    starts = live.select("name", F.col("start_seq").alias("seq"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    sums = _running_positions(starts.unionByName(moves.select("name", "seq", "x", "y")), bucket_width)
    return sums.select("name", (F.col("_k") - 1).cast("long").alias("pos_idx"), "x", "y")


def _running_positions(rows: DataFrame, bucket_width: int) -> DataFrame:
    """``name, seq, x, y`` (a start, then vectors) to ``name, _k`` (from 1) and the positions ``x, y``."""
    terms = {"_k": F.lit(1)}
    for c in ("x", "y"):
        term = exact_term(F.col(c))
        terms |= {f"_d{c}": F.coalesce(term, F.lit(0).cast(DECIMAL)), f"_s{c}": F.col(c), f"_n{c}": term.isNull().cast("int")}
    sums = running_sum(rows, ["name"], "seq", terms, bucket_width=bucket_width)
    at = lambda c: F.when(F.col(f"_n{c}") == 0, F.col(f"_d{c}").cast("double")).otherwise(F.col(f"_s{c}"))
    return sums.select("name", "seq", "_k", at("x").alias("x"), at("y").alias("y"))


def apply_commands(history: DataFrame, cmds: DataFrame, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Incremental read model: the history after applying ``cmds`` (all later than the commands
    behind ``history``) to ``history``. Equal to ``project_vehicles`` over the whole log, at the
    cost of the live history plus the new commands instead of the whole log.

    * a name with a create/remove among ``cmds`` starts over from its last marker there
      (``project_vehicles(cmds)``), its previous history is dropped;
    * any other live name keeps its history and appends its moves: running sums of the vectors
      from its last position, indexes continuing after its last index."""
    cmds = well_formed(materialize(cmds))
    history = materialize(history)
    marked = cmds.filter(F.col("type").isin("create", "remove")).select("name").distinct()
    fresh = project_vehicles(cmds, bucket_width)
    kept = history.join(marked, on="name", how="left_anti")
    last = kept.groupBy("name").agg(F.max_by(F.struct("x", "y"), F.col("pos_idx")).alias("_p"),
                                    F.max("pos_idx").alias("_last"))
    moves = (cmds.filter(F.col("type") == "move").select("name", "seq", "x", "y")
             .join(marked, on="name", how="left_anti").join(last, on="name", how="inner"))
    first = last.join(moves.groupBy("name").agg(F.min("seq").alias("_from")), "name").select(
        "name", (F.col("_from") - 1).alias("seq"), F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    sums = _running_positions(first.unionByName(moves.select("name", "seq", "x", "y")), bucket_width).filter("_k > 1")
    steps = sums.join(last.select("name", "_last"), "name").select(
        "name", (F.col("_last") + F.col("_k") - 1).cast("long").alias("pos_idx"), "x", "y")
    return kept.select("name", "pos_idx", "x", "y").unionByName(steps).unionByName(fresh)


def vehicles(history: DataFrame) -> DataFrame:
    """Read model summary per live vehicle: ``name, x, y`` (current position) and ``moves``
    (number of moves = history length - 1)."""
    return history.groupBy("name").agg(
        F.max_by(F.struct("x", "y"), F.col("pos_idx")).alias("p"), F.max("pos_idx").alias("moves")
    ).select("name", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("moves").cast("int").alias("moves"))


def vehicle_by_name(state: DataFrame, name) -> DataFrame:
    """Point lookup; an empty result means the vehicle is absent."""
    return state.filter(F.col("name") == (name if isinstance(name, F.Column) else F.lit(name)))


def vehicles_at_position(state: DataFrame, x: float, y: float, radius: float = CLOSENESS) -> DataFrame:
    """Vehicles whose current position is within ``radius`` (inclusive) of one point."""
    return state.filter(geometry.vector_distance("x", "y", F.lit(x), F.lit(y)) <= radius)


def vehicle_position(state: DataFrame) -> DataFrame:
    """Current position per vehicle (last history element)."""
    return state.select("name", "x", "y")


def vehicle_number_of_moves(state: DataFrame) -> DataFrame:
    """Number of moves per vehicle: history length - 1, never negative."""
    return state.select("name", F.greatest(F.col("moves"), F.lit(0)).alias("moves"))


def vehicle_previous_positions(history: DataFrame) -> DataFrame:
    """All history rows except the current position."""
    history = materialize(history)
    last = history.groupBy("name").agg(F.max("pos_idx").alias("_last"))
    return history.join(last, "name").filter(F.col("pos_idx") < F.col("_last")).drop("_last")


def live_vehicle_names(cmds: DataFrame) -> DataFrame:
    """Names whose last create/remove is a create (moves do not change the set)."""
    return live_epochs(cmds).select("name")

"""Command admission against a read-model snapshot, as one set-based job.

Each pending command is judged against the same (possibly stale) snapshot, as a command handler
reading the read side would: two creates of one name in one interval can both pass. Rules, in the
order they are tested for a move: absent -> rejected; zero vector -> rejected; 5 or more moves
already -> becomes a remove; new position within 0.5 of an earlier (not the current) position
-> becomes a remove; otherwise every other vehicle within 0.5 of the new position gets a remove,
then the move is emitted. A create of a live name and a remove of an absent name are rejected.

Output rows: ``seq, sub_seq, verdict, type, name, x, y`` — ``type`` is the emitted command
(NULL when rejected); obstacle removes have ``sub_seq`` 0 and the move that caused them 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import proximity
from keelson.operators.vehicles import CLOSENESS, project_vehicles, vehicles, well_formed
from keelson.plans.stages import materialize

MAX_MOVES = 5  # fixed: the sixth move of a vehicle turns into its removal

_OUT = ["seq", "sub_seq", "verdict", "type", "name", "x", "y"]


def admit_commands_snapshot(pending: DataFrame, history: DataFrame, state: DataFrame | None = None,
                            radius: float = CLOSENESS, max_moves: int = MAX_MOVES) -> DataFrame:
    """Judge ``pending`` commands against the snapshot ``history`` rows (``project_vehicles``).

    Plan: one left join of the commands with the snapshot state gives every verdict in a single
    projection; the revisit test is a semi join on ``(name, grid cell)`` against the history
    rows, probed only by moves that reach it; the obstacle removes are a grid equi-join of the
    accepted moves with the snapshot positions — the only extra branch of the union."""
    history = materialize(history)
    state = materialize(vehicles(history) if state is None else state)
    live = state.select("name", F.col("x").alias("_cx"), F.col("y").alias("_cy"), "moves",
                        F.lit(True).alias("_live"))
    t = F.col("type")
    cmds = (well_formed(pending).join(live, on="name", how="left")
            .withColumn("_live", F.coalesce("_live", F.lit(False)))
            .withColumn("_nx", F.col("_cx") + F.col("x")).withColumn("_ny", F.col("_cy") + F.col("y")))
    zero = (F.col("x") == 0) & (F.col("y") == 0)
    limit = F.col("moves") >= max_moves
    probe = (t == "move") & F.col("_live") & ~zero & ~limit
    # revisit: new position near an earlier position of the same vehicle (pos_idx < moves)
    cmds = proximity.proximity_exists(
        cmds, history.select("name", "pos_idx", "x", "y"), radius, "_revisit", ["seq"],
        left_xy=("_nx", "_ny"), right_xy=("x", "y"), keys=["name"], left_cols=["moves"],
        extra=lambda: F.col("_r_pos_idx") < F.col("moves"), probe=probe)
    live_c = F.col("_live")
    verdict = (F.when(t == "create", F.when(live_c, "duplicate_create").otherwise("create"))
               .when(t == "remove", F.when(live_c, "remove").otherwise("unknown_remove"))
               .when(~live_c, "unknown_move").when(zero, "zero_move").when(limit, "motion_limit")
               .when(F.col("_revisit"), "revisit").otherwise("move"))
    judged = materialize(cmds.select("seq", "name", "x", "y", "_nx", "_ny", verdict.alias("verdict")))
    v = F.col("verdict")
    emitted = (F.when(v.isin("create", "move", "remove"), v)
               .when(v.isin("motion_limit", "revisit"), F.lit("remove")))
    keeps_xy = v.isin("create", "duplicate_create", "unknown_move", "zero_move", "move")
    rows = judged.select(
        "seq", F.when(v == "move", 1).otherwise(0).cast("int").alias("sub_seq"), "verdict",
        emitted.alias("type"), "name",
        F.when(keeps_xy, F.col("x")).cast("double").alias("x"),
        F.when(keeps_xy, F.col("y")).cast("double").alias("y"))

    movers = judged.filter(v == "move").select("seq", "name", "_nx", "_ny")
    others = state.select(F.col("name").alias("_oname"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    hits = proximity.proximity_join(movers, others, radius, left_xy=("_nx", "_ny"), right_xy=("_ox", "_oy"))
    obstacles = hits.filter(F.col("_oname") != F.col("name")).select(
        "seq", F.lit(0).cast("int").alias("sub_seq"), F.lit("obstacle").alias("verdict"),
        F.lit("remove").alias("type"), F.col("_oname").alias("name"),
        F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return rows.unionByName(obstacles).select(*_OUT)


def admit_from_log(history_cmds: DataFrame, pending: DataFrame) -> DataFrame:
    """Project the snapshot from a command log, then judge ``pending`` against it."""
    hist = project_vehicles(history_cmds)
    return admit_commands_snapshot(pending, hist)


# ---------------------------------------------------------------- the rules one by one
# Building blocks with the same semantics as the single-pass job above. Each takes commands
# (``seq, type, name, x, y``) and the snapshot ``state`` (``vehicles``) and returns the commands
# it applies to with a ``verdict`` column: the rule's verdict, or NULL when the rule passes.

def _live(state: DataFrame) -> DataFrame:
    return state.select("name", F.col("x").alias("_cx"), F.col("y").alias("_cy"), "moves",
                        F.lit(True).alias("_live"))


def reject_duplicate_create(cmds: DataFrame, state: DataFrame) -> DataFrame:
    """Creates of a live name -> 'duplicate_create' (left join flag: semi and anti in one pass)."""
    c = cmds.filter(F.col("type") == "create").join(_live(state).select("name", "_live"), "name", "left")
    return c.withColumn("verdict", F.when(F.col("_live"), F.lit("duplicate_create"))).drop("_live")


def reject_unknown_remove(cmds: DataFrame, state: DataFrame) -> DataFrame:
    """Removes of an absent name -> 'unknown_remove'."""
    c = cmds.filter(F.col("type") == "remove").join(_live(state).select("name", "_live"), "name", "left")
    return c.withColumn("verdict", F.when(F.col("_live").isNull(), F.lit("unknown_remove"))).drop("_live")


def reject_unknown_move(cmds: DataFrame, state: DataFrame) -> DataFrame:
    """Moves of an absent name -> 'unknown_move'."""
    c = cmds.filter(F.col("type") == "move").join(_live(state).select("name", "_live"), "name", "left")
    return c.withColumn("verdict", F.when(F.col("_live").isNull(), F.lit("unknown_move"))).drop("_live")


def reject_zero_move(moves: DataFrame) -> DataFrame:
    """Moves by the vector (0, 0) -> 'zero_move'."""
    return moves.withColumn("verdict", F.when((F.col("x") == 0) & (F.col("y") == 0), F.lit("zero_move")))


def motion_limit_to_remove(moves: DataFrame, state: DataFrame, max_moves: int = MAX_MOVES) -> DataFrame:
    """Moves of a vehicle that already moved ``max_moves`` times -> 'motion_limit' (emits a remove)."""
    c = moves.join(_live(state).select("name", "moves"), "name", "inner")
    return c.withColumn("verdict", F.when(F.col("moves") >= max_moves, F.lit("motion_limit"))).drop("moves")


def revisit_to_remove(moves: DataFrame, history: DataFrame, state: DataFrame,
                      radius: float = CLOSENESS) -> DataFrame:
    """Moves whose target is within ``radius`` of an earlier (not the current) position of the
    same vehicle -> 'revisit' (emits a remove). Semi join on ``(name, grid cell)``."""
    c = (moves.join(_live(state), "name", "inner")
         .withColumn("_nx", F.col("_cx") + F.col("x")).withColumn("_ny", F.col("_cy") + F.col("y")))
    c = proximity.proximity_exists(
        c, materialize(history).select("name", "pos_idx", "x", "y"), radius, "_revisit", ["seq"],
        left_xy=("_nx", "_ny"), right_xy=("x", "y"), keys=["name"], left_cols=["moves"],
        extra=lambda: F.col("_r_pos_idx") < F.col("moves"))
    return (c.withColumn("verdict", F.when(F.col("_revisit"), F.lit("revisit")))
            .drop("_cx", "_cy", "moves", "_live", "_nx", "_ny", "_revisit"))


def remove_obstacles(moves: DataFrame, state: DataFrame, radius: float = CLOSENESS) -> DataFrame:
    """For each move, the other vehicles within ``radius`` of its target: rows ``seq, name``
    (the obstacle), each to be removed before the move. Grid equi-join, mover excluded."""
    c = (moves.join(_live(state).select("name", "_cx", "_cy"), "name", "inner")
         .select("seq", "name", (F.col("_cx") + F.col("x")).alias("_nx"), (F.col("_cy") + F.col("y")).alias("_ny")))
    others = state.select(F.col("name").alias("_oname"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    hits = proximity.proximity_join(c, others, radius, left_xy=("_nx", "_ny"), right_xy=("_ox", "_oy"))
    return hits.filter(F.col("_oname") != F.col("name")).select("seq", F.col("_oname").alias("name"))

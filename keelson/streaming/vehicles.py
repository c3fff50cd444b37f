"""Stateful vehicle operators: incremental read model and ordered command admission.

Both are ``transformWithStateInPandas`` processors; state lives in the state store (RocksDB in
our sessions), so it is checkpointed with the query and never held whole by the driver.

* ``project_vehicles_stream`` folds commands per vehicle name (update mode: one row per name
  touched in a micro-batch, with its state after the batch).
* ``vehicle_history_stream`` writes every position once, with the ends of lives and the late commands
  beside them; ``live_history`` and ``late_commands`` read its output.
* ``admit_commands_ordered`` judges each command after all earlier ones of its world are
  applied. Obstacle removal couples all vehicles of a world, so the fold is keyed by
  ``world_id`` and parallel across worlds. Positions are indexed in a grid kept in a MapState,
  so an obstacle lookup touches only the 3x3 cells around the target.

In batch mode the input is hash-partitioned by key and sorted by ``(key, seq)`` before the
fold, so rows reach the processor in log order chunk by chunk and a world is never collected
whole; in streaming mode each micro-batch of a key (bounded by the trigger size) is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keelson.functions.exact import SMALL
from keelson.operators.admission import MAX_MOVES
from keelson.operators.vehicles import CLOSENESS, well_formed
from keelson.plans.stages import materialize

ADMISSION_SCHEMA = ("world_id int, seq long, sub_seq int, verdict string, type string, name string, "
                    "x double, y double")
HISTORY_SCHEMA = "name string, kind string, seq long, start_seq long, pos_idx long, x double, y double"
FOLD_SCHEMA = "name string, live boolean, x double, y double, moves int, last_seq long"


def _ordered_chunks(rows: Iterator[pd.DataFrame], presorted: bool) -> Iterator[pd.DataFrame]:
    """Chunks in ``seq`` order. Pre-sorted input is streamed and checked; otherwise the rows of
    this key in this micro-batch are sorted."""
    if not presorted:
        pdf = pd.concat(list(rows), ignore_index=True)
        yield pdf.sort_values("seq", kind="stable")
        return
    last = None
    for pdf in rows:
        s = pdf["seq"]
        if len(s) and ((last is not None and s.iloc[0] < last) or not s.is_monotonic_increasing):
            raise ValueError("input of an ordered fold is not sorted by seq")
        if len(s):
            last = s.iloc[-1]
        yield pdf


def _prepare(df: DataFrame, key: str, presorted: bool) -> DataFrame:
    if df.isStreaming:
        return df
    df.sparkSession.streams  # noqa: B018 - starts the state store coordinator batch folds need
    return df.repartition(key).sortWithinPartitions(key, "seq") if presorted else df


# ---------------------------------------------------------------- read model fold

class _Sum:
    """An exact running sum of decimals with 18 places, read with 17; plain once a number does not fit, as in the
    set-based read model."""

    def __init__(self, units: int = 0, plain: float = 0.0, whole: bool = True):
        self.units, self.plain, self.whole = units, plain, whole

    def add(self, v: float) -> None:
        self.plain += v
        if abs(v) < SMALL:
            self.units += int(Decimal(repr(v)).scaleb(18).to_integral_value(ROUND_HALF_UP))
        else:
            self.whole = False

    def value(self) -> float:
        if not self.whole:
            return self.plain
        tenth = (abs(self.units) + 5) // 10
        return float(Fraction(-tenth if self.units < 0 else tenth, 10 ** 17))

    def kept(self) -> str:
        return f"{self.units} {self.plain!r} {int(self.whole)}"

    @classmethod
    def of(cls, kept: str) -> _Sum:
        units, plain, whole = kept.split()
        return cls(int(units), float(plain), whole == "1")


class _Life:
    """One vehicle: ``live``, start and last applied ``seq``, moves, sums of x and y, greatest ``seq`` seen."""

    DDL = "live boolean, start_seq long, moves int, x string, y string, last_seq long, seen long"

    def __init__(self, kept: tuple | None):
        self.live, self.start, self.moves, x, y, self.last, self.seen = kept or (False, None, 0, None, None, None, None)
        self.x, self.y = (_Sum.of(x), _Sum.of(y)) if x else (None, None)

    def kept(self) -> tuple:
        x, y = (self.x.kept(), self.y.kept()) if self.live else (None, None)
        return self.live, self.start, self.moves, x, y, self.last, self.seen

    def apply(self, kind: str, seq: int, x, y) -> bool:
        """Whether the command counts: a move of an absent vehicle does not. Commands come in ``seq`` order."""
        self.seen = seq
        if kind == "move":
            if not self.live:
                return False
            self.moves += 1
        else:
            self.live, self.start, self.moves = kind == "create", seq if kind == "create" else None, 0
            self.x, self.y = (_Sum(), _Sum()) if self.live else (None, None)
        if self.live:
            self.x.add(float(x))
            self.y.add(float(y))
        self.last = seq
        return True

    def at(self) -> tuple:
        return (self.x.value(), self.y.value()) if self.live else (None, None)


def _commands(pdf: pd.DataFrame) -> Iterator[tuple]:
    return zip(pdf["type"], pdf["seq"].astype("int64").tolist(), pdf["x"], pdf["y"])


class VehicleFoldProcessor(StatefulProcessor):
    def __init__(self, presorted: bool):
        self.presorted = presorted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("vehicle", _Life.DDL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        life = _Life(self.state.get() if self.state.exists() else None)
        before = life.seen
        for pdf in _ordered_chunks(rows, self.presorted):
            for kind, seq, x, y in _commands(pdf):
                if before is None or seq > before:
                    life.apply(kind, seq, x, y)
        self.state.update(life.kept())
        x, y = life.at()
        yield pd.DataFrame([{"name": key[0], "live": life.live, "x": x, "y": y, "moves": life.moves, "last_seq": life.last}])

    def close(self) -> None:
        pass


class VehicleHistoryProcessor(VehicleFoldProcessor):
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        life = _Life(self.state.get() if self.state.exists() else None)
        before = life.seen
        for pdf in _ordered_chunks(rows, self.presorted):
            out = []
            for kind, seq, x, y in _commands(pdf):
                if before is not None and seq <= before:
                    out.append(("late", seq, None, None, None, None))
                    continue
                was = life.start if life.live else None
                if not life.apply(kind, seq, x, y):
                    continue
                if kind != "move" and was is not None:
                    out.append(("end", seq, was, None, None, None))
                if life.live:
                    out.append(("at", seq, life.start, life.moves, *life.at()))
            yield pd.DataFrame([(key[0], *r) for r in out], columns=[c.split()[0] for c in HISTORY_SCHEMA.split(", ")])
        self.state.update(life.kept())


def _folded(cmds: DataFrame, processor, schema: str, mode: str, presorted: bool) -> DataFrame:
    presorted = presorted and not cmds.isStreaming
    cmds = _prepare(well_formed(cmds).select("name", "seq", "type", F.col("x").cast("double").alias("x"),
                                             F.col("y").cast("double").alias("y")), "name", presorted)
    return cmds.groupBy("name").transformWithStateInPandas(processor(presorted), schema, mode, "None")


def project_vehicles_stream(cmds: DataFrame, presorted: bool = True) -> DataFrame:
    """Incremental read model: per name touched, ``live, x, y, moves, last_seq`` after the
    micro-batch. Malformed commands are ignored, as are late ones: those at or behind the greatest ``seq`` that
    earlier micro-batches had for the name (``vehicle_history_stream`` reports them)."""
    return _folded(cmds, VehicleFoldProcessor, FOLD_SCHEMA, "Update", presorted)


def vehicle_history_stream(cmds: DataFrame, presorted: bool = True) -> DataFrame:
    """The read model with history, as an append stream ``name, kind, seq, start_seq, pos_idx, x, y``: a row ``at`` for
    each position of the life opened at ``start_seq``, a row ``end`` for each life that a remove or a new create ends, a
    row ``late`` for each command at or behind the greatest ``seq`` that earlier micro-batches had for its name, which
    changes nothing. The state holds one row for each vehicle, however long its history. A position that is NaN is null."""
    return _folded(cmds, VehicleHistoryProcessor, HISTORY_SCHEMA, "Append", presorted)


def live_history(rows: DataFrame) -> DataFrame:
    """``name, pos_idx, x, y`` of the live vehicles, from the rows ``vehicle_history_stream`` has written so far: equal
    to ``project_vehicles`` over the commands that were not late."""
    rows = materialize(rows)
    over = rows.filter("kind = 'end'").select(F.col("name").alias("_name"), F.col("start_seq").alias("_start"))
    ended = (F.col("name") == F.col("_name")) & (F.col("start_seq") == F.col("_start"))
    return rows.filter("kind = 'at'").join(over, ended, "left_anti").select("name", "pos_idx", "x", "y")


def late_commands(rows: DataFrame) -> DataFrame:
    return rows.filter("kind = 'late'").select("name", "seq")


# ---------------------------------------------------------------- ordered admission

class _CachedMap:
    """Write-back cache over a MapState for one ``handleInputRows`` call: each key touched is
    read from the state store at most once and written back once at the end. Only keys the
    micro-batch touches are held, never the whole state of a world."""

    _MISSING = object()

    def __init__(self, state):
        self.state, self.cache, self.dirty = state, {}, set()

    def get(self, key):
        v = self.cache.get(key, self._MISSING)
        if v is self._MISSING:
            v = self.state.getValue(key) if self.state.containsKey(key) else None
            self.cache[key] = v
        return v

    def put(self, key, value):
        self.cache[key] = value
        self.dirty.add(key)

    def flush(self):
        for k in self.dirty:
            v = self.cache[k]
            if v is None:
                if self.state.containsKey(k):
                    self.state.removeKey(k)
            else:
                self.state.updateValue(k, v)
        self.dirty.clear()


class OrderedAdmissionProcessor(StatefulProcessor):
    """State per world: vehicles (position and history) and a grid index of positions."""

    def __init__(self, presorted: bool, radius: float = CLOSENESS, max_moves: int = MAX_MOVES):
        self.presorted, self.radius, self.max_moves = presorted, radius, max_moves
        self.cell = radius * (1 + 1e-9)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.veh_state = handle.getMapState("vehicles", "name string",
                                            "x double, y double, hx array<double>, hy array<double>")
        self.grid_state = handle.getMapState("grid", "cx long, cy long", "names array<string>")

    # grid index ---------------------------------------------------------------
    def _key(self, x: float, y: float) -> tuple[int, int]:
        return math.floor(x / self.cell), math.floor(y / self.cell)

    def _grid_add(self, name: str, x: float, y: float) -> None:
        k = self._key(x, y)
        cur = self.grid.get(k)
        self.grid.put(k, ((list(cur[0]) if cur else []) + [name],))

    def _grid_remove(self, name: str, x: float, y: float) -> None:
        k = self._key(x, y)
        cur = self.grid.get(k)
        if cur is None:
            return
        names = [n for n in cur[0] if n != name]
        self.grid.put(k, (names,) if names else None)

    def _near(self, x: float, y: float) -> list[str]:
        cx, cy = self._key(x, y)
        found = []
        for dx in (-1, 0, 1):
            for dy in (-1, 0, 1):
                cur = self.grid.get((cx + dx, cy + dy))
                for n in (cur[0] if cur else []):
                    vx, vy, _, _ = self.veh.get((n,))
                    if math.sqrt((vx - x) * (vx - x) + (vy - y) * (vy - y)) <= self.radius:
                        found.append(n)
        return sorted(found)

    def _remove(self, name: str) -> None:
        vx, vy, _, _ = self.veh.get((name,))
        self._grid_remove(name, vx, vy)
        self.veh.put((name,), None)

    # fold ---------------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        world = key[0]
        self.veh, self.grid = _CachedMap(self.veh_state), _CachedMap(self.grid_state)
        for pdf in _ordered_chunks(rows, self.presorted):
            out = []

            def emit(seq, sub, verdict, typ, name, x=None, y=None):
                out.append((world, seq, sub, verdict, typ, name, x, y))

            for t, s, name, cx, cy in zip(pdf["type"], pdf["seq"], pdf["name"], pdf["x"], pdf["y"]):
                s = int(s)
                cur = self.veh.get((name,))
                if t == "create":
                    if cur is not None:
                        emit(s, 0, "duplicate_create", None, name, cx, cy)
                    else:
                        emit(s, 0, "create", "create", name, cx, cy)
                        self.veh.put((name,), (float(cx), float(cy), [float(cx)], [float(cy)]))
                        self._grid_add(name, float(cx), float(cy))
                elif t == "remove":
                    if cur is not None:
                        emit(s, 0, "remove", "remove", name)
                        self._remove(name)
                    else:
                        emit(s, 0, "unknown_remove", None, name)
                elif t == "move":
                    if cur is None:
                        emit(s, 0, "unknown_move", None, name, cx, cy)
                        continue
                    if cx == 0 and cy == 0:
                        emit(s, 0, "zero_move", None, name, cx, cy)
                        continue
                    vx, vy, hx, hy = cur
                    if len(hx) - 1 >= self.max_moves:
                        emit(s, 0, "motion_limit", "remove", name)
                        self._remove(name)
                        continue
                    nx, ny = vx + float(cx), vy + float(cy)
                    if any(math.sqrt((px - nx) ** 2 + (py - ny) ** 2) <= self.radius
                           for px, py in zip(hx[:-1], hy[:-1])):
                        emit(s, 0, "revisit", "remove", name)
                        self._remove(name)
                        continue
                    for other in self._near(nx, ny):
                        if other != name:
                            emit(s, 0, "obstacle", "remove", other)
                            self._remove(other)
                    self._grid_remove(name, vx, vy)
                    self.veh.put((name,), (nx, ny, list(hx) + [nx], list(hy) + [ny]))
                    self._grid_add(name, nx, ny)
                    emit(s, 1, "move", "move", name, cx, cy)
            yield pd.DataFrame(out, columns=["world_id", "seq", "sub_seq", "verdict", "type", "name", "x", "y"])
            # bound the cache by one input chunk: write back and forget
            self.veh.flush()
            self.grid.flush()
            self.veh.cache.clear()
            self.grid.cache.clear()

    def close(self) -> None:
        pass


def admit_commands_ordered(cmds: DataFrame, presorted: bool = True) -> DataFrame:
    """Judge commands ``world_id, seq, type, name, x, y`` one after another per world.
    Output: ``world_id`` plus the columns of ``admit_commands_snapshot``."""
    cmds = cmds.select(F.col("world_id").cast("int").alias("world_id"), "seq", "type", "name",
                       F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    sorted_input = presorted and not cmds.isStreaming
    cmds = _prepare(well_formed(cmds), "world_id", sorted_input)
    return cmds.groupBy("world_id").transformWithStateInPandas(
        OrderedAdmissionProcessor(sorted_input), ADMISSION_SCHEMA, "Append", "None")

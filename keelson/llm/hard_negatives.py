"""Hard negatives by slots.

Vectors become integers (``floor(scale * x)``), scores are their exact inner products, higher first, ties to the smaller
id. The positives of an anchor are its first rows of the same label under another id; a positive of score p allows the
negatives (rows of another label) of score s with ``low * p <= 100 * s <= high * p``. Upper limits of an anchor's positives,
highest first, cut the scores into slots. Tasks keep the first ``k`` negatives of each slot, merged again after the shuffle:
at most ``k`` rows a slot. The slots' rows from one slot on, highest first, then answer the window that begins there: its
first ``k``, less those under its lower limit. Windows may overlap in any way.

Rows are packed into matrices and dealt to a fixed number of groups, each of which meets every anchor: the anchors (about
``ANCHORS``; of more, each block has groups of its own) are read first, the rows pass by and are not held. What a group
gives out is bounded by its anchors.

Rows with a null id, label or vector, or a component that is null or not finite (also when scaled) take no part. Vectors are
compared with those of the same length only. An anchor given twice is mined twice; rows that repeat an id are candidates
each, but not positives of their own id. Scores beyond a long count as the nearest long. An empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.plans.stages import materialize

ROWS, ANCHORS = 1024, 16_384  # rows of a matrix; anchors held by a task
_PACKED = pa.schema([("row", pa.binary()), ("id", pa.binary()), ("label", pa.binary()), ("q", pa.binary()), ("n", pa.int64()),
                     ("dim", pa.int32()), ("limits", pa.binary()), ("number", pa.int64())])
_PACKED_DDL = "row binary, id binary, label binary, q binary, n long, dim int, limits binary, number long"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, label and q (whole numbers, as doubles) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("e"), F.col("anchor"))
    v = v.withColumn("s", F.transform("e", lambda x: x * F.lit(float(scale))))
    fine = F.forall("s", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & fine).select(
        "vec_id", "label", "s", F.coalesce("anchor", F.lit(False)).alias("anchor"))


def packed(rows: DataFrame, size: int = ROWS) -> DataFrame:
    """Rows (row, vec_id, label, s, limits) as matrices of at most ``size`` vectors of one length; ``number`` counts them."""
    def run(batches):
        waiting: dict[int, list] = {}
        number = itertools.count(TaskContext.get().partitionId())

        def matrix(dim, part):
            q = np.floor(np.array([r[3] for r in part], np.float64).reshape(len(part), dim))
            ints = [np.array([r[i] for r in part], "<i8").tobytes() for i in range(3)]
            limits = np.array([r[4] for r in part], "<i8").tobytes() if part[0][4] is not None else b""
            if np.abs(q).max(initial=0) < 1 << 31:
                q = q.astype("<i4")
            return pa.RecordBatch.from_pylist([dict(zip(_PACKED.names, (*ints, q.tobytes(), len(part), dim, limits, next(number))))],
                                              schema=_PACKED)

        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("row", "vec_id", "label", "s", "limits"))):
                part = waiting.setdefault(len(r[3]), [])
                part.append(r)
                if len(part) >= size:
                    yield matrix(len(r[3]), waiting.pop(len(r[3])))
        for dim, part in waiting.items():
            yield matrix(dim, part)

    return rows.select("row", "vec_id", "label", "s", "limits").mapInArrow(run, _PACKED_DDL)


def _matrix(r: dict, dim: int) -> tuple:
    """row numbers, ids, labels, vectors (doubles) and limits of a packed row."""
    row, ids, label = (np.frombuffer(r[c], "<i8") for c in ("row", "id", "label"))
    wide = len(r["q"]) > 4 * r["n"] * dim
    q = np.frombuffer(r["q"], "<f8" if wide else "<i4").reshape(r["n"], dim).astype(np.float64)
    return row, ids, label, q, np.frombuffer(r["limits"], "<i8").reshape(r["n"], -1) if r["limits"] else None


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles; those beyond a long as the nearest long."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, _LEAST, _MOST).astype(np.int64)


class _Firsts:
    """The first ``k`` (score, id) of each anchor and slot so far."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.key = self.score = self.id = np.zeros(0, np.int64)
        self.least = np.full(anchors * slots, _LEAST)  # score of the k-th, where there are k

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key = anchor * self.slots + slot
        near = score >= self.least[key]
        if not near.any():
            return
        key, score, ids = (np.concatenate(x) for x in ((self.key, key[near]), (self.score, score[near]), (self.id, ids[near])))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        last = place == self.k - 1
        self.least[key[last]] = score[last]
        keep = place < self.k
        self.key, self.score, self.id = key[keep], score[keep], ids[keep]


def _same_label(a: tuple, r: tuple, score: np.ndarray):
    """Anchor number, slot and row number of the candidates for positives."""
    anchor, at = np.nonzero((a[2][:, None] == r[2][None, :]) & (a[1][:, None] != r[1][None, :]))
    return anchor, np.zeros(len(anchor), np.int64), at


def _in_windows(a: tuple, r: tuple, score: np.ndarray):
    """The same for negatives: the slot of the lowest upper limit that allows the score."""
    upper, low = a[4][:, :-1], a[4][:, -1]
    anchor, at = np.nonzero((a[2][:, None] != r[2][None, :]) & (score <= upper[:, :1]) & (score >= low[:, None]))
    return anchor, (upper[anchor] >= score[anchor, at][:, None]).sum(axis=1) - 1, at


def firsts(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, candidates, slots: int, k: int) -> DataFrame:
    """row, slot, vec_id, score: of each group of rows the first ``k`` candidates of each anchor row and slot. ``rows`` and
    ``anchors`` are packed; each group of rows meets each block of anchors, which come first."""
    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    a = anchors.withColumn("block", F.pmod(F.xxhash64("id", "number"), F.lit(blocks)).cast("int")).withColumn("group", every(groups))
    r = rows.withColumn("block", every(blocks)).withColumn("group", F.pmod("number", F.lit(groups)).cast("int"))
    cols = ["block", "group", "kind", "dim", "row", "id", "label", "q", "n", "limits"]
    both = a.withColumn("kind", F.lit(0)).select(cols).unionByName(r.withColumn("kind", F.lit(1)).select(cols))
    both = both.repartition(blocks * groups, "block", "group").sortWithinPartitions("block", "group", "kind")

    def run(batches):
        at, held = None, []

        def done():
            for m, best in held:
                anchor, slot = np.divmod(best.key, slots)
                yield pa.RecordBatch.from_arrays([pa.array(m[0][anchor]), pa.array(slot.astype(np.int32)), pa.array(best.id),
                                                  pa.array(best.score)], names=["row", "slot", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                x = b.slice(i, 1).to_pylist()[0]
                if at != (x["block"], x["group"]):
                    yield from done()
                    at, held = (x["block"], x["group"]), []
                m = _matrix(x, x["dim"])
                if x["kind"] == 0:
                    held.append((m, _Firsts(len(m[0]), slots, k)))
                    continue
                for a, best in held:
                    if a[3].shape[1] == x["dim"]:
                        score = products(a[3], m[3])
                        anchor, slot, row = candidates(a, m, score)
                        best.add(anchor, slot, score[anchor, row], m[1][row])
        yield from done()

    return both.mapInArrow(run, "row long, slot int, vec_id long, score long")


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _share(percent: int, rounded) -> Column:
    return rounded(F.col("positive_score").cast("decimal(25,0)") * F.lit(percent) / F.lit(100)).cast("long")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, low: int = 30, high: int = 90, k: int = 10,
         scale: float = 256.0, groups: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``vectors``: vec_id, label, embedding;
    ``groups`` of rows, by default two for each core, are the tasks of a block of anchors."""
    spark = vectors.sparkSession
    groups = groups or 2 * spark.sparkContext.defaultParallelism
    v = usable(vectors.select("vec_id", "label", "embedding", is_anchor.alias("anchor")), scale)
    none = F.lit(None).cast("array<bigint>").alias("limits")
    rows = materialize(packed(v.select(F.lit(0).cast("long").alias("row"), "vec_id", "label", "s", none)), force=True)
    anchors = materialize(v.filter("anchor").select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "s"), force=True)
    blocks = max(1, -(-anchors.count() // ANCHORS))

    near = firsts(rows, packed(anchors.withColumn("limits", none)), blocks, groups, _same_label, 1, positives)
    near = _top(near, ["row"], positives).filter("score >= 0")  # a negative score allows nothing
    near = near.select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = near.withColumn("upper", _share(high, F.floor)).withColumn("lower", _share(low, F.ceil))
    near = near.withColumn("slot", F.dense_rank().over(Window.partitionBy("row").orderBy(F.desc("upper"))) - 1)
    near = materialize(near, force=True)
    upper = F.sort_array(F.collect_set("upper"), asc=False)  # at most ``positives`` limits
    limits = near.groupBy("row").agg(F.concat(upper, F.array_repeat(F.lit(_LEAST), positives - F.size(upper)),
                                              F.array(F.min("lower"))).alias("limits"))

    found = firsts(rows, packed(anchors.join(limits, "row")), blocks, groups, _in_windows, positives, k)
    found = _top(found, ["row", "slot"], k).groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("slot", (-F.col("score")).alias("minus"), "vec_id"))).alias("slots"))  # at most positives * k rows
    first = F.slice(F.filter("slots", lambda x: x["slot"] >= F.col("slot")), 1, k)
    out = near.join(found, "row").withColumn("window", F.filter(first, lambda x: -x["minus"] >= F.col("lower")))
    out = out.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "positive_score", F.posexplode("window").alias("at", "x")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score",
        (-F.col("x.minus")).alias("negative_score"))

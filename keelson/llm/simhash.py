"""SimHash near-dedup by multi-index hashing.

A fingerprint bit is set when it is set in over half of the XXH64 hashes (seed 42) of the
word shingles (null or no word: zero). Documents with one fingerprint are one node, known by its smallest row number. Two fingerprints at
distance <= 3 have a 32-bit half at distance <= 1: each half probes its Hamming ball of radius 1
in the table of halves, and the full distance of every match is checked. Links feed an
alternating star contraction, one written table per round in the shared checkpoint folder.
Repeated rows and ties join one group; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.plans.stages import materialize

BLOCK = 1 << 16  # shingles hashed per block, bounds memory on long texts


def fingerprint(text: str | None, k: int = 3) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    norm, at, starts, ends = b" ".join(words), 0, [], []
    for w in words:
        starts.append(at)
        ends.append(at + len(w))
        at += len(w) + 1
    spans = list(zip(starts, ends[k - 1:])) if len(words) >= k else [(0, len(norm))]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(spans), BLOCK):
        h = np.array([digest(norm[s:e], 42) for s, e in spans[i:i + BLOCK]], dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3, *also: str) -> DataFrame:
    """doc_id, the columns ``also``, fingerprint, hi, lo; only texts travel through Python."""
    @F.pandas_udf("fingerprint string, hi long, lo long")
    def run(text: pd.Series) -> pd.DataFrame:
        f = [fingerprint(t, k) for t in text]
        return pd.DataFrame({"fingerprint": [f"{x:016x}" for x in f], "hi": [x >> 32 for x in f], "lo": [x & 0xFFFFFFFF for x in f]})

    own = ["doc_id", *also]
    return docs.select(*own, run("text").alias("p")).select(*own, "p.fingerprint", "p.hi", "p.lo")


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b), a < b: nodes (node, hi, lo) whose fingerprints differ in at most ``distance`` bits."""
    radius = distance // 2
    if radius > 1:
        raise ValueError("balls of radius 0 and 1 are supported: distance <= 3")
    masks = [0] + [1 << i for i in range(32)] * radius
    halves = nodes.select("node", "hi", "lo", F.inline(F.array(
        F.struct(F.lit(0).alias("seg"), F.col("hi").alias("value")),
        F.struct(F.lit(1).alias("seg"), F.col("lo").alias("value")))))
    probes = halves.select(F.col("node").alias("a"), F.col("hi").alias("hi_a"), F.col("lo").alias("lo_a"), "seg",
                           F.explode(F.array(*[F.col("value").bitwiseXOR(F.lit(m)) for m in masks])).alias("value"))
    found = probes.join(halves.withColumnRenamed("node", "b"), ["seg", "value"])
    bits = F.bit_count(F.col("hi").bitwiseXOR(F.col("hi_a"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("lo_a")))
    return found.filter((F.col("a") < F.col("b")) & (bits <= distance)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link."""
    edges = materialize(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), force=True)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, force=True)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), force=True)


def _members(prints: DataFrame, distance: int) -> DataFrame:
    """fingerprint, root (one for each group), first (its rows' smallest id and row: struct no_id, doc_id, row)."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    nodes = materialize(prints.groupBy("fingerprint", "hi", "lo").agg(F.min("row").alias("node"), F.min(first).alias("first")),
                        force=True)
    roots = components(links(nodes.select("node", "hi", "lo"), distance))
    return nodes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("root"), "first")


def near_groups(docs: DataFrame, k: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id (smallest doc_id reachable, null where no row of the group has an id)."""
    prints = materialize(fingerprints(docs, k).withColumn("row", F.monotonically_increasing_id()), force=True)
    members = materialize(_members(prints, distance), force=True)
    ids = members.groupBy("root").agg(F.min("first").getField("doc_id").alias("component_id"))
    named = members.select("fingerprint", "root").join(ids, "root").select("fingerprint", "component_id")
    return prints.select("doc_id", "fingerprint").join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_firsts(docs: DataFrame, k: int = 3, distance: int = 3) -> DataFrame:
    """row: of each group, the row of smallest (doc_id, row), null ids last. ``docs``: doc_id, text, row (all different)."""
    prints = materialize(fingerprints(docs, k, "row"), force=True)
    return _members(prints, distance).groupBy("root").agg(F.min("first").getField("row").alias("row")).select("row")

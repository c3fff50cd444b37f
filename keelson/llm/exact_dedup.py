"""Exact dedup with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Rows are grouped by a
128-bit hash (MD5) of the normalised text. Only hashes are shuffled to find those that rows share. They
set bits in a filter of at most ``WORDS`` 64-bit words (the bound of its broadcast); rows whose bit
is not set are alone. The other rows are grouped by (hash, text), which compares the bytes, so a collision
gives two groups; tasks aggregate before that shuffle, so a hot group is one row of each task. The answers of the
``HOT`` largest groups go to their rows by broadcast, the others by a join on the hash, in which no
group holds more than 1 in ``HOT`` of the rows. A filter that fills up (beyond some 1e7 shared hashes) lets
more texts through the shuffle, with the same result.

Empty tables give empty results; extra columns are ignored. Rows that repeat an id and its
text share one fate; a null id stays only where no row of its group has an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.plans.stages import materialize

WORDS, HOT = 1 << 20, 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                 hash_fn=F.md5) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. ``keep`` names the id
    that stays ("max" or "min"); ``hash_fn`` is a parameter so that tests can force collisions."""
    pick = F.max if keep == "max" else F.min
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("h", hash_fn(F.col("norm").cast("binary")))
    sha = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    ids = materialize(rows.select("doc_id", "h", sha), force=True)
    marks = materialize(_marks(ids.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")), force=True)
    groups = (_marked(rows, marks).filter("marked").groupBy("h", "norm")
              .agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    groups = materialize(groups.select("h", sha, "keep_id", "group_size"), force=True)
    hot = groups.orderBy(F.desc("group_size"), "h", "text_sha256").limit(HOT)
    of, key = _marked(ids, marks), ["h", "text_sha256"]
    alone = of.filter("NOT marked").select("doc_id", *key, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    shared = of.filter("marked").drop("marked")
    out = shared.join(F.broadcast(hot), key).unionByName(
        shared.join(F.broadcast(hot.select(*key)), key, "left_anti").join(groups, key)).unionByName(alone)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      F.col("keep_id").eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def _word_bit() -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64("h"), F.lit(64 * WORDS))
    return F.floor(at / 64).cast("int"), (at % 64).cast("int")


def _marks(hashes: DataFrame) -> DataFrame:
    """The words of the filter that hold a set bit."""
    word, bit = _word_bit()
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    return hashes.select(word.alias("word"), one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits"))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``marked``: the bit of their hash is set."""
    word, bit = _word_bit()
    met = rows.withColumn("word", word).join(F.broadcast(marks), "word", "left")
    return met.withColumn("marked", F.coalesce(F.getbit("bits", bit) == 1, F.lit(False))).drop("word", "bits")

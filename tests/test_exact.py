"""Order-free sums."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from keelson.functions.exact import exact_sum
from keelson.operators import lidar as ld


def test_any_partitioning_gives_the_same_bits(spark):
    rnd = random.Random(3)
    rows = [(i % 3, rnd.choice([1e12, 0.1, -1e12, 0.123456, 1e-7, 3.3, 12345678.9])) for i in range(900)]
    want = {g: float(sum((Fraction(repr(v)) for k, v in rows if k == g), Fraction(0))) for g in range(3)}
    for parts in (1, 4, 9):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
        assert {r.g: r.s for r in df.groupBy("g").agg(exact_sum("v").alias("s")).collect()} == want


def test_values_that_do_not_fit_fall_back(spark):
    rows = [(0, 1e300), (0, 1.0), (1, float("nan")), (2, float("inf")), (3, None), (3, 2.5), (4, None)] + [(5, 9e18)] * 50
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.s for r in df.groupBy("g").agg(exact_sum("v").alias("s")).collect()}
    assert got[0] == 1e300 and got[1] != got[1] and got[2] == float("inf") and got[3] == 2.5 and got[4] is None and got[5] == 4.5e20
    assert spark.createDataFrame([], "v double").agg(exact_sum("v").alias("s")).first().s is None


def test_legacy_totals_keep_a_small_rest(spark):
    rows = [(0, 0, 1.0), (1, 1, 1e12), (2, 1, 0.123456), (3, 2, 5.0), (4, 2, 0.25), (5, 3, 7.0)]
    seg = spark.createDataFrame([(s, q, d) for q, s, d in rows], "scan long, seq long, distance double")
    for monotone in (True, False):
        got = sorted((r.emit_seq, r.scan, r.distance) for r in ld.scan_total_distance_legacy(seg, monotone=monotone).collect())
        assert got == [(1, 0, 1.0), (2, 1, 0.123456), (3, 2, 0.25)]

"""Hand-traced LiDAR cases (FIXTURES section 3) and bucket-width metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from keelson.functions import codecs
from keelson.operators import lidar as ld

# (seq, angle, distance, quality)
TRACE = [(1, 10.0, 100.0, 20), (2, 90.0, 100.0, 15), (3, 180.0, 100.0, 14), (4, 270.0, 100.0, 20),
         (5, 5.0, 100.0, 20), (6, 5.0, 50.0, 20), (7, 95.0, 50.0, 30), (8, 1.0, 10.0, 20), (9, 2.0, 10.0, 20)]
SCHEMA = "seq long, angle double, distance double, quality int"


def _df(spark, rows=TRACE):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("bw", [1, 2, 3, 1 << 20])
def test_group_segments_totals(spark, bw):
    g = ld.scan_group(ld.lidar_quality_filter(_df(spark)), bucket_width=bw)
    assert sorted((r.seq, r.scan) for r in g.collect()) == [
        (1, 0), (2, 0), (4, 0), (5, 1), (6, 1), (7, 1), (8, 2), (9, 2)]
    seg = ld.scan_segment_distance(g, bucket_width=bw)
    got = sorted((r.scan, round(r.distance, 6)) for r in seg.collect())
    assert got == [(0, 128.557522), (0, 200.0), (1, 50.0), (1, 70.710678), (2, 0.174531)]
    tot = sorted((r.scan, round(r.distance, 6)) for r in ld.scan_total_distance(seg).collect())
    assert tot == [(0, 328.557522), (1, 120.710678), (2, 0.174531)]
    leg = ld.scan_total_distance_legacy(seg, bucket_width=bw)
    assert sorted((r.emit_seq, r.scan, round(r.distance, 6)) for r in leg.collect()) == [
        (1, 0, 328.557522), (2, 1, 70.710678)]


def test_legacy_without_group_zero(spark):
    rows = [r for r in TRACE if r[0] >= 5]
    g = ld.scan_group(ld.lidar_quality_filter(_df(spark, [(1, 10.0, 1.0, 20)] + rows)))
    seg = ld.scan_segment_distance(g).filter(F.col("scan") > 0)
    leg = ld.scan_total_distance_legacy(seg)
    assert sorted((r.scan, round(r.distance, 6)) for r in leg.collect()) == [(0, 0.0), (1, 70.710678)]


def test_negative_first_angle(spark):
    g = ld.scan_group(_df(spark, [(1, -5.0, 1.0, 20), (2, 3.0, 1.0, 20)]))
    assert [r.scan for r in g.orderBy("seq").collect()] == [1, 1]


def test_quality_boundary(spark):
    kept = {r.seq for r in ld.lidar_quality_filter(_df(spark)).collect()}
    assert 3 not in kept and 2 in kept


def _fold_groups(angles):
    idx, last, out = 0, 0.0, []
    for a in angles:
        if a < last:
            idx += 1
        last = a
        out.append(idx)
    return out


@pytest.mark.parametrize("bw", [1, 7, 64])
def test_group_matches_sequential_fold_with_keys(spark, bw):
    import random
    rnd = random.Random(5)
    rows = []
    for key in ("a", "b"):
        seq = 0
        for _ in range(300):
            seq += rnd.choice([1, 1, 2, 5])
            rows.append((key, seq, float(rnd.choice([-3, 0, 10, 10, 50, 90, 200, 359]))))
    df = spark.createDataFrame(rows, "dev string, seq long, angle double")
    got = {(r.dev, r.seq): r.scan for r in ld.scan_group(df, ["dev"], bucket_width=bw).collect()}
    for key in ("a", "b"):
        mine = sorted((s, a) for k, s, a in rows if k == key)
        exp = _fold_groups([a for _, a in mine])
        assert [got[(key, s)] for s, _ in mine] == exp


def test_chain_from_json(spark):
    lines = codecs.encode_lidar(_df(spark)).select("seq", "value")
    bad = spark.createDataFrame([(100, '{"winkel": 1'), (101, '{"winkel": 1.0, "qualitaet": 20}')], "seq long, value string")
    tot = ld.lidar_chain(lines.unionByName(bad))
    assert sorted((r.scan, round(r.distance, 6)) for r in tot.collect()) == [
        (0, 328.557522), (1, 120.710678), (2, 0.174531)]


def test_decode_truncates_quality(spark):
    df = spark.createDataFrame([(1, '{"winkel": 1.5, "distanz": 2.0, "qualitaet": 15.9}'),
                                (2, 'not json'), (3, '{"winkel": 1.5, "distanz": 2.0}')], "seq long, value string")
    got = {r.seq: (r.quality, r.decode_error) for r in codecs.decode_lidar(df).collect()}
    assert got == {1: (15, None), 2: (None, "malformed"), 3: (None, "missing field")}
    assert [r.seq for r in codecs.drop_undecodable(codecs.decode_lidar(df)).collect()] == [1]


def test_encode_shape(spark):
    v = codecs.encode_lidar(_df(spark, [(1, 10.0, 100.0, 20)])).first().value
    assert v == '{"winkel":10.0,"distanz":100.0,"qualitaet":20}'


@pytest.mark.parametrize("bw", [1, 3, 1 << 20])
def test_scan_points_equals_separate_passes(spark, bw):
    df = ld.lidar_quality_filter(_df(spark))
    pts = ld.scan_points(df, bucket_width=bw)
    assert sorted((r.seq, r.scan) for r in pts.collect()) == sorted(
        (r.seq, r.scan) for r in ld.scan_group(df).collect())
    got = sorted((r.scan, r.seq, round(r.distance, 6)) for r in ld.segments_of(pts).collect())
    exp = sorted((r.scan, r.seq, round(r.distance, 6)) for r in ld.scan_segment_distance(ld.scan_group(df)).collect())
    assert got == exp


def test_scan_points_fixture_keyed(spark):
    from keelson.plans import views as V
    df = ld.lidar_quality_filter(V.lidar(V.events(spark, "/root/testdata/sf0.01"), with_scanner=True))
    a = ld.segments_of(ld.scan_points(df, ["scanner"], bucket_width=97), ["scanner"])
    b = ld.scan_segment_distance(ld.scan_group(df, ["scanner"]), ["scanner"])
    rows = lambda d: sorted((r.scanner, r.scan, r.seq, round(r.distance, 6)) for r in d.collect())
    assert rows(a) == rows(b)


@pytest.mark.parametrize("drop_g0", [False, True])
def test_legacy_monotone_equals_generic(spark, drop_g0):
    from keelson.plans import views as V
    df = ld.lidar_quality_filter(V.lidar(V.events(spark, "/root/testdata/sf0.01"), with_scanner=True))
    seg = ld.segments_of(ld.scan_points(df, ["scanner"]), ["scanner"])
    if drop_g0:
        seg = seg.filter("scan > 0")
    rows = lambda d: sorted((r.scanner, r.emit_seq, r.scan, round(r.distance, 6)) for r in d.collect())
    assert rows(ld.scan_total_distance_legacy(seg, ["scanner"], monotone=True)) == rows(
        ld.scan_total_distance_legacy(seg, ["scanner"]))


def test_legacy_recurring_group_generic(spark):
    # a stream where rotation 1 recurs after rotation 2: the generic fold treats it as a new run
    seg = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 1, 4.0), (4, 1, 8.0), (5, 2, 16.0),
                                 (6, 1, 32.0), (7, 1, 64.0), (8, 3, 128.0)], "seq long, scan int, distance double")
    got = sorted((r.emit_seq, r.scan, r.distance) for r in ld.scan_total_distance_legacy(seg).collect())
    assert got == [(1, 0, 3.0), (2, 1, 8.0), (3, 2, 0.0), (4, 1, 64.0)]

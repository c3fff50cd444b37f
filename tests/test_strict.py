"""Lines and commands the readers must refuse, and wide rotation ids."""

from keelson.functions import codecs
from keelson.operators import admission, lidar, vehicles


def test_strict_json(spark):
    good = '{"winkel":1.5,"distanz":2,"qualitaet":15.9}'
    lines = [good, good + "  ", good.replace('"', "'"), '{"winkel":NaN,"distanz":2,"qualitaet":15}', good + " tail", "", None]
    got = codecs.decode_lidar(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.decode_error is None for r in got] == [True, True] + [False] * 5
    group = ['{"group":%s,"data":{"winkel":1,"distanz":2,"qualitaet":15}}' % g for g in ("1.9", "1.0", "5000000000", '"x"')]
    got = codecs.decode_lidar_grouped(spark.createDataFrame([(x,) for x in group], "value string")).collect()
    assert [r.scan for r in got if r.decode_error is None] == [1, 1, 5_000_000_000]
    got = codecs.decode_lidar_distance(spark.createDataFrame([('{"scan":2.5,"distance":1}',)], "value string")).first()
    assert (got.scan, got.distance) == (2, 1.0)


def test_malformed_commands_are_ignored(spark):
    ddl = "seq long, type string, name string, x double, y double"
    hist = vehicles.project_vehicles(spark.createDataFrame([(1, "create", "A", 0.0, 0.0), (2, "move", "A", None, 1.0)], ddl))
    assert [(r.pos_idx, r.x, r.y) for r in hist.collect()] == [(0, 0.0, 0.0)]
    odd = [(3, "teleport", "A", 1.0, 1.0), (4, "move", "A", None, None), (5, None, "A", 1.0, 1.0),
           (6, "create", None, 1.0, 1.0), (7, "move", "A", 3.0, 0.0)]
    got = admission.admit_commands_snapshot(spark.createDataFrame(odd, ddl), hist).collect()
    assert [(r.seq, r.verdict) for r in got] == [(7, "move")]


def test_keyed_frames_and_long_ids(spark):
    rows = [(1, 10.0, 1.0, 20, 0), (2, 5.0, 1.0, 20, 1), (3, 1.0, 1.0, 20, 0)]
    g = lidar.scan_group(spark.createDataFrame(rows, "seq long, angle double, distance double, quality int, scanner int"), ["scanner"])
    assert g.schema["scan"].dataType.simpleString() == "bigint"
    assert [(r.scanner, r.scan) for r in lidar.scan_ids(g, key_cols=["scanner"]).collect()] == [(0, 0), (0, 1), (1, 0)]
    assert lidar.scan_frames(g, key_cols=["scanner"]).columns == ["scanner", "scan", "seq", "x", "y", "max_range"]

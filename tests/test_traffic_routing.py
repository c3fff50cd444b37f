"""Parsing guards, routing hand trace (FIXTURES section 3) and audit operators."""

import pytest
from pyspark.sql import functions as F

from keelson.functions import formats, parsing
from keelson.operators import audit, routing, traffic as tr

ROUTE_TRACE = [
    (0, "2025-10-03T05:22:40.000Z 7 10", "OUT", "MID=traffic-data-0-0 2025-10-03T05:22:40.000Z SensorId=7 SpeedKmh=36.00"),
    (1, "", "BAD", "MID=traffic-data-0-1 BAD: <blank line>"),
    (2, "a b", "BAD", "MID=traffic-data-0-2 BAD: a b | reason=expected 3 tokens"),
    (3, "2025-10-03T05:22:40.000Z 7 -1", "BAD", "MID=traffic-data-0-3 BAD: 2025-10-03T05:22:40.000Z 7 -1 | reason=negative speed"),
    (4, "2025-10-03 7 1", "BAD", "MID=traffic-data-0-4 BAD: 2025-10-03 7 1 | DateTimeParseException"),
    (5, "2025-10-03T05:22:40.000Z 7.5 1", "BAD", "MID=traffic-data-0-5 BAD: 2025-10-03T05:22:40.000Z 7.5 1 | NumberFormatException"),
    (6, "  2025-10-03T05:22:40.000Z  7   0  ", "OUT", "MID=traffic-data-0-6 2025-10-03T05:22:40.000Z SensorId=7 SpeedKmh=0.00"),
    (7, "2025-10-03T05:22:40.000Z 7 -0.0", "OUT", "MID=traffic-data-0-7 2025-10-03T05:22:40.000Z SensorId=7 SpeedKmh=-0.00"),
]


def _records(spark, rows):
    df = spark.createDataFrame([(o, v) for o, v, *_ in rows], "offset long, value string")
    return df.select(F.lit(None).cast("string").alias("key"), "value", F.lit("traffic-data").alias("topic"),
                     F.lit(0).alias("partition"), "offset", F.current_timestamp().alias("timestamp"))


def test_route_hand_trace(spark):
    got = {r.offset: (r.route, r.value) for r in routing.route_traffic(_records(spark, ROUTE_TRACE)).collect()}
    assert got == {o: (route, text) for o, _, route, text in ROUTE_TRACE}


def test_audit_of_hand_trace(spark):
    recs = _records(spark, ROUTE_TRACE)
    r = routing.route_traffic(recs)
    rec = audit.reconcile_counts(recs, r.filter("route = 'OUT'"), r.filter("route = 'BAD'")).first()
    assert (rec.input_lines, rec.output_lines, rec.bad_lines, rec.total, rec.counts_match) == (8, 3, 5, 8, True)
    assert audit.duplicate_mids(r).count() == 0
    assert audit.next_offsets(recs).first().next_offset == 8
    assert audit.end_offset_sum(audit.next_offsets(recs)).first().end_offset_sum == 8
    m = audit.mid_audit(r).first()
    assert (m.lines, m.distinct_mids, m.duplicate_mids, m.ok) == (8, 8, 0, True)
    twice = r.unionByName(r.filter("offset < 2"))
    assert sorted(x.mid for x in audit.duplicate_mids(twice).collect()) == ["MID=traffic-data-0-0", "MID=traffic-data-0-1"]
    assert audit.dedupe_by_mid(twice).count() == 8
    empty = spark.createDataFrame([("no id here",)], "value string")
    assert not audit.mid_audit(empty).first().ok


def test_lenient_parser_trace(spark):
    rows = [(o, v) for o, v, *_ in ROUTE_TRACE] + [(8, "2025-10-03T05:22:40.000Z 7 1 extra")]
    df = spark.createDataFrame(rows, "offset long, value string")
    ok = sorted(r.offset for r in tr.decoded_events(df).collect())
    assert ok == [0, 3, 7, 8]
    assert sorted(r.offset for r in tr.assign_event_time(df).collect()) == ok
    errs = {r.offset: r.parse_error for r in tr.parse_traffic_lenient(df).collect()}
    assert errs[2] == "DateTimeParseException" and errs[6] == "DateTimeParseException"
    assert errs[5] == "NumberFormatException"


@pytest.mark.parametrize("text,ok", [
    ("2025-10-03T05:22:40Z", True), ("2025-10-03T05:22:40.123456789Z", True), ("2025-10-03t05:22:40z", True),
    ("2025-10-03T05:22:40+02:00", True), ("2025-10-03", False), ("2025-10-03T05:22:40", False),
    ("2025-10-03 05:22:40Z", False), ("2025-13-03T05:22:40Z", False), ("", False)])
def test_instant_guard(spark, text, ok):
    v = spark.createDataFrame([(text,)], "t string").select(parsing.parse_instant("t").alias("v")).first().v
    assert (v is not None) == ok


@pytest.mark.parametrize("text,val", [("5", 5), ("+5", 5), ("-5", -5), (" 5", None), ("5.7", None),
                                      ("2147483648", None), ("", None), ("0x10", None)])
def test_int_guard(spark, text, val):
    assert spark.createDataFrame([(text,)], "t string").select(parsing.parse_int("t").alias("v")).first().v == val


@pytest.mark.parametrize("text,val", [("1.5", 1.5), ("1d", 1.0), ("2F", 2.0), ("1e3", 1000.0), (".5", 0.5),
                                      ("5.", 5.0), ("-0.0", -0.0), ("inf", None), ("1,5", None), ("", None),
                                      ("Infinity", float("inf"))])
def test_double_guard(spark, text, val):
    v = spark.createDataFrame([(text,)], "t string").select(parsing.parse_double("t").alias("v")).first().v
    assert v == val


def test_nan_speed_paths(spark):
    df = spark.createDataFrame([(1, "2025-10-03T05:22:40.000Z 1 NaN")], "offset long, value string")
    ev = tr.decoded_events(df)
    assert ev.count() == 1 and tr.valid_speed_filter(ev).count() == 0
    r = routing.route_traffic(df.select("value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                                        "offset", F.current_timestamp().alias("timestamp"))).first()
    assert r.route == "OUT" and r.value.endswith("SpeedKmh=NaN")


def test_formats(spark):
    df = spark.createDataFrame([(1, 1759468960000, 1759468970000, 54.125, 0.125)], "s int, a long, b long, v double, w double")
    r = df.select(formats.format_average("a", "b", "s", "v").alias("x"),
                  formats.format_average_epl("a", "b", "s", "v").alias("y"),
                  formats.format_speed_change("s", "w", "v").alias("z"),
                  formats.extract_message_id(F.lit("MID=t-0-5 rest")).alias("m")).first()
    assert r.x == "[2025-10-03T05:22:40.000Z, 2025-10-03T05:22:50.000Z) SensorId=1 AverageSpeed=54.13"
    assert r.y == "[2025-10-03T05:22:40.000Z, 2025-10-03T05:22:50.000Z) SensorId=1 AvgSpeed=54.13 km/h"
    assert r.z == "Sensor 1 | 0.13 km/h --> 54.13 km/h (Delta: 54.00)"
    assert r.m == "MID=t-0-5"


def test_anchored_idle_rows(spark):
    rows = [(1, "2025-10-03 05:22:43.000", 10.0), (2, "2025-10-03 05:22:44.000", 10.0),
            (1, "2025-10-03 05:22:52.999", 20.0), (1, "2025-10-03 05:23:04.000", 5.0)]
    df = spark.createDataFrame(rows, "sensor_id int, t string, speed_ms double").select(
        "sensor_id", F.to_timestamp("t").alias("ts"), "speed_ms")
    got = sorted((r.sensor_id, r.batch_start_ms % 100000, round(r.avg_speed_kmh, 2))
                 for r in tr.anchored_batch_avg_speed(df, with_idle=True).collect())
    # anchored at 22:43.000: 22:52.999 shares the first batch; [22:53, 23:03) is empty and
    # emits nothing; sensor 2 gets its 0.0 row in the next emitted batch
    assert got == [(1, 63000, 54.0), (1, 83000, 18.0), (2, 63000, 36.0), (2, 83000, 0.0)]

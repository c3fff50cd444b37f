"""Derived tables over the driver's ``events`` table.

The workloads need a traffic sensor log, a LiDAR scan log and a vehicle command log. None is in
the test data, so each is derived from ``events`` by plain arithmetic (the same mapping is written
in DuckDB SQL in ``keelson.plans.oracle``). ``event_id`` plays the role of the topic offset, so the
order column ``seq`` is dense and stable across re-reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived fixtures (FIXTURES.md section 2).
TRAFFIC_BASE_MS = 1759468960000  # 2025-10-03T05:22:40.000Z, first instant of the traffic file
TRAFFIC_STEP_MS = 500
TRAFFIC_SENSORS = 10
TRAFFIC_TOPIC = "traffic-data"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# ---------------------------------------------------------------- traffic

def traffic(ev: DataFrame) -> DataFrame:
    """``seq, sensor_id INT, ts TIMESTAMP, speed_ms DOUBLE``."""
    return ev.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") % TRAFFIC_SENSORS).cast("int").alias("sensor_id"),
        F.timestamp_millis(F.lit(TRAFFIC_BASE_MS) + F.col("event_id") * TRAFFIC_STEP_MS).alias("ts"),
        (F.col("value") / 10 - 3).alias("speed_ms"),
    )


def traffic_lines(ev: DataFrame) -> DataFrame:
    """Traffic file lines in topic-record layout, with corruptions chosen by ``event_id % 23``:
    3 blank, 5 two tokens, 7 date-only instant, 11 fractional sensor id, 13 decimal comma,
    17 padded with blanks (valid after trim), 19 an extra token."""
    t = traffic(ev)
    ts_txt = F.date_format(F.col("ts"), ISO_MILLIS)
    sensor = F.col("sensor_id").cast("string")
    speed = F.col("speed_ms").cast("decimal(10,3)").cast("string")
    line = F.concat_ws(" ", ts_txt, sensor, speed)
    r = F.col("seq") % 23
    value = (F.when(r == 3, F.lit(""))
             .when(r == 5, F.concat_ws(" ", ts_txt, sensor))
             .when(r == 7, F.concat_ws(" ", F.substring(ts_txt, 1, 10), sensor, speed))
             .when(r == 11, F.concat_ws(" ", ts_txt, F.concat(sensor, F.lit(".5")), speed))
             .when(r == 13, F.concat_ws(" ", ts_txt, sensor, F.regexp_replace(speed, r"\.", ",")))
             .when(r == 17, F.concat(F.lit("  "), line, F.lit("  ")))
             .when(r == 19, F.concat(line, F.lit(" extra")))
             .otherwise(line))
    return t.select(
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        F.lit(TRAFFIC_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


# ---------------------------------------------------------------- lidar

def lidar(ev: DataFrame, with_scanner: bool = False) -> DataFrame:
    """``seq, angle DOUBLE (degrees), distance DOUBLE, quality INT``; ``with_scanner`` adds
    ``scanner = user_id % 4`` so that the log interleaves four independent scanners."""
    cols = [F.col("event_id").alias("seq"),
            ((F.col("event_id") * 37) % 3600 / 10.0).alias("angle"),
            F.col("value").cast("double").alias("distance"),
            ((F.col("event_id") * 7) % 31).cast("int").alias("quality")]
    if with_scanner:
        cols.append((F.col("user_id") % 4).cast("int").alias("scanner"))
    return ev.select(*cols)


def lidar_lines(ev: DataFrame) -> DataFrame:
    """Scan file lines ``seq, value`` (JSON), corrupted by ``seq % 29``: 5 truncated JSON,
    9 fractional quality (reader truncates), 13 ``distanz`` key missing."""
    l = lidar(ev)
    good = F.to_json(F.struct(F.col("angle").alias("winkel"), F.col("distance").alias("distanz"),
                              F.col("quality").alias("qualitaet")))
    frac = F.to_json(F.struct(F.col("angle").alias("winkel"), F.col("distance").alias("distanz"),
                              (F.col("quality") + 0.75).alias("qualitaet")))
    missing = F.to_json(F.struct(F.col("angle").alias("winkel"), F.col("quality").alias("qualitaet")))
    r = F.col("seq") % 29
    value = (F.when(r == 5, good.substr(F.lit(1), F.length(good) - 5))
             .when(r == 9, frac).when(r == 13, missing).otherwise(good))
    return l.select("seq", value.alias("value"))


# ---------------------------------------------------------------- vehicles

def vehicle_commands(ev: DataFrame, with_world: bool = False) -> DataFrame:
    """``seq, type, name, x, y``: signup -> create at a grid point, error -> remove, anything
    else -> move by a small integer vector (possibly zero). ``with_world`` adds
    ``world_id = user_id % 8`` for ordered admission (vehicles interact only inside a world)."""
    e = F.col("event_id")
    typ = (F.when(F.col("event_type") == "signup", F.lit("create"))
           .when(F.col("event_type") == "error", F.lit("remove"))
           .otherwise(F.lit("move")))
    x = (F.when(typ == "create", (e * 13) % 11)
         .when(typ == "move", (e * 13) % 5 - 2)).cast("double")
    y = (F.when(typ == "create", (e * 7) % 11)
         .when(typ == "move", (e * 11) % 3 - 1)).cast("double")
    cols = [e.alias("seq"), typ.alias("type"),
            F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("name"),
            x.alias("x"), y.alias("y")]
    if with_world:
        cols.append((F.col("user_id") % 8).cast("int").alias("world_id"))
    return ev.select(*cols)


def split_commands(cmds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history, pending): commands with ``seq < n/2`` and the rest, n = number of commands."""
    half = cmds.select(F.count(F.lit(1)) / 2).scalar()
    return cmds.filter(F.col("seq") < half), cmds.filter(F.col("seq") >= half)

"""JSON record codecs as table jobs.

Decoders never raise: they add the typed columns plus ``decode_error`` (NULL for good rows), so
one pass can route good and bad rows to the same sink. ``split_decoded`` gives the two parts.
Field names on the wire are the original German keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.plans.stages import computed_once

# Fixed wire field names of the scan records.
WINKEL, DISTANZ, QUALITAET = "winkel", "distanz", "qualitaet"

_LIDAR_WIRE = T.StructType([
    T.StructField(WINKEL, T.DoubleType()),
    T.StructField(DISTANZ, T.DoubleType()),
    # read as double and truncate: an integral reader would turn 15.9 into NULL, the original
    # reader truncates it to 15
    T.StructField(QUALITAET, T.DoubleType()),
    T.StructField("_corrupt_record", T.StringType()),
])
_POS = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_GROUPED_WIRE = T.StructType([T.StructField("group", T.DoubleType()),
                              T.StructField("data", T.StructType(_LIDAR_WIRE.fields[:3]))])
_DISTANCE_WIRE = T.StructType([T.StructField("scan", T.DoubleType()), T.StructField("distance", T.DoubleType())])
_COMMAND_WIRE = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("startPosition", _POS), T.StructField("moveVector", _POS),
])
VEHICLE_TYPES = ("create", "move", "remove")


def _parsed(value_col: str, wire: T.StructType, **options):
    """``from_json`` without single quotes and NaN; a record whose text goes on after its last brace is NULL."""
    value = F.col(value_col)
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    return F.when(value.rlike(r"\}\s*\z"), F.from_json(value, wire, strict | options))


def _lidar_struct(angle="angle", distance="distance", quality="quality"):
    return F.struct(F.col(angle).alias(WINKEL), F.col(distance).alias(DISTANZ), F.col(quality).alias(QUALITAET))


def encode_lidar(df: DataFrame, out_col: str = "value") -> DataFrame:
    """``{"winkel":a,"distanz":d,"qualitaet":q}`` per reading."""
    return df.withColumn(out_col, F.to_json(_lidar_struct()))


def decode_lidar(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``angle, distance, quality`` and ``decode_error``: 'malformed' (not JSON, or a field
    of the wrong type) or 'missing field'."""
    j = _parsed(value_col, _LIDAR_WIRE, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    out = computed_once(df, {"_j": j})
    q = F.col(f"_j.{QUALITAET}").try_cast("int")
    err = (F.when(F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull(), F.lit("malformed"))
           .when(F.col(f"_j.{WINKEL}").isNull() | F.col(f"_j.{DISTANZ}").isNull() | q.isNull(),
                 F.lit("missing field")))
    return (out.withColumn("angle", F.col(f"_j.{WINKEL}")).withColumn("distance", F.col(f"_j.{DISTANZ}"))
            .withColumn("quality", q).withColumn("decode_error", err).drop("_j"))


def encode_lidar_grouped(df: DataFrame, scan_col: str = "scan", out_col: str = "value") -> DataFrame:
    """``{"group":g,"data":{...}}`` per grouped reading."""
    return df.withColumn(out_col, F.to_json(F.struct(F.col(scan_col).alias("group"), _lidar_struct().alias("data"))))


def decode_lidar_grouped(df: DataFrame, value_col: str = "value") -> DataFrame:
    j = _parsed(value_col, _GROUPED_WIRE)
    out = computed_once(df, {"_j": j})
    q = F.col(f"_j.data.{QUALITAET}").try_cast("int")
    scan = F.col("_j.group").try_cast("long")
    err = F.when(F.col("_j").isNull() | scan.isNull() | F.col(f"_j.data.{WINKEL}").isNull()
                 | F.col(f"_j.data.{DISTANZ}").isNull() | q.isNull(), F.lit("malformed"))
    return (out.withColumn("scan", scan).withColumn("angle", F.col(f"_j.data.{WINKEL}"))
            .withColumn("distance", F.col(f"_j.data.{DISTANZ}")).withColumn("quality", q)
            .withColumn("decode_error", err).drop("_j"))


def encode_lidar_distance(df: DataFrame, scan_col: str = "scan", out_col: str = "value") -> DataFrame:
    return df.withColumn(out_col, F.to_json(F.struct(F.col(scan_col).alias("scan"), F.col("distance"))))


def decode_lidar_distance(df: DataFrame, value_col: str = "value") -> DataFrame:
    j = _parsed(value_col, _DISTANCE_WIRE)
    out = computed_once(df, {"_j": j})
    scan = F.col("_j.scan").try_cast("long")
    err = F.when(F.col("_j").isNull() | scan.isNull() | F.col("_j.distance").isNull(), F.lit("malformed"))
    return (out.withColumn("scan", scan).withColumn("distance", F.col("_j.distance"))
            .withColumn("decode_error", err).drop("_j"))


def encode_vehicle_commands(df: DataFrame, out_col: str = "value") -> DataFrame:
    """Three shapes: create with ``startPosition``, move with ``moveVector``, remove with only a
    name (valid JSON; NULL fields are omitted by ``to_json``)."""
    pos = F.struct(F.col("x").alias("x"), F.col("y").alias("y"))
    s = F.struct(
        F.col("type").alias("type"), F.col("name").alias("name"),
        F.when(F.col("type") == "create", pos).alias("startPosition"),
        F.when(F.col("type") == "move", pos).alias("moveVector"))
    return df.withColumn(out_col, F.to_json(s))


def decode_vehicle_commands(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``type, name, x, y`` (start position for create, vector for move) and
    ``decode_error``; an unknown type or malformed JSON is an error (ignored by projections)."""
    j = _parsed(value_col, _COMMAND_WIRE)
    out = computed_once(df, {"_j": j})
    typ = F.col("_j.type")
    pos = F.when(typ == "create", F.col("_j.startPosition")).when(typ == "move", F.col("_j.moveVector"))
    err = (F.when(F.col("_j").isNull() | F.col("_j.name").isNull(), F.lit("malformed"))
           .when(~typ.isin(*VEHICLE_TYPES) | typ.isNull(), F.lit("unknown type"))
           .when((typ != "remove") & (pos.isNull() | pos["x"].isNull() | pos["y"].isNull()), F.lit("malformed")))
    return (out.withColumn("type", typ).withColumn("name", F.col("_j.name"))
            .withColumn("x", pos["x"]).withColumn("y", pos["y"])
            .withColumn("decode_error", err).drop("_j"))


def split_decoded(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) halves of a decoded frame."""
    return df.filter(F.col("decode_error").isNull()), df.filter(F.col("decode_error").isNotNull())


def drop_undecodable(df: DataFrame) -> DataFrame:
    """Keep rows that decoded (the original readers silently skip the rest)."""
    return df.filter(F.col("decode_error").isNull()).drop("decode_error")

"""Route each source record to OUT or BAD exactly once, tagged with its message id.

Input: topic records ``value, topic, partition, offset, timestamp`` (the Kafka source layout,
or the same columns from a file log). Output per record: ``topic, partition, offset, timestamp,
mid, route ('OUT'|'BAD'), reason, value`` where ``value`` is ``<mid> <text>``:

* OUT: ``<instant token as received> SensorId=<id> SpeedKmh=<speed*3.6, %.2f>``
* BAD: ``BAD: <blank line>`` | ``BAD: <line> | reason=expected 3 tokens`` |
  ``BAD: <line> | reason=negative speed`` | ``BAD: <line> | DateTimeParseException`` |
  ``BAD: <line> | NumberFormatException``

Strict parse: blank -> BAD; trim; exactly three blank-separated tokens; instant, integer, double
in that order; negative speed -> BAD. All native column expressions (one projection, no UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import formats, parsing
from keelson.operators.traffic import MS_TO_KMH
from keelson.plans.stages import computed_once


# The BAD texts of the original processor (exception classes stand for its
# exception messages).
BAD_BLANK = "BAD: <blank line>"
BAD_PREFIX = "BAD: "
BAD_TOKENS = " | reason=expected 3 tokens"
BAD_NEGATIVE = " | reason=negative speed"
BAD_INSTANT = " | DateTimeParseException"
BAD_NUMBER = " | NumberFormatException"


def parse_traffic_strict(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``sensor_id, speed_ms, ts, instant_text`` and ``reason`` (NULL when the line is
    good): blank, tokens, instant, int, double, negative. Each stage is computed once per row
    (``computed_once``), so filters on the result never re-run the parse."""
    v = F.col(value_col)
    s1 = computed_once(df, {"_parts": F.split(parsing.java_trim(F.coalesce(v, F.lit(""))), r"\s+", -1),
                            "_blank": parsing.is_blank(v)})
    s2 = computed_once(s1, {"_n": F.size("_parts"),
                            "_ts": parsing.parse_instant(F.get(F.col("_parts"), 0)),
                            "_sensor": parsing.parse_int(F.get(F.col("_parts"), 1)),
                            "_speed": parsing.parse_double(F.get(F.col("_parts"), 2))})
    reason = (F.when(F.col("_blank"), F.lit("blank"))
              .when(F.col("_n") != 3, F.lit("tokens"))
              .when(F.col("_ts").isNull(), F.lit("instant"))
              .when(F.col("_sensor").isNull(), F.lit("int"))
              .when(F.col("_speed").isNull(), F.lit("double"))
              .when(F.col("_speed") < 0, F.lit("negative")))
    s3 = computed_once(s2, {"reason": reason})
    good = F.col("reason").isNull()
    out = s3.select("*",
                    F.when(good, F.col("_sensor")).alias("sensor_id"), F.when(good, F.col("_speed")).alias("speed_ms"),
                    F.when(good, F.col("_ts")).alias("ts"),
                    F.when(good, F.get(F.col("_parts"), 0)).alias("instant_text"))
    return out.drop("_parts", "_blank", "_n", "_ts", "_sensor", "_speed")


def route_traffic(records: DataFrame, value_col: str = "value") -> DataFrame:
    p = parse_traffic_strict(records, value_col)
    v = F.col(value_col)
    mid = formats.message_id("topic", "partition", "offset")
    r = F.col("reason")
    text = (F.when(r.isNull(), formats.format_processed("instant_text", "sensor_id",
                                                        F.col("speed_ms") * F.lit(MS_TO_KMH)))
            .when(r == "blank", F.lit(BAD_BLANK))
            .when(r == "tokens", F.concat(F.lit(BAD_PREFIX), v, F.lit(BAD_TOKENS)))
            .when(r == "negative", F.concat(F.lit(BAD_PREFIX), v, F.lit(BAD_NEGATIVE)))
            .when(r == "instant", F.concat(F.lit(BAD_PREFIX), v, F.lit(BAD_INSTANT)))
            .otherwise(F.concat(F.lit(BAD_PREFIX), v, F.lit(BAD_NUMBER))))
    return p.select("topic", "partition", "offset", "timestamp", mid.alias("mid"),
                    F.when(r.isNull(), F.lit("OUT")).otherwise(F.lit("BAD")).alias("route"),
                    r.alias("reason"), F.concat(mid, F.lit(" "), text).alias("value"))

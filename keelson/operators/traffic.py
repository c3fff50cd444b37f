"""Traffic speed analytics: parsing, filtering, event-time windows and means.

Input events are ``sensor_id INT, speed_ms DOUBLE, ts TIMESTAMP`` (plus any order column).
Windowed means aggregate partially on the map side and shuffle once on ``(window, sensor)``;
a hot sensor is split by its windows, so no group grows with the size of the log.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import formats, parsing
from keelson.plans.ordered import shift
from keelson.plans.stages import computed_once, materialize

MS_TO_KMH = 3.6  # fixed conversion factor


# ---------------------------------------------------------------- parsing

def parse_traffic_lenient(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Split the line on blanks without trimming (trailing empty tokens dropped, a leading blank
    gives an empty first token) and read tokens 0, 1, 2 as instant, sensor id and speed; more
    tokens are ignored. Adds ``sensor_id, speed_ms, ts`` and ``parse_error`` (NULL when the line
    parsed, else the failing JDK exception class)."""
    v = F.coalesce(F.col(value_col), F.lit(""))
    s1 = computed_once(df, {"_parts": F.split(F.regexp_replace(v, r"\s+$", ""), r"\s+", -1),
                            # a non-empty all-blank line splits into no tokens at all
                            "_allblank": v.rlike(r"^\s+$")})
    n = F.when(F.col("_allblank"), F.lit(0)).otherwise(F.size("_parts"))
    s2 = computed_once(s1, {"_n": n,
                            "_ts": parsing.parse_instant(F.get(F.col("_parts"), 0)),
                            "_sensor": parsing.parse_int(F.get(F.col("_parts"), 1)),
                            "_speed": parsing.parse_double(F.get(F.col("_parts"), 2))})
    n = F.col("_n")
    err = (F.when(n < 1, F.lit("ArrayIndexOutOfBoundsException"))
           .when(F.col("_ts").isNull(), F.lit("DateTimeParseException"))
           .when(n < 2, F.lit("ArrayIndexOutOfBoundsException"))
           .when(F.col("_sensor").isNull(), F.lit("NumberFormatException"))
           .when(n < 3, F.lit("ArrayIndexOutOfBoundsException"))
           .when(F.col("_speed").isNull(), F.lit("NumberFormatException")))
    s3 = computed_once(s2, {"parse_error": err})
    ok = F.col("parse_error").isNull()
    out = s3.select("*", F.when(ok, F.col("_sensor")).alias("sensor_id"), F.when(ok, F.col("_speed")).alias("speed_ms"),
                    F.when(ok, F.col("_ts")).alias("ts"))
    return out.drop("_parts", "_allblank", "_n", "_ts", "_sensor", "_speed")


def assign_event_time(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Event time from the line itself: records are parsed leniently and ``ts`` (the instant in
    the line, truncated to ms) replaces the record timestamp. Spark has no skew limit between
    the two, so none is applied."""
    return decoded_events(records, value_col)


def event_time_watermark(events: DataFrame, delay: str = "0 seconds", ts_col: str = "ts") -> DataFrame:
    """Watermark on event time: the maximum event time seen minus ``delay``, advanced between
    micro-batches (the original advanced on the last seen time; equal for in-order input)."""
    return events.withWatermark(ts_col, delay)


def decoded_events(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parsed events only; undecodable lines are dropped (the lenient reader's behaviour)."""
    return parse_traffic_lenient(df, value_col).filter(F.col("parse_error").isNull()).drop("parse_error")


# ---------------------------------------------------------------- row ops

def valid_speed_filter(df: DataFrame, speed_col: str = "speed_ms") -> DataFrame:
    """Keep ``speed >= 0``. NaN counts as invalid (NaN >= 0 is true in Spark SQL, false in the JDK)."""
    s = F.col(speed_col)
    return df.filter((s >= 0) & ~F.isnan(s))


def ms_to_kmh(speed_ms) -> Column:
    s = F.col(speed_ms) if isinstance(speed_ms, str) else speed_ms
    return s * F.lit(MS_TO_KMH)


def sensor_speed_projection(df: DataFrame) -> DataFrame:
    return df.select("sensor_id", "speed_ms")


def event_log_lines(df: DataFrame) -> DataFrame:
    """Debug projection: one text line per event with its event time in ms."""
    return df.select(formats.event_log_line("sensor_id", "speed_ms", F.unix_millis("ts")).alias("line"))


# ---------------------------------------------------------------- windows

_UNITS_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def _duration_ms(text: str) -> int | None:
    """'10 seconds' -> 10000; None for anything else (then Spark's own window() is used)."""
    m = re.fullmatch(r"\s*(\d+)\s*(millisecond|second|minute|hour|day)s?\s*", text.lower())
    return int(m.group(1)) * _UNITS_MS[m.group(2)] if m else None


def tumbling_avg_speed(df: DataFrame, window: str = "10 seconds", key_cols: Sequence[str] = ("sensor_id",),
                       ts_col: str = "ts", speed_col: str = "speed_ms", filter_valid: bool = True) -> DataFrame:
    """Mean speed in km/h per key and fixed, epoch-aligned, half-open event-time window.
    Empty windows produce no row. Output: keys, ``window_start_ms, window_end_ms, avg_speed_kmh``.

    Batch input groups by the window start in epoch milliseconds (a long key: ~20% faster than
    grouping by Spark's window struct); streaming input uses ``window()`` so that the watermark
    can close windows (see ``keelson.streaming``)."""
    if filter_valid:
        df = valid_speed_filter(df, speed_col)
    width = _duration_ms(window)
    if df.isStreaming or width is None:
        g = (df.groupBy(F.window(F.col(ts_col), window).alias("w"), *key_cols)
             .agg(F.avg(F.col(speed_col)).alias("_avg_ms")))
        return g.select(*key_cols,
                        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
                        F.unix_millis(F.col("w.end")).alias("window_end_ms"),
                        ms_to_kmh("_avg_ms").alias("avg_speed_kmh"))
    ms = F.unix_millis(F.col(ts_col))
    start = ms - F.pmod(ms, F.lit(width))
    g = (df.filter(F.col(ts_col).isNotNull()).groupBy(start.alias("window_start_ms"), *key_cols)
         .agg(F.avg(F.col(speed_col)).alias("_avg_ms")))
    return g.select(*key_cols, "window_start_ms",
                    (F.col("window_start_ms") + F.lit(width)).alias("window_end_ms"),
                    ms_to_kmh("_avg_ms").alias("avg_speed_kmh"))


def anchored_batch_avg_speed(df: DataFrame, batch_ms: int = 10_000, origin_ms: int | Column | None = None,
                             key_cols: Sequence[str] = ("sensor_id",), ts_col: str = "ts",
                             speed_col: str = "speed_ms", filter_valid: bool = False,
                             with_idle: bool = False) -> DataFrame:
    """Batches of ``batch_ms`` of event time anchored at ``origin_ms`` (default: the first event
    time of the input, a scalar subquery), not at the epoch. Per key and batch: mean km/h and the
    key's first and last event time in the batch (``window_start_ms``/``window_end_ms``).

    No speed filter by default. ``with_idle`` adds a 0.0 row (NULL times) for a key that had a
    row in the previous non-empty batch and none in this one; batches without any event emit
    nothing, so idle rows never go past the last non-empty batch."""
    if filter_valid:
        df = valid_speed_filter(df, speed_col)
    ts_ms = F.unix_millis(F.col(ts_col))
    if origin_ms is None:
        origin = df.select(F.min(F.unix_millis(F.col(ts_col)))).scalar()
    else:
        origin = origin_ms if isinstance(origin_ms, Column) else F.lit(origin_ms)
    batch = F.floor((ts_ms - origin) / F.lit(batch_ms)).cast("long")
    # projected first: grouping expressions may not contain a subquery over a non-deterministic
    # source (e.g. line order of a text file)
    g = (df.withColumn("_batch", batch).groupBy("_batch", *key_cols)
         .agg(F.avg(F.col(speed_col)).alias("_avg_ms"),
              F.min(ts_ms).alias("window_start_ms"),
              F.max(ts_ms).alias("window_end_ms")))
    if with_idle:
        g = materialize(g)  # read three times below
    out = g.select(*key_cols,
                   (origin + F.col("_batch") * batch_ms).alias("batch_start_ms"),
                   F.col("_batch"),
                   ms_to_kmh("_avg_ms").alias("avg_speed_kmh"),
                   "window_start_ms", "window_end_ms")
    if with_idle:
        # the batch that follows k is the next non-empty one (empty batches emit nothing)
        batches = g.select("_batch").distinct()
        nxt = shift(batches, [], "_batch", [], direction=-1, prefix="_n")
        present = out.select(*key_cols, "_batch")
        following = (present.join(nxt, on="_batch")
                     .filter(F.col("_n_batch").isNotNull())
                     .select(*key_cols, F.col("_n_batch").alias("_batch")))
        idle = (following.join(present, on=[*key_cols, "_batch"], how="left_anti")
                .select(*key_cols,
                        (origin + F.col("_batch") * batch_ms).alias("batch_start_ms"),
                        F.col("_batch"),
                        F.lit(0.0).alias("avg_speed_kmh"),
                        F.lit(None).cast("long").alias("window_start_ms"),
                        F.lit(None).cast("long").alias("window_end_ms")))
        out = out.unionByName(idle)
    return out.drop("_batch")

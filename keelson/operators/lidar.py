"""LiDAR scan analytics: group readings into rotations and measure path length per rotation.

Input rows: ``seq`` (log order), ``angle`` (degrees), ``distance``, ``quality`` and optional key
columns (a device or topic partition). A rotation ends when the angle drops. Everything that
depends on log order uses bucketed two-level scans (``keelson.plans.ordered``), so neither a
single device nor an un-keyed log is ever processed by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import codecs, geometry
from keelson.functions.exact import exact_sum
from keelson.plans.ordered import DEFAULT_BUCKET_WIDTH, change_count, running_sum, shift
from keelson.plans.stages import materialize

MIN_QUALITY = 15  # fixed: readings below this quality are dropped before grouping


def lidar_quality_filter(df: DataFrame, min_quality: int = MIN_QUALITY) -> DataFrame:
    """Keep readings with ``quality >= min_quality``. Apply before ``scan_group``: a filter on a
    non-key column is not pushed below a window, and grouping depends on which rows remain."""
    return df.filter(F.col("quality") >= min_quality)


def scan_group(df: DataFrame, key_cols: Sequence[str] = (), order_col: str = "seq",
               angle_col: str = "angle", out_col: str = "scan",
               bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Rotation index per reading: starts at 0 with previous angle 0.0 and increases by one
    whenever the angle is strictly lower than the previous reading's angle (so a first reading
    with a negative angle is in rotation 1). One fused two-level pass (``change_count``): no
    task ever holds a whole device or the whole un-keyed log."""
    return change_count(df, key_cols, order_col, angle_col, lambda prev, cur: cur < prev, out_col,
                        first_prev=F.lit(0.0), bucket_width=bucket_width)


def with_cartesian(df: DataFrame, angle_col: str = "angle", distance_col: str = "distance") -> DataFrame:
    x, y = geometry.polar_to_cartesian(angle_col, distance_col)
    return df.withColumn("x", x).withColumn("y", y)


def scan_segment_distance(grouped: DataFrame, key_cols: Sequence[str] = (), order_col: str = "seq",
                          scan_col: str = "scan", bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Euclidean distance between each reading and the reading immediately before it, when
    both are in the same rotation; the first reading of a rotation yields no segment.
    Output: keys, ``scan, seq, distance``."""
    keys = list(key_cols)
    pts = with_cartesian(grouped).select(*keys, order_col, scan_col, "x", "y")
    prev = shift(pts, keys, order_col, [scan_col, "x", "y"], direction=1, prefix="_p_",
                 bucket_width=bucket_width)
    seg = prev.filter(F.col("_p_" + scan_col) == F.col(scan_col))
    return seg.select(*keys, scan_col, order_col,
                      geometry.vector_distance("x", "y", "_p_x", "_p_y").alias("distance"))


def scan_points(df: DataFrame, key_cols: Sequence[str] = (), order_col: str = "seq",
                angle_col: str = "angle", distance_col: str = "distance", out_col: str = "scan",
                bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Rotation index and segment in one two-level pass: adds ``scan`` (as ``scan_group``),
    ``x, y`` and ``segment`` — the distance to the previous reading when it is in the same
    rotation, else NULL (as ``scan_segment_distance``). A reading continues the previous
    reading's rotation exactly when no new rotation starts at it, so the previous point's
    coordinates ride along in the rotation pass (``change_count(prev_cols=...)``)."""
    pts = with_cartesian(df, angle_col, distance_col)
    out = change_count(pts, key_cols, order_col, angle_col, lambda prev, cur: cur < prev, out_col,
                       first_prev=F.lit(0.0), start_col="_new_scan", bucket_width=bucket_width,
                       prev_cols=["x", "y"], prev_prefix="_p_")
    seg = F.when(~F.col("_new_scan") & F.col("_p_x").isNotNull(),
                 geometry.vector_distance("x", "y", "_p_x", "_p_y"))
    return out.withColumn("segment", seg).drop("_new_scan", "_p_x", "_p_y")


def segments_of(points: DataFrame, key_cols: Sequence[str] = (), order_col: str = "seq",
                scan_col: str = "scan") -> DataFrame:
    """The segment rows of ``scan_points`` output, shaped like ``scan_segment_distance``."""
    return points.filter(F.col("segment").isNotNull()).select(
        *key_cols, scan_col, order_col, F.col("segment").alias("distance"))


def scan_total_distance(segments: DataFrame, key_cols: Sequence[str] = (), scan_col: str = "scan") -> DataFrame:
    """Path length per rotation: sum of its segments (partial aggregation before the shuffle)."""
    return segments.groupBy(*key_cols, scan_col).agg(F.sum("distance").alias("distance"))


def scan_total_distance_legacy(segments: DataFrame, key_cols: Sequence[str] = (), order_col: str = "seq",
                               scan_col: str = "scan", bucket_width: int = DEFAULT_BUCKET_WIDTH,
                               monotone: bool = False) -> DataFrame:
    """The totals a running-sum consumer of the segment stream emits, reproduced exactly.

    The consumer starts in rotation 0 with sum 0. On a segment of another rotation it emits
    (current rotation, sum), switches and resets the sum to 0 without adding that segment;
    otherwise it adds the segment. Consequences: every run except a leading run of rotation 0
    loses its first segment, the last run is never emitted, and a leading run of another
    rotation is preceded by an emitted (0, 0.0). Output: keys, ``emit_seq`` (emission order),
    ``scan``, ``distance``.

    Runs come from one fused ``change_count`` pass; per-run sums are a partial aggregation; the
    last run is the one without a successor (a semi join of the small runs table with itself).

    ``monotone=True`` declares that rotation ids never decrease along the order (true for the
    output of ``scan_group`` / ``scan_points``): then every rotation is one run and the result
    needs aggregates only — per rotation the sum with and without its first segment (exact sums, so
    a large first segment leaves no trace in the small rest), per key the first and last rotation —
    and no ordered pass at all."""
    keys = list(key_cols)
    if monotone:
        return _legacy_monotone(segments, keys, order_col, scan_col)
    s = segments.select(*keys, order_col, scan_col, "distance")
    s = change_count(s, keys, order_col, scan_col, lambda prev, cur: cur != prev, "_run",
                     first_prev=None, start_col="_start", bucket_width=bucket_width)
    include = ~F.col("_start") | ((F.col("_run") == 1) & (F.col(scan_col) == 0))
    runs = materialize(s.groupBy(*keys, "_run").agg(
        F.any_value(scan_col).alias(scan_col),
        F.sum(F.when(include, F.col("distance")).otherwise(F.lit(0.0))).alias("distance")))
    # run ids are dense per key: a run is emitted when run + 1 exists
    later = runs.select(*keys, (F.col("_run") - 1).alias("_run"))
    emitted = runs.join(later, on=[*keys, "_run"], how="left_semi").select(
        *keys, F.col("_run").cast("long").alias("emit_seq"), scan_col, "distance")
    lead_zero = runs.filter((F.col("_run") == 1) & (F.col(scan_col) != 0)).select(
        *keys, F.lit(0).cast("long").alias("emit_seq"), F.lit(0).cast(segments.schema[scan_col].dataType).alias(scan_col),
        F.lit(0.0).alias("distance"))
    return emitted.unionByName(lead_zero)


def _legacy_monotone(segments: DataFrame, keys: list[str], order_col: str, scan_col: str) -> DataFrame:
    first = F.min_by(F.col("distance"), F.col(order_col))
    per_scan = materialize(segments.groupBy(*keys, scan_col).agg(
        exact_sum("distance").alias("_sum"), exact_sum("distance", less=first).alias("_rest")))
    w_keys = per_scan.groupBy(*keys).agg(F.min(scan_col).alias("_lo"), F.max(scan_col).alias("_hi"))
    runs = (per_scan.join(w_keys, on=keys) if keys
            else per_scan.withColumn("_lo", w_keys.select("_lo").scalar())
            .withColumn("_hi", w_keys.select("_hi").scalar()))
    # the leading run keeps its first segment only when it is rotation 0
    keep_first = (F.col(scan_col) == F.col("_lo")) & (F.col(scan_col) == 0)
    distance = F.when(keep_first, F.col("_sum")).otherwise(F.col("_rest"))
    emitted = runs.filter(F.col(scan_col) < F.col("_hi")).select(
        *keys, scan_col, distance.alias("distance"))
    lead_zero = runs.filter((F.col(scan_col) == F.col("_lo")) & (F.col(scan_col) != 0)).select(
        *keys, F.lit(0).cast("long").alias("emit_seq"), F.lit(0).cast(segments.schema[scan_col].dataType).alias(scan_col),
        F.lit(0.0).alias("distance"))
    return _rank_scans(emitted, per_scan, keys, scan_col).unionByName(lead_zero)


def _rank_scans(emitted: DataFrame, per_scan: DataFrame, keys: list[str], scan_col: str) -> DataFrame:
    """``emit_seq`` = 1-based position of the rotation among the key's rotations with segments:
    a running count over the small per-rotation table (bucketed, so no single task)."""
    ranked = running_sum(per_scan.select(*keys, scan_col), keys, scan_col, {"emit_seq": F.lit(1)},
                         bucket_width=1 << 16)
    return emitted.join(ranked, on=[*keys, scan_col]).select(
        *keys, F.col("emit_seq").cast("long").alias("emit_seq"), scan_col, "distance")


def lidar_chain(lines: DataFrame, value_col: str = "value", order_col: str = "seq",
                   key_cols: Sequence[str] = (), min_quality: int = MIN_QUALITY,
                   bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """JSON scan lines -> decode (undecodable dropped) -> quality filter -> rotation and
    segments (one fused ordered pass) -> total path length per rotation."""
    dec = codecs.decode_lidar(lines, value_col)
    readings = dec.filter(F.col("decode_error").isNull()).select(*key_cols, order_col, "angle", "distance", "quality")
    points = scan_points(lidar_quality_filter(readings, min_quality), key_cols, order_col,
                         bucket_width=bucket_width)
    return scan_total_distance(segments_of(points, key_cols, order_col), key_cols)


def scan_frames(grouped: DataFrame, scan_col: str = "scan", key_cols: Sequence[str] = ()) -> DataFrame:
    """Plot data per point: keys, rotation, x, y, and the largest distance overall (axis range, a
    scalar subquery). Distinct rotations in order come from ``scan_ids``."""
    grouped = materialize(grouped)
    max_range = grouped.select(F.max("distance")).scalar()
    return with_cartesian(grouped).select(*key_cols, scan_col, "seq", "x", "y", max_range.alias("max_range"))


def scan_ids(grouped: DataFrame, scan_col: str = "scan", key_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct rotations in order; with ``key_cols`` those of each scanner."""
    return grouped.select(*key_cols, scan_col).distinct().orderBy(*key_cols, scan_col)

"""Streaming traffic analytics: watermarked tumbling and anchored means, incremental jump detection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keelson.operators.traffic import ms_to_kmh, tumbling_avg_speed


def tumbling_avg_speed_stream(events: DataFrame, watermark: str = "0 seconds", ts_col: str = "ts",
                              **kwargs) -> DataFrame:
    """Streaming form of ``tumbling_avg_speed``: one final row per window and sensor, emitted in
    append mode once the watermark (max event time seen minus ``watermark``) passes the window
    end. With no delay, events older than the watermark are dropped (no allowed lateness)."""
    return tumbling_avg_speed(events.withWatermark(ts_col, watermark), ts_col=ts_col, **kwargs)


def anchored_batch_avg_speed_stream(events: DataFrame, origin_ms: int, batch_ms: int = 10_000,
                                    watermark: str = "0 seconds", key_cols: Sequence[str] = ("sensor_id",),
                                    ts_col: str = "ts", speed_col: str = "speed_ms") -> DataFrame:
    """Streaming form of ``anchored_batch_avg_speed``: batches anchored at ``origin_ms`` (required
    in streaming, where the first event time is not known up front) expressed as tumbling
    windows with ``startTime = origin mod batch``, so the watermark closes them in append mode.
    Output as in batch: keys, ``batch_start_ms, avg_speed_kmh, window_start_ms, window_end_ms``
    (the key's first and last event time in the batch)."""
    shift_ms = origin_ms % batch_ms
    ev = events.withWatermark(ts_col, watermark)
    w = F.window(F.col(ts_col), f"{batch_ms} milliseconds", f"{batch_ms} milliseconds", f"{shift_ms} milliseconds")
    ts_ms = F.unix_millis(F.col(ts_col))
    g = ev.groupBy(w.alias("w"), *key_cols).agg(
        F.avg(F.col(speed_col)).alias("_avg_ms"), F.min(ts_ms).alias("window_start_ms"),
        F.max(ts_ms).alias("window_end_ms"))
    return g.select(*key_cols, F.unix_millis(F.col("w.start")).alias("batch_start_ms"),
                    ms_to_kmh("_avg_ms").alias("avg_speed_kmh"), "window_start_ms", "window_end_ms")


class SpeedChangeProcessor(StatefulProcessor):
    """Per sensor: remembers the last emitted average; each new average (in window order within
    a micro-batch) is paired with the previous one and emitted when the jump exceeds the
    threshold."""

    def __init__(self, key_cols: Sequence[str], order_col: str, value_col: str, threshold: float,
                 inclusive: bool):
        self.key_cols, self.order_col, self.value_col = list(key_cols), order_col, value_col
        self.threshold, self.inclusive = threshold, inclusive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "window_ms long, speed double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one sensor's averages of one micro-batch (bounded by the trigger size)
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.order_col, kind="stable")
        w = pdf[self.order_col].to_numpy(dtype="int64")
        v = pdf[self.value_col].to_numpy(dtype="float64")
        if self.last.exists():
            pw, pv = self.last.get()
            w_prev = np.concatenate([[pw], w[:-1]])
            v_prev = np.concatenate([[pv], v[:-1]])
            has_prev = np.ones(len(w), dtype=bool)
        else:
            w_prev = np.concatenate([[0], w[:-1]])
            v_prev = np.concatenate([[0.0], v[:-1]])
            has_prev = np.arange(len(w)) > 0
        d = np.abs(v - v_prev)
        hit = has_prev & ((d >= self.threshold) if self.inclusive else (d > self.threshold))
        if len(w):
            self.last.update((int(w[-1]), float(v[-1])))
        out = {k: [kv] * int(hit.sum()) for k, kv in zip(self.key_cols, key)}
        out.update(previous_window_ms=w_prev[hit], window_ms=w[hit],
                   previous_speed=v_prev[hit], current_speed=v[hit])
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def speed_change_stream(avgs: DataFrame, threshold: float = 20.0, inclusive: bool = False,
                        key_cols: Sequence[str] = ("sensor_id",), order_col: str = "window_start_ms",
                        value_col: str = "avg_speed_kmh") -> DataFrame:
    """Incremental ``speed_change`` over a stream of averages (append mode). State per sensor is
    one row in the state store; averages must arrive in window order across micro-batches,
    which a watermarked window aggregate guarantees."""
    fields = avgs.schema
    key_ddl = ", ".join(f"{k} {fields[k].dataType.simpleString()}" for k in key_cols)
    schema = (f"{key_ddl}, previous_window_ms long, window_ms long, previous_speed double, "
              f"current_speed double")
    proc = SpeedChangeProcessor(key_cols, order_col, value_col, threshold, inclusive)
    return avgs.groupBy(*key_cols).transformWithStateInPandas(proc, schema, "Append", "None")


def start_windowed_average_lines(events: DataFrame, path: str, checkpoint: str, watermark: str = "0 seconds",
                                 available_now: bool = True):
    """Stream the 10 s means as text, one shard per window (``<path>/window_start=<ms>/``).

    Windows are final when emitted (append mode), and each micro-batch overwrites exactly the
    window partitions it produced (dynamic partition overwrite), so a replayed batch rewrites the
    same files instead of adding copies."""
    from keelson.functions.formats import format_average

    avgs = tumbling_avg_speed_stream(events, watermark)
    lines = avgs.select(F.col("window_start_ms").alias("window_start"),
                        format_average("window_start_ms", "window_end_ms", "sensor_id", "avg_speed_kmh").alias("value"))

    def write(df: DataFrame, batch_id: int) -> None:
        (df.repartition("window_start").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("window_start").text(path))

    w = lines.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()

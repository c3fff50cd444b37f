"""Streaming LiDAR chain: rotation index, segments and totals carried across micro-batches.

One ``transformWithStateInPandas`` processor per scanner (``key_cols``) keeps the rotation
counter, the previous reading and the open rotation's running sum, plus the state of the legacy
running-sum consumer. Each micro-batch of a scanner (bounded by the trigger size) is sorted by
``seq`` and processed with vectorised numpy. Output rows (append mode), by ``kind``:

* ``segment`` — ``scan, seq, distance`` for every reading that continues its rotation;
* ``total``   — ``scan, distance`` once a rotation is closed by the next rotation's first
  reading (the open rotation is reported when a later reading arrives, as in the batch result
  minus the still-open rotation);
* ``legacy``  — ``emit_seq, scan, distance`` exactly as the running-sum consumer emits them,
  numbered as ``scan_total_distance_legacy`` (leading ``(0, 0.0)`` is 0, runs from 1).

Readings must be filtered (``lidar_quality_filter``) before this operator, as in batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_STATE = ("idx long, last_angle double, has_prev boolean, px double, py double, "
          "open_scan long, open_sum double, open_segments long, "
          "cur_group long, cur_sum double, emitted long")
_OUT_COLS = ["kind", "scan", "seq", "distance", "emit_seq"]


class LidarChainProcessor(StatefulProcessor):
    def __init__(self, key_cols: Sequence[str]):
        self.key_cols = list(key_cols)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("chain", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        if self.state.exists():
            (idx0, last_angle, has_prev, px, py, open_scan, open_sum, open_n,
             cur_group, cur_sum, emitted) = self.state.get()
        else:
            idx0, last_angle, has_prev, px, py = 0, 0.0, False, 0.0, 0.0
            open_scan, open_sum, open_n, cur_group, cur_sum, emitted = 0, 0.0, 0, 0, 0.0, 0
        seq = pdf["seq"].to_numpy(dtype="int64")
        a = pdf["angle"].to_numpy(dtype="float64")
        d = pdf["distance"].to_numpy(dtype="float64")
        rad = np.radians(a)
        x, y = np.cos(rad) * d, np.sin(rad) * d
        prev_a = np.concatenate([[last_angle], a[:-1]])
        drop = a < prev_a
        idx = idx0 + np.cumsum(drop)
        have = np.concatenate([[has_prev], np.ones(len(a) - 1, dtype=bool)])
        prev_x = np.concatenate([[px], x[:-1]])
        prev_y = np.concatenate([[py], y[:-1]])
        is_seg = have & ~drop
        dx, dy = x - prev_x, y - prev_y
        seg_d = np.sqrt(dx * dx + dy * dy)
        out = []
        s_idx, s_seq, s_d = idx[is_seg], seq[is_seg], seg_d[is_seg]
        out += [("segment", int(i), int(q), float(v), None) for i, q, v in zip(s_idx, s_seq, s_d)]

        # totals of rotations closed in this batch; the rotation open at the end stays in state
        sums: dict[int, float] = {}
        counts: dict[int, int] = {}
        if open_n:
            sums[open_scan], counts[open_scan] = open_sum, open_n
        for i, v in zip(s_idx, s_d):
            sums[int(i)] = sums.get(int(i), 0.0) + float(v)
            counts[int(i)] = counts.get(int(i), 0) + 1
        final_idx = int(idx[-1]) if len(idx) else idx0
        for i in sorted(sums):
            if i < final_idx:
                out.append(("total", i, None, sums[i], None))
        open_scan, open_sum, open_n = final_idx, sums.get(final_idx, 0.0), counts.get(final_idx, 0)

        # the running-sum consumer over the segment stream (runs of equal rotation)
        if len(s_idx):
            starts = np.flatnonzero(np.concatenate([[True], s_idx[1:] != s_idx[:-1]]))
            ends = np.concatenate([starts[1:], [len(s_idx)]])
            # ``emitted`` is the index of the current run: 0 while the consumer still holds its
            # initial (0, 0.0); a leading run of rotation 0 becomes run 1 (as in the batch form)
            for st, en in zip(starts, ends):
                g = int(s_idx[st])
                if g != cur_group:
                    out.append(("legacy", cur_group, None, cur_sum, emitted))
                    emitted += 1
                    cur_group, cur_sum = g, float(s_d[st + 1:en].sum())
                else:
                    emitted = max(emitted, 1)
                    cur_sum += float(s_d[st:en].sum())

        if len(a):
            last_angle, has_prev, px, py = float(a[-1]), True, float(x[-1]), float(y[-1])
        self.state.update((final_idx, last_angle, has_prev, px, py, open_scan, open_sum, open_n,
                           cur_group, cur_sum, emitted))
        res = pd.DataFrame(out, columns=_OUT_COLS)
        for k, v in reversed(list(zip(self.key_cols, key))):
            res.insert(0, k, v)
        yield res

    def close(self) -> None:
        pass


def lidar_chain_stream(readings: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """Streaming rotation / segment / total / legacy rows for quality-filtered readings
    ``seq, angle, distance`` (+ ``key_cols``). Without keys the log is one scanner."""
    keys = list(key_cols) or ["_scanner"]
    df = readings if key_cols else readings.withColumn("_scanner", F.lit(0))
    fields = df.schema
    key_ddl = ", ".join(f"{k} {fields[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_ddl}, kind string, scan long, seq long, distance double, emit_seq long"
    out = df.select(*keys, "seq", "angle", "distance").groupBy(*keys).transformWithStateInPandas(
        LidarChainProcessor(keys), schema, "Append", "None")
    return out if key_cols else out.drop("_scanner")

"""Text renderings of results, as column expressions.

``format_string('%.2f')`` runs the JDK formatter, so rounding is HALF_UP on the decimal form,
the same as the original printf-style output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the original outputs.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
FMT_AVERAGE = "[%s, %s) SensorId=%d AverageSpeed=%.2f"
FMT_AVERAGE_EPL = "[%s, %s) SensorId=%d AvgSpeed=%.2f km/h"
FMT_SPEED_CHANGE = "Sensor %d | %.2f km/h --> %.2f km/h (Delta: %.2f)"
FMT_PROCESSED = "%s SensorId=%d SpeedKmh=%.2f"
MID_PREFIX = "MID="


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_millis(ms) -> Column:
    """Epoch milliseconds -> ``2025-10-03T05:22:40.000Z`` (session time zone must be UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms)), ISO_MILLIS)


def format_average(start_ms, end_ms, sensor_id, avg_kmh) -> Column:
    """``[start, end) SensorId=<id> AverageSpeed=<avg %.2f>`` (windowed mean output)."""
    return F.format_string(FMT_AVERAGE,
                           iso_millis(start_ms), iso_millis(end_ms), _c(sensor_id), _c(avg_kmh))


def format_average_epl(min_ms, max_ms, sensor_id, avg_kmh) -> Column:
    """``[minTs, maxTs) SensorId=<id> AvgSpeed=<avg %.2f> km/h`` (anchored batch output)."""
    return F.format_string(FMT_AVERAGE_EPL,
                           iso_millis(min_ms), iso_millis(max_ms), _c(sensor_id), _c(avg_kmh))


def format_speed_change(sensor_id, previous, current) -> Column:
    """``Sensor <id> | <prev> km/h --> <cur> km/h (Delta: <cur-prev>)``."""
    return F.format_string(FMT_SPEED_CHANGE,
                           _c(sensor_id), _c(previous), _c(current), _c(current) - _c(previous))


def format_processed(instant_text, sensor_id, speed_kmh) -> Column:
    """``<instant as received> SensorId=<id> SpeedKmh=<%.2f>``."""
    return F.format_string(FMT_PROCESSED, _c(instant_text), _c(sensor_id), _c(speed_kmh))


def message_id(topic, partition, offset) -> Column:
    """``MID=<topic>-<partition>-<offset>``: unique per source record, used to prove
    exactly-once delivery downstream."""
    return F.concat(F.lit(MID_PREFIX), _c(topic), F.lit("-"), _c(partition).cast("string"),
                    F.lit("-"), _c(offset).cast("string"))


def extract_message_id(value) -> Column:
    """The ``MID=...`` token of an output line (empty string when absent)."""
    return F.regexp_extract(_c(value), r"(MID=\S+)", 1)


def event_log_line(sensor_id, speed_ms, ts_ms) -> Column:
    """Debug line of one parsed event with its event time in milliseconds."""
    return F.format_string("Event: SpeedEvent[sensorId=%d, speedMs=%.3f], event-time: %d",
                           _c(sensor_id), _c(speed_ms), _c(ts_ms))

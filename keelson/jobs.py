"""Job entry points (``spark-submit -m``-style): ``python -m keelson.jobs <job> [options]``.

Each job reads its input with the sources in ``keelson.sources.topics``, runs the operators and
writes to a sink; nothing is collected to the driver. Checkpoints default to a fresh folder
under the session's ``spark.checkpoint.dir``.

Jobs:
  lidar-totals      JSON-lines scan files -> path length per rotation (``--legacy`` for the
                    running-sum consumer's exact output)
  traffic-averages  traffic text files -> one text shard per 10 s window of mean km/h lines
  traffic-jumps     traffic text files -> anchored 10 s means -> jump lines (> 20 km/h)
  vehicles          vehicle command topic -> read model tables (history and summary)
  admit             command log + pending commands -> verdicts (snapshot admission)
  admit-ordered     command files (world_id, seq, type, name, x, y) -> verdicts, each command
                    judged after all earlier ones of its world (checkpointed streaming fold;
                    files must be appended in seq order, as a log is)
  route             traffic topic -> exactly-once OUT/BAD routing (streaming, checkpointed)
  audit             traffic topic + routed output -> counts and duplicate message ids
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from keelson.functions import codecs, formats
from keelson.operators import admission, audit, cep, lidar, traffic, vehicles
from keelson.plans.stages import materialized_mark, release_materialized
from keelson.session import build_session, path_exists
from keelson.sources import topics
from keelson.streaming import eos


def _lidar_totals(spark, a):
    readings = topics.read_lidar_scans(spark, a.input)
    good, _ = codecs.split_decoded(readings)
    points = lidar.scan_points(lidar.lidar_quality_filter(good), ["file"])
    seg = lidar.segments_of(points, ["file"])
    out = (lidar.scan_total_distance_legacy(seg, ["file"], monotone=True) if a.legacy
           else lidar.scan_total_distance(seg, ["file"]))
    out.write.mode(a.mode).parquet(a.output)


def _traffic_events(spark, path):
    recs = topics.read_traffic_file(spark, path)
    return traffic.decoded_events(recs)


def _traffic_averages(spark, a):
    avgs = traffic.tumbling_avg_speed(_traffic_events(spark, a.input))
    lines = avgs.select(F.col("window_start_ms").alias("window_start"),
                        formats.format_average("window_start_ms", "window_end_ms", "sensor_id",
                                               "avg_speed_kmh").alias("line"))
    topics.windowed_text_sink(lines, a.output)


def _traffic_jumps(spark, a):
    avgs = traffic.anchored_batch_avg_speed(_traffic_events(spark, a.input),
                                            origin_ms=a.origin_ms, with_idle=a.idle)
    jumps = cep.speed_change(avgs, threshold=a.threshold, order_col="batch_start_ms")
    jumps.select(formats.format_speed_change("sensor_id", "previous_speed", "current_speed").alias("value")) \
        .write.mode(a.mode).text(a.output)


def _vehicles(spark, a):
    cmds = codecs.decode_vehicle_commands(topics.read_topic(spark, a.topics, a.topic))
    good, _ = codecs.split_decoded(cmds.withColumnRenamed("offset", "seq"))
    hist = vehicles.project_vehicles(good)
    hist.write.mode(a.mode).parquet(os.path.join(a.output, "history"))
    vehicles.vehicles(spark.read.parquet(os.path.join(a.output, "history"))) \
        .write.mode(a.mode).parquet(os.path.join(a.output, "state"))


def _admit(spark, a):
    hist = spark.read.parquet(a.history)
    pending = codecs.decode_vehicle_commands(topics.read_topic(spark, a.topics, a.topic))
    good, _ = codecs.split_decoded(pending.withColumnRenamed("offset", "seq"))
    admission.admit_commands_snapshot(good, hist).write.mode(a.mode).parquet(a.output)


def _checkpoint(spark, a) -> str:
    """The streaming checkpoint belongs to the output: by default it lies beside it, so a later run
    goes on where the last one ended. A new checkpoint for an output that has rows would lose input."""
    ckpt = a.checkpoint or f"{a.output.rstrip('/')}_checkpoint"
    if path_exists(spark, f"{a.output}/_spark_metadata") and not path_exists(spark, ckpt):
        raise ValueError(f"{a.output} was written with another checkpoint than {ckpt}; pass it with --checkpoint")
    return ckpt


def _admit_ordered(spark, a):
    from keelson.streaming import vehicles as sv

    ckpt = _checkpoint(spark, a)
    schema = spark.read.parquet(a.input).schema
    cmds = spark.readStream.schema(schema).option("maxFilesPerTrigger", a.max_per_trigger).parquet(a.input)
    q = (sv.admit_commands_ordered(cmds).writeStream.format("parquet").option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start(a.output))
    q.awaitTermination()


def _route(spark, a):
    ckpt = _checkpoint(spark, a)
    src = topics.read_topic_stream(spark, a.topics, a.topic, max_per_trigger=a.max_per_trigger)
    q = eos.start_routing(src, a.output, ckpt, available_now=not a.continuous,
                          processing_time="10 seconds" if a.continuous else None)
    q.awaitTermination()


def _audit(spark, a):
    inputs = topics.read_topic(spark, a.topics, a.topic)
    routed = spark.read.parquet(a.routed)
    rec = audit.reconcile_counts(inputs, routed.filter("route = 'OUT'"), routed.filter("route = 'BAD'"))
    rec.write.mode(a.mode).json(os.path.join(a.output, "counts"))
    audit.mid_audit(routed).write.mode(a.mode).json(os.path.join(a.output, "mids"))
    audit.duplicate_mids(routed).write.mode(a.mode).parquet(os.path.join(a.output, "duplicates"))


JOBS = {"lidar-totals": _lidar_totals, "traffic-averages": _traffic_averages,
        "traffic-jumps": _traffic_jumps, "vehicles": _vehicles, "admit": _admit,
        "admit-ordered": _admit_ordered,
        "route": _route, "audit": _audit}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="keelson.jobs", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--input")
    p.add_argument("--output", required=True)
    p.add_argument("--mode", default="errorifexists")
    p.add_argument("--topics", help="root folder of the topic log")
    p.add_argument("--topic", default="traffic-data")
    p.add_argument("--history", help="history table for admit")
    p.add_argument("--routed", help="routed output for audit")
    p.add_argument("--checkpoint")
    p.add_argument("--max-per-trigger", type=int, default=topics.MAX_RECORDS_PER_POLL)
    p.add_argument("--continuous", action="store_true")
    p.add_argument("--legacy", action="store_true")
    p.add_argument("--idle", action="store_true")
    p.add_argument("--origin-ms", type=int)
    p.add_argument("--threshold", type=float, default=20.0)
    a = p.parse_args(argv)
    spark = build_session(app_name=f"keelson-{a.job}")
    mark = materialized_mark(spark)
    try:
        JOBS[a.job](spark, a)
    finally:
        release_materialized(spark, since=mark)  # this job's intermediates in spark.checkpoint.dir


if __name__ == "__main__":
    main(sys.argv[1:])

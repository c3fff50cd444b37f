"""End-to-end job entry points on small inputs."""

import os
import tempfile

from keelson import jobs
from keelson.plans import views as V
from keelson.sources import topics


def test_lidar_job(spark):
    d = tempfile.mkdtemp(prefix="job-lidar-")
    rows = [(10, 100, 20), (90, 100, 15), (180, 100, 14), (270, 100, 20), (5, 100, 20), (5, 50, 20),
            (95, 50, 30), (1, 10, 20), (2, 10, 20)]
    os.makedirs(os.path.join(d, "in"))
    with open(os.path.join(d, "in", "scans.json"), "w") as f:
        for a, dist, q in rows:
            f.write(f'{{"winkel": {a}, "distanz": {dist}, "qualitaet": {q}}}\n')
        f.write("garbage\n")
    jobs.main(["lidar-totals", "--input", os.path.join(d, "in"), "--output", os.path.join(d, "out")])
    got = sorted((r.scan, round(r.distance, 6)) for r in spark.read.parquet(os.path.join(d, "out")).collect())
    assert got == [(0, 328.557522), (1, 120.710678), (2, 0.174531)]
    jobs.main(["lidar-totals", "--legacy", "--input", os.path.join(d, "in"), "--output", os.path.join(d, "leg")])
    got = sorted((r.scan, round(r.distance, 6)) for r in spark.read.parquet(os.path.join(d, "leg")).collect())
    assert got == [(0, 328.557522), (1, 70.710678)]


def test_traffic_jobs(spark):
    d = tempfile.mkdtemp(prefix="job-traffic-")
    os.makedirs(os.path.join(d, "in"))
    with open(os.path.join(d, "in", "traffic.txt"), "w") as f:
        f.write("2025-10-03T05:22:40.000Z 1 10\n2025-10-03T05:22:45.000Z 1 20\n2025-10-03T05:22:49.999Z 1 -5\n"
                "2025-10-03T05:22:50.000Z 1 30\n2025-10-03T05:23:05.000Z 1 5\nnot a line\n")
    jobs.main(["traffic-averages", "--input", os.path.join(d, "in"), "--output", os.path.join(d, "avg")])
    lines = sorted(r.value for r in spark.read.text(os.path.join(d, "avg")).collect())
    assert lines[0] == "[2025-10-03T05:22:40.000Z, 2025-10-03T05:22:50.000Z) SensorId=1 AverageSpeed=54.00"
    jobs.main(["traffic-jumps", "--input", os.path.join(d, "in"), "--output", os.path.join(d, "jumps")])
    jumps = sorted(r.value for r in spark.read.text(os.path.join(d, "jumps")).collect())
    assert jumps == ["Sensor 1 | 108.00 km/h --> 18.00 km/h (Delta: -90.00)",
                     "Sensor 1 | 30.00 km/h --> 108.00 km/h (Delta: 78.00)"]


def test_route_and_audit_jobs(spark):
    root = tempfile.mkdtemp(prefix="job-route-")
    topics.write_topic(V.traffic_lines(V.events(spark, "/root/testdata/sf0.001")), root, "traffic-data", files=4)
    out, ck = os.path.join(root, "routed"), os.path.join(root, "ck")
    jobs.main(["route", "--topics", root, "--output", out, "--checkpoint", ck])
    jobs.main(["audit", "--topics", root, "--routed", out, "--output", os.path.join(root, "audit")])
    counts = spark.read.json(os.path.join(root, "audit", "counts")).first()
    assert counts.input_lines == 1000 and counts.counts_match
    assert spark.read.json(os.path.join(root, "audit", "mids")).first().ok


def test_admit_ordered_job(spark):
    from keelson.streaming import vehicles as sv
    root = tempfile.mkdtemp(prefix="job-admit-")
    cmds = V.vehicle_commands(V.events(spark, "/root/testdata/sf0.001"), with_world=True)
    # a command log grows by appends in seq order: write three chunks one after another
    n = cmds.count()
    for i in range(3):
        part = cmds.filter((cmds.seq >= i * n // 3) & (cmds.seq < (i + 1) * n // 3)).coalesce(1)
        part.write.mode("append").parquet(os.path.join(root, "in"))
    jobs.main(["admit-ordered", "--input", os.path.join(root, "in"), "--output", os.path.join(root, "out"),
               "--checkpoint", os.path.join(root, "ck"), "--max-per-trigger", "1"])
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, "out")).select(
        "world_id", "seq", "sub_seq", "verdict", "type", "name", "x", "y").collect())
    assert got == sorted(tuple(r) for r in sv.admit_commands_ordered(cmds).collect())


def test_vehicle_jobs(spark):
    from keelson.functions import codecs
    from keelson.operators import admission, vehicles as vh
    root = tempfile.mkdtemp(prefix="job-veh-")
    cmds = V.vehicle_commands(V.events(spark, "/root/testdata/sf0.001"))
    hist_cmds, pending = V.split_commands(cmds)
    topics.publish(codecs.encode_vehicle_commands(hist_cmds), root, "vehicles", order_col="seq")
    jobs.main(["vehicles", "--topics", root, "--topic", "vehicles", "--output", os.path.join(root, "model")])
    state = spark.read.parquet(os.path.join(root, "model", "state"))
    exp = vh.vehicles(vh.project_vehicles(hist_cmds))
    assert sorted(tuple(r) for r in state.collect()) == sorted(tuple(r) for r in exp.collect())
    topics.publish(codecs.encode_vehicle_commands(pending), root, "pending", order_col="seq")
    jobs.main(["admit", "--topics", root, "--topic", "pending", "--history", os.path.join(root, "model", "history"),
               "--output", os.path.join(root, "verdicts")])
    got = spark.read.parquet(os.path.join(root, "verdicts")).groupBy("verdict").count()
    exp_v = admission.admit_commands_snapshot(pending, vh.project_vehicles(hist_cmds)).groupBy("verdict").count()
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in exp_v.collect())

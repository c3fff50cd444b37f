"""Runs that go on: empty batches, later runs of the same job, far coordinates."""

import pytest

from keelson import jobs
from keelson.operators.proximity import with_cell
from keelson.streaming.admission import judge_batch

SCHEMA = "seq long, type string, name string, x double, y double"


def test_removed_vehicle_stays_removed(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("snapshot", "log", "verdicts")]
    for bid, cmd in enumerate([("create", "A", 0.0, 0.0), ("remove", "A", None, None), ("move", "A", 1.0, 0.0),
                               ("create", "B", 0.0, 0.0)]):
        judge_batch(spark.createDataFrame([(bid, *cmd)], SCHEMA), *paths, bid)
    judge_batch(spark.createDataFrame([(2, "move", "A", 1.0, 0.0)], SCHEMA), *paths, 2)  # a replay
    got = {r.batch_id: r.verdict for r in spark.read.parquet(paths[2]).collect()}
    assert got[2] == "unknown_move"
    assert [r.name for r in spark.read.parquet(paths[0] + "/batch_id=3").collect()] == ["B"]


def test_checkpoint_belongs_to_the_output(spark, tmp_path):
    class A:
        checkpoint, output = None, str(tmp_path / "out")

    assert jobs._checkpoint(spark, A) == A.output + "_checkpoint"
    (tmp_path / "out" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError):
        jobs._checkpoint(spark, A)


def test_far_coordinates_have_a_cell(spark):
    assert with_cell(spark.createDataFrame([(1e300, -1e300)], "x double, y double"), "x", "y", 0.5).count() == 1
    assert with_cell(spark.createDataFrame([(1e300, 0.1)], "x double, y double"), "x", "y", 0.5).first()._cx > 0

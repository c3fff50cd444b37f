"""Physical plan checks for every registered query: no nested-loop or cartesian joins, and
column pruning reaches the Parquet scan (the unused ``props`` column is never read)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))):
        assert "props" not in schema

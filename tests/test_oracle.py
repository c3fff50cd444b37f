"""The driver's correctness gate, locally: every registered query against its DuckDB SQL."""

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["sensor_id", "window_start_ms", "window_end_ms", "avg_speed_kmh"]


def test_every_query_has_oracle():
    from keelson.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SF).count() > 0
        return
    problems, n, _, _ = compare(spark, con, name, fn, sql, SF)
    assert not problems, problems

"""Every registered query against DuckDB, exactly."""

import compare
import pytest

import __spark_entry__ as entry_module
from tripmart import workload

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(workload.queries()) == set(workload.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(workload.queries()))
def test_query_matches_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == [
        "pickup_hour",
        "pickup_h3",
        "pickup_zone",
        "trip_count",
        "avg_fare",
        "avg_trip_duration_minutes",
    ]
    assert result.count() > 0

"""Every registered query against its SQL, and what its plan must not hold."""

import pytest

from __spark_entry__ import entry
from gridplume.registered import ORACLE, QUERIES
from tests.check_oracle import compare, duckdb_over
from tests.rows import plan

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_equal_the_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_DIR) == []


@pytest.mark.parametrize("name", ["int_cems_aggregated", "mart_emissions_by_fuel", "hourly_to_daily", "latest_snapshot",
                                  "run_summary", "remaining_chunks", "chunk_calendar", "not_null", "fuel_share"])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR), "simple")
    assert not [word for word in FORBIDDEN if word in text]


def test_entry(spark):
    assert entry(spark).count() > 0

"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest
from compare import duck, duck_rows, spark_rows

from farescope.plans.oracles import all_oracles
from farescope.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()
# These write tables when built.
EAGER = {
    "csv_ingest",
    "trip_table",
    "rate_lookup",
    "stored_rates",
    "stored_mappings",
    "stream_ingest",
    "place_coordinates",
    "batch_rates",
    "reload_states",
    "quick_sequential",
    "trip_row_ids",
    "quick_completeness_trips",
    "quarantine_tables",
    "incremental_rates",
    "refresh_run",
    "map_refresh",
    "geo_to_zone_split",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    columns, got = spark_rows(QUERIES[name](spark, SF))
    names, want = duck_rows(con, ORACLES[name])
    assert columns == names
    assert sum(want.values()) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_shape(spark, name):
    """No all-pairs joins, no Python in the plan, methods small enough for the JVM to compile."""
    df = QUERIES[name](spark, SF)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in text
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, SF)
        code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))

import pytest

from farescope import lookup_rates, index_zones
from farescope.operators import lookup
from farescope.schemas import RATES, REQUESTS
from farescope.sources import tables
from test_spatial import zones  # noqa: F401 - fixture


@pytest.fixture(scope="module")
def rates(spark):
    rows = [
        # zone, month, hour, traffic, rate, holiday, weekend, covid
        (1, 5, 8, 2, 4.0, 0, 0, 0),
        (1, 6, 8, 2, 40.0, 0, 0, 0),
        (1, 5, 8, 1, 99.0, 0, 0, 0),
        (2, 5, 8, 2, 7.0, 0, 0, 0),
        (1, 5, 9, 2, 5.005, 0, 1, 0),
        (1, 0, 23, 2, 6.0, 1, -1, 0),
        (1, 3, 8, 2, 10.0, 0, 0, 1),
        (1, 4, 8, 2, 20.0, 0, 0, 1),
        (1, -1, 8, 2, 8.0, 1, -1, 1),
    ]
    return spark.createDataFrame(rows, RATES)


@pytest.fixture(scope="module")
def answers(spark, zones, rates):  # noqa: F811
    requests = spark.createDataFrame(
        [
            (1, 0.5, 0.5, 5, 2, False),
            (2, 0.5, 0.5, 5, 2, True),
            (3, 2.0, 4.0, 5, 2, False),  # on the border of zones 1 and 2
            (4, 50.0, 50.0, 5, 2, False),
        ],
        REQUESTS,
    )
    out = lookup_rates(requests, rates, index_zones(zones, 0.5, "include"), 0.5)
    assert out.columns == ["request_id", "series", "hour", "rate"]
    return {(r.request_id, r.series, r.hour): r.rate for r in out.collect()}


def test_dense_hours(answers):
    assert len(answers) == 4 * 3 * 24


def test_month_traffic_and_series(answers):
    known = {k: v for k, v in answers.items() if v is not None and k[0] == 1}
    assert known == {(1, "weekday", 8): 4.0, (1, "weekend", 9): 5.01, (1, "holiday", 23): 6.0}


def test_restrictions_average_months_unweighted(answers):
    known = {k: v for k, v in answers.items() if v is not None and k[0] == 2}
    assert known == {(2, "weekday", 8): 15.0, (2, "holiday", 8): 8.0}


def test_shared_border_averages_zones(answers):
    assert answers[3, "weekday", 8] == 5.5
    assert answers[3, "weekend", 9] == 5.01


def test_off_the_map(answers):
    assert all(v is None for k, v in answers.items() if k[0] == 4)


def test_stored_curves_answer_alike_and_stay_in_place(spark, zones, rates, tmp_path, monkeypatch):  # noqa: F811
    base = str(tmp_path)
    assert tables.read_curves(spark, base).count() == 0
    tables.write_curves(lookup.rate_curves(rates.limit(1)), base)
    tables.write_curves(lookup.rate_curves(rates), base)
    curves = tables.read_curves(spark, base)
    index = index_zones(zones, 0.5, "include")
    requests = spark.range(400).selectExpr(
        "id AS request_id", "0.05D + (id % 40) / 4.0D AS lat", "0.05D + (id % 23) / 3.0D AS lng",
        "cast(id % 12 + 1 AS int) AS month", "cast(id % 3 + 1 AS int) AS traffic", "id % 5 = 0 AS covid",
    )
    want = sorted(map(tuple, lookup_rates(requests, rates, index, 0.5).collect()), key=str)
    assert sorted(map(tuple, lookup_rates(requests, curves, index, 0.5).collect()), key=str) == want
    monkeypatch.setattr(lookup, "broadcast_if_small", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_rates(requests, curves, index, 0.5)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, joined.collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert not [line for line in plan.split("\n") if "Exchange" in line and "_totals" in line]

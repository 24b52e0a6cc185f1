from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farescope import clean_trips, odd_date_trips, reject_audit, sanitize_columns, unify_columns
from farescope.functions.names import sanitize_name
from farescope.functions import measures as M
from farescope.operators.clean import typed
from farescope.schemas import CLEAN_GEO, CLEAN_ZONE

GOOD = dict(
    pickup_datetime="2018-05-05 10:00:00",
    dropoff_datetime="2018-05-05 10:30:00",
    passenger_count="1",
    trip_distance="5.0",
    tip_amount="1.0",
    total_amount="21.0",
    PULocationID="7",
    DOLocationID="8",
)


def frame(spark, *changes, base=GOOD):
    rows = [{**base, **c} for c in changes]
    names = list(base)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_derived_values(spark):
    df = clean_trips(frame(spark, {}), 2021)
    assert df.schema.fieldNames() == CLEAN_ZONE.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in CLEAN_ZONE]
    row = df.first()
    assert (row.fare_amount, row.rate, row.duration, row.speed) == (20.0, 4.0, 0.5, 10.0)
    assert (row.traffic, row.isweekend, row.pickup_hour, row.pickup_month) == (2, 1, 10, 5)


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"pickup_datetime": ""}, 0),
        ({"dropoff_datetime": None}, 0),
        ({"pickup_datetime": "not a time"}, 0),
        ({"passenger_count": "0"}, 0),
        ({"passenger_count": None}, 0),
        ({"passenger_count": "1.0"}, 1),
        ({"trip_distance": "0.5", "dropoff_datetime": "2018-05-05 10:06:30"}, 0),
        ({"tip_amount": "-1"}, 0),
        ({"tip_amount": "0"}, 1),
        ({"total_amount": "2.49"}, 0),
        ({"total_amount": "2.5", "tip_amount": "0"}, 1),
        ({"total_amount": "251", "tip_amount": "1"}, 0),  # rate exactly 50
        ({"total_amount": "250.95", "tip_amount": "1"}, 1),  # 49.99
        ({"total_amount": "250.975", "tip_amount": "1"}, 0),  # 49.995 rounds to 50
        ({"dropoff_datetime": "2018-05-05 10:06:17", "trip_distance": "2"}, 0),  # 377 s is 0.10 h
        ({"dropoff_datetime": "2018-05-05 10:06:18", "trip_distance": "2"}, 1),  # 378 s is 0.11 h
        ({"trip_distance": "2.5"}, 0),  # speed exactly 5
        ({"trip_distance": "2.51"}, 1),
        ({"trip_distance": "50", "total_amount": "90"}, 0),  # speed exactly 100
        ({"trip_distance": "49.99", "total_amount": "90"}, 1),
        ({"pickup_datetime": "2007-12-31 23:50:00", "dropoff_datetime": "2008-01-01 00:20:00"}, 0),
        ({"pickup_datetime": "2008-01-01 00:00:00", "dropoff_datetime": "2008-01-01 00:30:00"}, 1),
        ({"pickup_datetime": "2021-12-31 23:59:59", "dropoff_datetime": "2022-01-01 00:30:00"}, 1),
        ({"pickup_datetime": "2022-01-01 00:00:00", "dropoff_datetime": "2022-01-01 00:30:00"}, 0),
        ({"PULocationID": "0"}, 0),
        ({"PULocationID": None}, 0),
        ({"DOLocationID": "0"}, 1),
    ],
)
def test_edges(spark, change, kept):
    raw = frame(spark, change)
    assert clean_trips(raw, 2021).count() == kept
    audit = {r.rule: r.trips for r in reject_audit(raw, 2021).collect()}
    assert audit.get("kept", 0) == kept and sum(audit.values()) == 1


@pytest.mark.parametrize("miles, level", [("12.5", 2), ("12.51", 1), ("5.0", 2), ("4.99", 3)])
def test_traffic_bounds_are_moderate(spark, miles, level):
    assert clean_trips(frame(spark, {"trip_distance": miles}), 2021).first().traffic == level


def test_geo_variant_needs_only_a_pickup_place(spark):
    base = {k: v for k, v in GOOD.items() if not k.endswith("LocationID")}
    base |= dict(Pickup_Longitude="-73.9", pickup_latitude="40.7", dropoff_longitude="0", dropoff_latitude="0")
    raw = unify_columns(frame(spark, {}, {"pickup_latitude": "0"}, {"Pickup_Longitude": "0"}, base=base))
    df = clean_trips(raw, 2021)
    assert df.schema.fieldNames() == CLEAN_GEO.fieldNames()
    assert df.count() == 1


def test_quarantine_holds_odd_years_only(spark):
    odd = {"pickup_datetime": "2001-01-01 10:00:00", "dropoff_datetime": "2001-01-01 10:30:00"}
    raw = frame(spark, {}, odd, {**odd, "tip_amount": "-1"})
    assert [r.pickup_year for r in odd_date_trips(raw, 2021).collect()] == [2001]


def test_durations_ignore_the_session_time_zone(spark):
    raw = frame(spark, {"pickup_datetime": "2018-03-11 01:45:00", "dropoff_datetime": "2018-03-11 03:15:00", "trip_distance": "20"})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = clean_trips(raw, 2021).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.duration == 1.5


def test_filters_reach_a_typed_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    typed(frame(spark, {}, {"passenger_count": "0"})).write.parquet(path)
    df = clean_trips(spark.read.parquet(path), 2021)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for test in (
        "GreaterThan(passenger_count,0)",
        "GreaterThan(trip_distance,0.5)",
        "GreaterThanOrEqual(total_amount,2.5)",
        "GreaterThan(PULocationID,0)",
        "GreaterThanOrEqual(pickup_datetime,2008-01-01T00:00)",
        "LessThan(pickup_datetime,2022-01-01T00:00)",
    ):
        assert test in pushed
    assert "Exchange" not in plan
    assert df.count() == 1


def test_names():
    assert sanitize_name(" Trip_Distance") == "Trip_Distance"
    assert sanitize_name("total_amount\r") == "total_amount"
    assert sanitize_name("ab cd") == "ab"  # the first of the longest
    assert sanitize_name("a----b") == "----"  # separators count as pieces too
    assert sanitize_name("plain") == "plain"


def test_name_variants(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `Total_Amt\r` int")
    assert sanitize_columns(df, last_only=True).columns == ["a b", "Total_Amt"]
    assert unify_columns(sanitize_columns(df)).columns == ["a", "total_amount"]


def half_up(x: float) -> Decimal:
    return Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP)


@settings(max_examples=2000, deadline=None)
@given(st.floats(0.001, 1000), st.sampled_from([49.995, 5.005, 99.995, 25.005, 9.995]), st.integers(-3, 3))
def test_unrounded_bounds_equal_rounded_tests(x, bound, ulps):
    """The comparisons in ``cleaning_rules`` and ``traffic_level`` stand for tests of rounded values."""
    import math

    near = bound
    for _ in range(abs(ulps)):
        near = math.nextafter(near, math.inf if ulps > 0 else -math.inf)
    for v in (x, near):
        assert (v < 49.995) == (half_up(v) < 50)
        assert (v < 99.995) == (half_up(v) < 100)
        assert (v >= 5.005) == (half_up(v) > 5)
        assert (v >= 25.005) == (half_up(v) > 25)
        assert (v < 9.995) == (half_up(v) < 10)


def test_hours_equal_decimal_rounding(spark):
    rows = spark.range(0, 40_000).select("id", M.hours(F.col("id")).alias("h"), F.round(F.col("id") / 3600, 2).alias("r"))
    assert rows.filter("h <> r").count() == 0

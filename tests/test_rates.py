from collections import Counter

import pytest
from pyspark.sql import functions as F

from farescope import build_rates
from farescope.operators.rates import SLICES, rate_slice
from farescope.schemas import RATES

SCHEMA = (
    "PULocationID int, pickup_date date, pickup_year int, pickup_month int, pickup_hour int, traffic int, "
    "rate double, isholiday int, isweekend int"
)
ROWS = [
    # zone, date, year, stored month, hour, traffic, rate, holiday, weekend
    (1, "2019-05-06", 2019, 5, 8, 2, 4.0, 0, 0),
    (1, "2019-05-07", 2019, 5, 8, 2, 5.0, 0, 0),
    (1, "2021-05-07", 2021, 5, 8, 2, 9.0, 0, 0),
    (1, "2020-02-29", 2020, 2, 8, 2, 3.0, 0, 1),
    (1, "2020-03-01", 2020, 3, 8, 2, 6.0, 0, 1),
    (1, "2020-07-04", 2020, 0, 8, 2, 7.0, 1, -1),
    (1, "2021-01-01", 2021, 0, 8, 2, 8.0, 1, -1),
]


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(
        [(r[0], None, *r[2:]) for r in ROWS], SCHEMA
    ).drop("pickup_date").join(
        spark.createDataFrame([(r[6], r[1]) for r in ROWS], "rate double, d string").select(
            "rate", F.to_date("d").alias("pickup_date")
        ),
        "rate",
    )


def table(df):
    assert df.schema.fieldNames() == RATES.fieldNames()
    return {
        (r.isholiday, r.isweekend, r.iscovid, r.target_month): r.rate for r in df.collect()
    }


def test_compat_counts_late_trips_twice(trips):
    assert table(build_rates(trips)) == {
        (0, 0, 0, 5): 6.0,  # 4, 5 and 9: years after 2020 stay in the first era
        (0, 0, 1, 5): 9.0,
        (0, 1, 0, 2): 3.0,
        (0, 1, 1, 3): 6.0,
        (1, -1, 0, 0): 7.5,  # both holidays: the stored month is 0
        (1, -1, 1, -1): 8.0,
    }


def test_calendar_keeps_eras_apart(trips):
    assert table(build_rates(trips, "calendar")) == {
        (0, 0, 0, 5): 4.5,
        (0, 0, 1, 5): 9.0,
        (0, 1, 0, 2): 3.0,
        (0, 1, 1, 3): 6.0,
        (1, -1, 1, -1): 7.5,
    }


@pytest.mark.parametrize("mode", ["compat", "calendar"])
def test_one_plan_equals_six(spark, trips, mode):
    whole = Counter(tuple(r) for r in build_rates(trips, mode).collect())
    parts = Counter(tuple(r) for name in SLICES for r in rate_slice(trips, name, mode).collect())
    assert whole == parts


def test_unknown_mode(trips):
    with pytest.raises(ValueError):
        build_rates(trips, "other")

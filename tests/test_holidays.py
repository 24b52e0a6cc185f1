import datetime as dt

from farescope import flag_holidays, holiday_calendar
from farescope.schemas import TRIPS_ZONE
from test_clean import frame
from farescope import clean_trips

# Public holidays of 2021 and 2022 in the State of New York, with observed days.
DAYS_2021 = """2021-01-01 2021-01-18 2021-02-12 2021-02-15 2021-05-31 2021-06-18 2021-06-19 2021-07-04
2021-07-05 2021-09-06 2021-10-11 2021-11-02 2021-11-11 2021-11-25 2021-12-24 2021-12-25 2021-12-31""".split()


def test_known_year(spark):
    cal = holiday_calendar(spark, 2022, 2021)
    days = sorted(str(r.holiday_date) for r in cal.filter("year(holiday_date) = 2021").collect())
    assert days == DAYS_2021
    assert cal.count() == cal.select("holiday_date").distinct().count()


def test_rules_by_year(spark):
    cal = {r.holiday_date for r in holiday_calendar(spark, 2020, 2008).collect()}
    assert dt.date(2008, 11, 4) in cal and dt.date(2009, 11, 3) not in cal and dt.date(2015, 11, 3) in cal
    assert dt.date(2020, 6, 19) not in cal
    plain = {r.holiday_date for r in holiday_calendar(spark, 2020, 2008, state_days=False).collect()}
    assert plain < cal and dt.date(2016, 2, 12) in cal - plain


def test_overlay(spark):
    raw = frame(
        spark,
        {"pickup_datetime": "2018-07-04 10:00:00", "dropoff_datetime": "2018-07-04 10:30:00"},
        {},
    )
    # A calendar that names a date twice must not repeat trips.
    cal = holiday_calendar(spark, 2018, 2018)
    df = flag_holidays(clean_trips(raw, 2021), cal.unionByName(cal))
    assert df.schema.fieldNames() == TRIPS_ZONE.fieldNames()
    rows = {str(r.pickup_date): (r.pickup_month, r.isweekend, r.isholiday) for r in df.collect()}
    assert rows == {"2018-07-04": (0, -1, 1), "2018-05-05": (5, 1, 0)}

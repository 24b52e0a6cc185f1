"""Holiday calendar and the calendar flags of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farescope import schemas
from farescope.session import broadcast_if_small

# Public holidays of the United States and the State of New York.
# (name, month, day, first year, weekend copies, state day)
FIXED_DATES = (
    ("New Year's Day", 1, 1, 1870, True, False),
    ("Lincoln's Birthday", 2, 12, 1971, True, True),
    ("Susan B. Anthony Day", 2, 15, 2004, False, True),
    ("Juneteenth", 6, 19, 2021, True, False),
    ("Independence Day", 7, 4, 1870, True, False),
    ("Veterans Day", 11, 11, 1938, True, False),
    ("Christmas Day", 12, 25, 1870, True, False),
)
# (name, month, weekday, which one in the month; 0 is the last)
NTH_WEEKDAYS = (
    ("Martin Luther King Jr. Day", 1, "Mon", 3),
    ("Washington's Birthday", 2, "Mon", 3),
    ("Memorial Day", 5, "Mon", 0),
    ("Labor Day", 9, "Mon", 1),
    ("Columbus Day", 10, "Mon", 2),
    ("Thanksgiving", 11, "Thu", 4),
)
FIRST_YEAR = 2008


def _entry(date: str, name: str) -> str:
    escaped = name.replace("'", "\\'")
    return f"named_struct('holiday_date', {date}, 'name', '{escaped}')"


def _fixed(name: str, month: int, day: int, since: int, copies: bool) -> list[str]:
    """A fixed date and, on weekends, its copy on the Friday before or the Monday after."""
    date = f"if(y >= {since}, make_date(y, {month}, {day}), NULL)"
    entries = [_entry(date, name)]
    if copies:
        shifted = f"CASE dayofweek({date}) WHEN 7 THEN date_sub({date}, 1) WHEN 1 THEN date_add({date}, 1) END"
        entries.append(_entry(shifted, f"{name} (observed)"))
    return entries


def _nth(month: int, weekday: str, nth: int) -> str:
    first = f"make_date(y, {month}, 1)"
    if nth:
        return f"date_add(next_day(date_sub({first}, 1), '{weekday}'), {7 * (nth - 1)})"
    return f"next_day(date_sub(last_day({first}), 7), '{weekday}')"


def holiday_calendar(
    spark: SparkSession,
    last_year: int,
    first_year: int = FIRST_YEAR,
    state_days: bool = True,
) -> DataFrame:
    """(holiday_date, name), one row per date, from ``first_year`` to ``last_year``."""
    entries: list[str] = []
    for name, month, day, since, copies, state in FIXED_DATES:
        if state_days or not state:
            entries += _fixed(name, month, day, since, copies)
    entries += [_entry(_nth(month, day, nth), name) for name, month, day, nth in NTH_WEEKDAYS]
    if state_days:
        # Tuesday after the first Monday of November: even years, and every year from 2015.
        tuesday = f"date_add({_nth(11, 'Mon', 1)}, 1)"
        entries.append(_entry(f"if(y % 2 = 0 OR y >= 2015, {tuesday}, NULL)", "Election Day"))
    return (
        spark.range(first_year, last_year + 1, numPartitions=1)
        .selectExpr("CAST(id AS INT) AS y")
        .selectExpr(f"inline(array({', '.join(entries)}))")
        .where("holiday_date IS NOT NULL")
        .groupBy("holiday_date")
        .agg(F.min("name").alias("name"))
    )


def flag_holidays(
    trips: DataFrame, calendar: DataFrame, small: bool | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Overlay the calendar: holiday trips get month 0, weekend flag -1, holiday flag 1.

    ``calendar`` needs a ``holiday_date`` column. It is made unique by date, so the
    left join never repeats a trip, and is broadcast once its size has been checked.
    ``small=True`` skips the check for a calendar made by ``holiday_calendar``, which
    has at most some twenty rows per year. ``sourceid`` is kept, or NULL if absent, and so
    are the columns named by ``keep``.
    """
    days = calendar.select("holiday_date").filter("holiday_date IS NOT NULL").distinct()
    days = F.broadcast(days) if small else broadcast_if_small(days)
    joined = trips.join(days, F.col("pickup_date") == F.col("holiday_date"), "left")
    hit = F.col("holiday_date").isNotNull()
    flagged = joined.withColumns(
        {
            "pickup_month": F.when(hit, F.lit(0)).otherwise(F.col("pickup_month")),
            "isweekend": F.when(hit, F.lit(-1)).otherwise(F.col("isweekend")),
            "isholiday": F.when(hit, F.lit(1)).otherwise(F.lit(0)),
        }
    ).drop("holiday_date")
    stored = schemas.TRIPS_GEO if schemas.has_coordinates(trips) else schemas.TRIPS_ZONE
    if "sourceid" not in flagged.columns:
        flagged = flagged.withColumn("sourceid", F.lit(None).cast("long"))
    return flagged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.fields], *keep)

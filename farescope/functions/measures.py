"""Trip measures as Column expressions.

Every stored measure is rounded half-up to two decimals. Rounding a double goes
through a decimal, so it is done once per stored value. Tests such as ``rate < 50``
compare the unrounded quotient with the point where rounding would reach the bound:
``round(x, 2) < 50`` is ``x < 49.995`` and ``round(x, 2) > 5`` is ``x >= 5.005``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; zone-free timestamps are counted as they stand, never via a time zone."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def hours(seconds: Column) -> Column:
    """Seconds as hours rounded half-up to two decimals, in integer arithmetic.

    A hundredth of an hour is 36 seconds, so half of it is a whole number of seconds
    and no decimal rounding is needed.
    """
    return F.floor((seconds + F.lit(18)) / F.lit(36)).cast("double") / F.lit(100.0)


def quotient(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def two_decimals(x: Column) -> Column:
    return F.round(x, 2)


def two_decimals_stable(x: Column) -> Column:
    """Two-decimal rounding that ignores the last bits of a summed double."""
    return F.round(x.cast("decimal(38,12)"), 2).cast("double")


def traffic_level(raw_speed: Column) -> Column:
    """1 light (over 25 mph), 3 heavy (under 10 mph), else 2; bounds count as moderate."""
    return (
        F.when(raw_speed >= F.lit(25.005), F.lit(1))
        .when(raw_speed < F.lit(9.995), F.lit(3))
        .otherwise(F.lit(2))
    )


def weekend_flag(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def date_parts(moment: Column) -> dict[str, Column]:
    """Calendar parts of the pickup; Sunday is weekday 1."""
    return {
        "pickup_date": moment.cast("date"),
        "pickup_year": F.year(moment),
        "pickup_month": F.month(moment),
        "pickup_day": F.dayofmonth(moment),
        "pickup_weekday": F.dayofweek(moment),
        "pickup_hour": F.hour(moment),
    }

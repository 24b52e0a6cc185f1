"""Average fare per mile by zone, month, hour and traffic, in six slices.

Slices are a day kind (holiday, workday, weekend) in an era (before or during the
social restrictions). All six come from one scan and one shuffle: each group keeps a
sum and a count per era, and the two eras become rows only after aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farescope import schemas

MODES = ("compat", "calendar")

# Slice name -> (isholiday, isweekend, iscovid) as stored in the rates table.
SLICES = {
    "holiday": (1, -1, 0),
    "workday": (0, 0, 0),
    "weekend": (0, 1, 0),
    "covid_holiday": (1, -1, 1),
    "covid_workday": (0, 0, 1),
    "covid_weekend": (0, 1, 1),
}


def era_predicates(mode: str) -> tuple[Column, Column]:
    """(before, during) restrictions.

    ``compat`` tests the stored month, which is 0 on holidays, and lets trips after
    2020 count in both eras. ``calendar`` takes the month of ``pickup_date`` and keeps
    the eras apart: restrictions run from March 2020 on.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    year = F.col("pickup_year")
    if mode == "calendar":
        during = F.col("pickup_date") >= F.lit("2020-03-01").cast("date")
        return ~during, during
    month = F.col("pickup_month")
    before = (year != 2020) | (month < 3)
    during = (year > 2020) | ((year == 2020) & (month > 2))
    return before, during


def rate_sums(trips: DataFrame, mode: str = "compat", *keys: str) -> DataFrame:
    """Sums and counts of both eras by zone, month, hour, traffic and kind of day, and by ``keys``.

    They add up: those of several sources are merged by ``rates_of_sums``. ``rate`` holds whole
    cents (two decimals by definition), so it is summed as an integer: exact, independent of the
    order of rows, and cheap to combine map-side.
    """
    before, during = era_predicates(mode)
    cents = F.round(F.col("rate") * 100).cast("long")
    holiday = F.col("isholiday") == 1
    month = F.when(holiday, F.lit(0)).otherwise(F.col("pickup_month"))
    weekend = F.when(holiday, F.lit(-1)).when(F.col("isweekend") == 1, F.lit(1)).otherwise(F.lit(0))

    def total(era: Column) -> Column:
        return F.sum(F.when(era, cents))

    def trips_in(era: Column) -> Column:
        return F.count(F.when(era, cents))

    return trips.groupBy(
        *keys,
        F.col("PULocationID").cast("int").alias("zoneid"),
        month.cast("int").alias("target_month"),
        F.col("pickup_hour").alias("target_hour"),
        "traffic",
        weekend.alias("isweekend"),
    ).agg(
        total(before).alias("c0"),
        trips_in(before).alias("n0"),
        total(during).alias("c1"),
        trips_in(during).alias("n1"),
    )


def _rates(grouped: DataFrame) -> DataFrame:
    eras = F.array(
        F.struct(F.lit(0).alias("iscovid"), F.col("c0").alias("cents"), F.col("n0").alias("n")),
        F.struct(F.lit(1).alias("iscovid"), F.col("c1").alias("cents"), F.col("n1").alias("n")),
    )
    kind = grouped.select(
        "zoneid", "target_month", "target_hour", "traffic", "isweekend", F.inline(eras)
    ).filter("n > 0")
    holiday_row = F.col("isweekend") == -1
    out = kind.withColumns(
        {
            "rate": F.col("cents").cast("double") / (F.col("n") * 100).cast("double"),
            "isholiday": F.when(holiday_row, F.lit(1)).otherwise(F.lit(0)),
            "target_month": F.when(holiday_row & (F.col("iscovid") == 1), F.lit(-1)).otherwise(
                F.col("target_month")
            ),
        }
    )
    return out.select(*schemas.RATES.fieldNames())


def build_rates(trips: DataFrame, mode: str = "compat") -> DataFrame:
    """The rates table from flagged trips of the zone variant."""
    return _rates(rate_sums(trips, mode))


def rates_of_sums(sums: DataFrame) -> DataFrame:
    """The rates table from the sums of several sources."""
    keys = ["zoneid", "target_month", "target_hour", "traffic", "isweekend"]
    return _rates(sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("c0", "n0", "c1", "n1")]))


def rate_slice(trips: DataFrame, name: str, mode: str = "compat") -> DataFrame:
    """One of the six slices; the slice predicate is pushed to the scan side."""
    isholiday, isweekend, iscovid = SLICES[name]
    wanted = (
        (F.col("isholiday") == 1)
        if isholiday
        else (F.col("isholiday") < 1)
        & ((F.col("isweekend") == 1) if isweekend == 1 else (F.col("isweekend") < 1))
    )
    era = era_predicates(mode)[iscovid]
    return build_rates(trips.filter(wanted & era), mode).filter(F.col("iscovid") == iscovid)

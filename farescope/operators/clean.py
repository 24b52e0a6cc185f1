"""Cleaning of raw trips: typing, filters, derived measures, rejection audit.

All of it is one narrow projection and filter chain: no shuffle, no Python, and the
scan reads only the ten or so columns that are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farescope import schemas
from farescope.functions import measures as M
from farescope.session import evaluate_once

_RAW_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "pickup_latitude": "double",
    "pickup_longitude": "double",
    "dropoff_latitude": "double",
    "dropoff_longitude": "double",
}

_ODD_DATE = "odd_date"


_CARRIED = ("sourceid", "filename")


def typed(df: DataFrame) -> DataFrame:
    """Canonical columns in their proper types; text that does not parse becomes NULL.

    The source columns pass through, all others are dropped.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    columns = []
    for name, wanted in _RAW_TYPES.items():
        if name.lower() not in kinds:
            continue
        column = F.col(name)
        if wanted == "int" and not isinstance(kinds[name.lower()], T.IntegralType):
            column = column.try_cast("double")  # text such as "1.0" is still a count
        columns.append(column.try_cast(wanted).alias(name))
    columns += [F.col(c) for c in df.columns if c in _CARRIED]
    parsed = any(isinstance(k, T.StringType) for n, k in kinds.items() if n not in _CARRIED)
    return evaluate_once(df, *columns) if parsed else df.select(*columns)


def raw_columns(geo: bool) -> list[str]:
    """The canonical columns of one variant's files, in order."""
    others = schemas.ZONE_ENDS if geo else schemas.GEO_ENDS
    return [c for c in _RAW_TYPES if c not in others]


def _with_quotients(df: DataFrame) -> DataFrame:
    fare = F.col("total_amount") - F.col("tip_amount")
    seconds = M.seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return df.withColumns({"fare_amount": fare, "seconds": seconds})


def _raw_rate() -> Column:
    return M.quotient(F.col("fare_amount"), F.col("trip_distance"))


def _raw_speed() -> Column:
    return M.quotient(F.col("trip_distance"), M.hours(F.col("seconds")))


def cleaning_rules(geo: bool, as_of_year: int | None = None) -> dict[str, Column]:
    """Rules in the order they apply; a row is kept when every one is true.

    They read the canonical columns plus ``fare_amount`` and ``seconds``. A NULL
    operand rejects the row. Bounds on rounded measures are stated on the unrounded
    quotient (see ``functions.measures``).
    """
    current = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    first = F.lit("2008-01-01").cast("timestamp_ntz")
    end = F.make_date(current + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    pickup = F.col("pickup_datetime")
    rules = {
        "no_datetime": F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull(),
        "no_passenger": F.col("passenger_count") > 0,
        "short_distance": F.col("trip_distance") > 0.5,
        "negative_tip": F.col("tip_amount") >= 0,
        "below_minimum_fare": F.col("total_amount") >= 2.5,
        "rate_too_high": _raw_rate() < F.lit(49.995),  # rounded rate < 50
        "too_brief": F.col("seconds") >= F.lit(378),  # rounded hours > 0.1
        _ODD_DATE: (pickup >= first) & (pickup < end),
        "odd_speed": (_raw_speed() >= F.lit(5.005)) & (_raw_speed() < F.lit(99.995)),
    }
    if geo:
        rules["no_pickup_place"] = (F.col("pickup_latitude") != 0) & (F.col("pickup_longitude") != 0)
    else:
        rules["no_pickup_place"] = F.col("PULocationID") > 0
    return rules


def _finish(df: DataFrame, geo: bool, *extra: str) -> DataFrame:
    """Derived columns of rows that passed, in the stored order."""
    pickup = F.col("pickup_datetime")
    derived = df.withColumns(
        {
            **M.date_parts(pickup),
            "duration": M.hours(F.col("seconds")),
            "speed": M.two_decimals(_raw_speed()),
            "traffic": M.traffic_level(_raw_speed()),
            "rate": M.two_decimals(_raw_rate()),
            "isweekend": M.weekend_flag(pickup),
        }
    )
    names = (schemas.CLEAN_GEO if geo else schemas.CLEAN_ZONE).fieldNames()
    carried = [c for c in df.columns if c in _CARRIED]
    return derived.select(*names, *carried, *extra)


def _split(raw: DataFrame, as_of_year: int | None, odd_dates: bool) -> DataFrame:
    geo = schemas.has_coordinates(raw)
    rules = cleaning_rules(geo, as_of_year)
    keep = F.lit(True)
    for name, rule in rules.items():
        keep = keep & (~rule if odd_dates and name == _ODD_DATE else rule)
    return _finish(_with_quotients(typed(raw)).filter(keep), geo)


def sorted_trips(raw: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Valid trips and those of the quarantine in one pass, told apart by column ``odd_date``."""
    geo = schemas.has_coordinates(raw)
    rules = cleaning_rules(geo, as_of_year)
    odd = ~rules.pop(_ODD_DATE)
    keep = F.lit(True)
    for rule in rules.values():
        keep = keep & rule
    return _finish(_with_quotients(typed(raw)).filter(keep).withColumn(_ODD_DATE, odd), geo, _ODD_DATE)


def clean_trips(raw: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Valid trips with derived measures, coordinate or zone variant by the columns present.

    ``as_of_year`` fixes the upper end of the accepted years, for repeatable runs.
    """
    return _split(raw, as_of_year, odd_dates=False)


def odd_date_trips(raw: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Trips that pass every rule but the one on the year: the quarantine."""
    return _split(raw, as_of_year, odd_dates=True)


def reject_audit(raw: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Rows lost to each rule (the first one they fail) and rows kept, in one pass.

    Returns (step, rule, trips). Counts are combined before the shuffle, which moves
    a dozen rows per task.
    """
    rules = cleaning_rules(schemas.has_coordinates(raw), as_of_year)
    names = [*rules, "kept"]
    failed = None
    for step, rule in enumerate(rules.values(), start=1):
        lost = ~F.coalesce(rule, F.lit(False))
        failed = F.when(lost, F.lit(step)) if failed is None else failed.when(lost, F.lit(step))
    labels = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("step"))
    return (
        _with_quotients(typed(raw))
        .groupBy(failed.otherwise(F.lit(len(names))).alias("step"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select("step", labels.alias("rule"), "trips")
    )

"""What a ride costs per mile, hour by hour, at any number of map points at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope.functions.measures import two_decimals_stable
from farescope.operators.spatial import DEFAULT_CELL, join_zones
from farescope.session import broadcast_if_small

SERIES = ("weekday", "weekend", "holiday")
HOURS = 24
ANY_MONTH = 0


def rate_curves(rates: DataFrame) -> DataFrame:
    """Rates as requests ask for them: (zone_id, traffic, covid, month, totals, counts).

    ``totals`` and ``counts`` have an entry for each hour of each of the three series, 72 in all,
    that average further over zones. The month is 0 under restrictions, where the answer is the
    plain mean of the monthly means; else holidays, which have no month, stand in every month.
    """
    covid, holiday = F.col("iscovid") == 1, F.col("isholiday") == 1
    months = (
        F.when(covid, F.array(F.lit(ANY_MONTH)))
        .when(holiday, F.sequence(F.lit(1), F.lit(12)))
        .otherwise(F.array("target_month"))
    )
    series = F.when(holiday, F.lit(2)).when(F.col("isweekend") == 1, F.lit(1)).otherwise(F.lit(0))
    keys = ["zone_id", "traffic", "covid", "month"]
    rows = rates.select(
        F.col("zoneid").alias("zone_id"),
        "traffic",
        F.col("iscovid").alias("covid"),
        F.explode(months).alias("month"),
        (series * HOURS + F.col("target_hour")).alias("_slot"),
        "rate",
    )
    hourly = rows.groupBy(*keys, "_slot").agg(F.struct(F.sum("rate").alias("total"), F.count("rate").alias("n")).alias("_sums"))
    curves = hourly.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_sums"))).alias("_slots"))
    slots = F.sequence(F.lit(0), F.lit(len(SERIES) * HOURS - 1))

    def entries(field: str, kind: str):
        return F.transform(slots, lambda i: F.coalesce(F.col("_slots")[i][field], F.lit(0).cast(kind)))

    return curves.select(*keys, entries("total", "double").alias("totals"), entries("n", "bigint").alias("counts"))


def lookup_rates(
    requests: DataFrame,
    rates: DataFrame,
    index: DataFrame,
    cell: float = DEFAULT_CELL,
    boundary: str = "include",
    small: bool | None = None,
) -> DataFrame:
    """(request_id, series, hour, rate): three full 24-hour curves per request.

    ``rate`` is NULL where no trips were seen. ``rates`` is the rates table, or the curves made
    of it by ``rate_curves``, stored once for many lookups; ``index`` is a stored table too, as
    sizes are counted. The index is made with the same ``boundary``; when borders are included, a
    point on a shared one averages the rates of both zones. ``request_id`` must be unique.

    A request meets one row of curves per zone, and hours become rows at the very end. Curves
    that pass the size check are broadcast, and requests are shuffled once, by their id.
    Otherwise requests go to the curves, and curves that are bucketed by their keys stay in place.
    """
    curves = rates if "totals" in rates.columns else rate_curves(rates)
    located = join_zones(
        requests.select("request_id", "lat", "lng", "month", "traffic", "covid"),
        index,
        "lng",
        "lat",
        "zone_id",
        cell,
        boundary,
        "left",
        small,
    )
    asked = located.withColumns(
        {"month": F.when(F.col("covid"), F.lit(ANY_MONTH)).otherwise(F.col("month")), "covid": F.col("covid").cast("int")}
    )
    once = asked.repartition("request_id").dropDuplicates(["request_id", "zone_id"])
    here = curves.select(*[F.col(c).alias(f"_{c}") for c in curves.columns])
    on = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in ("zone_id", "traffic", "covid", "month")])
    found = once.join(broadcast_if_small(here), on, "left")
    zones = found.groupBy("request_id").agg(F.collect_list(F.when(F.col("_totals").isNotNull(), F.struct("_totals", "_counts"))).alias("zones"))

    def mean(slot):
        total = F.aggregate("zones", F.lit(0.0), lambda x, z: x + z["_totals"][slot])
        n = F.aggregate("zones", F.lit(0).cast("bigint"), lambda x, z: x + z["_counts"][slot])
        return F.try_divide(total, n)

    slots = F.sequence(F.lit(0), F.lit(len(SERIES) * HOURS - 1))
    rows = zones.select("request_id", F.posexplode(F.transform(slots, mean)).alias("slot", "mean"))
    series = F.array(*[F.lit(s) for s in SERIES])
    return (
        rows.select(
            "request_id",
            F.element_at(series, F.floor(F.col("slot") / HOURS).cast("int") + 1).alias("series"),
            (F.col("slot") % HOURS).alias("hour"),
            two_decimals_stable(F.col("mean")).alias("rate"),
        )
        # A request's rows are in one partition already: this orders its curves by hour.
        .sortWithinPartitions("request_id", "series", "hour")
    )

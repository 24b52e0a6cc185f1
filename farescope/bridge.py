"""Trips, map layers, files and requests derived from the benchmark tables.

Only integer arithmetic decides the values, so any SQL engine can build the same rows.
Map coordinates are integers in thousandths, written as GeoJSON text and loaded by the
same code that loads real layers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farescope import schemas
from farescope.operators.clean import clean_trips
from farescope.operators.files import file_name
from farescope.operators.holidays import flag_holidays, holiday_calendar
from farescope.operators.spatial import point_index, zone_cells
from farescope.session import evaluate_once, open_writers, shared_dir, shuffles_removed
from farescope.sources.geometry import load_geometry

AS_OF_YEAR = 2021
CELL = 0.25
FIRST_CALENDAR_YEAR, LAST_CALENDAR_YEAR = 2014, 2022
# Text files that a task writes side by side.
OPEN_FILES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(value: Column) -> Column:
    """An integer spread over the map, never on a grid line or a zone border."""
    return (value % 5200).cast("double") / F.lit(1000.0) + F.lit(0.0005)


def _pickup() -> Column:
    """When the trip of a line item starts."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    second = F.expr("interval '1' second")
    return (
        F.col("l_shipdate")
        + F.expr("interval 20 years")
        + second * ((order * 7919 + line * 104729 + part * 613) % 86400)
    )


def raw_trips(spark: SparkSession, sf_dir: str, geo: bool = False) -> DataFrame:
    """Raw trips in the canonical columns, one per line item."""
    return _trips_of(table(spark, sf_dir, "lineitem"), geo)


def _trips_of(items: DataFrame, geo: bool) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    second, start = F.expr("interval '1' second"), _pickup()
    length = second * (F.lit(300) + (part * 31 + supp * 17 + order * 13) % 4200)
    tip = (F.floor(F.col("l_discount") * 100 + 0.5).cast("int") * F.lit(0.25)) - F.when(
        (F.col("l_returnflag") == "A") & (line == 7), F.lit(1.0)
    ).otherwise(F.lit(0.0))
    distance = F.col("l_quantity") * F.lit(0.4)
    if geo:
        ends = {
            "pickup_latitude": _place(order * 53 + supp * 211 + line * 7),
            "pickup_longitude": _place(order * 37 + line * 11 + part * 101),
            "dropoff_latitude": _place(order * 29 + supp * 173 + line * 13),
            "dropoff_longitude": _place(order * 71 + line * 17 + part * 59),
        }
    else:
        ends = {
            "PULocationID": (supp % 25 + 1).cast("int"),
            "DOLocationID": (part % 25 + 1).cast("int"),
        }
    columns = {
        "pickup_datetime": start,
        "dropoff_datetime": start + length,
        "passenger_count": line - 1,
        "trip_distance": distance,
        "tip_amount": tip,
        "total_amount": distance * (F.lit(2) + part % 7) + F.lit(1.5),
        **ends,
    }
    return evaluate_once(items, *[c.alias(n) for n, c in columns.items()])


# One header dialect per variant, in published spelling with stray characters.
TEXT_HEADERS = {
    "pickup_datetime": " Trip_Pickup_DateTime",
    "dropoff_datetime": "Trip_Dropoff_DateTime",
    "passenger_count": "Passenger_Count",
    "trip_distance": "Trip_Distance",
    "tip_amount": "Tip_Amt",
    "total_amount": "Total_Amt\r",
    "PULocationID": "PULocationID",
    "DOLocationID": "DOLocationID",
    "pickup_latitude": "Start_Lat",
    "pickup_longitude": "Start_Lon",
    "dropoff_latitude": "End_Lat",
    "dropoff_longitude": "End_Lon",
}


def text_trips(spark: SparkSession, sf_dir: str, geo: bool = False) -> DataFrame:
    """The raw trips as a CSV reader delivers them: all text, headers of an old dialect."""
    return _as_text(raw_trips(spark, sf_dir, geo))


def _as_text(raw: DataFrame, *others: Column) -> DataFrame:
    return raw.select(*[F.col(c).cast("string").alias(TEXT_HEADERS[c]) for c in raw.columns], *others)


def write_monthly_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Text files with published names: a yellow one of zone trips and a green one of coordinate trips
    for each January, and one for each February with the trips that start in the first minute of an hour.
    """
    for geo, provider in ((False, "yellow"), (True, "green")):
        # Line items are dealt to the files, not the text made of them, which takes several times as much
        # room; by ranges, as hashes would give a task two large files and leave others none.
        items = table(spark, sf_dir, "lineitem").repartitionByRange(F.year(_pickup()), F.minute(_pickup()) == 0)
        start = F.col("pickup_datetime")
        month = F.when(F.minute(start) == 0, F.lit("-02")).otherwise(F.lit("-01"))
        name = F.concat(F.lit(f"{provider}_tripdata_"), F.year(start).cast("string"), month, F.lit(".csv"))
        named = _as_text(_trips_of(items, geo), name.alias("file"))
        parts = f"{folder}-{provider}"
        with open_writers(spark, OPEN_FILES), shuffles_removed(spark):  # a task has all rows of a file
            named.write.option("header", True).partitionBy("file").csv(parts)
        path = spark._jvm.org.apache.hadoop.fs.Path
        store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path(folder))
        for written in store.globStatus(path(parts, "file=*/part-*.csv")):  # one for each name
            part = written.getPath()
            store.rename(part, path(folder, part.getParent().getName()[len("file=") :]))


def calendar(spark: SparkSession) -> DataFrame:
    return holiday_calendar(spark, LAST_CALENDAR_YEAR, FIRST_CALENDAR_YEAR)


def trips(spark: SparkSession, sf_dir: str, geo: bool = False) -> DataFrame:
    """Clean, flagged trips."""
    cleaned = clean_trips(raw_trips(spark, sf_dir, geo), AS_OF_YEAR)
    return flag_holidays(cleaned, calendar(spark), small=True)


def _number(thousandths: Column) -> Column:
    """Thousandths as decimal text: 1600 is 1.600."""
    return F.concat(
        F.floor(thousandths / 1000).cast("string"),
        F.lit("."),
        F.lpad((thousandths % 1000).cast("string"), 3, "0"),
    )


def _coordinates(points: list[tuple[Column, Column]]) -> Column:
    corners = [F.concat(F.lit("["), _number(x), F.lit(","), _number(y), F.lit("]")) for x, y in points]
    return F.concat(F.lit("["), F.concat_ws(",", *corners), F.lit("]"))


def _polygon(ring: list[tuple[Column, Column]]) -> Column:
    return F.concat(
        F.lit('{"type":"Polygon","coordinates":['), _coordinates([*ring, ring[0]]), F.lit("]}")
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones on a five-by-five grid, each with a notch that no zone covers."""
    k = F.col("n_nationkey").cast("long")
    x, y = (k % 5) * 1000, F.floor(k / 5) * 1000
    ring = [(x, y), (x + 1000, y), (x + 1000, y + 1000), (x + 500, y + 600), (x, y + 1000)]
    text = table(spark, sf_dir, "nation").select(
        (k + 1).cast("int").alias("zone_id"), F.col("n_name").alias("zone"), _polygon(ring).alias("geom")
    )
    return load_geometry(text, "geom")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_cells(zones(spark, sf_dir), CELL)


def zone_index(spark: SparkSession, sf_dir: str, boundary: str = "exclude") -> DataFrame:
    """The point index of the zones, derived once and stored."""
    path = shared_dir(spark)
    point_index(cells(spark, sf_dir), CELL, boundary).write.parquet(path)
    return spark.read.parquet(path)


def _tract_corner() -> tuple[Column, Column]:
    k = F.col("s_suppkey")
    return (k * 37) % 43 * 100 + 13, (k * 53) % 41 * 100 + 17


def tract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = _tract_corner()
    ring = [(x, y), (x + 700, y), (x + 700, y + 700), (x, y + 700)]
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("gid"),
        F.concat(F.lit("Borough "), (F.col("s_nationkey") % 5).cast("string")).alias("boroname"),
        F.col("s_name").alias("ntaname"),
        F.concat(F.lit("NA"), F.col("s_nationkey").cast("string")).alias("ntacode"),
        _polygon(ring).alias("geom"),
    )


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_geometry(tract_text(spark, sf_dir), "geom")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street segments: a diagonal of each tract, with a text id."""
    x, y = _tract_corner()
    line = F.concat(
        F.lit('{"type":"LineString","coordinates":'),
        _coordinates([(x, y), (x + 700, y + 700)]),
        F.lit("}"),
    )
    text = table(spark, sf_dir, "supplier").select(
        F.substring("s_name", 10, 20).alias("segmentid"),
        F.col("s_name").alias("street"),
        line.alias("geom"),
    )
    return load_geometry(text, "geom")


def feet_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tract corners in state-plane feet."""
    x, y = _tract_corner()
    corners = [(x, y), (x + 700, y), (x + 700, y + 700), (x, y + 700), (x, y)]
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("seq"),
                (cx * 10 + 980_000).cast("double").alias("x"),
                (cy * 10 + 190_000).cast("double").alias("y"),
            )
            for i, (cx, cy) in enumerate(corners)
        ]
    )
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("gid"), F.inline(entries))


def in_feet(shapes: DataFrame) -> DataFrame:
    """Shapes of the map moved to state-plane feet, as ``feet_vertices`` has them."""
    feet = F.transform(
        "edges",
        lambda e: F.struct(
            *[(F.round(e[c] * 1000) * 10 + (980_000 if c[0] == "x" else 190_000)).alias(c) for c in ("x1", "y1", "x2", "y2")]
        ),
    )
    return shapes.withColumn("edges", feet)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map request per customer; every tenth lies on a border of two zones."""
    c = F.col("c_custkey")
    border = c % 10 == 0
    return table(spark, sf_dir, "customer").select(
        c.alias("request_id"),
        _place(c * 53 + 7).alias("lat"),
        F.when(border, (F.lit(1) + F.floor(c / 10) % 4).cast("double")).otherwise(_place(c * 37 + 11)).alias("lng"),
        (c % 12 + 1).cast("int").alias("month"),
        (c % 3 + 1).cast("int").alias("traffic"),
        (F.floor(c / 7) % 2 == 1).alias("covid"),
    )


def event_trips(spark: SparkSession, sf_dir: str, sources: int) -> DataFrame:
    """Row ids and their source files."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % sources).alias("sourceid")
    )


def event_registry(spark: SparkSession, sf_dir: str, sources: int) -> DataFrame:
    """The files of those rows, every third one already known complete."""
    return registry_of(event_trips(spark, sf_dir, sources))


def registry_of(trips: DataFrame) -> DataFrame:
    """A file for each source of ``trips``, every third one already known complete."""
    rows = trips.groupBy("sourceid").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(
        F.col("sourceid").alias("id"),
        F.concat(F.lit("yellow_tripdata_"), F.col("sourceid").cast("string"), F.lit(".csv")).alias("filename"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updateon"),
        F.when(F.col("sourceid") % 3 == 0, F.lit(schemas.GOOD))
        .otherwise(F.lit(schemas.UNCHECKED))
        .alias("islocked"),
    )


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = F.when(F.col("o_orderkey") % 3 == 0, F.lit("green")).otherwise(F.lit("yellow"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", provider.alias("provider")
    )


def known_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last month of each provider's orders."""
    return (
        _order_files(spark, sf_dir)
        .groupBy("provider")
        .agg(
            F.to_date(F.min("o_orderdate")).alias("first_month"),
            F.to_date(F.max("o_orderdate")).alias("last_month"),
        )
    )


def order_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per provider and month, its state the number of its orders modulo three."""
    named = _order_files(spark, sf_dir).withColumn(
        "filename", file_name(F.col("provider"), F.col("o_orderdate"))
    )
    return named.groupBy("filename").agg(
        F.min("o_orderkey").alias("id"), (F.count(F.lit(1)) % 3).cast("int").alias("islocked")
    )


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in storage: months with an even number of filled orders."""
    return (
        _order_files(spark, sf_dir)
        .filter("o_orderstatus = 'F'")
        .groupBy(file_name(F.col("provider"), F.col("o_orderdate")).alias("filename"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n % 2 = 0")
        .select("filename")
    )

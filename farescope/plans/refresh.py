"""The batch run: load files, place coordinates in zones, check files, rebuild rates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farescope import schemas
from farescope.functions.projection import NEW_YORK_LONG_ISLAND_FEET, ConicProjection
from farescope.operators.clean import sorted_trips
from farescope.operators.files import (
    EXACT_MINIMUM,
    QUICK_MINIMUM,
    WINDOW_IDS,
    expected_files,
    file_state,
    loadable_files,
    may_load,
    pending_files,
    providers,
    register_files,
    sequential_completeness,
)
from farescope.operators.holidays import flag_holidays
from farescope.operators.lookup import rate_curves
from farescope.operators.overlay import crossing_map, overlap_map
from farescope.operators.rates import rate_sums, rates_of_sums
from farescope.operators.spatial import DEFAULT_CELL, add_named_area, index_fits, point_index, zone_cells, zones_of_trips
from farescope.session import broadcast_if_small
from farescope.sources import tables
from farescope.sources.geometry import reproject_shapes, retype_segment
from farescope.sources.trips_csv import list_trip_files, read_trip_files

# States of a claim in ``run_refresh``.
CLAIMED, LOADED, CHECKED = "claimed", "loaded", "checked"


def with_source(trips: DataFrame, registry: DataFrame) -> DataFrame:
    """Replace ``filename`` by the registered file id; rows of an unknown file are an error."""
    ids = registry.select(F.col("filename").alias("_name"), F.col("id").alias("_id"))
    known = F.coalesce("_id", F.raise_error(F.concat(F.lit("not registered: "), "filename")).cast("long"))
    joined = trips.join(broadcast_if_small(ids), F.col("filename") == F.col("_name"), "left")
    return joined.withColumn("sourceid", known).drop("filename", "_name", "_id")


def _base_name(path: str) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def load_files(
    spark: SparkSession,
    paths: Iterable[str],
    base: str,
    calendar: DataFrame,
    as_of_year: int | None = None,
    multiline: bool = False,
) -> int:
    """Register, clean, flag and store the trips of ``paths``; returns how many files were read.

    Files known complete are skipped. Any other file counts as unchecked again, and what its
    source had in any trip table is replaced, by nothing if the file keeps nothing; a load that
    breaks off changes no table and is simply repeated. Valid trips of both variants and those
    with odd dates, for the quarantine, come from one pass and are written once. Two paths that
    end in the same name (compared without case) are an error: they would be one source.
    """
    paths = sorted(set(paths))
    if not paths:
        return 0
    names = Counter(path.rsplit("/", 1)[-1].lower() for path in paths)
    if twice := sorted(n for n, k in names.items() if k > 1):
        raise ValueError(f"several paths for one file name: {twice[:5]}")
    named = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("filename", F.col("path"))
    registry = tables.read_registry(spark, base)
    fresh = register_files(registry, named)
    registry = registry.unionByName(fresh)
    named = named.select("path", _base_name("path").alias("filename"))
    again = named.select("filename").distinct().withColumn("_again", F.lit(True))
    open_ = F.col("_again").isNotNull() & (F.col("islocked") != schemas.GOOD)
    registry = registry.join(again, "filename", "left").withColumn(
        "islocked", F.when(open_, F.lit(schemas.UNCHECKED)).otherwise(F.col("islocked"))
    )
    tables.write_registry(registry.drop("_again").select(*fresh.columns), base)
    registry = tables.read_registry(spark, base)
    wanted = named.join(may_load(registry).select("filename", "id"), "filename").select("path", "id").collect()
    chosen = [row.path for row in wanted]  # file names only
    ids = sorted({row.id for row in wanted})
    found = None
    for raw in read_trip_files(spark, chosen, multiline):
        if raw is None:
            continue
        geo = schemas.has_coordinates(raw)
        valid, odd = (tables.GEO_TABLE, tables.ODD_GEO_TABLE) if geo else (tables.ZONE_TABLE, tables.ODD_ZONE_TABLE)
        trips = flag_holidays(with_source(sorted_trips(raw, as_of_year), registry), calendar, keep=("odd_date",))
        trips = trips.withColumn("table", F.when(F.col("odd_date"), odd).otherwise(valid)).drop("odd_date")
        found = trips if found is None else found.unionByName(trips, allowMissingColumns=True)
    gen = tables.write_trips(found, base) if found is not None else None
    tables.publish(spark, base, gen, F.col("sourceid").isin(ids))
    return len(chosen)


def staged_sources(spark: SparkSession, base: str) -> DataFrame:
    """(sourceid, gen) of the coordinate trips that wait for their zones."""
    entries = tables.read_manifest(spark, base).where((F.col("table") == tables.GEO_TABLE) & F.col("file").isNotNull())
    return entries.select("sourceid", "gen").distinct()


def place_coordinates(
    spark: SparkSession, base: str, index: DataFrame, cell: float = DEFAULT_CELL
) -> None:
    """Move staged coordinate trips to the zone table, those off the map to a table of their own.

    One scan finds both zones of each trip by left joins and fills both tables. All of it shows
    at once, with the manifest; a run that broke off is simply repeated. A source that was staged
    again meanwhile stays staged, and nothing of its earlier rows is shown. Zones are taken not to
    overlap: a trip whose one end lies in several and the other off the map would be listed for
    each of them.
    """
    taken = [tuple(r) for r in staged_sources(spark, base).collect()]  # a row a source
    if not taken:
        return
    ids = sorted({i for i, _ in taken})
    staged = tables.read_trips(spark, base, tables.GEO_TABLE, ids)
    small = index_fits(index)
    placed = zones_of_trips(staged, index, cell, small=small)
    on_map = F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull()
    split = placed.withColumn("table", F.when(on_map, tables.ZONE_TABLE).otherwise(tables.UNMATCHED_TABLE))
    # A trip in the zone table has no coordinates, one off the map no zones.
    split = split.withColumns({c: F.when(~on_map, F.col(c)) for c in schemas.GEO_ENDS})
    split = split.withColumns({c: F.when(F.col("table") == tables.ZONE_TABLE, F.col(c)) for c in schemas.ZONE_ENDS})
    gen = tables.write_trips(split, base, rebalance=not small)
    now = {tuple(r) for r in staged_sources(spark, base).collect()}
    moved = sorted({i for i, g in taken if (i, g) in now and not any(j == i and h != g for j, h in now)})
    stale = spark.createDataFrame([(i,) for i in sorted(set(ids) - set(moved))], "sourceid bigint")
    places = (tables.GEO_TABLE, tables.ZONE_TABLE, tables.UNMATCHED_TABLE)
    tables.publish(spark, base, gen, F.col("sourceid").isin(moved) & F.col("table").isin(*places), stale)


def check_files(
    spark: SparkSession,
    base: str,
    minimum: int = EXACT_MINIMUM,
    window: int = WINDOW_IDS,
    quick_minimum: int | None = QUICK_MINIMUM,
) -> None:
    """Settle the state of every unchecked file from the rows it has in the zone table.

    First the quick pass over windows of row ids (not with ``quick_minimum`` None), for which the
    manifest tells enough; then an exact count of the files that are still open, of which only
    their partitions are read.
    """
    registry = tables.read_registry(spark, base)
    unchecked = registry.where(F.col("islocked") == schemas.UNCHECKED).select("id")
    if unchecked.isEmpty():
        return
    if quick_minimum is not None:
        quick_minimum = max(quick_minimum, minimum - 1)  # the quick pass must not pass what the exact one wouldn't
        registry = sequential_completeness(tables.id_ranges(spark, base), registry, window, quick_minimum)
        tables.write_registry(registry, base)
        registry = tables.read_registry(spark, base)
    open_ = [r.id for r in registry.where(F.col("islocked") == schemas.UNCHECKED).select("id").collect()]
    trips = tables.read_trips(spark, base, sources=open_)
    tables.write_registry(file_state(registry, trips, minimum), base)


def refresh_rates(spark: SparkSession, base: str, mode: str = "compat") -> list[int]:
    """Rebuild the rates, and the lookup curves, from stored sums; returns the sources that had to be read.

    Each source's sums and counts are kept as long as its trips stand, so only sources that were
    loaded since the last refresh are scanned.
    """
    table = f"rate_sums_{mode}"
    entries = tables.read_manifest(spark, base).where((F.col("table") == tables.ZONE_TABLE) & F.col("file").isNotNull())
    valid = entries.select("sourceid", "gen").distinct()
    known = tables.read_version(spark, base, table, schemas.RATE_SUMS)
    missing = valid.join(known.select("sourceid", "gen").distinct(), ["sourceid", "gen"], "left_anti")
    gens = {r.sourceid: r.gen for r in missing.collect()}  # a row a source
    kept = known.join(broadcast_if_small(valid), ["sourceid", "gen"], "left_semi")
    if gens:
        trips = tables.read_trips(spark, base, sources=gens)
        fresh = rate_sums(trips, mode, "sourceid").join(broadcast_if_small(missing), "sourceid")
        kept = kept.unionByName(fresh.select(*kept.columns))
    tables.write_version(kept, base, table)
    tables.write_rates(rates_of_sums(tables.read_version(spark, base, table, schemas.RATE_SUMS)), base)
    tables.write_curves(rate_curves(tables.read_rates(spark, base)), base)
    return sorted(gens)


def run_pipeline(
    spark: SparkSession,
    incoming: str,
    base: str,
    index: DataFrame,
    calendar: DataFrame,
    cell: float = DEFAULT_CELL,
    as_of_year: int | None = None,
    mode: str = "compat",
    minimum: int = EXACT_MINIMUM,
    multiline: bool = False,
) -> DataFrame:
    """Everything from new CSV files to the rates table, which is returned."""
    found = [row.path for row in list_trip_files(spark, incoming).select("path").collect()]
    load_files(spark, found, base, calendar, as_of_year, multiline)
    place_coordinates(spark, base, index, cell)
    check_files(spark, base, minimum)
    refresh_rates(spark, base, mode)
    return tables.read_rates(spark, base)


def find_tasks(spark: SparkSession, incoming: str, base: str, known: DataFrame, through=None) -> DataFrame:
    """(filename, path) of the files to load now: expected, not known complete, and in storage.

    ``known`` is (provider, first_month); ``through`` the last month, today's when left out.
    Storage is asked for exactly the expected names. Of several files of one name, the one with
    the smallest path is taken.
    """
    registry = tables.read_registry(spark, base)
    pending = pending_files(expected_files(known, through), registry)
    stored = list_trip_files(spark, incoming).groupBy("filename").agg(F.min("path").alias("path"))
    return loadable_files(pending, stored).join(stored, "filename").select("filename", "path")


def run_refresh(
    spark: SparkSession,
    incoming: str,
    base: str,
    index: DataFrame,
    calendar: DataFrame,
    known: DataFrame | None = None,
    through=None,
    cell: float = DEFAULT_CELL,
    as_of_year: int | None = None,
    mode: str = "compat",
    minimum: int = EXACT_MINIMUM,
    multiline: bool = False,
    files_per_load: int = 100,
) -> DataFrame:
    """Find the files to load, load and check them, and refresh the rates; returns the claims.

    Claims (filename, path, state) are a table: files are claimed before they are loaded, loaded
    in groups of ``files_per_load``, then checked all together. A run that finds claims of one
    that broke off goes on with those: what was loaded isn't loaded again. Once the rates stand,
    the claims are checked, and the next run looks for tasks anew.
    """

    def claims() -> DataFrame:
        return tables.read_version(spark, base, "claims", schemas.CLAIMS)

    def mark(names: list[str], state: str) -> None:
        mine = F.col("filename").isin(names)
        tables.write_version(claims().withColumn("state", F.when(mine, F.lit(state)).otherwise(F.col("state"))), base, "claims")

    open_ = claims().where(F.col("state") != CHECKED)
    if open_.isEmpty():
        tasks = find_tasks(spark, incoming, base, providers(spark) if known is None else known, through)
        tables.write_version(tasks.withColumn("state", F.lit(CLAIMED)), base, "claims")
    todo = [(r.filename, r.path) for r in claims().where(F.col("state") == CLAIMED).orderBy("filename").collect()]
    for i in range(0, len(todo), files_per_load):  # names only
        group = todo[i : i + files_per_load]
        load_files(spark, [path for _, path in group], base, calendar, as_of_year, multiline)
        mark([name for name, _ in group], LOADED)
    place_coordinates(spark, base, index, cell)
    check_files(spark, base, minimum)
    refresh_rates(spark, base, mode)
    mark([r.filename for r in claims().select("filename").collect()], CHECKED)
    return claims()


def refresh_maps(
    spark: SparkSession,
    base: str,
    zones: DataFrame,
    tracts: DataFrame,
    segments: DataFrame,
    area: tuple[str, dict] | None = None,
    cell: float = DEFAULT_CELL,
    projection: ConicProjection | None = NEW_YORK_LONG_ISLAND_FEET,
) -> None:
    """Map layers and all that is derived from them, stored in one step.

    ``zones`` (zone_id, zone, edges) and ``tracts`` (gid, edges, ...) are in ``projection``'s own
    unit, or in degrees already if it is None; ``segments`` (segmentid as text, edges) are in
    degrees. ``area`` is the name of a zone whose shape is added to the tracts, and its
    attributes there. Tables: zones, tracts, segments, zone_index, segment_zones, tract_zones,
    each a version that shows once it is complete.
    """
    if projection is not None:
        zones, tracts = reproject_shapes(zones, projection), reproject_shapes(tracts, projection)

    def kept(df: DataFrame, name: str) -> DataFrame:
        return spark.read.schema(df.schema).parquet(tables.write_version(df, base, name))

    zones = kept(zones, "zones")
    tracts = kept(add_named_area(tracts, zones, *area) if area else tracts, "tracts")
    segments = kept(retype_segment(segments), "segments")
    cells = zone_cells(zones, cell)
    tables.write_version(point_index(cells, cell), base, "zone_index")
    tables.write_mapping(crossing_map(segments, cells, "segmentid", cell), base, "segment_zones")
    tables.write_mapping(overlap_map(tracts, zones, "gid", cell), base, "tract_zones")

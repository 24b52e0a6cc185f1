"""Source files: which to expect, which are missing, which were loaded completely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farescope import schemas
from farescope.session import shared_dir

# First published month per provider.
FIRST_MONTHS = {"yellow": "2009-01-01", "green": "2013-01-01"}

WINDOW_IDS = 10_000
QUICK_MINIMUM = 1_000
EXACT_MINIMUM = 1_000


def providers(spark: SparkSession) -> DataFrame:
    """(provider, first_month) of the published trip files."""
    return spark.createDataFrame(list(FIRST_MONTHS.items()), "provider string, first_month string").select(
        "provider", F.to_date("first_month").alias("first_month")
    )


def file_name(provider: Column, month: Column) -> Column:
    return F.concat(provider, F.lit("_tripdata_"), F.date_format(month, "yyyy-MM"), F.lit(".csv"))


def expected_files(known: DataFrame, last_month: Column | str | None = None) -> DataFrame:
    """(provider, filename): one file per provider and month, through ``last_month``.

    ``known`` is (provider, first_month); ``last_month`` is a date column or literal,
    today when left out.
    """
    if last_month is None:
        last_month = F.current_date()
    elif isinstance(last_month, str):
        last_month = F.lit(last_month).cast("date")
    first, last = F.trunc("first_month", "month"), F.trunc(last_month, "month")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return (
        known.filter(first <= last)
        .withColumn("month", F.explode(months))
        .select("provider", file_name(F.col("provider"), F.col("month")).alias("filename"))
    )


def good_files(registry: DataFrame, provider: str | None = None) -> DataFrame:
    """Names of files known complete, of one provider or of all."""
    rows = registry.filter(F.col("islocked") == schemas.GOOD)
    if provider:
        rows = rows.filter(F.col("filename").startswith(provider))
    return rows.select("filename")


def pending_files(expected: DataFrame, registry: DataFrame) -> DataFrame:
    """Expected files not yet known complete, in order of name."""
    missing = expected.join(good_files(registry), "filename", "left_anti")
    return missing.select("filename").orderBy("filename")


def loadable_files(pending: DataFrame, stored: DataFrame) -> DataFrame:
    """Pending files that are in storage under exactly that name, in order of name."""
    return pending.join(stored.select("filename"), "filename", "left_semi").orderBy("filename")


def dense_ids(df: DataFrame, key: str, start: Column | int = 0, buckets: int = 64) -> DataFrame:
    """Add ``id``: start + 1, start + 2, ... in a fixed order, with no single-task sort.

    Rows are numbered within hash buckets of ``key``; each bucket's offset is the sum
    of the (at most ``buckets``) smaller buckets' sizes.
    """
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_bucket").orderBy(key)
    start = F.lit(start) if isinstance(start, int) else start
    return (
        keyed.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")  # one row per bucket
        .withColumn("id", (start + F.col("_offset") + F.col("_rn")).cast("long"))
        .drop("_bucket", "_n", "_offset", "_rn")
    )


def register_files(registry: DataFrame, names: DataFrame, now: Column | None = None) -> DataFrame:
    """New registry rows for ``names`` (filename or path) that are not registered yet.

    Names are reduced to the lower-cased base name. Registering twice adds nothing, so
    a rerun is safe; ``may_load`` tells which files can be loaded again.
    """
    base = F.lower(F.element_at(F.split("filename", "/"), -1))
    fresh = (
        names.select(base.alias("filename"))
        .distinct()
        .join(registry.select("filename"), "filename", "left_anti")
    )
    last = registry.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return dense_ids(fresh, "filename", last).select(
        "id",
        "filename",
        (F.current_timestamp() if now is None else now).alias("updateon"),
        F.lit(schemas.UNCHECKED).alias("islocked"),
    )


def may_load(registry: DataFrame) -> DataFrame:
    """Registered files that may be (re)loaded: all but those known complete."""
    return registry.filter(F.col("islocked") != schemas.GOOD)


def file_state(registry: DataFrame, trips: DataFrame, minimum: int = EXACT_MINIMUM) -> DataFrame:
    """The registry after an exact count of each unchecked file's rows.

    Fewer than ``minimum`` rows is "no data", otherwise good; other states stand. Trips
    are counted per source first, so the join moves one row per file.
    """
    counts = trips.groupBy(F.col("sourceid").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    found = F.coalesce(F.col("_n"), F.lit(0))
    state = (
        F.when(F.col("islocked") != schemas.UNCHECKED, F.col("islocked"))
        .when(found < minimum, F.lit(schemas.NO_DATA))
        .otherwise(F.lit(schemas.GOOD))
    )
    return (
        registry.join(counts, "id", "left")
        .withColumn("islocked", state)
        .select(*registry.columns)
    )


def window_counts(
    trips: DataFrame, registry: DataFrame, window: int = WINDOW_IDS, id_col: str = "id"
) -> DataFrame:
    """(bucket, sourceid, n): rows of unchecked files per window of row ids.

    Windows run down from the highest id and share their end points, so an id on a
    border counts in both. Counting precedes the join with the registry: what is
    shuffled is one row per window and source, however many trips a source has.
    """
    last = trips.agg(F.max(id_col)).scalar()
    below = last - F.col(id_col)
    bucket = F.floor(below / F.lit(window)).cast("long")
    on_border = (below % window == 0) & (below > 0)
    buckets = F.when(on_border, F.array(bucket - 1, bucket)).otherwise(F.array(bucket))
    unchecked = registry.filter(F.col("islocked") == schemas.UNCHECKED).select(
        F.col("id").alias("sourceid")
    )
    return (
        trips.select("sourceid", F.explode(buckets).alias("bucket"))
        .groupBy("bucket", "sourceid")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(unchecked, "sourceid", "left_semi")
        .select("bucket", "sourceid", "n")
    )


def range_counts(ranges: DataFrame, registry: DataFrame, window: int = WINDOW_IDS) -> DataFrame:
    """``window_counts`` of trips whose ids are known as ranges: (sourceid, first_id, last_id), both included.

    No trip is read: a range adds its overlap to each window that it meets.
    """
    last = ranges.agg(F.max("last_id")).scalar()
    unchecked = registry.filter(F.col("islocked") == schemas.UNCHECKED).select(F.col("id").alias("sourceid"))
    top = F.floor((last - F.col("last_id")) / F.lit(window))
    end = F.floor((last - F.col("first_id")) / F.lit(window))
    # One window more at the upper end: a border counts in both of its windows.
    buckets = F.sequence(F.greatest(top - 1, F.lit(0)), end)
    overlap = F.least(last - F.col("bucket") * window, "last_id") - F.greatest(last - (F.col("bucket") + 1) * window, "first_id") + 1
    return (
        ranges.join(unchecked, "sourceid", "left_semi")
        .select("sourceid", "first_id", "last_id", F.explode(buckets).alias("bucket"))
        .withColumn("n", overlap)
        .filter("n > 0")
        .groupBy("bucket", "sourceid")
        .agg(F.sum("n").alias("n"))
    )


def top_sources(counts: DataFrame) -> DataFrame:
    """The largest source of each window, the lowest id on ties."""
    ranked = Window.partitionBy("bucket").orderBy(F.desc("n"), "sourceid")
    return (
        counts.withColumn("_rank", F.row_number().over(ranked))
        .filter("_rank = 1")
        .select("bucket", "sourceid", "n")
    )


def quick_completeness(
    trips: DataFrame,
    registry: DataFrame,
    window: int = WINDOW_IDS,
    minimum: int = QUICK_MINIMUM,
    id_col: str = "id",
    top_only: bool = False,
) -> DataFrame:
    """The registry after the quick pass: files with over ``minimum`` rows in a window are good.

    ``top_only`` credits only the largest source of each window.
    """
    counts = window_counts(trips, registry, window, id_col)
    if top_only:
        counts = top_sources(counts)
    good = counts.filter(F.col("n") > minimum).select(F.col("sourceid").alias("id")).distinct()
    marked = registry.join(good.withColumn("_good", F.lit(True)), "id", "left")
    return marked.withColumn(
        "islocked", F.when(F.col("_good"), F.lit(schemas.GOOD)).otherwise(F.col("islocked"))
    ).select(*registry.columns)


def sequential_marks(counts: DataFrame, minimum: int = QUICK_MINIMUM, max_rounds: int | None = None) -> DataFrame:
    """(sourceid, bucket): the window at which each source is marked good, one window after another.

    From window 0 on, the largest source that isn't marked yet (the lowest id on ties) is marked
    if it has over ``minimum`` rows there. What a window does depends on earlier windows only.
    So all windows are done at once with the marks found so far, over and over: after k rounds
    the first k windows are right for good, and marks that a round leaves as they are are the
    sequential ones. That takes as many rounds as marks push each other along, not as there
    are windows. Counts and marks are a row for each source of a window; each round is stored.
    """
    counts = _kept(counts.select("bucket", "sourceid", "n"))
    largest = Window.partitionBy("bucket").orderBy(F.desc("n"), "sourceid")
    marks = counts.select("sourceid", "bucket").where("false")
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        earlier = marks.select("sourceid", F.col("bucket").alias("_at"))
        open_ = counts.join(earlier, "sourceid", "left").where("_at IS NULL OR _at >= bucket")
        top = open_.withColumn("_rank", F.row_number().over(largest)).where(f"_rank = 1 AND n > {int(minimum)}")
        fresh = _kept(top.groupBy("sourceid").agg(F.min("bucket").alias("bucket")))
        known = marks.withColumn("_known", F.lit(True))
        changed = fresh.withColumn("_found", F.lit(True)).join(known, ["sourceid", "bucket"], "full")
        if changed.where("_known IS NULL OR _found IS NULL").isEmpty():
            break
        marks = fresh
    return marks


def _kept(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sequential_completeness(
    trips: DataFrame,
    registry: DataFrame,
    window: int = WINDOW_IDS,
    minimum: int = QUICK_MINIMUM,
    id_col: str = "id",
) -> DataFrame:
    """The registry after the quick pass as it is run one window after another.

    A source that is marked leaves the later windows, so that runners-up can win those.
    ``trips`` has a row for each trip (``id_col``, sourceid), or one for each range of ids
    (sourceid, first_id, last_id).
    """
    ranges = "first_id" in trips.columns
    counts = range_counts(trips, registry, window) if ranges else window_counts(trips, registry, window, id_col)
    marks = sequential_marks(counts, minimum)
    good = marks.select(F.col("sourceid").alias("id"), F.lit(True).alias("_good"))
    state = F.when(F.col("_good"), F.lit(schemas.GOOD)).otherwise(F.col("islocked"))
    return registry.join(good, "id", "left").withColumn("islocked", state).select(*registry.columns)

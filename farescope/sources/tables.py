"""Stored tables: trips, rates, mappings, file registry; JDBC as an option.

Trip tables lie below one folder, partitioned by table, source file and generation, so that one
pass over the rows fills several of them. A write makes a new generation; nothing reads it before
the manifest, a small versioned table, names it. So a source is replaced as a whole and at once,
a write that breaks off is never seen, and readers keep what they have read the manifest for.

The manifest also counts the rows of each file and numbers them on: a row's id is its place in
its file after the ids given out before. Ids are dense within a write and never given out twice.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from farescope import schemas
from farescope.session import broadcast_if_small, open_writers

ZONE_TABLE = "tripdata"
GEO_TABLE = "tripdata_geo"
UNMATCHED_TABLE = "tripdata_unmatched"
ODD_ZONE_TABLE = "tripdata_odddate"
ODD_GEO_TABLE = "tripdata_geo_odddate"
TRIP_TABLES = (ZONE_TABLE, GEO_TABLE, UNMATCHED_TABLE, ODD_ZONE_TABLE, ODD_GEO_TABLE)
KEPT_VERSIONS = 3
# Files that a task writes side by side; what they buffer is bounded by the rows of the task.
OPEN_FILES = 8
CURVE_KEYS = ("zone_id", "traffic", "covid", "month")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def table_for(df: DataFrame) -> str:
    """Zone trips and coordinate trips have a table each, chosen by the columns."""
    return GEO_TABLE if schemas.has_coordinates(df) else ZONE_TABLE


def write_trips(df: DataFrame, base: str, rebalance: bool = False) -> str:
    """Write rows of one or several trip tables, named in column ``table``, as a new generation.

    Returns the generation, which no reader sees before ``publish``. Columns that a row's table
    doesn't have are NULL. Tasks that read one file write one partition: no shuffle, and no sort
    unless a task has rows for more than OPEN_FILES partitions.
    ``rebalance`` is for rows that come out of a shuffle and would leave a file per task and
    source; AQE then sizes the files and splits large sources.
    """
    gen = f"g{uuid.uuid4().hex}"
    known = {c.lower() for c in df.columns}
    columns = [
        F.col(f.name) if f.name.lower() in known else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.TRIPS_ALL
    ]
    df = df.select("table", *columns, F.lit(gen).alias("gen"))
    if rebalance:
        df = df.hint("rebalance", "table", "sourceid")
    with open_writers(df.sparkSession, OPEN_FILES):
        df.write.mode("append").partitionBy("table", "sourceid", "gen").parquet(table_path(base, "trips"))
    return gen


def _stored(spark: SparkSession, base: str, *paths: str) -> DataFrame | None:
    """Rows below some partition folders, with their partition columns; None if there are none."""
    schema = T.StructType([*schemas.TRIPS_ALL, T.StructField("table", T.StringType()), T.StructField("gen", T.StringType())])
    root = table_path(base, "trips")
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    return read_version(spark, base, "manifest", schemas.MANIFEST)


def publish(
    spark: SparkSession, base: str, gen: str | None, replaced: Column | None = None, unless: DataFrame | None = None
) -> None:
    """Make a generation visible, and take out of the trip tables what it replaces: one new manifest.

    ``replaced`` is a condition on manifest rows (table, sourceid, gen); by default a source's
    earlier rows go from each table that it has new rows for. ``unless`` (sourceid) are sources
    whose new rows are not wanted any more. Counting the new rows reads no column of them.
    """
    old = read_manifest(spark, base)
    files, last = old.where("file IS NOT NULL"), old.where("file IS NULL")
    stored = _stored(spark, base, f"table=*/sourceid=*/gen={gen}") if gen else None
    if stored is None:
        fresh = spark.createDataFrame([], schemas.MANIFEST).drop("last_id")
    else:
        fresh = stored.groupBy("table", "sourceid", "gen", F.col("_metadata.file_name").alias("file"))
        fresh = fresh.agg(F.count(F.lit(1)).alias("n_rows"))
    if unless is not None:
        fresh = fresh.join(unless, "sourceid", "left_anti")
    fresh = fresh.persist()  # a row for each new file
    if replaced is None:
        again = F.broadcast(fresh.select("table", "sourceid").distinct())
        kept = files.join(again, ["table", "sourceid"], "left_anti")
    else:
        kept = files.where(~F.coalesce(replaced, F.lit(False)))
    names = schemas.MANIFEST.fieldNames()
    before = F.broadcast(last.select("table", F.col("last_id").alias("_last")))  # a row a table
    upto = F.sum("n_rows").over(Window.partitionBy("table").orderBy("sourceid", "file"))
    numbered = fresh.join(before, "table", "left").withColumn("last_id", F.coalesce("_last", F.lit(0)) + upto)
    given = last.select("table", "last_id").unionByName(numbered.select("table", "last_id"))
    given = given.groupBy("table").agg(F.max("last_id").alias("last_id"))
    entries = kept.select(*names).unionByName(numbered.select(*names)).unionByName(given, allowMissingColumns=True)
    write_version(entries.select(*names), base, "manifest")
    fresh.unpersist()


def append_trips(df: DataFrame, base: str, rebalance: bool = False) -> str:
    """Add trips to the table of their variant; returns the new generation.

    A source that has rows in ``df`` is replaced as a whole, so loading a file again, or
    retrying a failed load, never doubles rows.
    """
    gen = write_trips(df.withColumn("table", F.lit(table_for(df))), base, rebalance)
    publish(df.sparkSession, base, gen)
    return gen


def read_trips(
    spark: SparkSession, base: str, name: str = ZONE_TABLE, sources: Iterable[int] | None = None, ids: bool = False
) -> DataFrame:
    """A trip table as the latest manifest has it, empty when nothing was written yet.

    ``sources`` reads only the partitions of some source files. ``ids`` adds ``id``, the number
    of each row: its place in its file, after the ids before that file. Nothing is sorted or
    shuffled for it, and a row keeps its id as long as its source isn't loaded again.
    """
    schema = schemas.TRIPS_ZONE if name in (ZONE_TABLE, ODD_ZONE_TABLE) else schemas.TRIPS_GEO
    names = schema.fieldNames()
    entries = read_manifest(spark, base).where((F.col("table") == name) & F.col("file").isNotNull())
    if sources is not None:
        entries = entries.where(F.col("sourceid").isin([int(i) for i in sources]))
    valid = entries.select("sourceid", "gen").distinct().orderBy("sourceid").collect()  # a row a source
    stored = _stored(spark, base, *[f"table={name}/sourceid={r.sourceid}/gen={r.gen}" for r in valid]) if valid else None
    if stored is None:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("id", F.lit(None).cast("bigint")) if ids else empty
    if not ids:
        return stored.select(*names)
    first = entries.select(
        F.col("gen").alias("_gen"),
        F.col("sourceid").alias("_sourceid"),
        F.col("file").alias("_file"),
        (F.col("last_id") - F.col("n_rows") + 1).alias("_first"),
    )
    placed = stored.select(*names, "gen", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_row"))
    same = (F.col("gen") == F.col("_gen")) & (F.col("sourceid") == F.col("_sourceid")) & (F.col("_name") == F.col("_file"))
    return placed.join(broadcast_if_small(first), same).select(*names, (F.col("_first") + F.col("_row")).alias("id"))


def id_ranges(spark: SparkSession, base: str, name: str = ZONE_TABLE) -> DataFrame:
    """(sourceid, first_id, last_id): the ids of a trip table, a range for each stored file."""
    entries = read_manifest(spark, base).where((F.col("table") == name) & F.col("file").isNotNull())
    return entries.select("sourceid", (F.col("last_id") - F.col("n_rows") + 1).alias("first_id"), "last_id")


def drop_sources(spark: SparkSession, base: str, ids: Iterable[int], names: Iterable[str] = TRIP_TABLES) -> None:
    """Take some sources out of trip tables; other sources stay as they are."""
    gone = F.col("sourceid").isin([int(i) for i in ids]) & F.col("table").isin(list(names))
    publish(spark, base, None, gone)


def vacuum(spark: SparkSession, base: str, hours: float = 24.0) -> int:
    """Delete generations that no kept manifest names and that are older than ``hours``; their number."""
    kept = versions(spark, base, "manifest")
    named = None
    for v in kept:
        one = spark.read.schema(schemas.MANIFEST).parquet(f"{table_path(base, 'manifest')}/version={v}")
        named = one if named is None else named.unionByName(one)
    used = {r.gen for r in named.select("gen").distinct().collect()} if kept else set()
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(table_path(base, "trips"))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path(root, "table=*/sourceid=*/gen=*")) or []
    oldest = spark._jvm.java.lang.System.currentTimeMillis() - hours * 3_600_000
    gone = [s.getPath() for s in found if s.getPath().getName()[4:] not in used and s.getModificationTime() <= oldest]
    for folder in gone:
        files.delete(folder, True)
    return len(gone)


def versions(spark: SparkSession, base: str, name: str) -> list[int]:
    """Numbers of the complete versions of a table, in order. Lists its folders, not their files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(table_path(base, name))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = {s.getPath().getName(): s.getPath() for s in files.listStatus(root)}
    numbered = {m.group(1): p for n, p in found.items() if (m := re.fullmatch(r"version=(\d+)", n))}
    return sorted(int(n) for n, p in numbered.items() if files.exists(path(p, "_SUCCESS")))


def write_version(df: DataFrame, base: str, name: str) -> str:
    """Store a table as a new version, visible once complete; returns its path.

    The KEPT_VERSIONS last ones stay, for readers of an earlier one and for a table that is
    derived from the one before it.
    """
    spark, root = df.sparkSession, table_path(base, name)
    done = versions(spark, base, name)
    path = f"{root}/version={max(done, default=0) + 1}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in done[: 1 - KEPT_VERSIONS]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"version={old}"), True)
    return path


def read_version(spark: SparkSession, base: str, name: str, schema) -> DataFrame:
    """The latest complete version of a table, empty at first."""
    done = versions(spark, base, name)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table_path(base, name)}/version={done[-1]}")


def write_rates(rates: DataFrame, base: str) -> str:
    """Rebuild the rates table as a new version, clustered by its keys.

    A zone's rates lie in one file, and zones in ranges, so that a reader of some zones skips
    the other files and row groups by their bounds.
    """
    ranged = rates.repartitionByRange("zoneid")
    return write_version(ranged.sortWithinPartitions("zoneid", "target_month", "target_hour", "traffic"), base, "rates")


def read_rates(spark: SparkSession, base: str) -> DataFrame:
    return read_version(spark, base, "rates", schemas.RATES)


def _files(spark: SparkSession, folder: str):
    """(the store's client, a maker of paths) for a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_curves(curves: DataFrame, base: str) -> str:
    """Store lookup curves as a new version, bucketed by all that a request asks for.

    There are as many buckets as the session has shuffle partitions; an empty file beside the
    versions notes their number.
    """
    spark, root = curves.sparkSession, table_path(base, "curves")
    version = max(versions(spark, base, "curves"), default=0) + 1
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"curves_{uuid.uuid4().hex}"
    files, path = _files(spark, root)
    for old in files.globStatus(path(root, f"_buckets-{version}=*")) or []:  # of a write that broke off
        files.delete(old.getPath(), False)
    files.create(path(root, f"_buckets-{version}={n}")).close()
    dealt = curves.select(*schemas.CURVES.fieldNames()).repartition(n, *CURVE_KEYS)
    writer = dealt.write.mode("overwrite").bucketBy(n, *CURVE_KEYS).sortBy(*CURVE_KEYS)
    writer.option("path", f"{root}/version={version}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return f"{root}/version={version}"


def read_curves(spark: SparkSession, base: str) -> DataFrame:
    """The latest curves; a join on all their keys leaves them where they are."""
    root, done = table_path(base, "curves"), versions(spark, base, "curves")
    if not done:
        return spark.createDataFrame([], schemas.CURVES)
    files, path = _files(spark, root)
    (note,) = files.globStatus(path(root, f"_buckets-{done[-1]}=*"))
    n, name = int(note.getPath().getName().split("=")[1]), f"curves_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.CURVES)
    keys = ", ".join(CURVE_KEYS)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys})"
        f" INTO {n} BUCKETS LOCATION '{root}/version={done[-1]}'"
    )
    out = spark.table(name)
    out.schema  # resolved: the name isn't needed any more
    spark.sql(f"DROP TABLE {name}")
    return out


def write_mapping(mapping: DataFrame, base: str, name: str) -> str:
    """Create or replace an overlay mapping table; readers of the one before keep it."""
    return write_version(mapping, base, name)


def write_registry(registry: DataFrame, base: str) -> str:
    """Store the registry as a new version."""
    return write_version(registry.select(*schemas.FILE_REGISTRY.fieldNames()), base, "registry")


def latest_version(spark: SparkSession, base: str, name: str = "registry") -> int | None:
    return max(versions(spark, base, name), default=None)


def read_registry(spark: SparkSession, base: str) -> DataFrame:
    """The latest complete registry, empty at first."""
    return read_version(spark, base, "registry", schemas.FILE_REGISTRY)


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a SQL text run by a database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append rows to a database table, one connection per partition."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()

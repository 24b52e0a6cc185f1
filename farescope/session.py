"""Session settings and the few places where a plan depends on data size."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of column values that a side may have before it is shuffled instead of broadcast. The
# hash table that executors build of it takes some three times as much.
BROADCAST_BYTES = 48 << 20
_ROW_BYTES = 16  # what a row takes besides its values

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "farescope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword pairs override them.

    Shuffle partition counts and split sizes are left to the cluster and to AQE.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _bytes(column: Column, kind: T.DataType) -> Column | int:
    """Bytes of a column's values: a number for fixed types, else a column to be summed."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return _total([_bytes(column[f.name], f.dataType) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        each = _bytes(F.lit(None).cast(kind.elementType), kind.elementType)
        if isinstance(each, int):
            return F.greatest(F.size(column), F.lit(0)) * each + 8
        return F.octet_length(F.to_json(F.struct(column)))
    if isinstance(kind, T.MapType):
        return F.octet_length(F.to_json(F.struct(column)))
    return 8


def _total(parts: list) -> Column | int:
    fixed = sum(p for p in parts if isinstance(p, int))
    varying = [p for p in parts if not isinstance(p, int)]
    return reduce(lambda x, y: x + y, varying, F.lit(fixed)) if varying else fixed


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` is small enough to copy to every executor.

    One aggregate row comes back to the driver: the bytes of all values, nested ones included.
    """
    names = [f.name.replace("`", "``") for f in df.schema.fields]
    width = _total([_bytes(F.col(f"`{n}`"), f.dataType) for n, f in zip(names, df.schema.fields, strict=True)])
    width = F.lit(width) if isinstance(width, int) else width
    found = df.agg(F.coalesce(F.sum((width + _ROW_BYTES).cast("bigint")), F.lit(0))).first()[0]
    return found <= max_bytes


def broadcast_if_small(df: DataFrame, **limits) -> DataFrame:
    """Hint a broadcast when the checked size allows it, else leave the join to AQE."""
    return F.broadcast(df) if fits_broadcast(df, **limits) else df


def evaluate_once(df: DataFrame, *columns) -> DataFrame:
    """Select ``columns``, each computed once per row.

    A filter on a computed column is moved below the projection that defines it, and
    the definition is copied into every condition. Parsing text or building timestamps
    a dozen times per row costs more than all the rest, and can grow the generated
    code past what the JVM compiles. A one-element ``inline`` stays in place, inside
    the same generated stage. ``columns`` are columns or SQL text. Use it for computed
    columns only: it also keeps filters from reaching a scan.
    """
    fields = [F.expr(c) if isinstance(c, str) else c for c in columns]
    return df.select(F.inline(F.array(F.struct(*fields))))


@contextmanager
def _set(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def open_writers(spark: SparkSession, files: int) -> AbstractContextManager[None]:
    """Partitioned writes in this block keep up to ``files`` files open in a task and don't sort its rows.

    A task with more than that sorts the rows that are left, as any partitioned write does with
    all of them; the memory of such a sort grows with the rows of the task.
    """
    return _set(spark, "spark.sql.maxConcurrentOutputFileWriters", files)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes in this block delete their shuffle files when they end.

    Otherwise these stay on the executors' disks until the driver happens to collect garbage. A
    Spark that doesn't know the setting (before 4.1) keeps them until then.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Every executor must be able to reach it. Where the setting is absent, the session's
    warehouse folder takes its place, which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    return os.path.join(base, f"farescope-{uuid.uuid4().hex}")

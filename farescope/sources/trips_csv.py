"""Raw trip CSV files and their discovery."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from farescope.functions.names import canonical_name, sanitize_columns, sanitize_name, unify_columns
from farescope.operators.clean import raw_columns, typed
from farescope.session import broadcast_if_small


_HEADER_READERS = 16
HEADER_BYTES = 1 << 16


def _reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
    )


def _file_name(name: str) -> Column:
    """A file name as the registry has it: percent-decoded, in lower case."""
    return F.lower(F.expr(f"coalesce(try_url_decode(replace({name}, '+', '%2B')), {name})"))


def read_trips_csv(
    spark: SparkSession, path, multiline: bool = False, with_file: bool = False
) -> DataFrame:
    """Raw trips of one header dialect: every column text, names cleaned and unified.

    Nothing is inferred, so the data is read once. Files are split unless
    ``multiline`` is set, which quoted line breaks require. ``with_file`` adds the
    lower-cased ``filename`` each row came from.
    """
    raw = _reader(spark, multiline).csv(path)
    if with_file:
        raw = raw.select("*", _file_name("_metadata.file_name").alias("filename"))
    return unify_columns(sanitize_columns(raw))


def _addresses(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """Paths as Spark's readers write them: with the store's name, percent-encoded."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    stores, out = {}, {}
    for p in paths:
        folder = _folder(p)
        if folder not in stores:
            stores[folder] = path(folder).getFileSystem(conf)
        out[p] = re.sub("^file:/+", "file:/", stores[folder].makeQualified(path(p)).toUri().toString())
    return out


def _folder(path: str) -> str:
    return path.rsplit("/", 1)[0] if "/" in path else "."


def _located(spark: SparkSession, reader: DataFrameReader, addresses: dict[str, str]) -> DataFrame:
    """Rows of some CSV files, with ``_file``, the file's address as a reader spells it.

    The files' folders are listed, one call each, and other files in them are pruned by their
    address before anything is read; asking for each file by itself would take a job of its own.
    """
    found = reader.option("recursiveFileLookup", True).csv(sorted({_folder(p) for p in addresses}))
    wanted = sorted({s for a in addresses.values() for s in _spellings(a)})
    return found.where(F.col("_metadata.file_path").isin(wanted)).withColumn("_file", F.col("_metadata.file_path"))


def _spellings(address: str) -> list[str]:
    """How readers may spell an address: a local one has one to three slashes."""
    rest = address.removeprefix("file:/")
    return [f"file:{'/' * n}{rest}" for n in (1, 2, 3)] if rest != address else [address]


def file_headers(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """The first line of each file that isn't empty.

    No Spark job, however many files there are: Spark reads a file to its end even if one line is
    wanted, so the first bytes are read through the store's own client, several files at a time.
    A line longer than HEADER_BYTES is cut there.
    """
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def header(p: str) -> str:
        file = path(p)
        stream = file.getFileSystem(conf).open(file)
        try:
            first = b""
            for size in (4 << 10, HEADER_BYTES - (4 << 10)):
                first += bytes(stream.readNBytes(size))
                if b"\n" in first or b"\r" in first:
                    break
        finally:
            stream.close()
        return re.split(b"[\r\n]", first, maxsplit=1)[0].decode("utf-8-sig", "replace")

    paths = sorted(set(paths))
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        return {p: line for p, line in zip(paths, pool.map(header, paths), strict=True) if line}


def position_map(header: str) -> dict[str, int]:
    """Where a header line has each canonical column; the first place of a name that comes twice."""
    cells = next(csv.reader([header]), [])
    names = [canonical_name(sanitize_name(cell.strip())) for cell in cells]
    return {name: i for i, name in reversed(list(enumerate(names)))}


def _one_scan(spark: SparkSession, files: dict[str, dict[str, int]], geo: bool, multiline: bool) -> DataFrame:
    """Trips of files of one kind, whatever their dialects: a single scan.

    Lines are split into cells by position; a small table of files says which dialect a line
    has, and the dialect at which position a column is.
    """
    wanted = raw_columns(geo)
    places = {path: tuple(sorted((c, i) for c, i in at.items() if c in wanted)) for path, at in files.items()}
    dialects = sorted(set(places.values()))
    addresses = _addresses(spark, files)
    width = 1 + max(i for d in dialects for _, i in d)
    schema = ", ".join(f"_c{i} string" for i in range(width))
    raw = _located(spark, _reader(spark, multiline).schema(schema), addresses)
    raw = raw.select(*[f"_c{i}" for i in range(width)], "_file")
    # What holds for a whole file is worked out once for each, and not for each row.
    known = {s: (a.rsplit("/", 1)[-1], dialects.index(places[p])) for p, a in addresses.items() for s in _spellings(a)}
    known = spark.createDataFrame([(s, *x) for s, x in known.items()], "_file string, _name string, _dialect int")
    known = known.select("_file", _file_name("_name").alias("filename"), "_dialect")
    raw = raw.join(broadcast_if_small(known), "_file")
    dialect = F.col("_dialect")

    def column(name: str) -> Column:
        found: dict[int, list[int]] = defaultdict(list)
        for k, d in enumerate(dialects):
            for c, i in d:
                if c == name:
                    found[i].append(k)
        value = F.lit(None).cast("string")
        for i, ks in sorted(found.items()):
            here = F.col(f"_c{i}")
            value = here if len(ks) == len(dialects) else F.when(dialect.isin(ks), here).otherwise(value)
        return value.alias(name)

    return typed(raw.select(*[column(c) for c in wanted], "filename"))


def read_trip_files(
    spark: SparkSession, paths: Iterable[str], multiline: bool = False
) -> tuple[DataFrame | None, DataFrame | None]:
    """(coordinate trips, zone trips) of many files of any dialect, typed, with ``filename``.

    The header lines are read first, without a Spark job; then each side is one scan, however
    many files and dialects it has.
    A side is None when no file is of that kind. Columns that a file lacks are NULL, so that
    its rows are rejected; a file without a pickup time is no trip file and is left out.
    Header lines are single lines, also with ``multiline``.
    """
    sides: dict[bool, dict[str, dict[str, int]]] = {True: {}, False: {}}
    for path, line in file_headers(spark, paths).items():
        at = position_map(line)
        if "pickup_datetime" in at:
            sides["pickup_longitude" in at][path] = at
    geo, zone = (_one_scan(spark, sides[k], k, multiline) if sides[k] else None for k in (True, False))
    return geo, zone


def list_trip_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, filename, length) of the CSV files under ``path``; contents are not read.

    Spark leaves empty files out.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "length")
    )

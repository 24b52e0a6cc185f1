"""New trip files as a stream of file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from farescope.plans.refresh import load_files

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_files(
    spark: SparkSession,
    directory: str,
    base: str,
    checkpoint: str,
    calendar: DataFrame,
    as_of_year: int | None = None,
    multiline: bool = False,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load every CSV file not seen before, then stop; run again for the next ones.

    The stream carries names, not contents, so files of different header dialects can
    arrive together and each batch is one distributed load. A batch that is retried
    replaces the rows of its own files, so each file counts once.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
        .select("path")
    )

    def load(batch: DataFrame, _: int) -> None:
        paths = [row.path for row in batch.collect()]  # at most files_per_batch names
        load_files(batch.sparkSession, paths, base, calendar, as_of_year, multiline)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

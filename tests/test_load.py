"""What a load does once for each file, not for each row."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_run import put

from farescope import holiday_calendar, list_trip_files, read_trip_files
from farescope.plans.refresh import load_files
from farescope.sources import tables

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def writers(spark, monkeypatch):
    """The files that a task may have open, for each write with partitions."""
    seen = []
    whole = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: seen.append(int(spark.conf.get(WRITERS))) or whole(self, *c))
    return seen


def test_trips_are_stored_without_a_sort(spark, tmp_path, writers):
    paths = [put(tmp_path, f"{k}.csv", "yellow_new", k + 1) for k in range(tables.OPEN_FILES + 4)]
    load_files(spark, paths, str(tmp_path / "base"), holiday_calendar(spark, 2022), 2021)
    assert writers == [tables.OPEN_FILES]
    counts = tables.read_trips(spark, str(tmp_path / "base"), ids=True).groupBy("sourceid").agg(F.count("id"), F.countDistinct("id")).collect()
    assert sorted(r[1] for r in counts) == [*range(1, tables.OPEN_FILES + 5)] and all(r[1] == r[2] for r in counts)


def test_file_names_are_not_worked_out_for_each_row(spark, tmp_path):
    folder = tmp_path / "a b+c%20d"
    folder.mkdir()
    put(folder, "Ä b+c%20d.CSV", "yellow_new", 3)
    put(folder, "other.csv", "green_new", 2)
    paths = [r.path for r in list_trip_files(spark, str(folder)).collect()]
    _, zone = read_trip_files(spark, paths)
    plan = zone._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "UrlCodec" not in plan.split("FileScan csv")[0].split("Inner")[0]
    assert {r.filename: r["count"] for r in zone.groupBy("filename").count().collect()} == {"ä b+c%20d.csv": 3, "other.csv": 2}


def test_a_file_spelled_in_two_ways_is_read_once(spark, tmp_path):
    path = put(tmp_path, "x.csv", "yellow_new", 3)
    assert read_trip_files(spark, [path, f"file:{path}", f"file://{path}"])[1].count() == 3

"""What keeps the memory of a writing task from growing with the tables."""

import os
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from farescope import bridge
from farescope.session import open_writers

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def writers(spark, monkeypatch):
    """The files that a task may have open, for each write with partitions."""
    seen = []
    whole = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: seen.append(int(spark.conf.get(WRITERS))) or whole(self, *c))
    return seen


def test_monthly_files_are_written_without_a_sort(spark, tmp_path, writers):
    item = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, "
        "l_returnflag string, l_shipdate timestamp_ntz"
    )
    rows = spark.range(200).select(
        "id", (F.col("id") * 7 % 50).alias("p"), (F.col("id") % 30).alias("s"), (F.col("id") % 7 + 1).cast("int"), F.lit(9.0),
        F.lit(0.05), F.lit("N"), F.expr("cast('1995-03-01' as timestamp_ntz) + make_ym_interval(cast(id % 3 as int), 0)"),
    )
    spark.createDataFrame(rows.collect(), item).write.parquet(str(tmp_path / "lineitem.parquet"))
    before = spark.conf.get(WRITERS)
    bridge.write_monthly_files(spark, str(tmp_path), str(tmp_path / "in"))
    assert writers == [bridge.OPEN_FILES] * 2 and spark.conf.get(WRITERS) == before
    lines = {p.name: len(p.read_text().splitlines()) - 1 for p in (tmp_path / "in").glob("*.csv")}
    assert sum(n for k, n in lines.items() if k.startswith("yellow")) == 200 == sum(n for k, n in lines.items() if k.startswith("green"))
    assert {k[-11:-7] for k in lines} == {"2015", "2016", "2017"}


def test_more_partitions_than_open_files(spark, tmp_path):
    with open_writers(spark, 2):
        spark.range(100).coalesce(1).withColumn("k", F.col("id") % 7).write.partitionBy("k").parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t"))
    assert found.count() == 100 and found.where("k <> id % 7").isEmpty()


def line_items(spark, folder, years):
    """Forty line items in each of some years, and one without a date."""
    rows = spark.range(40 * years).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 50).alias("l_partkey"), (F.col("id") % 30).alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), F.lit(9.0).alias("l_quantity"), F.lit(0.05).alias("l_discount"),
        F.lit("N").alias("l_returnflag"),
        F.expr(f"cast('1993-03-01' as timestamp_ntz) + make_ym_interval(cast(id % {years} as int), 0)").alias("l_shipdate"),
    )
    undated = rows.limit(1).withColumn("l_shipdate", F.lit(None).cast("timestamp_ntz"))
    rows.unionByName(undated).write.parquet(f"{folder}/lineitem.parquet")


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def test_monthly_files_leave_no_shuffle_files(spark, tmp_path):
    line_items(spark, tmp_path, 3)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(name), shuffle_files(spark)
    bridge.write_monthly_files(spark, str(tmp_path), str(tmp_path / "in"))
    until = time.time() + 20  # they are deleted in the background
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files and spark.conf.get(name) == before


def test_monthly_files_are_dealt_as_line_items(spark, tmp_path, monkeypatch):
    line_items(spark, tmp_path, 8)
    plans = []
    whole = DataFrameWriter.partitionBy
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: plans.append(plan(self._df)) or whole(self, *c))
    bridge.write_monthly_files(spark, str(tmp_path), str(tmp_path / "in"))
    assert len(plans) == 2
    for above, below in (p.split("Exchange ", 1) for p in plans):
        assert " as string" in above and " as string" not in below  # no text is shuffled
    names = [p.name for p in (tmp_path / "in").iterdir() if not p.name.startswith(".")]
    texts = {n: (tmp_path / "in" / n).read_text().splitlines() for n in names}
    header = texts["yellow_tripdata_2013-01.csv"][0]
    assert header == 'Trip_Pickup_DateTime,Trip_Dropoff_DateTime,Passenger_Count,Trip_Distance,Tip_Amt,"Total_Amt",PULocationID,DOLocationID'
    for kind in ("yellow", "green"):
        own = {n: t[1:] for n, t in texts.items() if n.startswith(kind)}
        assert sum(len(t) for t in own.values()) == 320
        assert all(line[:4] == n[-11:-7] for n, t in own.items() for line in t)
        assert all((line[14:16] == "00") == n.endswith("-02.csv") for n, t in own.items() for line in t)

"""Files of several dialects through the sources, the batch run and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from farescope import (
    clean_trips,
    holiday_calendar,
    index_zones,
    ingest_new_files,
    list_trip_files,
    load_geometry,
    read_trip_files,
    read_trips_csv,
    run_pipeline,
)
from farescope.schemas import RATES, TRIPS_GEO, TRIPS_ZONE
from farescope.sources import tables
from farescope.plans.refresh import load_files

# Header lines in published spellings, one per provider and era.
HEADERS = {
    "yellow_old": " Trip_Pickup_DateTime,Trip_Dropoff_DateTime,Passenger_Count,Trip_Distance,Start_Lon,Start_Lat,End_Lon,End_Lat,Tip_Amt,Total_Amt\r",
    "yellow_new": "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,PULocationID,DOLocationID,fare_amount,tip_amount,total_amount",
    "green_old": "lpep_pickup_datetime,Lpep_dropoff_datetime,Pickup_longitude,Pickup_latitude,Dropoff_longitude,Dropoff_latitude,Passenger_count,Trip_distance,Tip_amount,Total_amount",
    "green_new": "lpep_pickup_datetime,lpep_dropoff_datetime,PULocationID,DOLocationID,passenger_count,trip_distance,tip_amount,total_amount",
}


def rows(kind, n, day):
    a, b = f"{day} 10:00:00", f"{day} 10:30:00"
    return {
        "yellow_old": [f"{a},{b},1,5.0,0.5,0.5,1.5,0.5,1.0,21.0"],
        "yellow_new": [f"1,{a},{b},1,5.0,1,2,99,1.0,21.0"],
        "green_old": [f"{a},{b},1.5,0.5,0.5,0.5,1,5.0,1.0,21.0"],
        "green_new": [f"{a},{b},2,1,1,5.0,1.0,21.0"],
    }[kind] * n


def put(folder, name, kind, n, day="2018-05-07"):
    (folder / name).write_text("\n".join([HEADERS[kind], *rows(kind, n, day)]) + "\n")
    return str(folder / name)


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "Yellow_tripdata_2010-01.csv", "yellow_old", 12)
    put(folder, "yellow_tripdata_2018-05.csv", "yellow_new", 11)
    put(folder, "yellow_tripdata_2018-06.csv", "yellow_new", 3, "2018-07-04")
    put(folder, "green_tripdata_2014-01.csv", "green_old", 13)
    put(folder, "green_tripdata_2018-05.csv", "green_new", 10)
    (folder / "notes.txt").write_text("not a trip file")
    (folder / "other.csv").write_text("a,b\n1,2\n")
    return folder


@pytest.fixture(scope="module")
def index(spark):
    squares = [(i, f"z{i}", json.dumps({"type": "Polygon", "coordinates": [[[i - 1, 0], [i, 0], [i, 1], [i - 1, 1], [i - 1, 0]]]})) for i in (1, 2)]
    return index_zones(load_geometry(spark.createDataFrame(squares, "zone_id int, zone string, geom string"), "geom"), 0.5)


def test_listing(spark, incoming):
    listed = {r.filename: r.length for r in list_trip_files(spark, str(incoming)).collect()}
    assert len(listed) == 6 and all(n > 0 for n in listed.values())


def test_dialects_come_out_alike(spark, incoming):
    paths = [r.path for r in list_trip_files(spark, str(incoming)).collect()]
    geo, zone = read_trip_files(spark, paths)
    cleaned = clean_trips(geo, 2021)
    assert cleaned.groupBy("filename").count().count() == 2
    assert cleaned.count() == 25
    assert {(r.fare_amount, r.rate) for r in cleaned.collect()} == {(20.0, 4.0)}
    by_file = {r.filename: r["count"] for r in clean_trips(zone, 2021).groupBy("filename").count().collect()}
    assert by_file == {"yellow_tripdata_2018-05.csv": 11, "yellow_tripdata_2018-06.csv": 3, "green_tripdata_2018-05.csv": 10}


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text(
        "note,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,PULocationID,DOLocationID,tip_amount,total_amount\n"
        '"two\nlines, ""quoted""",2018-05-07 10:00:00,2018-05-07 10:30:00,1,5.0,1,2,1.0,21.0\n'
    )
    raw = read_trips_csv(spark, str(path), multiline=True)
    assert raw.first().note == 'two\nlines, "quoted"'
    assert clean_trips(raw, 2021).count() == 1


def test_batch_run_twice(spark, incoming, tmp_path, index):
    base, cal = str(tmp_path / "base"), holiday_calendar(spark, 2022)
    for _ in range(2):  # a second run finds complete files done and replaces the others
        rates = run_pipeline(spark, str(incoming), base, index, cal, 0.5, 2021, minimum=10)
        assert rates.schema.fieldNames() == RATES.fieldNames()
        trips = tables.read_trips(spark, base)
        assert trips.schema.fieldNames() == TRIPS_ZONE.fieldNames()
        assert trips.count() == 12 + 11 + 3 + 13 + 10
        assert tables.read_trips(spark, base, tables.GEO_TABLE).count() == 0
        state = {r.filename: r.islocked for r in tables.read_registry(spark, base).collect()}
        assert state == {
            "yellow_tripdata_2010-01.csv": 2,
            "yellow_tripdata_2018-05.csv": 2,
            "yellow_tripdata_2018-06.csv": 0,
            "green_tripdata_2014-01.csv": 2,
            "green_tripdata_2018-05.csv": 2,
            "other.csv": 0,
        }
        got = {(r.zoneid, r.target_month, r.isholiday): r.rate for r in rates.collect()}
        assert got == {(1, 5, 0): 4.0, (2, 5, 0): 4.0, (1, 0, 1): 4.0}
    ids = [r.id for r in tables.read_registry(spark, base).collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]


def test_a_changed_file_replaces_its_rows(spark, tmp_path):
    folder, base, cal = tmp_path / "in", str(tmp_path / "base"), holiday_calendar(spark, 2022)
    folder.mkdir()
    path = put(folder, "yellow_tripdata_2018-05.csv", "yellow_new", 4)
    assert load_files(spark, [path], base, cal, 2021) == 1
    put(folder, "yellow_tripdata_2018-05.csv", "yellow_new", 6)
    spark.catalog.refreshByPath(path)
    load_files(spark, [path], base, cal, 2021)
    assert tables.read_trips(spark, base).count() == 6


def test_nothing_to_do(spark, tmp_path):
    assert load_files(spark, [], str(tmp_path / "base"), holiday_calendar(spark, 2022)) == 0
    assert tables.read_trips(spark, str(tmp_path / "base")).count() == 0
    assert tables.read_registry(spark, str(tmp_path / "base")).count() == 0


def test_stream_takes_each_file_once(spark, incoming, tmp_path):
    base, cal = str(tmp_path / "base"), holiday_calendar(spark, 2022)

    def run():
        query = ingest_new_files(spark, str(incoming), base, str(tmp_path / "checkpoint"), cal, 2021, files_per_batch=2)
        query.awaitTermination()
        return (
            tables.read_trips(spark, base).count(),
            tables.read_trips(spark, base, tables.GEO_TABLE).count(),
            tables.latest_version(spark, base),
        )

    zone, geo, version = run()
    assert (zone, geo) == (24, 25) and version == 3  # six files, two per batch
    assert run() == (zone, geo, version)
    put(incoming, "green_tripdata_2018-06.csv", "green_new", 5)
    assert run() == (zone + 5, geo, version + 1)
    assert tables.read_trips(spark, base, tables.GEO_TABLE).schema.fieldNames() == TRIPS_GEO.fieldNames()


def test_tables_round_trip(spark, tmp_path):
    mapping = spark.createDataFrame([(1, 2)], "segmentid int, zone_id int")
    for _ in range(2):
        path = tables.write_mapping(mapping, str(tmp_path), "segment_zone_map")
    assert spark.read.parquet(path).count() == 1
    rates = spark.createDataFrame([(z, 1, 1, 1, 1.0, 0, 0, 0) for z in range(5)], RATES)
    tables.write_rates(rates, str(tmp_path))
    tables.write_rates(rates.filter("zoneid < 2"), str(tmp_path))
    assert tables.read_rates(spark, str(tmp_path)).count() == 2


def loaded(spark, base):
    trips = tables.read_trips(spark, base)
    return trips.count(), {r["filename"]: r["islocked"] for r in tables.read_registry(spark, base).collect()}


def test_odd_names_lose_no_rows(spark, tmp_path):
    base, folder = str(tmp_path / "base"), tmp_path / "odd names"
    folder.mkdir()
    for name in ("a b.csv", "c+d%20e.csv", "YELLOW.CSV"):
        put(folder, name, "yellow_new", 5)
    paths = [r.path for r in list_trip_files(spark, str(folder)).select("path").collect()]
    load_files(spark, paths, base, holiday_calendar(spark, 2025))
    assert loaded(spark, base)[0] == 15


def test_reload_replaces_rows_and_state(spark, tmp_path):
    from farescope.plans.refresh import check_files

    base, calendar = str(tmp_path / "base"), holiday_calendar(spark, 2025)
    path = put(tmp_path, "f.csv", "yellow_new", 5)
    load_files(spark, [path], base, calendar)
    check_files(spark, base, 10)
    assert loaded(spark, base) == (5, {"f.csv": 0})
    (tmp_path / "f.csv").write_text(HEADERS["yellow_new"] + "\n")
    load_files(spark, [path], base, calendar)
    assert loaded(spark, base) == (0, {"f.csv": 1})
    put(tmp_path, "f.csv", "yellow_new", 50)
    load_files(spark, [path], base, calendar)
    check_files(spark, base, 10)
    assert loaded(spark, base) == (50, {"f.csv": 2})


def test_file_without_a_column_is_rejected_not_fatal(spark, tmp_path):
    base, short = str(tmp_path / "base"), tmp_path / "short.csv"
    short.write_text("tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID\n2018-05-07 10:00:00,2018-05-07 10:30:00,1\n")
    paths = [str(short), put(tmp_path, "whole.csv", "yellow_new", 4)]
    load_files(spark, paths, base, holiday_calendar(spark, 2025))
    assert loaded(spark, base)[0] == 4


def test_only_moved_sources_leave_the_staging_table(spark, tmp_path):
    base = str(tmp_path / "base")
    paths = [put(tmp_path, "a.csv", "yellow_old", 3), put(tmp_path, "b.csv", "yellow_old", 2)]
    load_files(spark, paths, base, holiday_calendar(spark, 2025))
    sources = lambda: sorted({r[0] for r in tables.read_trips(spark, base, tables.GEO_TABLE).select("sourceid").collect()})
    ids = sources()
    tables.drop_sources(spark, base, ids[:1], (tables.GEO_TABLE,))
    assert len(ids) == 2 and sources() == ids[1:]


def test_readers_of_earlier_rates_survive_a_refresh(spark, tmp_path):
    base = str(tmp_path / "base")
    rates = spark.createDataFrame([(z, 1, 1, 1, 1.0, 0, 0, 0) for z in range(5)], RATES)
    assert tables.read_rates(spark, base).count() == 0
    tables.write_rates(rates, base)
    held = tables.read_rates(spark, base)
    tables.write_rates(rates.filter("zoneid < 2"), base)
    assert (held.count(), tables.read_rates(spark, base).count()) == (5, 2)
    (tmp_path / "base" / "rates" / "version=3").mkdir()  # of a write that broke off
    assert tables.latest_version(spark, base, "rates") == 2
    for _ in range(3):
        tables.write_rates(rates, base)
    assert tables.versions(spark, base, "rates") == [3, 4, 5]

"""Generations, the manifest, row ids, the quick pass, quarantine, and runs that broke off."""

import uuid

import pytest
from pyspark.sql import functions as F
from test_run import HEADERS, index, put, rows  # noqa: F401

from farescope import holiday_calendar, list_trip_files
from farescope.operators.files import EXACT_MINIMUM, file_state, sequential_completeness, sequential_marks
from farescope.operators.rates import build_rates
from farescope.plans import refresh
from farescope.schemas import FILE_REGISTRY, GOOD
from farescope.sources import tables
from farescope.sources.trips_csv import file_headers, position_map, read_trip_files
from test_files import numbered, registry


def calendar(spark):
    return holiday_calendar(spark, 2025)


def count(spark, base, name=tables.ZONE_TABLE):
    return {r["sourceid"]: r["count"] for r in tables.read_trips(spark, base, name).groupBy("sourceid").count().collect()}


def jobs(spark, run):
    """The number of Spark jobs that ``run`` starts."""
    context = spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        out = run()
    finally:
        context._jsc.clearJobGroup()
    return len(context.statusTracker().getJobIdsForGroup(group)), out


# Headers


def test_the_number_of_jobs_does_not_depend_on_the_number_of_files(spark, tmp_path):
    kinds = list(HEADERS)
    paths = [put(tmp_path, f"f{i:02}.csv", kinds[i % 4], 3) for i in range(50)]
    put(tmp_path, "other.csv", "yellow_new", 3)  # in the folder, but not asked for
    assert jobs(spark, lambda: len(file_headers(spark, paths))) == (0, 50)
    small, _ = jobs(spark, lambda: [x.count() for x in read_trip_files(spark, paths[:5])])
    large, counts = jobs(spark, lambda: [x.count() for x in read_trip_files(spark, paths)])
    assert small == large and counts == [75, 75]
    geo, _ = read_trip_files(spark, paths)
    plan = geo._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_odd_header_lines(spark, tmp_path):
    texts = {"a": "x,y\r\n1,2\r\n", "b": "\ufeffx,\u00e9\n", "c": "x", "d": "", "e": "x\ry\r", "f": "h" * 2_000_000}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = file_headers(spark, [str(tmp_path / n) for n in texts])
    assert {k.rsplit("/", 1)[1]: len(v) if len(v) > 99 else v for k, v in got.items()} == {"a": "x,y", "b": "x,\u00e9", "c": "x", "e": "x", "f": 1 << 16}


def test_position_maps():
    at = position_map('"a, b", Trip_Pickup_DateTime,pulocationid,Trip_Pickup_DateTime,,Total_Amt\r')
    assert at["pickup_datetime"] == 1 and at["PULocationID"] == 2 and at["total_amount"] == 5
    assert position_map("") == {}


def test_one_name_in_two_folders_is_an_error(spark, tmp_path):
    paths = [put(tmp_path, "a.csv", "yellow_new", 2)]
    (tmp_path / "other").mkdir()
    paths.append(put(tmp_path / "other", "A.CSV", "yellow_new", 3))
    with pytest.raises(ValueError, match="a.csv"):
        refresh.load_files(spark, paths, str(tmp_path / "base"), calendar(spark))
    assert tables.read_registry(spark, str(tmp_path / "base")).count() == 0


# Generations


def test_what_is_not_published_is_not_seen(spark, tmp_path):
    base = str(tmp_path / "base")
    refresh.load_files(spark, [put(tmp_path, "a.csv", "yellow_new", 5)], base, calendar(spark))
    held = tables.read_trips(spark, base)
    more = held.unionByName(held).withColumn("table", F.lit(tables.ZONE_TABLE))
    gen = tables.write_trips(more, base)
    assert count(spark, base) == {1: 5}
    tables.publish(spark, base, gen)
    assert count(spark, base) == {1: 10} and held.count() == 5
    assert tables.vacuum(spark, base) == 0  # too young
    assert tables.vacuum(spark, base, hours=-1) == 0  # named by an earlier manifest that is kept
    for _ in range(tables.KEPT_VERSIONS):
        tables.drop_sources(spark, base, [99])
    assert tables.vacuum(spark, base, hours=-1) == 1 and count(spark, base) == {1: 10}


def test_a_source_staged_again_during_the_move_is_not_lost(spark, tmp_path, index, monkeypatch):  # noqa: F811
    base, cal = str(tmp_path / "base"), calendar(spark)
    paths = [put(tmp_path, "a.csv", "yellow_old", 3), put(tmp_path, "b.csv", "yellow_old", 4)]
    refresh.load_files(spark, paths, base, cal)
    write = tables.write_trips

    def staged_again_meanwhile(*args, **kwargs):
        monkeypatch.setattr(tables, "write_trips", write)
        gen = write(*args, **kwargs)
        refresh.load_files(spark, [put(tmp_path, "b.csv", "yellow_old", 6)], base, cal)
        return gen

    monkeypatch.setattr(tables, "write_trips", staged_again_meanwhile)
    refresh.place_coordinates(spark, base, index, 0.5)
    assert count(spark, base) == {1: 3} and count(spark, base, tables.GEO_TABLE) == {2: 6}
    refresh.place_coordinates(spark, base, index, 0.5)
    assert count(spark, base) == {1: 3, 2: 6} and count(spark, base, tables.GEO_TABLE) == {}


def test_one_scan_fills_the_zone_table_and_the_unmatched(spark, tmp_path, index):  # noqa: F811
    base = str(tmp_path / "base")
    off = rows("yellow_old", 1, "2018-05-07")[0].replace(",0.5,0.5,1.5,0.5,", ",0.5,0.5,9.5,0.5,")
    path = tmp_path / "a.csv"
    path.write_text("\n".join([HEADERS["yellow_old"], *rows("yellow_old", 3, "2018-05-07"), off, off]) + "\n")
    refresh.load_files(spark, [str(path)], base, calendar(spark))
    refresh.place_coordinates(spark, base, index, 0.5)
    assert count(spark, base) == {1: 3} and count(spark, base, tables.UNMATCHED_TABLE) == {1: 2}
    off_map = tables.read_trips(spark, base, tables.UNMATCHED_TABLE).first()
    assert (off_map["pickup_longitude"], off_map["dropoff_longitude"]) == (0.5, 9.5)
    staged = tables.read_trips(spark, base, tables.GEO_TABLE)
    plan = refresh.zones_of_trips(staged, index, 0.5, small=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftOuter") == 2


# Quarantine


def test_odd_dates_go_to_their_table_in_the_same_pass(spark, tmp_path):
    base, kinds = str(tmp_path / "base"), ("yellow_new", "green_old")
    for kind in kinds:
        lines = [*rows(kind, 4, "2018-05-07"), *rows(kind, 2, "2031-05-07"), *rows(kind, 1, "2001-01-01")]
        (tmp_path / f"{kind}.csv").write_text("\n".join([HEADERS[kind], *lines]) + "\n")
    paths = [str(tmp_path / f"{kind}.csv") for kind in kinds]
    for _ in range(2):
        refresh.load_files(spark, paths, base, calendar(spark), 2021)
        assert sum(count(spark, base).values()) == sum(count(spark, base, tables.GEO_TABLE).values()) == 4
        assert sum(count(spark, base, tables.ODD_ZONE_TABLE).values()) == 3
        assert sum(count(spark, base, tables.ODD_GEO_TABLE).values()) == 3
    odd = tables.read_trips(spark, base, tables.ODD_GEO_TABLE)
    assert {r["pickup_year"] for r in odd.collect()} == {2031, 2001} and "pickup_longitude" in odd.columns


# Row ids


def test_ids_are_dense_and_never_given_out_twice(spark, tmp_path):
    base, cal = str(tmp_path / "base"), calendar(spark)

    def ids():
        got = {}
        for r in tables.read_trips(spark, base, ids=True).select("sourceid", "id").collect():
            got.setdefault(r["sourceid"], []).append(r["id"])
        return {k: sorted(v) for k, v in got.items()}

    paths = [put(tmp_path, "a.csv", "yellow_new", 30), put(tmp_path, "b.csv", "yellow_new", 20)]
    refresh.load_files(spark, paths, base, cal)
    assert ids() == {1: list(range(1, 31)), 2: list(range(31, 51))}
    refresh.load_files(spark, [put(tmp_path, "c.csv", "yellow_new", 5)], base, cal)
    refresh.load_files(spark, [put(tmp_path, "a.csv", "yellow_new", 7)], base, cal)
    assert ids() == {1: list(range(56, 63)), 2: list(range(31, 51)), 3: list(range(51, 56))}
    tables.drop_sources(spark, base, [1])
    refresh.load_files(spark, [put(tmp_path, "d.csv", "yellow_new", 2)], base, cal)
    assert ids()[4] == [63, 64]
    first = tables.read_trips(spark, base, ids=True).where("sourceid = 2").orderBy("id").first()
    assert first["id"] == 31
    assert tables.read_trips(spark, str(tmp_path / "none"), ids=True).columns[-1] == "id"
    plan = tables.read_trips(spark, base, ids=True)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_ranges_of_ids_count_like_the_ids(spark, tmp_path):
    from farescope.operators.files import range_counts, window_counts

    base, cal = str(tmp_path / "base"), calendar(spark)
    for name, n in (("a.csv", 30), ("b.csv", 21), ("c.csv", 55), ("a.csv", 44), ("d.csv", 1)):
        refresh.load_files(spark, [put(tmp_path, name, "yellow_new", n)], base, cal)
    reg = registry(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 1)])
    trips, ranges = tables.read_trips(spark, base, ids=True), tables.id_ranges(spark, base)
    for window in (1, 5, 10, 44, 1000):
        got = sorted(map(tuple, range_counts(ranges, reg, window).select("bucket", "sourceid", "n").collect()))
        assert got == sorted(map(tuple, window_counts(trips, reg, window).select("bucket", "sourceid", "n").collect())) and got
    assert range_counts(ranges.where("false"), reg).count() == 0
    one = sequential_completeness(ranges, reg, 10, 8)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sequential_completeness(trips, reg, 10, 8).collect()))


# Quick pass


def greedy(counts, minimum):
    """One window after another."""
    marks = {}
    for k in sorted({b for b, _ in counts}):
        here = [(-n, s) for (b, s), n in counts.items() if b == k and s not in marks]
        if here and -min(here)[0] > minimum:
            marks[min(here)[1]] = k
    return marks


@pytest.mark.parametrize("seed", range(4))
def test_marks_are_those_of_one_window_after_another(spark, seed):
    import random

    rng = random.Random(seed)
    counts = {(b, s): rng.randint(1, 30) for b in range(25) for s in range(12) if rng.random() < 0.6}
    df = spark.createDataFrame([(b, s, n) for (b, s), n in counts.items()], "bucket bigint, sourceid bigint, n bigint")
    got = {r["sourceid"]: r["bucket"] for r in sequential_marks(df, 20).collect()}
    assert got == greedy(counts, 20)
    assert sequential_marks(df.where("false"), 20).count() == 0


def test_a_runner_up_wins_a_later_window(spark):
    counts = spark.createDataFrame([(0, 1, 50), (0, 2, 40), (1, 1, 50), (1, 2, 40), (2, 1, 60), (2, 3, 10)], "bucket bigint, sourceid bigint, n bigint")
    assert {r["sourceid"]: r["bucket"] for r in sequential_marks(counts, 20).collect()} == {1: 0, 2: 1}


def test_quick_and_exact_pass_equal_the_exact_one(spark):
    trips = numbered(spark, [(1, 2500), (2, 1001), (3, 1000), (4, 999), (5, 12_000)])
    reg = registry(spark, [(i, str(i), 1) for i in range(1, 7)])
    quick = sequential_completeness(trips, reg, minimum=EXACT_MINIMUM - 1)
    assert quick.where(F.col("islocked") == GOOD).count() > 0
    both = {r["id"]: r["islocked"] for r in file_state(quick, trips).collect()}
    assert both == {r["id"]: r["islocked"] for r in file_state(reg, trips).collect()}


# Rates


def test_a_refresh_reads_new_sources_only(spark, tmp_path):
    base, cal = str(tmp_path / "base"), calendar(spark)
    refresh.load_files(spark, [put(tmp_path, "a.csv", "yellow_new", 5), put(tmp_path, "b.csv", "green_new", 3)], base, cal)
    assert refresh.refresh_rates(spark, base) == [1, 2]
    assert refresh.refresh_rates(spark, base) == []
    refresh.load_files(spark, [put(tmp_path, "c.csv", "yellow_new", 4, "2018-07-04")], base, cal)
    assert refresh.refresh_rates(spark, base) == [3]
    refresh.load_files(spark, [put(tmp_path, "a.csv", "yellow_new", 2, "2020-07-01")], base, cal)
    assert refresh.refresh_rates(spark, base) == [1]
    tables.drop_sources(spark, base, [2])
    assert refresh.refresh_rates(spark, base) == []
    want = sorted(map(tuple, build_rates(tables.read_trips(spark, base)).collect()))
    assert sorted(map(tuple, tables.read_rates(spark, base).collect())) == want and want


def test_a_zone_s_rates_lie_in_one_file(spark, tmp_path):
    from farescope.schemas import RATES

    base = str(tmp_path)
    many = spark.range(40_000).selectExpr(
        "cast(id % 250 AS int) AS zoneid", "cast(id / 250 % 12 AS int) AS target_month", "cast(id % 24 AS int) AS target_hour",
        "1 AS traffic", "1.0D AS rate", "0 AS isholiday", "0 AS isweekend", "0 AS iscovid",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_rates(many.select(*RATES.fieldNames()), base)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = tables.read_rates(spark, base).select("zoneid", "_metadata.file_name")
    files = {}
    for r in stored.distinct().collect():
        files.setdefault(r["zoneid"], set()).add(r["file_name"])
    assert all(len(f) == 1 for f in files.values()) and len(set.union(*files.values())) > 1


# Runs


def run(spark, tmp_path, index, **options):  # noqa: F811
    base = str(tmp_path / "base")
    known = spark.createDataFrame([("yellow", "2018-05-01"), ("green", "2014-01-01")], "provider string, first_month string")
    known = known.withColumn("first_month", F.to_date("first_month"))
    claims = refresh.run_refresh(
        spark, str(tmp_path / "in"), base, index, calendar(spark), known, "2018-07-01", 0.5, 2021, minimum=10, files_per_load=2, **options
    )
    return {r["filename"]: r["state"] for r in claims.collect()}


def test_the_run_finds_its_tasks_and_goes_on_after_a_break(spark, tmp_path, index, monkeypatch):  # noqa: F811
    folder, base = tmp_path / "in", str(tmp_path / "base")
    folder.mkdir()
    put(folder, "yellow_tripdata_2018-05.csv", "yellow_new", 11)
    put(folder, "yellow_tripdata_2018-06.csv", "yellow_new", 3)
    put(folder, "yellow_tripdata_2018-09.csv", "yellow_new", 11)  # later than the last month
    put(folder, "Yellow_tripdata_2018-07.csv", "yellow_new", 11)  # not exactly the name
    put(folder, "green_tripdata_2014-01.csv", "green_old", 13)
    put(folder, "green_tripdata_2018-05.csv", "green_new", 10)
    tables.write_registry(spark.createDataFrame([(7, "green_tripdata_2018-05.csv", None, GOOD)], FILE_REGISTRY), base)
    loads, load = [], refresh.load_files

    def breaks(spark, paths, *args):
        loads.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        if len(loads) == 2:
            raise RuntimeError("lost")
        return load(spark, paths, *args)

    monkeypatch.setattr(refresh, "load_files", breaks)
    with pytest.raises(RuntimeError):
        run(spark, tmp_path, index)
    put(folder, "yellow_tripdata_2018-07.csv", "yellow_new", 12)  # for the run after this one
    names = ["green_tripdata_2014-01.csv", "yellow_tripdata_2018-05.csv", "yellow_tripdata_2018-06.csv"]
    assert run(spark, tmp_path, index) == dict.fromkeys(names, "checked")
    assert loads == [names[:2], names[2:], names[2:]]
    states = {r["filename"]: r["islocked"] for r in tables.read_registry(spark, base).collect()}
    assert states == {names[0]: 2, names[1]: 2, names[2]: 0, "green_tripdata_2018-05.csv": 2}
    assert sum(count(spark, base).values()) == 11 + 3 + 13
    assert run(spark, tmp_path, index) == {n: "checked" for n in ("yellow_tripdata_2018-06.csv", "yellow_tripdata_2018-07.csv")}
    assert loads[3:] == [["yellow_tripdata_2018-06.csv", "yellow_tripdata_2018-07.csv"]]
    assert list_trip_files(spark, str(folder)).count() == 7

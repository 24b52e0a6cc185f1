from collections import Counter

import pytest
from pyspark.sql import functions as F

from farescope import expected_files, file_state, loadable_files, pending_files, quick_completeness, register_files
from farescope.operators.files import dense_ids, good_files, may_load, providers, top_sources, window_counts
from farescope.schemas import FILE_REGISTRY


def registry(spark, rows):
    return spark.createDataFrame([(i, name, None, state) for i, name, state in rows], FILE_REGISTRY)


def numbered(spark, counts):
    """Trips with dense ids: ``counts`` rows of each source, one after another."""
    rows, last = [], 0
    for source, n in counts:
        rows.append((source, last + 1, last + n))
        last += n
    return spark.createDataFrame(rows, "sourceid long, a long, b long").select(
        "sourceid", F.explode(F.sequence("a", "b")).alias("id")
    )


def test_expected_months(spark):
    names = [r.filename for r in expected_files(providers(spark), "2013-02-14").collect()]
    assert len(names) == len(set(names)) == 50 + 2
    assert {"yellow_tripdata_2009-01.csv", "yellow_tripdata_2013-02.csv", "green_tripdata_2013-01.csv"} <= set(names)
    assert expected_files(providers(spark), "2010-01-01").filter("provider = 'green'").count() == 0


def test_pending_and_loadable(spark):
    reg = registry(spark, [(1, "yellow_tripdata_2009-01.csv", 2), (2, "yellow_tripdata_2009-02.csv", 0), (3, "green_x", 2)])
    expected = expected_files(providers(spark), "2009-03-01")
    pending = pending_files(expected, reg)
    assert {r.filename for r in pending.collect()} == {"yellow_tripdata_2009-02.csv", "yellow_tripdata_2009-03.csv"}
    stored = spark.createDataFrame([("yellow_tripdata_2009-03.csv",), ("yellow_tripdata_2009-02.csv.bak",)], "filename string")
    assert [r.filename for r in loadable_files(pending, stored).collect()] == ["yellow_tripdata_2009-03.csv"]
    assert [r.filename for r in good_files(reg, "yellow").collect()] == ["yellow_tripdata_2009-01.csv"]
    assert {r.id for r in may_load(reg).collect()} == {2}


def test_registration_is_idempotent(spark):
    reg = registry(spark, [(7, "a.csv", 2)])
    names = spark.createDataFrame([("s3://x/A.csv",), ("dir/B.csv",), ("b.csv",), ("c.csv",)], "filename string")
    fresh = register_files(reg, names)
    assert {r.filename for r in fresh.collect()} == {"b.csv", "c.csv"}
    assert sorted(r.id for r in fresh.collect()) == [8, 9]
    assert register_files(reg.unionByName(fresh), names).count() == 0
    assert fresh.schema.fieldNames() == FILE_REGISTRY.fieldNames()


def test_dense_ids(spark):
    df = dense_ids(spark.range(1000).withColumnRenamed("id", "key"), "key", 10, buckets=7)
    ids = [r.id for r in df.collect()]
    assert sorted(ids) == list(range(11, 1011))


def test_exact_state_bounds(spark):
    trips = numbered(spark, [(1, 999), (2, 1000), (3, 1001), (5, 5)])
    reg = registry(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1), (4, "d", 1), (5, "e", 2), (6, "f", 0)])
    got = {r.id: r.islocked for r in file_state(reg, trips).collect()}
    assert got == {1: 0, 2: 2, 3: 2, 4: 0, 5: 2, 6: 0}


def windows(ids, last, width, unchecked):
    """(window, source) counts with both ends of a window inside it."""
    counts, k = Counter(), 0
    while last - k * width >= 0:
        low, high = last - (k + 1) * width, last - k * width
        for i, source in ids:
            if low <= i <= high and source in unchecked:
                counts[k, source] += 1
        k += 1
    return counts


def test_windows_share_their_ends(spark):
    trips = numbered(spark, [(1, 9), (2, 12), (1, 5), (3, 14), (2, 1)])
    reg = registry(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2)])
    ids = [(r.id, r.sourceid) for r in trips.collect()]
    got = {(r.bucket, r.sourceid): r.n for r in window_counts(trips, reg, 10).collect()}
    assert got == dict(windows(ids, 41, 10, {1, 2}))
    top = {r.bucket: (r.sourceid, r.n) for r in top_sources(window_counts(trips, reg, 10)).collect()}
    for k, pair in top.items():
        assert pair == min(((s, n) for (b, s), n in got.items() if b == k), key=lambda p: (-p[1], p[0]))


@pytest.mark.parametrize("top_only", [False, True])
def test_quick_then_exact_equals_exact(spark, top_only):
    trips = numbered(spark, [(1, 2500), (2, 1001), (3, 1000), (4, 999), (5, 12_000)])
    reg = registry(spark, [(i, str(i), 1) for i in range(1, 7)])
    quick = quick_completeness(trips, reg, top_only=top_only)
    marked = {r.id for r in quick.filter("islocked = 2").collect()}
    assert 5 in marked and not marked & {3, 4, 6}
    both = {r.id: r.islocked for r in file_state(quick, trips).collect()}
    assert both == {r.id: r.islocked for r in file_state(reg, trips).collect()}

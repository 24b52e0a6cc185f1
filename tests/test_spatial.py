"""Zone lookups against a plain edge-by-edge test written apart from the library."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farescope import add_named_area, geo_to_zone, geo_unmatched, index_zones, load_geometry, zone_of_point
from farescope.operators.spatial import join_zones
from farescope.schemas import TRIPS_GEO, TRIPS_ZONE

# A square with a square hole, a neighbour sharing a border, a two-part zone, a spiky zone
# with slanted edges, and a zone lying over the first.
SHAPES = {
    1: [[[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]]],
    2: [[[(4, 0), (8, 0), (8, 4), (4, 4)]]],
    3: [[[(0, 5), (1, 5), (1, 6), (0, 6)]], [[(2, 5), (3.5, 5), (3.5, 6.5), (2, 6.5)]]],
    4: [[[(5, 5), (9, 5.5), (7, 6), (9, 9), (6.5, 7), (5, 9), (6, 6.5)]]],
    5: [[[(2, 2.5), (5, 2.5), (5, 3.5), (2, 3.5)]]],
}


def close(ring):
    return [list(map(float, p)) for p in [*ring, ring[0]]]


def edges_of(parts):
    rings = [close(r) for part in parts for r in part]
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:])]


def inside(parts, x, y, include):
    odd = False
    for (x1, y1), (x2, y2) in edges_of(parts):
        cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return include
        if (y1 > y) != (y2 > y) and (cross > 0) == (y2 > y1):
            odd = not odd
    return odd


@pytest.fixture(scope="module")
def zones(spark):
    rows = [
        (
            i,
            f"zone {i}",
            json.dumps(
                {"type": "Polygon", "coordinates": [close(r) for r in parts[0]]}
                if len(parts) == 1
                else {"type": "MultiPolygon", "coordinates": [[close(r) for r in p] for p in parts]}
            ),
        )
        for i, parts in SHAPES.items()
    ]
    return load_geometry(spark.createDataFrame(rows, "zone_id int, zone string, geom string"), "geom")


def sample_points():
    rng = random.Random(7)
    points = [(rng.uniform(-1, 10), rng.uniform(-1, 10)) for _ in range(400)]
    # Grid points hit corners, borders, cell lines and the heights of vertices.
    points += [(i / 2, j / 2) for i in range(-1, 20) for j in range(-1, 20)]
    points += [(rng.uniform(-1, 10), j / 2) for j in range(-1, 20) for _ in range(6)]
    return [(i, x, y) for i, (x, y) in enumerate(points)]


@pytest.mark.parametrize("boundary", ["exclude", "include"])
@pytest.mark.parametrize("cell", [0.3, 0.5, 2.0, 50.0])
def test_against_edge_by_edge(spark, zones, boundary, cell):
    points = sample_points()
    df = spark.createDataFrame(points, "id long, x double, y double")
    index = index_zones(zones, cell, boundary)
    got = Counter(
        (r.id, r.z) for r in join_zones(df, index, "x", "y", "z", cell, boundary, small=True).collect()
    )
    want = Counter(
        (i, z) for i, x, y in points for z, parts in SHAPES.items() if inside(parts, x, y, boundary == "include")
    )
    assert got == want


def test_shuffled_join_equals_broadcast(spark, zones):
    """Also with cells that hold more rows than a task should take, and many points in no cell."""
    points = sample_points() + [(10_000 + i, 0.6, 0.7) for i in range(300)] + [(20_000 + i, None, 1.0) for i in range(50)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    index = index_zones(zones, 0.5)
    for how in ("inner", "left", "left_semi", "left_anti"):
        one, two = (
            Counter(map(tuple, join_zones(df, index, "x", "y", "z", 0.5, how=how, small=small, cell_rows=20).collect()))
            for small in (True, False)
        )
        assert one == two


@pytest.mark.parametrize("boundary", ["exclude", "include"])
@pytest.mark.parametrize("crowd", [3, 12, 1000])
def test_cells_of_several_sizes(spark, zones, boundary, crowd):
    points = sample_points()
    df = spark.createDataFrame(points, "id long, x double, y double")
    index = index_zones(zones, 8.0, boundary, crowd)
    levels = {r["level"] for r in index.select("level").distinct().collect()}
    assert (len(levels) > 2) == (crowd < 1000)
    want = Counter((i, z) for i, x, y in points for z, parts in SHAPES.items() if inside(parts, x, y, boundary == "include"))
    for small in (True, False):
        found = join_zones(df, index, "x", "y", "z", 8.0, boundary, small=small, cell_rows=50)
        assert Counter((r.id, r.z) for r in found.collect()) == want
    lost = join_zones(df, index, "x", "y", "z", 8.0, boundary, "left_anti", small=True)
    assert {r.id for r in lost.collect()} == {i for i, _, _ in points} - {i for i, _ in want}
    outer = join_zones(df, index, "x", "y", "z", 8.0, boundary, "left", small=True)
    assert {r.id for r in outer.where("z IS NULL").collect()} == {r.id for r in lost.collect()}


def test_a_map_of_many_uneven_zones_fits(spark):
    """A hundred thousand zones: small ones in one corner, large ones around them."""
    from farescope.operators.spatial import index_fits

    def squares(first, n, side, x, y):
        k = F.col("id")
        x0, y0 = x + (k % n) * side, y + F.floor(k / n) * side
        ring = [(x0, y0), (x0 + side, y0), (x0 + side, y0 + side), (x0, y0 + side), (x0, y0)]
        edges = F.array(*[F.struct(a[0].cast("double").alias("x1"), a[1].cast("double").alias("y1"), b[0].cast("double").alias("x2"), b[1].cast("double").alias("y2")) for a, b in zip(ring, ring[1:])])
        return spark.range(n * n).select((k + first).cast("int").alias("zone_id"), edges.alias("edges"))

    small, large = squares(0, 300, 1 / 64, F.lit(0.0), F.lit(0.0)), squares(90_000, 100, 4.0, F.lit(8.0), F.lit(8.0))
    path = spark.conf.get("spark.checkpoint.dir") + "/many"
    index_zones(small.unionByName(large), 8.0, crowd=64).write.mode("overwrite").parquet(path)
    index = spark.read.parquet(path)
    assert index_fits(index)
    points = spark.range(20_000).selectExpr(
        "id", "if(id % 2 = 0, (id * 7919 % 46800) / 10000D + 0.00003D, (id * 7919 % 399000) / 1000D + 8.0007D) AS x",
        "if(id % 2 = 0, (id * 104729 % 46800) / 10000D + 0.00003D, (id * 104729 % 399000) / 1000D + 8.0007D) AS y",
    )
    want = "if(x < 8, cast(floor(x * 64) + 300 * floor(y * 64) AS int), 90000 + cast(floor((x - 8) / 4) + 100 * floor((y - 8) / 4) AS int))"
    found = join_zones(points, index, "x", "y", "z", 8.0)
    assert found.count() == 20_000 and found.where(f"z <> {want}").count() == 0


def test_zone_or_default(spark, zones):
    points = [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 3.5, 3.0), (4, 4.0, 1.0), (5, 99.0, 99.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = dict(map(tuple, zone_of_point(df, index_zones(zones, 0.5), "id", "x", "y", 0.5).collect()))
    assert got == {1: 1, 2: -1, 3: 1, 4: -1, 5: -1}


def test_conversion_splits_trips(spark, zones):
    names = TRIPS_GEO.fieldNames()
    places = [(0.5, 0.5, 6.0, 1.0), (0.5, 0.5, 99.0, 1.0), (99.0, 0.5, 0.5, 0.5), (3.5, 3.0, 3.5, 3.0)]
    base = spark.createDataFrame(places, "px double, py double, dx double, dy double")
    filled = base.select(
        *[
            {
                "pickup_longitude": F.col("px"),
                "pickup_latitude": F.col("py"),
                "dropoff_longitude": F.col("dx"),
                "dropoff_latitude": F.col("dy"),
            }
            .get(n, F.lit(None))
            .cast(TRIPS_GEO[n].dataType)
            .alias(n)
            for n in names
        ]
    )
    index = index_zones(zones, 0.5)
    done = geo_to_zone(filled, index, 0.5)
    assert done.schema.fieldNames() == TRIPS_ZONE.fieldNames()
    # The last trip starts and ends where two zones overlap: one row per pair of zones.
    ends = Counter((r.PULocationID, r.DOLocationID) for r in done.collect())
    assert ends == Counter([(1, 2), (1, 1), (1, 5), (5, 1), (5, 5)])
    for small in (True, False):
        lost = geo_unmatched(filled, index, 0.5, small=small)
        assert lost.columns == names
        places = sorted((r.pickup_longitude, r.dropoff_longitude) for r in lost.collect())
        assert places == [(0.5, 99.0), (99.0, 0.5)]


def test_added_area(spark, zones):
    areas = zones.select(F.col("zone_id").alias("gid"), F.lit("B").alias("boroname"), "edges")
    out = add_named_area(areas, zones, "zone 2", {"boroname": "New Jersey"})
    row = out.filter("gid IS NULL").first()
    assert row.boroname == "New Jersey" and len(row.edges) == 4
    assert out.count() == areas.count() + 1


def test_absurd_coordinates_are_in_no_cell(spark):
    from farescope.operators.spatial import cell_of

    rows = spark.createDataFrame([(1e9,), (-1e9,), (float("nan"),), (None,), (0.5,)], "x double")
    assert [r[0] for r in rows.selectExpr(cell_of("x", 0.01) + " AS c").collect()] == [None] * 4 + [50]

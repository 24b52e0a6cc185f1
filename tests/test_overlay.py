import json
import random

import pytest
from pyspark.sql import functions as F

from farescope import crossing_map, load_geometry, overlap_map, polygon_area, reproject, zone_cells
from farescope.functions.projection import NEW_YORK_LONG_ISLAND_FEET, cone_constants
from farescope.sources.geometry import (
    edge_rows,
    edges_from_vertices,
    reproject_shapes,
    retype_segment,
    shapes_from_edges,
)
from test_spatial import close, edges_of, inside


def layer(spark, shapes, key="gid"):
    rows = [(i, json.dumps({"type": "Polygon", "coordinates": [close(r) for r in rings]})) for i, rings in shapes.items()]
    return load_geometry(spark.createDataFrame(rows, f"{key} int, geom string"), "geom")


def star(rng, x, y, n=9):
    import math

    return [
        (x + rng.uniform(0.3, 1.2) * math.cos(a), y + rng.uniform(0.3, 1.2) * math.sin(a))
        for a in (2 * math.pi * i / n for i in range(n))
    ]


RNG = random.Random(3)
AREAS = {i: [star(RNG, RNG.uniform(0, 3), RNG.uniform(0, 3))] for i in range(6)}
ZONES = {i: [star(RNG, RNG.uniform(0, 3), RNG.uniform(0, 3))] for i in range(5)}


def shares(spark, a, z, cell=0.4, least=None):
    df = overlap_map(layer(spark, a), layer(spark, z, "zone_id"), "gid", cell, least)
    return {(r.gid, r.zone_id): r.overlap for r in df.collect()}


def shoelace(rings):
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in edges_of([rings])) / 2


def test_overlap_against_sampling(spark):
    got = shares(spark, AREAS, ZONES)
    rng = random.Random(5)
    points = [(rng.uniform(-1.3, 4.3), rng.uniform(-1.3, 4.3)) for _ in range(20_000)]
    held = {("a", i): {p for p in points if inside([r], *p, False)} for i, r in AREAS.items()}
    held |= {("z", i): {p for p in points if inside([r], *p, False)} for i, r in ZONES.items()}
    box = 5.6**2 / len(points)
    for i in AREAS:
        for j in ZONES:
            sampled = len(held["a", i] & held["z", j]) * box / abs(shoelace(AREAS[i]))
            assert got.get((i, j), 0.0) == pytest.approx(sampled, abs=0.05)


def test_overlap_is_symmetric_and_whole_on_itself(spark):
    area = {r.gid: r.area for r in polygon_area(layer(spark, AREAS), "gid").collect()}
    zone_area = {r.zone_id: r.area for r in polygon_area(layer(spark, ZONES, "zone_id"), "zone_id").collect()}
    there, back = shares(spark, AREAS, ZONES), shares(spark, ZONES, AREAS, 0.7)
    assert {(j, i) for i, j in there} == set(back)
    for (i, j), share in there.items():
        assert share * area[i] == pytest.approx(back[j, i] * zone_area[j], abs=1e-9)
    itself = shares(spark, AREAS, AREAS, 0.9, least=0.999)
    assert set(itself) == {(i, i) for i in AREAS}


def test_overlap_with_hole_and_threshold(spark):
    zone = {1: [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]]}
    areas = {1: [[(0, 0), (2, 0), (2, 2), (0, 2)]], 2: [[(1, 1), (3, 1), (3, 3), (1, 3)]], 3: [[(4, 0), (5, 0), (5, 1), (4, 1)]]}
    assert shares(spark, areas, zone) == {(1, 1): pytest.approx(0.75)}
    assert shares(spark, areas, zone, least=0.75) == {}


def test_crossings(spark):
    zone = {1: [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]], 2: [[(4, 0), (8, 0), (6, 4)]]}
    lines = {
        1: ([(1.5, 1.5), (2.5, 2.5)], set()),  # in the hole
        2: ([(0.5, 0.5), (0.6, 0.5)], {1}),  # within
        3: ([(1.5, 2.0), (9.0, 2.0)], {1, 2}),  # out of the hole, across both
        4: ([(-1.0, 4.0), (-0.5, 5.0)], set()),
        5: ([(-1.0, 5.0), (0.0, 4.0), (-1.0, 3.0)], {1}),  # touches a corner
        6: ([(4.0, -1.0), (4.0, 0.0)], {1, 2}),  # ends on a shared corner
        7: ([(-3.0, -3.0), (12.0, -2.9)], set()),
        8: ([(-1.0, 0.0), (9.0, 0.0)], {1, 2}),  # runs along borders
        9: ([(2.0, 1.0), (2.0, 3.0)], {1}),  # spans the hole border to border
    }
    rows = [(i, json.dumps({"type": "LineString", "coordinates": pts})) for i, (pts, _) in lines.items()]
    streets = load_geometry(spark.createDataFrame(rows, "segmentid int, geom string"), "geom")
    for cell in (0.37, 1.0, 20.0):
        cells = zone_cells(layer(spark, zone, "zone_id"), cell)
        for small in (True, False):
            got = {tuple(r) for r in crossing_map(streets, cells, "segmentid", cell, small).collect()}
            assert got == {(i, z) for i, (_, hit) in lines.items() for z in hit}


def test_vertices_round_trip(spark):
    shapes = layer(spark, AREAS)
    rows = [
        (i, 0, n, float(x), float(y)) for i, rings in AREAS.items() for n, (x, y) in enumerate(close(rings[0]))
    ]
    vertices = spark.createDataFrame(rows, "gid int, ring int, seq int, x double, y double")
    edges = edges_from_vertices(vertices, ["gid", "ring"], "seq").drop("ring")
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, edge_rows(shapes, "gid").collect()))
    again = polygon_area(shapes_from_edges(edges, "gid"), "gid")
    assert {r.gid: round(r.area, 9) for r in again.collect()} == {
        i: round(abs(shoelace(r)), 9) for i, r in AREAS.items()
    }


def test_geometry_types(spark):
    rows = [
        ("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]], 3),
        ("LineString", [[0, 0], [1, 1]], 1),
        ("Point", [0, 0], None),
    ]
    df = spark.createDataFrame([(json.dumps({"type": t, "coordinates": c}), n) for t, c, n in rows], "geom string, n int")
    for r in load_geometry(df, "geom").collect():
        assert (None if r.edges is None else len(r.edges)) == r.n


def test_reprojection_inverts_the_forward_formula(spark):
    import math

    p, c = NEW_YORK_LONG_ISLAND_FEET, cone_constants(NEW_YORK_LONG_ISLAND_FEET)
    assert c["n"] == pytest.approx(0.6540820912, abs=1e-10)
    assert c["rho0"] == pytest.approx(7_462_536.301, abs=1e-3)

    def forward(lon, lat):
        phi, s = math.radians(lat), c["e"] * math.sin(math.radians(lat))
        t = math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (c["e"] / 2)
        rho, theta = p.semi_major * c["F"] * t ** c["n"], c["n"] * math.radians(lon - p.central_meridian)
        east, north = rho * math.sin(theta), c["rho0"] - rho * math.cos(theta)
        return east / p.unit_in_metres + p.false_easting, north / p.unit_in_metres

    places = [(-74.25, 40.5), (-73.7, 40.92), (-74.0, 40.7), (-73.98, 40.75)]
    df = spark.createDataFrame([(lon, lat, *forward(lon, lat)) for lon, lat in places], "lon double, lat double, x double, y double")
    for r in reproject(df).collect():
        assert (r.x, r.y) == (pytest.approx(r.lon, abs=1e-11), pytest.approx(r.lat, abs=1e-11))
    shapes = df.select(F.array(F.struct(F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))).alias("edges"), "lon", "lat")
    for r in reproject_shapes(shapes).collect():
        assert (r.edges[0].x2, r.edges[0].y2) == (pytest.approx(r.lon, abs=1e-11), pytest.approx(r.lat, abs=1e-11))


def test_retype(spark):
    df = spark.createDataFrame([("0042", "a"), ("x", "b"), (None, "c")], "segmentid string, street string")
    out = retype_segment(df)
    assert out.schema["segmentid"].dataType.simpleString() == "int"
    assert [r.segmentid for r in out.orderBy("street").collect()] == [42, None, None]

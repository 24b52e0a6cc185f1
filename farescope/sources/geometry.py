"""Map layers: GeoJSON text or vertex tables into shapes with edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farescope.functions import shapes as S
from farescope.functions.projection import (
    NEW_YORK_LONG_ISLAND_FEET,
    ConicProjection,
    lcc_to_lonlat,
)

_POINTS = "array<array<double>>"
_RINGS = f"array<{_POINTS}>"
_PARTS = f"array<{_RINGS}>"


def geojson_rings(column: str) -> Column:
    """Vertex lists of a (multi)polygon or (multi)line geometry; NULL for other types."""
    kind = f"get_json_object({column}, '$.type')"
    coordinates = f"get_json_object({column}, '$.coordinates')"
    return F.expr(
        f"CASE WHEN {kind} IN ('Polygon', 'MultiLineString') THEN from_json({coordinates}, '{_RINGS}')"
        f" WHEN {kind} = 'MultiPolygon' THEN flatten(from_json({coordinates}, '{_PARTS}'))"
        f" WHEN {kind} = 'LineString' THEN array(from_json({coordinates}, '{_POINTS}')) END"
    )


def load_geometry(df: DataFrame, geom_col: str, keep: list[str] | None = None) -> DataFrame:
    """Replace GeoJSON text by ``edges``; a shape stays one row and nothing is shuffled."""
    names = [c for c in df.columns if c != geom_col] if keep is None else keep
    rings = df.select(*names, geojson_rings(geom_col).alias("_rings"))
    return rings.selectExpr(*names, f"flatten(transform(_rings, r -> {S.ring_edges('r')})) AS edges")


def edge_rows(shapes: DataFrame, *keys: str) -> DataFrame:
    """One row per edge: (keys, x1, y1, x2, y2)."""
    return shapes.select(*keys, F.inline("edges"))


def edges_from_vertices(
    vertices: DataFrame, shape: list[str], order: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """Edge rows of a vertex table; ``shape`` names one ring (id, part, ring).

    Rings must repeat their first vertex at the end, as published layers do.
    """
    along = Window.partitionBy(*shape).orderBy(order)
    return vertices.select(
        *shape,
        F.col(x).alias("x1"),
        F.col(y).alias("y1"),
        F.lead(x).over(along).alias("x2"),
        F.lead(y).over(along).alias("y2"),
    ).filter("x2 IS NOT NULL")


def shapes_from_edges(edges: DataFrame, *keys: str) -> DataFrame:
    """Edge rows back to one row per shape. A shape is one record of its layer, as in the text form."""
    return edges.groupBy(*keys).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))


def reproject(
    vertices: DataFrame, x: str = "x", y: str = "y", params: ConicProjection = NEW_YORK_LONG_ISLAND_FEET
) -> DataFrame:
    """Replace projected coordinates by degrees (x is longitude, y latitude)."""
    lon, lat = lcc_to_lonlat(F.col(x), F.col(y), params)
    return vertices.withColumns({x: lon, y: lat})


def reproject_shapes(
    shapes: DataFrame, params: ConicProjection = NEW_YORK_LONG_ISLAND_FEET
) -> DataFrame:
    """The same for the edges of whole shapes."""

    def once(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def degrees(e: Column) -> Column:
        lon1, lat1 = lcc_to_lonlat(e.x1, e.y1, params, once)
        lon2, lat2 = lcc_to_lonlat(e.x2, e.y2, params, once)
        return F.struct(lon1.alias("x1"), lat1.alias("y1"), lon2.alias("x2"), lat2.alias("y2"))

    return shapes.withColumn("edges", F.transform("edges", degrees))


def retype_segment(layer: DataFrame, column: str = "segmentid") -> DataFrame:
    """A layer with its text segment id as an integer, NULL where it is not one."""
    return layer.withColumn(column, F.col(column).try_cast("int"))

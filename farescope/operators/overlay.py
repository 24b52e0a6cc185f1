"""Overlays of map layers: lines on zones, areas on zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope.functions import shapes as S
from farescope.operators.spatial import (
    DEFAULT_CELL,
    cell_box,
    cell_join,
    cell_of,
    cell_range,
)
from farescope.session import broadcast_if_small, fits_broadcast


def polygon_area(shapes: DataFrame, key: str) -> DataFrame:
    """(key, area) from the edges in each row, in the layer's own units."""
    return shapes.selectExpr(key, f"abs({S.signed_area('edges')}) AS area")


def crossing_map(
    lines: DataFrame,
    cells: DataFrame,
    key: str,
    cell: float = DEFAULT_CELL,
    small: bool | None = None,
) -> DataFrame:
    """(key, zone_id) for each line that meets a zone, its boundary included.

    ``cells`` comes from ``zone_cells``. Line edges are cut up by the cells they pass.
    In a cell wholly inside a zone the match is certain; elsewhere the edge must touch
    one of the zone's edges of that cell, or start inside the zone.
    """
    small = fits_broadcast(cells) if small is None else small
    # The stretch of an edge within a column of cells bounds the rows of cells to look at.
    from_x, to_x = "greatest(x0, least(e.x1, e.x2))", "least(x1, greatest(e.x1, e.x2))"
    ends = f"array(coalesce({S.y_at('e', from_x)}, e.y1), coalesce({S.y_at('e', to_x)}, e.y2))"
    x0, y0, x1, y1 = cell_box(cell)
    pieces = (
        lines.select(F.col(key).alias("_line"), F.inline("edges"))
        .selectExpr(
            "_line",
            "struct(x1, y1, x2, y2) AS e",
            f"{cell_range('least(x1, x2)', 'greatest(x1, x2)', cell)} AS cx",
        )
        .selectExpr("*", x0, x1)
        .selectExpr("*", f"{ends} AS ends")
        .selectExpr(
            "_line", "e", "cx", "x0", "x1",
            f"explode(sequence({cell_of('array_min(ends)', cell)} - 1, {cell_of('array_max(ends)', cell)} + 1)) AS cy",
        )
        .selectExpr("*", y0, y1)
        .where(S.edge_meets_box("e", "x0", "y0", "x1", "y1"))
        .selectExpr("_line", "e", "cx AS _cx", "cy AS _cy")
    )
    starts_here = f"_cx = {cell_of('e.x1', cell)} AND _cy = {cell_of('e.y1', cell)}"
    on = (
        "(whole"
        f" OR exists(edges, z -> {S.edges_touch('e', 'z')})"
        f" OR ({starts_here} AND {S.contains_point('edges', '_x', '_y', 'include')}))"
    )
    # The start point is named apart: inside the edge fold, ``e`` is the zone's edge.
    pieces = pieces.selectExpr("*", "e.x1 AS _x", "e.y1 AS _y")
    matched = cell_join(pieces, cells, [("_cx", "cx"), ("_cy", "cy")], on, "inner", small)
    return matched.select(F.col("_line").alias(key), "zone_id").distinct()


def _boxes(shapes: DataFrame, key: str, p: str, cell: float) -> DataFrame:
    """A row for each cell of a shape's bounding box: id, area and box, columns prefixed by ``p``."""
    return (
        shapes.where("size(edges) > 0")
        .selectExpr(f"{key} AS {p}id", f"abs({S.signed_area('edges')}) AS {p}area", *S.bounds("edges", p))
        .selectExpr("*", f"{cell_range(f'{p}xmin', f'{p}xmax', cell)} AS {p}cx")
        .selectExpr("*", f"{cell_range(f'{p}ymin', f'{p}ymax', cell)} AS {p}cy")
    )


def _strips(shapes: DataFrame, key: str, p: str, cell: float) -> DataFrame:
    """A row for each edge and each strip of x, one cell wide, that it passes. Upright edges bound no area."""
    return (
        shapes.select(F.col(key).alias(f"{p}id"), F.inline("edges"))
        .where("x1 <> x2")
        .selectExpr(
            f"{p}id", f"x1 AS {p}x1", f"y1 AS {p}y1", f"x2 AS {p}x2", f"y2 AS {p}y2",
            f"{cell_range('least(x1, x2)', 'greatest(x1, x2)', cell)} AS {p}strip",
        )
    )


def overlap_map(
    areas: DataFrame,
    zones: DataFrame,
    key: str,
    cell: float = DEFAULT_CELL,
    min_share: float | None = 0.5,
) -> DataFrame:
    """(key, zone_id, overlap): share of each area lying in a zone, above ``min_share``.

    Pairs whose bounding boxes meet are found through shared cells, each pair once: in the cell
    of the low corner of the common box. They are ids and boxes only. The edges of both sides,
    dealt to strips of x one cell wide, are then fetched by id and strip; within a strip two
    edges meet where their stretches of x do, and the common area is a signed sum over these,
    combined before the only shuffle that follows. Keys are unique, one of them may be NULL.
    ``min_share=None`` keeps every positive share.
    """
    a, z = _boxes(areas, key, "a_", cell), _boxes(zones, "zone_id", "z_", cell)
    low_x, low_y = "greatest(a_xmin, z_xmin)", "greatest(a_ymin, z_ymin)"
    high_x = "least(a_xmax, z_xmax)"
    on = (
        f"{low_x} < {high_x} AND {low_y} < least(a_ymax, z_ymax)"
        f" AND a_cx = {cell_of(low_x, cell)} AND a_cy = {cell_of(low_y, cell)}"
    )
    width = f"{float(cell)!r}D"
    pairs = (
        cell_join(a, z, [("a_cx", "z_cx"), ("a_cy", "z_cy")], on, "inner", fits_broadcast(z))
        .selectExpr(
            "a_id AS id", "z_id AS zone", "a_area AS area", f"{low_x} AS low", f"{high_x} AS high",
            f"{cell_range(low_x, high_x, cell)} AS strip",
        )
        .selectExpr(
            "id", "zone", "area", "strip",
            f"greatest(low, strip * {width}) AS lo", f"least(high, (strip + 1) * {width}) AS hi",
        )
        .where("lo < hi")
    )
    ours, theirs = _strips(areas, key, "p_", cell), broadcast_if_small(_strips(zones, "zone_id", "q_", cell))
    matches = (
        pairs.join(theirs, F.expr("zone <=> q_id AND strip = q_strip"))
        .join(ours, F.expr("id <=> p_id AND strip = p_strip"))
        .selectExpr(
            "id", "zone", "area", "struct(p_x1 AS x1, p_y1 AS y1, p_x2 AS x2, p_y2 AS y2) AS p",
            "struct(q_x1 AS x1, q_y1 AS y1, q_x2 AS x2, q_y2 AS y2) AS q",
            "greatest(lo, least(p_x1, p_x2), least(q_x1, q_x2)) AS l",
            "least(hi, greatest(p_x1, p_x2), greatest(q_x1, q_x2)) AS r",
        )
        .where("l < r")
        .selectExpr(
            "id", "zone", "area", "r - l AS width", "signum(p.x1 - p.x2) * signum(q.x1 - q.x2) AS sign",
            f"{S.y_at('p', 'l')} AS f0", f"{S.y_at('p', 'r')} AS f1",
            f"{S.y_at('q', 'l')} AS g0", f"{S.y_at('q', 'r')} AS g1",
        )
    )
    common = F.expr(f"abs(sum(sign * {S.area_below_both('f0', 'f1', 'g0', 'g1', 'width')}))")
    shares = (
        matches.groupBy("id", "zone")
        .agg(common.alias("common"), F.first("area").alias("area"))
        .selectExpr(f"id AS {key}", "zone AS zone_id", "try_divide(common, area) AS overlap")
    )
    return shares.where(F.col("overlap") > (1e-12 if min_share is None else min_share))

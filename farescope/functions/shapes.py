"""Planar geometry as SQL expressions over edge structs (x1, y1, x2, y2).

A polygon is the array of the edges of all its rings, holes and parts alike; inside is
decided by parity. A line is the array of its segments. Functions take and return SQL
text, to be given to ``F.expr`` or ``selectExpr``: one long expression is then parsed
once instead of being assembled call by call.
"""

from __future__ import annotations

BOUNDARIES = ("exclude", "include")

_ON_EDGE = 1 << 20  # added per edge the point lies on; far above any crossing count


def side(e: str, x: str, y: str) -> str:
    """Twice the signed area of the edge and (x, y): zero on the edge's line, else which side."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def in_box(e: str, x: str, y: str) -> str:
    """Whether (x, y) is in the edge's bounding box, borders included."""
    return (
        f"({x} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2)"
        f" AND {y} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2))"
    )


def contains_point(edges: str, x: str, y: str, boundary: str = "exclude") -> str:
    """Whether (x, y) is inside; points on an edge count only with ``boundary="include"``.

    Counts the edges that a ray to the right crosses; an edge crosses when it spans y
    half-open and has the point on its left.
    """
    if boundary not in BOUNDARIES:
        raise ValueError(f"boundary must be one of {BOUNDARIES}, not {boundary!r}")
    s = side("e", x, y)
    score = (
        f"aggregate({edges}, 0, (acc, e) -> acc + CASE"
        f" WHEN {s} = 0 AND {in_box('e', x, y)} THEN {_ON_EDGE}"
        f" WHEN (e.y1 > {y}) <> (e.y2 > {y}) AND ({s} > 0) = (e.y2 > e.y1) THEN 1"
        " ELSE 0 END)"
    )
    if boundary == "include":
        return f"({score} >= {_ON_EDGE} OR {score} % 2 = 1)"
    return f"({score} < {_ON_EDGE} AND {score} % 2 = 1)"


def edges_touch(a: str, b: str) -> str:
    """Whether two closed segments share a point."""
    b1, b2 = side(a, f"{b}.x1", f"{b}.y1"), side(a, f"{b}.x2", f"{b}.y2")
    a1, a2 = side(b, f"{a}.x1", f"{a}.y1"), side(b, f"{a}.x2", f"{a}.y2")
    return (
        f"((signum({b1}) * signum({b2}) < 0 AND signum({a1}) * signum({a2}) < 0)"
        f" OR ({b1} = 0 AND {in_box(a, f'{b}.x1', f'{b}.y1')})"
        f" OR ({b2} = 0 AND {in_box(a, f'{b}.x2', f'{b}.y2')})"
        f" OR ({a1} = 0 AND {in_box(b, f'{a}.x1', f'{a}.y1')})"
        f" OR ({a2} = 0 AND {in_box(b, f'{a}.x2', f'{a}.y2')}))"
    )


def edge_meets_box(e: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """Whether a segment meets a closed axis-parallel box."""
    corners = ", ".join(side(e, x, y) for x in (x0, x1) for y in (y0, y1))
    return (
        f"(least({e}.x1, {e}.x2) <= {x1} AND greatest({e}.x1, {e}.x2) >= {x0}"
        f" AND least({e}.y1, {e}.y2) <= {y1} AND greatest({e}.y1, {e}.y2) >= {y0}"
        f" AND least({corners}) <= 0 AND greatest({corners}) >= 0)"
    )


def bounds(edges: str, prefix: str = "") -> list[str]:
    """Bounding box of an edge array, as xmin, xmax, ymin, ymax."""
    return [
        f"array_{low}(transform({edges}, e -> {pick}(e.{a}1, e.{a}2))) AS {prefix}{a}{low}"
        for a in ("x", "y")
        for low, pick in (("min", "least"), ("max", "greatest"))
    ]


def signed_area(edges: str) -> str:
    """Half the sum of cross products over the edges."""
    return f"(aggregate({edges}, 0D, (acc, e) -> acc + (e.x1 * e.y2 - e.x2 * e.y1)) / 2D)"


def x_at(e: str, y: str) -> str:
    """Where an edge that is not horizontal passes the height y."""
    return f"({e}.x1 + ({e}.x2 - {e}.x1) * (({y} - {e}.y1) / nullif({e}.y2 - {e}.y1, 0D)))"


def y_at(e: str, x: str) -> str:
    """Height of an edge that is not vertical at x."""
    return f"({e}.y1 + ({e}.y2 - {e}.y1) * (({x} - {e}.x1) / nullif({e}.x2 - {e}.x1, 0D)))"


def ring_edges(ring: str) -> str:
    """Edges of a vertex list [[x, y], ...] in order; a closed ring repeats its first vertex."""
    return (
        f"transform(sequence(1, size({ring}) - 1), i -> named_struct("
        f"'x1', {ring}[i - 1][0], 'y1', {ring}[i - 1][1], 'x2', {ring}[i][0], 'y2', {ring}[i][1]))"
    )


def area_below_both(f0: str, f1: str, g0: str, g1: str, width: str) -> str:
    """Integral over ``width`` of the lower of two lines, given by their end heights.

    The chord of the lower ends, plus the triangle above it when the lines cross. Summed
    with signs over the edge pairs of two polygons it gives their common area.
    """
    d0, d1 = f"({f0} - {g0})", f"({f1} - {g1})"
    chord = f"(least({f0}, {g0}) + least({f1}, {g1})) / 2D * {width}"
    triangle = f"abs({d0} * {d1}) / nullif(abs({d0}) + abs({d1}), 0D) / 2D * {width}"
    return f"(CASE WHEN {d0} * {d1} < 0 THEN {chord} + {triangle} ELSE {chord} END)"

"""Points into zones: a grid of cells makes the spatial join an equi-join.

``zone_cells`` cuts every zone into grid cells. A cell lying wholly inside its zone
needs no test; a cell on the zone's border keeps the few edges that matter there.
``point_index`` cuts border cells further into bands between vertex heights. In a band
edges neither start, end nor cross, so the zone's part of it is a list of pieces with
one edge on the left and one on the right, and two side tests in generated code decide
a point. A vertex height itself becomes a list of intervals of x.

A point has one cell, so nothing is compared with every zone, and the point side is
never shuffled while the index fits a broadcast.

Where zones differ much in size, one cell size is too fine for some and too coarse for
others. With ``crowd``, cells that hold more edges than that are split in four, over and
over; the index then has cells of several sizes, and names those that were split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope import schemas
from farescope.functions import shapes as S
from farescope.session import broadcast_if_small, evaluate_once, fits_broadcast, shared_dir

DEFAULT_CELL = 0.005  # degrees; about a quarter of a city zone
# Rows of one cell beyond which they are spread over several tasks, where the index isn't broadcast.
CELL_ROWS = 500_000
# How often a cell may be split, and the factor that makes room for the level in a cell's number.
LEVELS = 7
_LEVEL_ROOM = 8
_MARGIN = 1e-9  # of a cell: keeps rounding at cell borders on the safe side

# How an index row decides a point: always, between two edges, or on a vertex height; or that the
# cell was split, so that smaller ones decide.
_WHOLE, _BAND, _LEVEL, _SPLIT = 0, 1, 2, 3


def cell_of(value: str, cell: float) -> str:
    """Cell number of a coordinate. Two 32-bit numbers join as one 64-bit hash key.

    A coordinate that is no number, or too large for a cell, is in no cell.
    """
    return f"try_cast(floor(nullif({value}, double('NaN')) / {float(cell)!r}D) AS INT)"


def cell_range(low: str, high: str, cell: float) -> str:
    return f"explode(sequence({cell_of(low, cell)}, {cell_of(high, cell)}))"


def cell_box(cell: float) -> list[str]:
    """The box of cell (cx, cy), a little enlarged, as x0, y0, x1, y1."""
    cell = float(cell)
    pad = cell * _MARGIN
    return [
        f"(cx * {cell!r}D - {pad!r}D) AS x0",
        f"(cy * {cell!r}D - {pad!r}D) AS y0",
        f"((cx + 1) * {cell!r}D + {pad!r}D) AS x1",
        f"((cy + 1) * {cell!r}D + {pad!r}D) AS y1",
    ]


def zone_cells(zones: DataFrame, cell: float = DEFAULT_CELL) -> DataFrame:
    """(cx, cy, zone_id, whole, edges): the cells each zone touches.

    ``edges`` keeps those a ray from the cell to the right can meet, which is also
    every edge through the cell. Nothing is grouped: a zone's cells and edges all
    derive from its own row.
    """
    border = f"exists(edges, e -> {S.edge_meets_box('e', 'x0', 'y0', 'x1', 'y1')})"
    centre = S.contains_point("edges", "(x0 + x1) / 2D", "(y0 + y1) / 2D")
    x0, y0, x1, y1 = cell_box(cell)
    rows = (
        zones.where("size(edges) > 0")
        .selectExpr("zone_id", "edges", *S.bounds("edges"))
        .selectExpr("zone_id", "edges", "xmin", "xmax", f"{cell_range('ymin', 'ymax', cell)} AS cy")
        .selectExpr("*", y0, y1)
        .selectExpr(
            "zone_id", "xmin", "xmax", "cy", "y0", "y1",
            "filter(edges, e -> least(e.y1, e.y2) <= y1 AND greatest(e.y1, e.y2) >= y0) AS edges",
        )
    )
    cells = rows.selectExpr(
        "zone_id", "edges", "cy", "y0", "y1", f"{cell_range('xmin', 'xmax', cell)} AS cx"
    ).selectExpr("*", x0, x1)
    right = "filter(edges, e -> greatest(e.x1, e.x2) >= x0) AS edges"
    boxed = evaluate_once(cells, "zone_id", "cx", "cy", "x0", "y0", "x1", "y1", right)
    tested = evaluate_once(
        boxed, "cx", "cy", "zone_id", f"{border} AS border", f"{centre} AS centre", "edges"
    )
    return tested.where("border OR centre").selectExpr(
        "cx", "cy", "zone_id", "NOT border AS whole", "if(border, edges, slice(edges, 1, 0)) AS edges"
    )


def _piece(kind: int, left: tuple, right: tuple, spans: str) -> str:
    names = ("lx", "ly", "ldx", "ldy", "rx", "ry", "rdx", "rdy")
    fields = ", ".join(f"'{n}', {v}" for n, v in zip(names, left + right))
    return f"named_struct('kind', {kind}, {fields}, 'spans', {spans})"


def point_index(cells: DataFrame, cell: float = DEFAULT_CELL, boundary: str = "exclude") -> DataFrame:
    """Index rows of plain numbers that decide points; see the module's description.

    (cx, cy, zone_id, kind, low, high, lx, ly, ldx, ldy, rx, ry, rdx, rdy, spans): the
    left and the right edge as a point and an upward direction, and for vertex heights
    the spans of x in the zone: open intervals, and single values with equal ends.
    ``boundary`` tells whether points on a zone's border are in it.
    """
    # Heights of the vertices in the cell, and the bands between them (low < high).
    heights = (
        "array_sort(array_distinct(filter(flatten(transform(edges, e -> array(e.y1, e.y2))),"
        " y -> y > y0 AND y < y1)))"
    )
    bands = (
        "if(whole, array(named_struct('low', y0, 'high', y1)), concat("
        "transform(sequence(1, size(cuts) - 1), i -> named_struct('low', cuts[i - 1], 'high', cuts[i])),"
        " transform(slice(cuts, 2, size(cuts) - 2), y -> named_struct('low', y, 'high', y))))"
    )
    # Edges through a band, by where they pass its middle. Edges left of the cell were
    # dropped with the cell: an odd number means that the zone goes on to the left.
    across = (
        "transform(array_sort(transform(filter(edges, e -> low < high AND least(e.y1, e.y2) <= low"
        f" AND greatest(e.y1, e.y2) >= high), e -> struct({S.x_at('e', '(low + high) / 2D')} AS at, e AS e))),"
        " p -> p.e)"
    )
    outside = "named_struct('x1', 2D * x0 - x1, 'y1', low, 'x2', 2D * x0 - x1, 'y2', high)"
    # Where edges meet a vertex height, within the cell.
    stops = (
        "array_sort(array_distinct(filter(flatten(transform(filter(edges, e -> low = high"
        " AND low BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)), e -> CASE"
        " WHEN e.y1 = low AND e.y2 = low THEN array(e.x1, e.x2)"
        " WHEN e.y1 = low THEN array(e.x1) WHEN e.y2 = low THEN array(e.x2)"
        f" ELSE array({S.x_at('e', 'low')}) END)), x -> x > x0 AND x < x1)))"
    )

    def upward(e: str) -> tuple[str, str, str, str]:
        turn = f"signum({e}.y2 - {e}.y1)"
        return f"{e}.x1", f"{e}.y1", f"({e}.x2 - {e}.x1) * {turn}", f"({e}.y2 - {e}.y1) * {turn}"

    none, no_spans = ("0D",) * 4, "slice(array(named_struct('lo', 0D, 'hi', 0D)), 1, 0)"
    band_pieces = (
        "transform(sequence(1, greatest(size(across) - 1, 1), 2), i ->"
        f" {_piece(_BAND, upward('across[i - 1]'), upward('across[i]'), no_spans)})"
    )
    gaps = (
        "filter(transform(sequence(1, size(stops) - 1), i ->"
        " named_struct('lo', stops[i - 1], 'hi', stops[i])), s -> "
        f"{S.contains_point('edges', '((s.lo + s.hi) / 2D)', 'low', boundary)})"
    )
    spots = (
        "transform(filter(slice(stops, 2, size(stops) - 2), x ->"
        f" {S.contains_point('edges', 'x', 'low', boundary)}), x -> named_struct('lo', x, 'hi', x))"
    )
    head = ("cx", "cy", "zone_id", "whole", "edges", "x0", "x1")
    boxed = cells.selectExpr("cx", "cy", "zone_id", "whole", "edges", *cell_box(cell))
    cut = evaluate_once(boxed, *head, "y0", "y1", f"concat(array(y0), {heights}, array(y1)) AS cuts")
    banded = cut.selectExpr(*head, f"inline({bands})")
    crossed = evaluate_once(
        banded, *head, "low", "high", f"{across} AS across", f"concat(array(x0), {stops}, array(x1)) AS stops"
    )
    paired = evaluate_once(
        crossed, *head, "low", "high", "stops",
        f"if(size(across) % 2 = 1, concat(array({outside}), across), across) AS across",
    )
    pieces = (
        f"CASE WHEN whole THEN array({_piece(_WHOLE, none, none, no_spans)})"
        f" WHEN low = high THEN array({_piece(_LEVEL, none, none, f'concat({gaps}, {spots})')})"
        f" WHEN size(across) > 1 THEN {band_pieces} END"
    )
    return (
        paired.selectExpr("cx", "cy", "zone_id", "low", "high", "x0", "x1", f"inline({pieces})")
        # A band piece that ends left of the cell, or starts right of it, decides nothing there.
        .where(f"kind <> {_LEVEL} OR size(spans) > 0")
        .where(
            f"kind <> {_BAND} OR (least(lx + ldx * ((low - ly) / ldy), lx + ldx * ((high - ly) / ldy)) <= x1"
            " AND greatest(rx + rdx * ((low - ry) / rdy), rx + rdx * ((high - ry) / rdy)) >= x0)"
        )
        .drop("x0", "x1")
    )


def _split_cells(cells: DataFrame, cell: float) -> DataFrame:
    """``zone_cells`` rows cut into four cells each, of size ``cell``.

    The edges of a row are all that matter to the right of it, so they are enough for its parts.
    """
    x0, y0, x1, y1 = cell_box(cell)
    parts = ", ".join(f"named_struct('cx', 2 * cx + {i}, 'cy', 2 * cy + {j})" for i in (0, 1) for j in (0, 1))
    boxed = cells.selectExpr("zone_id", "whole", "edges", f"inline(array({parts}))").selectExpr("*", x0, y0, x1, y1)
    near = "filter(edges, e -> least(e.y1, e.y2) <= y1 AND greatest(e.y1, e.y2) >= y0 AND greatest(e.x1, e.x2) >= x0) AS edges"
    cut = evaluate_once(boxed, "zone_id", "whole", "cx", "cy", "x0", "y0", "x1", "y1", near)
    border = f"exists(edges, e -> {S.edge_meets_box('e', 'x0', 'y0', 'x1', 'y1')})"
    centre = S.contains_point("edges", "(x0 + x1) / 2D", "(y0 + y1) / 2D")
    tested = evaluate_once(
        cut, "cx", "cy", "zone_id", f"NOT whole AND {border} AS border", f"whole OR {centre} AS within", "edges"
    )
    return tested.where("border OR within").selectExpr(
        "cx", "cy", "zone_id", "NOT border AS whole", "if(border, edges, slice(edges, 1, 0)) AS edges"
    )


def _kept(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(index: DataFrame, level: int) -> DataFrame:
    return index.withColumn("cx", F.col("cx") * _LEVEL_ROOM + level).withColumn("level", F.lit(level))


def index_zones(
    zones: DataFrame, cell: float = DEFAULT_CELL, boundary: str = "exclude", crowd: int | None = None
) -> DataFrame:
    """The point index of a zone layer. Write it to a table where it is used more than once.

    With ``crowd``, cells that hold more edges than that, of all zones, are split up to LEVELS
    times; ``cell`` is then the size of the largest ones.
    """
    cells = zone_cells(zones, cell)
    if crowd is None:
        return point_index(cells, cell, boundary)
    index = None
    for level in range(LEVELS + 1):
        size = cell / 2**level
        cells = _kept(cells)
        held = cells.groupBy("cx", "cy").agg(F.sum(F.size("edges")).alias("_held"))
        crowded = held.where(F.col("_held") > (crowd if level < LEVELS else 1 << 62)).select("cx", "cy")
        crowded = broadcast_if_small(_kept(crowded))
        done = point_index(cells.join(crowded, ["cx", "cy"], "left_anti"), size, boundary)
        split = crowded.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in done.schema if f.name not in ("cx", "cy", "kind")}
        ).withColumn("kind", F.lit(_SPLIT))
        one = _numbered(done.unionByName(split), level)
        index = one if index is None else index.unionByName(one)
        cells = cells.join(crowded, ["cx", "cy"], "left_semi")
        if cells.isEmpty():
            break
        cells = _split_cells(cells, size / 2)
    return index


def index_fits(index: DataFrame) -> bool:
    """Whether a stored index may be broadcast."""
    return fits_broadcast(index)


def _decides(p: str, x: str, y: str, boundary: str) -> str:
    """Whether an index row (columns prefixed by ``p``) holds the point (x, y).

    The fold over ``spans`` is reached only at the height of a vertex. It also keeps
    Spark from fusing the join into the generated stage that made the point, which would
    outgrow the size up to which the JVM compiles a method.
    """
    left = f"{p}ldx * ({y} - {p}ly) - ({x} - {p}lx) * {p}ldy"
    right = f"{p}rdx * ({y} - {p}ry) - ({x} - {p}rx) * {p}rdy"
    touch = "=" if boundary == "include" else ""
    in_span = f"({x} > s.lo AND {x} < s.hi) OR ({x} = s.lo AND {x} = s.hi)"
    return (
        f"({p}kind = {_WHOLE}"
        f" OR ({p}kind = {_BAND} AND {y} > {p}low AND {y} < {p}high"
        f" AND {left} <{touch} 0D AND {right} >{touch} 0D)"
        f" OR ({p}kind = {_LEVEL} AND {y} = {p}low AND exists({p}spans, s -> {in_span})))"
    )


def cell_join(
    left: DataFrame,
    index: DataFrame,
    keys: list[tuple[str, str]],
    on: str,
    how: str,
    small: bool,
    cell_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` to a cell index: ``keys`` (expressions and index columns) equal, and ``on``.

    A small index is broadcast. A large one is shuffled together with ``left``. Then the rows of
    each cell are counted first, and a cell with more than ``cell_rows`` of them is spread over as
    many copies as it takes, so that a crowded cell is not one task's work. What spreads them
    hashes the row and its input partition: many copies of one row are spread too, and a task
    that is run again sends its rows the same way, in whatever order they come.
    """
    if small:
        same = " AND ".join(f"{x} = {c}" for x, c in keys)
        return left.join(F.broadcast(index), F.expr(f"{same} AND {on}"), how)
    cell_rows = CELL_ROWS if cell_rows is None else cell_rows
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = left.withColumns({n: F.expr(x) for n, (x, _) in zip(names, keys, strict=True)})
    count = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_rows)
    copies = F.ceil(F.col("_n") / cell_rows).cast("int").alias("_copies")
    # A row for each crowded cell: fewer than the rows that a task takes.
    crowded = broadcast_if_small(_kept(count.na.drop().select(*[F.col(n).alias(f"{n}_") for n in names], copies)))
    mixed = F.xxhash64(*left.columns, F.spark_partition_id())
    ours = " AND ".join(f"{n} = {n}_" for n in names)
    salt = F.when(F.col(names[0]).isNull() | F.col(names[1]).isNull(), F.pmod(mixed, F.lit(1 << 10)))
    salted = keyed.join(crowded, F.expr(ours), "left").withColumn(
        "_salt", salt.otherwise(F.pmod(mixed, F.coalesce("_copies", F.lit(1)))).cast("int")
    )
    salted = salted.drop("_copies", *[f"{n}_" for n in names])
    theirs = " AND ".join(f"{c} = {n}_" for n, (_, c) in zip(names, keys, strict=True))
    spread = index.join(crowded, F.expr(theirs), "left").drop(*[f"{n}_" for n in names])
    spread = spread.selectExpr("*", "explode(sequence(0, coalesce(_copies, 1) - 1)) AS _copy").drop("_copies")
    same = " AND ".join(f"{n} = {c}" for n, (_, c) in zip(names, keys, strict=True))
    return salted.join(spread, F.expr(f"_salt = _copy AND {same} AND {on}"), how).drop("_salt", "_copy", *names)


def _with_levels(points: DataFrame, index: DataFrame, x: str, y: str, cell: float, p: str) -> tuple[DataFrame, str]:
    """Points with the level of the cell that decides them, as a column, and its name.

    A cell is split only if the one around it is, so the level is the number of splits that a
    point's cells have: one join with the split cells of each level.
    """
    split = index.where(f"kind = {_SPLIT}").select("level", "cx", "cy")
    deepest = split.agg(F.max("level")).first()[0]
    name, flags = f"{p}level", []
    for level in range(0 if deepest is None else deepest + 1):
        flag = f"{p}split{level}"
        names = [f"{flag}x", f"{flag}y"]
        side = split.where(F.col("level") == level).select(F.col("cx").alias(names[0]), F.col("cy").alias(names[1]))
        size = cell / 2**level
        on = f"{_level_cell(x, f'{size!r}D', str(level))} = {names[0]} AND {cell_of(y, size)} = {names[1]}"
        points = points.join(broadcast_if_small(side), F.expr(on), "left")
        points = points.withColumn(flag, F.col(names[0]).isNotNull().cast("int")).drop(*names)
        flags.append(flag)
    level = " + ".join(flags) or "0"
    return points.withColumn(name, F.expr(level)).drop(*flags), name


def _level_cell(value: str, size: str, level: str) -> str:
    """Number of a cell of a level along x, as ``_numbered`` writes it."""
    return f"try_cast(floor(nullif({value}, double('NaN')) / {size}) * {_LEVEL_ROOM} + {level} AS INT)"


def join_zones(
    points: DataFrame,
    index: DataFrame,
    x: str,
    y: str,
    zone: str,
    cell: float = DEFAULT_CELL,
    boundary: str = "exclude",
    how: str = "inner",
    small: bool | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Add column ``zone`` with the zone holding (x, y): one row per zone that does.

    ``index`` comes from ``index_zones`` with the same cell size and boundary. ``how`` is
    any of inner, left, left_semi, left_anti (the last two add no column). A point on an
    edge that two parts of one zone share can match it twice with ``"include"``.
    """
    small = index_fits(index) if small is None else small
    p, columns = f"_{zone}_", points.columns
    if "level" in index.columns:
        points, level = _with_levels(points, index, x, y, cell, p)
        size = f"({float(cell)!r}D / pow(2, {level}))"
        keys = [
            (_level_cell(x, size, level), f"{p}cx"),
            (f"try_cast(floor(nullif({y}, double('NaN')) / {size}) AS INT)", f"{p}cy"),
        ]
        index = index.where(f"kind <> {_SPLIT}").drop("level")
    else:
        keys = [(cell_of(x, cell), f"{p}cx"), (cell_of(y, cell), f"{p}cy")]
    side = index.toDF(*[p + c for c in index.columns])
    joined = cell_join(points, side, keys, _decides(p, x, y, boundary), how, small, cell_rows)
    if how in ("left_semi", "left_anti"):
        return joined.select(*columns)
    return joined.select(*columns, F.col(f"{p}zone_id").alias(zone))


def geo_to_zone(
    trips: DataFrame,
    index: DataFrame,
    cell: float = DEFAULT_CELL,
    boundary: str = "exclude",
    small: bool | None = None,
) -> DataFrame:
    """Coordinate trips with both ends in a zone, as zone trips."""
    small = index_fits(index) if small is None else small
    for point, zone in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        trips = join_zones(
            trips, index, f"{point}_longitude", f"{point}_latitude", zone, cell, boundary, "inner", small
        )
    wanted = schemas.TRIPS_ZONE if "isholiday" in trips.columns else schemas.CLEAN_ZONE
    carried = [c for c in trips.columns if c == "sourceid" and c not in wanted.fieldNames()]
    return trips.select(*wanted.fieldNames(), *carried)


def zones_of_trips(
    trips: DataFrame,
    index: DataFrame,
    cell: float = DEFAULT_CELL,
    boundary: str = "exclude",
    small: bool | None = None,
) -> DataFrame:
    """Coordinate trips with PULocationID and DOLocationID, NULL where an end is off the map."""
    small = index_fits(index) if small is None else small
    for point, zone in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        trips = join_zones(
            trips, index, f"{point}_longitude", f"{point}_latitude", zone, cell, boundary, "left", small
        )
    return trips


def geo_unmatched(
    trips: DataFrame,
    index: DataFrame,
    cell: float = DEFAULT_CELL,
    boundary: str = "exclude",
    small: bool | None = None,
) -> DataFrame:
    """Coordinate trips with an end off the map, once each: the rest of ``geo_to_zone``.

    One scan with two existence joins while the index is small; beyond that, salted anti
    and semi joins.
    """
    small = index_fits(index) if small is None else small
    if small and "level" not in index.columns:
        missing = [
            f"NOT EXISTS (SELECT * FROM {{index}} AS i WHERE"
            f" i.cx = {cell_of(f't.{end}_longitude', cell)} AND i.cy = {cell_of(f't.{end}_latitude', cell)}"
            f" AND {_decides('i.', f't.{end}_longitude', f't.{end}_latitude', boundary)})"
            for end in ("pickup", "dropoff")
        ]
        return trips.sparkSession.sql(
            f"SELECT t.* FROM {{trips}} AS t WHERE {' OR '.join(missing)}",
            trips=trips,
            index=F.broadcast(index),
        )

    def probe(df: DataFrame, point: str, how: str) -> DataFrame:
        return join_zones(
            df, index, f"{point}_longitude", f"{point}_latitude", "z", cell, boundary, how, small
        )

    no_pickup = probe(trips, "pickup", "left_anti")
    no_dropoff = probe(probe(trips, "pickup", "left_semi"), "dropoff", "left_anti")
    return no_pickup.unionByName(no_dropoff)


def zone_of_point(
    points: DataFrame,
    index: DataFrame,
    key: str,
    x: str,
    y: str,
    cell: float = DEFAULT_CELL,
    boundary: str = "exclude",
    small: bool | None = None,
) -> DataFrame:
    """(key, zone_id): the zone of each point, the lowest id if several, -1 if none."""
    located = join_zones(points, index, x, y, "_zone", cell, boundary, "left", small)
    return located.groupBy(key).agg(F.coalesce(F.min("_zone"), F.lit(-1)).alias("zone_id"))


def add_named_area(
    areas: DataFrame, zones: DataFrame, zone_name: str, attributes: dict[str, str]
) -> DataFrame:
    """Add the shape of a named zone to another layer, under the given attributes."""
    shape = zones.filter(F.col("zone") == zone_name).select(
        *[F.lit(v).alias(k) for k, v in attributes.items()], "edges"
    )
    return areas.unionByName(shape, allowMissingColumns=True)

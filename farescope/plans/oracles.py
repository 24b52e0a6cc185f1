"""The same queries as DuckDB SQL over the benchmark tables.

They take the direct route (flat edge tables, six unions, rounding of unsimplified
quotients) so that agreement says something about the Spark plans.
"""

from __future__ import annotations

from farescope import bridge as B
from farescope.plans import registry as R


def _r2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,12)), 2) as double)"


def _ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts)


def _place(x: str) -> str:
    return f"cast(({x}) % 5200 as double) / 1000e0 + 0.0005e0"


RAW = f"""raw0 AS (
  SELECT l_shipdate + INTERVAL 20 YEAR
           + to_seconds((l_orderkey*7919 + l_linenumber*104729 + l_partkey*613) % 86400) AS pickup_datetime,
         300 + (l_partkey*31 + l_suppkey*17 + l_orderkey*13) % 4200 AS secs,
         cast(l_linenumber - 1 AS integer) AS passenger_count,
         l_quantity * 0.4e0 AS trip_distance,
         cast(floor(l_discount*100e0 + 0.5e0) AS integer) * 0.25e0
           - CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 1e0 ELSE 0e0 END AS tip_amount,
         l_quantity * 0.4e0 * (2 + l_partkey % 7) + 1.5e0 AS total_amount,
         cast(l_suppkey % 25 + 1 AS integer) AS PULocationID,
         cast(l_partkey % 25 + 1 AS integer) AS DOLocationID,
         {_place('l_orderkey*53 + l_suppkey*211 + l_linenumber*7')} AS pickup_latitude,
         {_place('l_orderkey*37 + l_linenumber*11 + l_partkey*101')} AS pickup_longitude,
         {_place('l_orderkey*29 + l_suppkey*173 + l_linenumber*13')} AS dropoff_latitude,
         {_place('l_orderkey*71 + l_linenumber*17 + l_partkey*59')} AS dropoff_longitude
  FROM lineitem),
raw AS (
  SELECT *, pickup_datetime + to_seconds(secs) AS dropoff_datetime,
         total_amount - tip_amount AS fare_amount,
         {_r2('secs / 3600e0')} AS duration,
         {_r2('(total_amount - tip_amount) / trip_distance')} AS rate,
         cast(year(pickup_datetime) AS integer) AS pickup_year
  FROM raw0),
moved AS (
  SELECT *, CASE WHEN duration <> 0 THEN {_r2('trip_distance / duration')} END AS speed FROM raw)"""

_BASIC = (
    "passenger_count > 0 AND trip_distance > 0.5e0 AND tip_amount >= 0 AND total_amount >= 2.5e0 "
    "AND rate < 50 AND duration > 0.1e0"
)
_SPEED = "speed > 5 AND speed < 100"


def _clean(where: str) -> str:
    return f"""clean AS (
  SELECT *, cast(pickup_datetime AS date) AS pickup_date,
         cast(month(pickup_datetime) AS integer) AS pickup_month,
         cast(day(pickup_datetime) AS integer) AS pickup_day,
         cast(hour(pickup_datetime) AS integer) AS pickup_hour,
         CASE WHEN speed > 25 THEN 1 WHEN speed < 10 THEN 3 ELSE 2 END AS traffic,
         CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS isweekend
  FROM moved WHERE {where})"""


_KEPT = f"{_BASIC} AND pickup_year > 2007 AND pickup_year < {B.AS_OF_YEAR + 1} AND {_SPEED}"
_ODD = f"{_BASIC} AND NOT (pickup_year > 2007 AND pickup_year < {B.AS_OF_YEAR}) AND {_SPEED}"
ZONE_CLEAN = _clean(f"{_KEPT} AND PULocationID > 0")
GEO_CLEAN = _clean(f"{_KEPT} AND pickup_latitude <> 0 AND pickup_longitude <> 0")

_ZONE_ENDS = "PULocationID, DOLocationID"
_GEO_ENDS = "pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude"
_MEASURES = (
    "passenger_count, trip_distance, fare_amount, pickup_date, pickup_year, pickup_month, "
    "pickup_day, pickup_hour, duration, speed, traffic, rate, isweekend"
)


def _columns(ends: str) -> str:
    return f"pickup_datetime, dropoff_datetime, {ends}, {_MEASURES}"


def _nth(name: str, month: int, weekday: int, nth: int) -> str:
    first = f"make_date(y, {month}, 1)"
    return (
        f"SELECT '{name}' AS name, {first} + cast(({weekday} - dayofweek({first}) + 7) % 7 + {7 * (nth - 1)} "
        "AS integer) AS d FROM years"
    )


def _fixed(name: str, month: int, day: int, since: int = 0) -> str:
    where = f" WHERE y >= {since}" if since else ""
    return f"SELECT '{name}' AS name, make_date(y, {month}, {day}) AS d FROM years{where}"


CALENDAR = f"""years AS (SELECT cast(range AS integer) AS y
  FROM range({B.FIRST_CALENDAR_YEAR}, {B.LAST_CALENDAR_YEAR + 1})),
moving AS (
  {_fixed("New Year''s Day", 1, 1)} UNION ALL {_fixed("Lincoln''s Birthday", 2, 12)}
  UNION ALL {_fixed("Juneteenth", 6, 19, 2021)} UNION ALL {_fixed("Independence Day", 7, 4)}
  UNION ALL {_fixed("Veterans Day", 11, 11)} UNION ALL {_fixed("Christmas Day", 12, 25)}),
holidays AS (
  SELECT d AS holiday_date, min(name) AS name FROM (
    SELECT name, d FROM moving
    UNION ALL SELECT name || ' (observed)', d - 1 FROM moving WHERE dayofweek(d) = 6
    UNION ALL SELECT name || ' (observed)', d + 1 FROM moving WHERE dayofweek(d) = 0
    UNION ALL {_fixed("Susan B. Anthony Day", 2, 15)}
    UNION ALL {_nth("Martin Luther King Jr. Day", 1, 1, 3)}
    UNION ALL {_nth("Washington''s Birthday", 2, 1, 3)}
    UNION ALL SELECT 'Memorial Day', make_date(y, 5, 31)
      - cast((dayofweek(make_date(y, 5, 31)) + 6) % 7 AS integer) FROM years
    UNION ALL {_nth("Labor Day", 9, 1, 1)}
    UNION ALL {_nth("Columbus Day", 10, 1, 2)}
    UNION ALL {_nth("Thanksgiving", 11, 4, 4)}
    UNION ALL SELECT 'Election Day', d + 1 FROM ({_nth("", 11, 1, 1)}) e
      WHERE year(d) % 2 = 0 OR year(d) >= 2015
  ) h GROUP BY d)"""

FLAGGED = """trips AS (
  SELECT c.* EXCLUDE (pickup_month, isweekend),
         CASE WHEN h.holiday_date IS NULL THEN c.pickup_month ELSE 0 END AS pickup_month,
         CASE WHEN h.holiday_date IS NULL THEN c.isweekend ELSE -1 END AS isweekend,
         CASE WHEN h.holiday_date IS NULL THEN 0 ELSE 1 END AS isholiday
  FROM clean c LEFT JOIN holidays h ON h.holiday_date = c.pickup_date)"""

TRIPS = (RAW, ZONE_CLEAN, CALENDAR, FLAGGED)
GEO_TRIPS = (RAW, GEO_CLEAN, CALENDAR, FLAGGED)

_PRE = "(pickup_year <> 2020 OR (pickup_month < 3 AND pickup_year = 2020))"
_COVID = "(pickup_year > 2020 OR (pickup_month > 2 AND pickup_year = 2020))"
_PRE_CALENDAR = "pickup_date < DATE '2020-03-01'"
_COVID_CALENDAR = "pickup_date >= DATE '2020-03-01'"
_DAYS = {
    "holiday": "isholiday = 1",
    "workday": "isholiday < 1 AND isweekend < 1",
    "weekend": "isholiday < 1 AND isweekend = 1",
}


def _slice(day: str, covid: bool, calendar: bool = False, source: str = "trips") -> str:
    if calendar:
        era = _COVID_CALENDAR if covid else _PRE_CALENDAR
    else:
        era = _COVID if covid else _PRE
    if day == "holiday":
        month, keys = f"cast({-1 if covid else 0} AS integer)", "PULocationID, pickup_hour, traffic"
    else:
        month, keys = "pickup_month", "PULocationID, pickup_month, pickup_hour, traffic"
    weekend = {"holiday": -1, "workday": 0, "weekend": 1}[day]
    return f"""SELECT PULocationID AS zoneid, {month} AS target_month, pickup_hour AS target_hour, traffic,
  cast(sum(cast(round(rate * 100) AS bigint)) AS double) / cast(count(*) * 100 AS double) AS rate,
  {int(day == 'holiday')} AS isholiday, {weekend} AS isweekend, {int(covid)} AS iscovid
  FROM {source} WHERE {_DAYS[day]} AND {era} GROUP BY {keys}"""


def _all_slices(calendar: bool = False, source: str = "trips") -> str:
    return "\nUNION ALL\n".join(
        _slice(day, covid, calendar, source) for covid in (False, True) for day in _DAYS
    )


def _ring(shape: str, source: str, corners: list[tuple[str, str]]) -> str:
    """Flat edges of one closed ring per source row."""
    rows = []
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        rows.append(
            f"SELECT {shape} AS shape, ({ax})/1000e0 AS x1, ({ay})/1000e0 AS y1, "
            f"({bx})/1000e0 AS x2, ({by})/1000e0 AS y2 FROM {source}"
        )
    return "\n  UNION ALL ".join(rows)


ZONE_EDGES = (
    "zn AS (SELECT cast(n_nationkey + 1 AS integer) AS zone_id, n_name AS zone, "
    "(n_nationkey % 5) * 1000 AS x, (n_nationkey // 5) * 1000 AS y FROM nation),\n"
    "ze AS ("
    + _ring(
        "zone_id",
        "zn",
        [("x", "y"), ("x+1000", "y"), ("x+1000", "y+1000"), ("x+500", "y+600"), ("x", "y+1000")],
    )
    + ")"
)
TRACT_EDGES = (
    "tn AS (SELECT s_suppkey AS gid, s_name, s_nationkey, (s_suppkey*37) % 43 * 100 + 13 AS x, "
    "(s_suppkey*53) % 41 * 100 + 17 AS y FROM supplier),\n"
    "te AS ("
    + _ring("gid", "tn", [("x", "y"), ("x+700", "y"), ("x+700", "y+700"), ("x", "y+700")])
    + ")"
)

_LAYERS = (
    "SELECT 'zone ' || shape AS shape, x1, y1, x2, y2 FROM ze "
    "UNION ALL SELECT 'tract ' || shape, x1, y1, x2, y2 FROM te"
)

_SIDE = "((e.x2 - e.x1) * (p.y - e.y1) - (p.x - e.x1) * (e.y2 - e.y1))"
_CROSSINGS = (
    f"sum(CASE WHEN (e.y1 > p.y) <> (e.y2 > p.y) AND ({_SIDE} > 0) = (e.y2 > e.y1) THEN 1 ELSE 0 END) % 2 = 1"
)
_TOUCHES = (
    f"bool_or({_SIDE} = 0 AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
    "AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))"
)


def _inside(name: str, points: str, include: bool = False) -> str:
    """(id, zone_id) of points (id, x, y) in zones."""
    test = f"{_CROSSINGS} OR {_TOUCHES}" if include else f"{_CROSSINGS} AND NOT {_TOUCHES}"
    return (
        f"{name} AS (SELECT p.id, e.shape AS zone_id FROM ({points}) p, ze e "
        f"GROUP BY p.id, e.shape HAVING {test})"
    )


GEO_MATCH = (
    "gt AS (SELECT row_number() OVER () AS id, * FROM trips)",
    _inside("pu", "SELECT id, pickup_longitude AS x, pickup_latitude AS y FROM gt"),
    _inside("dof", "SELECT id, dropoff_longitude AS x, dropoff_latitude AS y FROM gt"),
    "placed AS (SELECT gt.* EXCLUDE (PULocationID, DOLocationID), pu.zone_id AS PULocationID, "
    "dof.zone_id AS DOLocationID FROM gt JOIN pu ON pu.id = gt.id JOIN dof ON dof.id = gt.id)",
)

REQUESTS = f"""req AS (SELECT c_custkey AS request_id, {_place('c_custkey*53 + 7')} AS lat,
  CASE WHEN c_custkey % 10 = 0 THEN cast(1 + (c_custkey // 10) % 4 AS double)
       ELSE {_place('c_custkey*37 + 11')} END AS lng,
  cast(c_custkey % 12 + 1 AS integer) AS month, cast(c_custkey % 3 + 1 AS integer) AS traffic,
  (c_custkey // 7) % 2 = 1 AS covid FROM customer)"""
_REQUEST_POINTS = "SELECT request_id AS id, lng AS x, lat AS y FROM req"

_ORDER_FILES = """ofile AS (SELECT o_orderkey, o_orderstatus, o_orderdate,
  CASE WHEN o_orderkey % 3 = 0 THEN 'green' ELSE 'yellow' END AS provider FROM orders)"""


def _file(month: str) -> str:
    return f"provider || '_tripdata_' || strftime({month}, '%Y-%m') || '.csv'"


FILES = (
    _ORDER_FILES,
    f"""expected AS (SELECT provider, {_file('m')} AS filename FROM (
    SELECT provider, unnest(generate_series(date_trunc('month', min(o_orderdate)),
      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM ofile GROUP BY provider) x)""",
    f"""oreg AS (SELECT {_file('o_orderdate')} AS filename, min(o_orderkey) AS id,
    cast(count(*) % 3 AS integer) AS islocked FROM ofile GROUP BY 1)""",
    "pending AS (SELECT filename FROM expected WHERE filename NOT IN "
    "(SELECT filename FROM oreg WHERE islocked = 2))",
    f"""stored AS (SELECT {_file('o_orderdate')} AS filename FROM ofile WHERE o_orderstatus = 'F'
    GROUP BY 1 HAVING count(*) % 2 = 0)""",
)


def _events(sources: int) -> tuple[str, str]:
    return (
        f"etrips AS (SELECT event_id AS id, user_id % {sources} AS sourceid FROM events)",
        """ereg AS (SELECT sourceid AS id, 'yellow_tripdata_' || sourceid || '.csv' AS filename,
    cast(CASE WHEN sourceid % 3 = 0 THEN 2 ELSE 1 END AS integer) AS islocked
    FROM etrips GROUP BY sourceid)""",
    )


_WINDOWS = f"""last AS (SELECT max(id) AS last FROM etrips),
wins AS (SELECT k AS bucket, last - (k + 1) * {R.EVENT_WINDOW} AS lo, last - k * {R.EVENT_WINDOW} AS hi
  FROM last, (SELECT unnest(generate_series(0, (SELECT last // {R.EVENT_WINDOW} + 1 FROM last))) AS k) s),
counts AS (SELECT bucket, sourceid, count(*) AS n FROM etrips, wins
  WHERE etrips.id BETWEEN lo AND hi AND sourceid IN (SELECT id FROM ereg WHERE islocked = 1)
  GROUP BY bucket, sourceid)"""



def _sequential(minimum: int) -> str:
    """(marked): the sources that windows mark one after another, from ``counts``."""
    return f"""ranked AS (SELECT bucket, list({{'n': n, 's': sourceid}} ORDER BY n DESC, sourceid) AS l FROM counts GROUP BY bucket),
steps_of AS (SELECT k, l FROM (SELECT unnest(generate_series(0, (SELECT max(bucket) FROM counts))) AS k) g LEFT JOIN ranked ON bucket = k),
seq(k, marked) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL SELECT k + 1, CASE WHEN t.n > {minimum} THEN list_append(marked, t.s) ELSE marked END
  FROM (SELECT s.k, s.marked, list_filter(o.l, lambda x: NOT list_contains(s.marked, x.s))[1] AS t
    FROM seq s JOIN steps_of o ON o.k = s.k) q),
marked AS (SELECT unnest(marked) AS id FROM (SELECT marked FROM seq ORDER BY k DESC LIMIT 1) m)"""


# A trip table loaded in three steps: ids go on, and the third step's replace those of the second.
_LEDGER = """loads AS (
  SELECT CASE WHEN sourceid > 12 THEN 0 ELSE 1 END AS phase, sourceid, n
  FROM (SELECT cast(PULocationID AS bigint) AS sourceid, count(*) AS n FROM trips GROUP BY 1) c
  UNION ALL SELECT 2, cast(PULocationID AS bigint), count(*) FROM trips WHERE PULocationID <= 5 GROUP BY 2),
ledger AS (
  SELECT sourceid, n, last_id, last_id - n + 1 AS first_id FROM (
    SELECT *, cast(sum(n) OVER (ORDER BY phase, sourceid) AS bigint) AS last_id,
      row_number() OVER (PARTITION BY sourceid ORDER BY phase DESC) AS rn FROM loads) l WHERE rn = 1)"""

_TRIP_WINDOWS = f"""ereg AS (SELECT sourceid AS id, 'yellow_tripdata_' || sourceid || '.csv' AS filename,
    cast(CASE WHEN sourceid % 3 = 0 THEN 2 ELSE 1 END AS integer) AS islocked FROM ledger),
last AS (SELECT max(last_id) AS last FROM ledger),
wins AS (SELECT k AS bucket, last - (k + 1) * {R.TRIP_WINDOW} AS lo, last - k * {R.TRIP_WINDOW} AS hi
  FROM last, (SELECT unnest(generate_series(0, (SELECT last // {R.TRIP_WINDOW} + 1 FROM last))) AS k) s),
counts AS (SELECT bucket, sourceid, least(hi, last_id) - greatest(lo, first_id) + 1 AS n FROM ledger, wins
  WHERE least(hi, last_id) >= greatest(lo, first_id) AND sourceid IN (SELECT id FROM ereg WHERE islocked = 1))"""

_MARKED_REGISTRY = """SELECT id, filename, cast(CASE WHEN id IN (SELECT id FROM marked) THEN 2 ELSE islocked END AS integer) AS islocked
  FROM ereg"""

# Inverse Lambert conformal conic, the latitude refined step by step in a recursive table.
_LCC = """par AS (SELECT sqrt(f*(2e0-f)) AS e, radians(40e0+2e0/3e0) AS p1, radians(41e0+1e0/30e0) AS p2,
    radians(40e0+1e0/6e0) AS p0 FROM (SELECT 1e0/298.257222101e0 AS f) q),
mt AS (SELECT e,
    cos(p1)/sqrt(1-(e*sin(p1))**2) AS m1, cos(p2)/sqrt(1-(e*sin(p2))**2) AS m2,
    tan(pi()/4-p1/2)/((1-e*sin(p1))/(1+e*sin(p1)))**(e/2) AS t1,
    tan(pi()/4-p2/2)/((1-e*sin(p2))/(1+e*sin(p2)))**(e/2) AS t2,
    tan(pi()/4-p0/2)/((1-e*sin(p0))/(1+e*sin(p0)))**(e/2) AS t0 FROM par),
cone AS (SELECT e, n, m1/(n*t1**n) AS f, 6378137e0*(m1/(n*t1**n))*t0**n AS rho0
    FROM (SELECT *, (ln(m1)-ln(m2))/(ln(t1)-ln(t2)) AS n FROM mt) w),
flat AS (SELECT gid, seq, (x-984250e0)*0.3048006096012192e0 AS ea,
    rho0 - y*0.3048006096012192e0 AS no, e, n, f FROM feet, cone),
steps AS (SELECT gid, seq, ea, no, e, n, (sqrt(ea*ea+no*no)/(6378137e0*f))**(1/n) AS t,
    pi()/2 - 2*atan((sqrt(ea*ea+no*no)/(6378137e0*f))**(1/n)) AS lat, 0 AS i FROM flat
    UNION ALL SELECT gid, seq, ea, no, e, n, t,
    pi()/2 - 2*atan(t*((1-e*sin(lat))/(1+e*sin(lat)))**(e/2)), i + 1 FROM steps WHERE i < 8)"""

FEET = (
    "tn AS (SELECT s_suppkey AS gid, (s_suppkey*37) % 43 * 100 + 13 AS x, "
    "(s_suppkey*53) % 41 * 100 + 17 AS y FROM supplier)",
    "feet AS ("
    + " UNION ALL ".join(
        f"SELECT gid, {i} AS seq, cast((x+{dx})*10+980000 AS double) AS x, "
        f"cast((y+{dy})*10+190000 AS double) AS y FROM tn"
        for i, (dx, dy) in enumerate([(0, 0), (700, 0), (700, 700), (0, 700), (0, 0)])
    )
    + ")",
)



def _degrees(*layers: tuple[str, str, list[tuple[str, str]], bool]) -> tuple[str, ...]:
    """Edges (gid, x1, y1, x2, y2) in degrees, table ``deg``, of shapes given in thousandths."""
    rows = []
    for name, source, corners, closed in layers:
        ring = corners + corners[:1] if closed else corners
        rows += [
            f"SELECT {name} AS gid, {i} AS seq, cast(({x})*10+980000 AS double) AS x, cast(({y})*10+190000 AS double) AS y FROM {source}"
            for i, (x, y) in enumerate(ring)
        ]
    return (
        "feet AS (" + " UNION ALL ".join(rows) + ")",
        _LCC,
        "spot AS (SELECT gid, seq, degrees(atan2(ea, no)/n) - 74e0 AS x, degrees(lat) AS y FROM steps WHERE i = 8)",
        "deg AS (SELECT a.gid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM spot a JOIN spot b ON b.gid = a.gid AND b.seq = a.seq + 1)",
    )


_ZONE_RING = [("x", "y"), ("x+1000", "y"), ("x+1000", "y+1000"), ("x+500", "y+600"), ("x", "y+1000")]
_TRACT_RING = [("x", "y"), ("x+700", "y"), ("x+700", "y+700"), ("x", "y+700")]

# Common area of two polygons: signed integrals of the lower edge over shared x ranges.
_OVERLAP = """pairs AS (SELECT t.shape AS gid, z.shape AS zone_id,
    sign(t.x1 - t.x2) * sign(z.x1 - z.x2) AS s,
    greatest(least(t.x1, t.x2), least(z.x1, z.x2)) AS l,
    least(greatest(t.x1, t.x2), greatest(z.x1, z.x2)) AS r,
    t.x1 AS ax, t.y1 AS ay, (t.y2 - t.y1) / nullif(t.x2 - t.x1, 0) AS am,
    z.x1 AS ox, z.y1 AS oy, (z.y2 - z.y1) / nullif(z.x2 - z.x1, 0) AS bm
    FROM te t, ze z WHERE t.x1 <> t.x2 AND z.x1 <> z.x2),
ends AS (SELECT *, ay + am*(l-ax) AS f0, ay + am*(r-ax) AS f1, oy + bm*(l-ox) AS g0, oy + bm*(r-ox) AS g1
    FROM pairs WHERE l < r),
mids AS (SELECT *, CASE WHEN (f0-g0)*(f1-g1) < 0 THEN l + (r-l)*(g0-f0)/((f1-f0)-(g1-g0)) ELSE r END AS c
    FROM ends),
parts AS (SELECT *, ay + am*(c-ax) AS fc FROM mids),
common AS (SELECT gid, zone_id, abs(sum(s * ((c-l)*(least(f0,g0)+least(fc, oy + bm*(c-ox)))/2
    + (r-c)*(least(fc, oy + bm*(c-ox))+least(f1,g1))/2))) AS a FROM parts GROUP BY gid, zone_id),
areas AS (SELECT shape AS gid, abs(sum(x1*y2 - x2*y1))/2 AS a FROM te GROUP BY shape)"""


def _turn(a: str, p: str, i: int) -> str:
    return f"(({a}.x2-{a}.x1)*({p}.y{i}-{a}.y1) - ({p}.x{i}-{a}.x1)*({a}.y2-{a}.y1))"


def _on(a: str, p: str, i: int) -> str:
    return (
        f"({_turn(a, p, i)} = 0 AND {p}.x{i} BETWEEN least({a}.x1,{a}.x2) AND greatest({a}.x1,{a}.x2) "
        f"AND {p}.y{i} BETWEEN least({a}.y1,{a}.y2) AND greatest({a}.y1,{a}.y2))"
    )


_MEET = (
    f"(({_turn('s', 'z', 1)} > 0) <> ({_turn('s', 'z', 2)} > 0) AND {_turn('s', 'z', 1)} <> 0 "
    f"AND {_turn('s', 'z', 2)} <> 0 AND ({_turn('z', 's', 1)} > 0) <> ({_turn('z', 's', 2)} > 0) "
    f"AND {_turn('z', 's', 1)} <> 0 AND {_turn('z', 's', 2)} <> 0) "
    f"OR {_on('s', 'z', 1)} OR {_on('s', 'z', 2)} OR {_on('z', 's', 1)} OR {_on('z', 's', 2)}"
)
SEGMENTS = (
    "seg AS (SELECT try_cast(substr(s_name, 10) AS integer) AS segmentid, s_name AS street, "
    "((s_suppkey*37) % 43 * 100 + 13)/1000e0 AS x1, ((s_suppkey*53) % 41 * 100 + 17)/1000e0 AS y1, "
    "((s_suppkey*37) % 43 * 100 + 713)/1000e0 AS x2, ((s_suppkey*53) % 41 * 100 + 717)/1000e0 AS y2 "
    "FROM supplier)"
)

_LOOKUP = """rates AS MATERIALIZED ({slices}),
grid AS (SELECT r.*, s.series, h.hour FROM req r,
    (SELECT unnest(['weekday', 'weekend', 'holiday']) AS series) s,
    (SELECT cast(range AS integer) AS hour FROM range(0, 24)) h),
near AS MATERIALIZED (SELECT q.*, hit.zone_id FROM req q JOIN hit ON hit.id = q.request_id),
hits AS (SELECT n.request_id, r.target_hour AS hour, avg(r.rate) AS rate,
      CASE WHEN r.isholiday = 1 THEN 'holiday' WHEN r.isweekend = 1 THEN 'weekend' ELSE 'weekday' END AS series
    FROM near n JOIN rates r ON r.zoneid = n.zone_id AND r.traffic = n.traffic AND r.iscovid = cast(n.covid AS integer)
    WHERE n.covid OR r.isholiday = 1 OR r.target_month = n.month
    GROUP BY ALL)"""


def _select(ctes: tuple[str, ...], body: str) -> str:
    return f"{_ctes(*ctes)}\n{body}"


def all_oracles() -> dict[str, str]:
    zone_columns, geo_columns = _columns(_ZONE_ENDS), _columns(_GEO_ENDS)
    stored = f"{zone_columns}, isholiday"
    clean = (RAW, ZONE_CLEAN)
    out = {
        "clean_trips": _select(clean, f"SELECT {zone_columns} FROM clean"),
        "clean_trips_geo": _select((RAW, GEO_CLEAN), f"SELECT {geo_columns} FROM clean"),
        "date_parts": _select(
            (RAW,),
            """SELECT pickup_datetime, cast(pickup_datetime AS date) AS pickup_date, pickup_year,
  cast(month(pickup_datetime) AS integer) AS pickup_month, cast(day(pickup_datetime) AS integer) AS pickup_day,
  cast(dayofweek(pickup_datetime) + 1 AS integer) AS pickup_weekday,
  cast(hour(pickup_datetime) AS integer) AS pickup_hour FROM raw""",
        ),
        "traffic_levels": _select(clean, "SELECT speed, traffic, count(*) AS trips FROM clean GROUP BY 1, 2"),
        "odd_date_trips": _select(
            (RAW, _clean(f"{_ODD} AND PULocationID > 0")), f"SELECT {zone_columns} FROM clean"
        ),
        "reject_audit": _select(
            (RAW,),
            f"""SELECT step, ['no_datetime', 'no_passenger', 'short_distance', 'negative_tip', 'below_minimum_fare',
    'rate_too_high', 'too_brief', 'odd_date', 'odd_speed', 'no_pickup_place', 'kept'][step] AS rule, count(*) AS trips
  FROM (SELECT CASE WHEN NOT passenger_count > 0 THEN 2 WHEN NOT trip_distance > 0.5e0 THEN 3
    WHEN NOT tip_amount >= 0 THEN 4 WHEN NOT total_amount >= 2.5e0 THEN 5 WHEN NOT rate < 50 THEN 6
    WHEN NOT duration > 0.1e0 THEN 7 WHEN NOT (pickup_year > 2007 AND pickup_year < {B.AS_OF_YEAR}) THEN 8
    WHEN NOT ({_SPEED}) THEN 9 WHEN NOT PULocationID > 0 THEN 10 ELSE 11 END AS step
    FROM (SELECT *, CASE WHEN duration <> 0 THEN {_r2('trip_distance / duration')} END AS speed FROM raw) m) s
  GROUP BY step""",
        ),
        "holiday_join": _select(
            (RAW, ZONE_CLEAN, CALENDAR),
            """SELECT holiday_date, name, cast(count(*) AS bigint) AS trips
  FROM clean LEFT JOIN holidays ON holiday_date = pickup_date GROUP BY 1, 2""",
        ),
        "calendar_flags": _select(
            TRIPS,
            "SELECT pickup_datetime, pickup_date, pickup_year, pickup_month, isholiday, isweekend FROM trips",
        ),
        "rates": _select(TRIPS, _all_slices()),
        "rates_calendar_mode": _select(TRIPS, _all_slices(calendar=True)),
        "zone_edges": _select((ZONE_EDGES, TRACT_EDGES), _LAYERS),
        "vertex_edges": _select(
            FEET,
            """SELECT a.gid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM feet a JOIN feet b ON b.gid = a.gid AND b.seq = a.seq + 1""",
        ),
        "reproject_vertices": _select(
            (*FEET, _LCC),
            """SELECT gid, seq, round(degrees(atan2(ea, no)/n) - 74e0, 8) AS lon, round(degrees(lat), 8) AS lat
  FROM steps WHERE i = 8""",
        ),
        "polygon_area": _select(
            (ZONE_EDGES, TRACT_EDGES),
            f"SELECT shape, round(abs(sum(x1*y2 - x2*y1)) / 2, 9) AS area FROM ({_LAYERS}) e GROUP BY shape",
        ),
        "geo_to_zone": _select(
            (*GEO_TRIPS, ZONE_EDGES, *GEO_MATCH),
            f"SELECT {stored}, cast(NULL AS bigint) AS sourceid FROM placed",
        ),
        "geo_unmatched": _select(
            (*GEO_TRIPS, ZONE_EDGES, *GEO_MATCH),
            f"""SELECT {geo_columns}, isholiday, cast(NULL AS bigint) AS sourceid FROM gt
  WHERE id NOT IN (SELECT id FROM pu) OR id NOT IN (SELECT id FROM dof)""",
        ),
        "geo_rates": _select((*GEO_TRIPS, ZONE_EDGES, *GEO_MATCH), _all_slices(source="placed")),
        "point_zone_or_default": _select(
            (ZONE_EDGES, REQUESTS, _inside("hit", _REQUEST_POINTS)),
            """SELECT request_id, cast(coalesce(min(zone_id), -1) AS integer) AS zone_id
  FROM req LEFT JOIN hit ON hit.id = request_id GROUP BY request_id""",
        ),
        "rate_lookup": _select(
            (
                *TRIPS,
                ZONE_EDGES,
                REQUESTS,
                _inside("hit", _REQUEST_POINTS, include=True),
                _LOOKUP.format(slices=_all_slices()),
            ),
            f"""SELECT g.request_id, g.series, g.hour, {_r2('h.rate')} AS rate FROM grid g LEFT JOIN hits h
  ON h.request_id = g.request_id AND h.series = g.series AND h.hour = g.hour""",
        ),
        "retype_segment": _select((SEGMENTS,), "SELECT segmentid, street FROM seg"),
        "segment_zone_map": _select(
            (
                ZONE_EDGES,
                SEGMENTS,
                _inside("starts", "SELECT segmentid AS id, x1 AS x, y1 AS y FROM seg", include=True),
            ),
            f"""SELECT s.segmentid, z.shape AS zone_id FROM seg s, ze z WHERE {_MEET}
  UNION SELECT id, zone_id FROM starts""",
        ),
        "tract_zone_map": _select(
            (ZONE_EDGES, TRACT_EDGES, _OVERLAP),
            """SELECT c.gid, c.zone_id, round(c.a / t.a, 6) AS overlap
  FROM common c JOIN areas t ON t.gid = c.gid WHERE c.a / t.a > 0.5""",
        ),
        "add_named_area": _select(
            (ZONE_EDGES, TRACT_EDGES),
            """SELECT gid, 'Borough ' || (s_nationkey % 5) AS boroname, s_name AS ntaname,
  'NA' || s_nationkey AS ntacode, x1, y1, x2, y2 FROM tn JOIN te ON te.shape = gid
  UNION ALL SELECT NULL, 'Outside', 'Added Airport', 'XX01', x1, y1, x2, y2
  FROM ze JOIN zn ON zn.zone_id = ze.shape WHERE zone = 'NATION_13'""",
        ),
        "expected_files": _select(FILES, "SELECT provider, filename FROM expected"),
        "pending_files": _select(FILES, "SELECT filename FROM pending"),
        "loadable_files": _select(FILES, "SELECT filename FROM pending WHERE filename IN (SELECT filename FROM stored)"),
        "register_files": _select(
            FILES,
            """SELECT filename, cast(1 AS bigint) AS files, cast(1 AS bigint) AS ids, cast(NULL AS bigint) AS first_id,
  cast(NULL AS bigint) AS last_id, cast(1 AS integer) AS islocked FROM pending
  UNION ALL SELECT NULL, count(*), count(*), 1, count(*), 1 FROM pending""",
        ),
        "quick_completeness": _select(
            (*_events(R.EVENT_SOURCES), _WINDOWS),
            f"""SELECT id, filename, cast(CASE WHEN id IN (SELECT sourceid FROM counts WHERE n > {R.EVENT_QUICK_MINIMUM})
  THEN 2 ELSE islocked END AS integer) AS islocked FROM ereg""",
        ),
        "quick_top_source": _select(
            (*_events(R.EVENT_SOURCES), _WINDOWS),
            """SELECT bucket, sourceid, n FROM (SELECT *, row_number() OVER (PARTITION BY bucket
  ORDER BY n DESC, sourceid) AS rn FROM counts) c WHERE rn = 1""",
        ),
        "file_state": _select(
            _events(R.STATE_SOURCES),
            f"""SELECT id, filename, cast(CASE WHEN islocked <> 1 THEN islocked
    WHEN (SELECT count(*) FROM etrips t WHERE t.sourceid = e.id) < {R.STATE_MINIMUM} THEN 0 ELSE 2 END
    AS integer) AS islocked FROM ereg e""",
        ),
        "trip_table": _select(TRIPS, f"SELECT {stored}, cast(PULocationID AS bigint) AS sourceid FROM trips"),
        "stored_rates": _select(TRIPS, _all_slices()),
        "stream_ingest": _select(
            TRIPS,
            f"""SELECT 'tripdata' AS variant, {stored} FROM trips
  UNION ALL BY NAME SELECT 'tripdata_geo' AS variant, {geo_columns}, isholiday FROM trips""",
        ),
        "reload_states": _select(
            TRIPS,
            """SELECT phase, cast(CASE phase WHEN 0 THEN 0 ELSE 2 END AS integer) AS islocked, phase < 2 AS loaded,
  pickup_year, count(*) AS trips FROM trips, (SELECT cast(range AS integer) AS phase FROM range(3)) p GROUP BY ALL""",
        ),
    }
    out["place_coordinates"] = _select(
        (*GEO_TRIPS, ZONE_EDGES, *GEO_MATCH),
        f"""SELECT 'tripdata' AS variant, {stored}, cast(pickup_year AS bigint) AS sourceid FROM placed
  UNION ALL BY NAME SELECT 'tripdata_unmatched' AS variant, {geo_columns}, isholiday, cast(pickup_year AS bigint) AS sourceid
  FROM gt WHERE id NOT IN (SELECT id FROM pu) OR id NOT IN (SELECT id FROM dof)""",
    )
    # Both variants keep the same trips (no pickup place is zero), so both come from one table.
    out["batch_rates"] = _select(
        (
            *GEO_TRIPS,
            ZONE_EDGES,
            *GEO_MATCH,
            "everything AS (SELECT PULocationID, pickup_year, pickup_month, pickup_date, pickup_hour, traffic, rate, "
            "isholiday, isweekend FROM trips UNION ALL SELECT PULocationID, pickup_year, pickup_month, pickup_date, "
            "pickup_hour, traffic, rate, isholiday, isweekend FROM placed)",
        ),
        _all_slices(source="everything"),
    )
    out["quick_sequential"] = _select(
        (*_events(R.EVENT_SOURCES), _WINDOWS, _sequential(R.EVENT_QUICK_MINIMUM)), _MARKED_REGISTRY
    )
    out["trip_row_ids"] = _select(
        (*TRIPS, _LEDGER), "SELECT sourceid, first_id, last_id, n AS trips, n AS ids FROM ledger"
    )
    out["quick_completeness_trips"] = _select(
        (*TRIPS, _LEDGER, _TRIP_WINDOWS, _sequential(R.TRIP_QUICK_MINIMUM)), _MARKED_REGISTRY
    )
    out["quarantine_tables"] = _select(
        (RAW, _clean(f"{_ODD} AND PULocationID > 0"), CALENDAR, FLAGGED),
        f"""SELECT 'tripdata_odddate' AS variant, {stored} FROM trips
  UNION ALL BY NAME SELECT 'tripdata_geo_odddate' AS variant, {geo_columns}, isholiday FROM trips""",
    )
    out["incremental_rates"] = _select(TRIPS, _all_slices())
    looked_for = f"m BETWEEN DATE '{R.REFRESH_FROM}' AND DATE '{R.REFRESH_THROUGH}'"
    month = "make_date(year(pickup_datetime), CASE WHEN minute(pickup_datetime) = 0 THEN 2 ELSE 1 END, 1)"
    out["refresh_run"] = _select(
        (
            *GEO_TRIPS,
            ZONE_EDGES,
            *GEO_MATCH,
            f"""lines AS (SELECT 'yellow' AS provider, {month} AS m FROM raw UNION ALL SELECT 'green', {month} FROM raw),
named AS (SELECT DISTINCT provider, m, provider || '_tripdata_' || strftime(m, '%Y-%m') || '.csv' AS filename FROM lines WHERE {looked_for}),
kept AS (SELECT 'yellow' AS provider, {month} AS m, count(*) AS n FROM trips GROUP BY ALL
  UNION ALL SELECT 'green', {month}, count(*) FROM placed GROUP BY ALL)""",
        ),
        f"""SELECT filename, CASE WHEN filename <> 'yellow_tripdata_2016-01.csv' THEN 'checked' END AS state,
  cast(CASE WHEN filename = 'yellow_tripdata_2016-01.csv' OR coalesce(n, 0) >= {R.REFRESH_MINIMUM} THEN 2 ELSE 0 END AS integer) AS islocked,
  CASE WHEN filename = 'yellow_tripdata_2016-01.csv' THEN 0 ELSE coalesce(n, 0) END AS trips
  FROM named LEFT JOIN kept USING (provider, m)""",
    )
    out["last_header"] = out["clean_trips"]
    out["geo_to_zone_split"] = out["geo_to_zone"]
    out["reproject_shapes"] = _select(
        (FEET[0], *_degrees(("gid", "tn", _TRACT_RING, True))),
        f"SELECT gid, {', '.join(f'round({c}, 8) AS {c}' for c in ('x1', 'y1', 'x2', 'y2'))} FROM deg",
    )
    out["map_refresh"] = _select(
        (
            ZONE_EDGES.split(",\nze AS")[0],
            FEET[0],
            "sn AS (SELECT try_cast(substr(s_name, 10) AS integer) AS segmentid, (s_suppkey*37) % 43 * 100 + 13 AS x, "
            "(s_suppkey*53) % 41 * 100 + 17 AS y FROM supplier)",
            *_degrees(
                ("'z' || zone_id", "zn", _ZONE_RING, True),
                ("'t' || gid", "tn", _TRACT_RING, True),
                ("'s' || segmentid", "sn", [("x", "y"), ("x+700", "y+700")], False),
            ),
            "ze AS (SELECT cast(gid[2:] AS integer) AS shape, x1, y1, x2, y2 FROM deg WHERE gid[1:1] = 'z')",
            "te AS (SELECT cast(gid[2:] AS bigint) AS shape, x1, y1, x2, y2 FROM deg WHERE gid[1:1] = 't' UNION ALL "
            "SELECT -1, x1, y1, x2, y2 FROM ze JOIN zn ON zone_id = shape WHERE zone = 'NATION_13')",
            "seg AS (SELECT cast(gid[2:] AS integer) AS segmentid, x1, y1, x2, y2 FROM deg WHERE gid[1:1] = 's')",
            _inside("starts", "SELECT segmentid AS id, x1 AS x, y1 AS y FROM seg", include=True),
            _OVERLAP,
        ),
        f"""SELECT 'segments' AS layer, cast(segmentid AS bigint) AS id, zone_id, cast(NULL AS double) AS overlap
  FROM (SELECT s.segmentid, z.shape AS zone_id FROM seg s, ze z WHERE {_MEET} UNION SELECT id, zone_id FROM starts) m
  UNION ALL SELECT 'tracts', c.gid, c.zone_id, round(c.a / t.a, 6) FROM common c JOIN areas t ON t.gid = c.gid WHERE c.a / t.a > 0.5""",
    )
    maps = {n: out[n] for n in ("segment_zone_map", "tract_zone_map")}
    out["stored_mappings"] = (
        f"SELECT 'segments' AS layer, cast(segmentid AS bigint) AS id, zone_id, cast(NULL AS double) AS overlap "
        f"FROM ({maps['segment_zone_map']}) s "
        f"UNION ALL SELECT 'tracts', gid, zone_id, overlap FROM ({maps['tract_zone_map']}) t"
    )
    out["unify_headers"] = out["clean_trips"]
    out["csv_ingest"] = out["clean_trips"]
    for name in ("holiday", "workday", "weekend"):
        for covid, prefix in ((False, ""), (True, "covid_")):
            out[f"rates_{prefix}{name}"] = _select(TRIPS, _slice(name, covid))
    return out

"""Table schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

_MOMENTS = [
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
]
_ZONE_ENDS = [("PULocationID", T.IntegerType()), ("DOLocationID", T.IntegerType())]
_GEO_ENDS = [
    ("pickup_latitude", T.DoubleType()),
    ("pickup_longitude", T.DoubleType()),
    ("dropoff_latitude", T.DoubleType()),
    ("dropoff_longitude", T.DoubleType()),
]
ZONE_ENDS, GEO_ENDS = [n for n, _ in _ZONE_ENDS], [n for n, _ in _GEO_ENDS]
_MEASURES = [
    ("passenger_count", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("pickup_date", T.DateType()),
    ("pickup_year", T.IntegerType()),
    ("pickup_month", T.IntegerType()),
    ("pickup_day", T.IntegerType()),
    ("pickup_hour", T.IntegerType()),
    ("duration", T.DoubleType()),
    ("speed", T.DoubleType()),
    ("traffic", T.IntegerType()),
    ("rate", T.DoubleType()),
]
_FLAGS = [
    ("isholiday", T.IntegerType()),
    ("isweekend", T.IntegerType()),
    ("sourceid", T.LongType()),
]


def _struct(*groups) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for group in groups for name, kind in group])


# Clean trips before the calendar is applied (``isweekend`` is 0 or 1 here).
CLEAN_ZONE = _struct(_MOMENTS, _ZONE_ENDS, _MEASURES, _FLAGS[1:2])
CLEAN_GEO = _struct(_MOMENTS, _GEO_ENDS, _MEASURES, _FLAGS[1:2])

# Trip tables as stored: calendar flags and source file added.
TRIPS_ZONE = _struct(_MOMENTS, _ZONE_ENDS, _MEASURES, _FLAGS)
TRIPS_GEO = _struct(_MOMENTS, _GEO_ENDS, _MEASURES, _FLAGS)

# All columns of both variants: what one write of several trip tables holds.
TRIPS_ALL = _struct(_MOMENTS, _ZONE_ENDS, _GEO_ENDS, _MEASURES, _FLAGS)

# Which files of which generation of a source make up a trip table, and the ids of their rows.
# A row without a file holds the last id that its table has given out.
MANIFEST = _struct(
    [
        ("table", T.StringType()),
        ("sourceid", T.LongType()),
        ("gen", T.StringType()),
        ("file", T.StringType()),
        ("n_rows", T.LongType()),
        ("last_id", T.LongType()),
    ]
)

RATES = _struct(
    [
        ("zoneid", T.IntegerType()),
        ("target_month", T.IntegerType()),
        ("target_hour", T.IntegerType()),
        ("traffic", T.IntegerType()),
        ("rate", T.DoubleType()),
        ("isholiday", T.IntegerType()),
        ("isweekend", T.IntegerType()),
        ("iscovid", T.IntegerType()),
    ]
)

# Sums of cents and counts of trips of a source's generation, before (0) and during (1) restrictions.
RATE_SUMS = _struct(
    [
        ("sourceid", T.LongType()),
        ("gen", T.StringType()),
        ("zoneid", T.IntegerType()),
        ("target_month", T.IntegerType()),
        ("target_hour", T.IntegerType()),
        ("traffic", T.IntegerType()),
        ("isweekend", T.IntegerType()),
        ("c0", T.LongType()),
        ("n0", T.LongType()),
        ("c1", T.LongType()),
        ("n1", T.LongType()),
    ]
)

CLAIMS = _struct([("filename", T.StringType()), ("path", T.StringType()), ("state", T.StringType())])

# Rates as requests ask for them: sums and counts for each hour of three series, 72 entries.
CURVES = _struct(
    [
        ("zone_id", T.IntegerType()),
        ("traffic", T.IntegerType()),
        ("covid", T.IntegerType()),
        ("month", T.IntegerType()),
        ("totals", T.ArrayType(T.DoubleType())),
        ("counts", T.ArrayType(T.LongType())),
    ]
)

FILE_REGISTRY = _struct(
    [
        ("id", T.LongType()),
        ("filename", T.StringType()),
        ("updateon", T.TimestampType()),
        ("islocked", T.IntegerType()),
    ]
)

# Registry states.
NO_DATA, UNCHECKED, GOOD = 0, 1, 2

EDGE = _struct([(name, T.DoubleType()) for name in ("x1", "y1", "x2", "y2")])

# A polygon (or line) layer: one row per shape, edges in the shape's own row.
ZONES = T.StructType(
    [
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("zone", T.StringType()),
        T.StructField("edges", T.ArrayType(EDGE)),
    ]
)

REQUESTS = _struct(
    [
        ("request_id", T.LongType()),
        ("lat", T.DoubleType()),
        ("lng", T.DoubleType()),
        ("month", T.IntegerType()),
        ("traffic", T.IntegerType()),
        ("covid", T.BooleanType()),
    ]
)


def has_coordinates(df) -> bool:
    """Whether a trip table is the coordinate variant (names compared without case)."""
    return "pickup_longitude" in {name.lower() for name in df.columns}

"""Column-name rules: strip stray characters, then unify the header dialects."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Header spellings of the published trip files, lower-cased, and the
# canonical name each one stands for.
HEADER_NAMES = {
    "trip_pickup_datetime": "pickup_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "trip_dropoff_datetime": "dropoff_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "tip_amt": "tip_amount",
    "total_amt": "total_amount",
    "start_lat": "pickup_latitude",
    "start_lon": "pickup_longitude",
    "end_lat": "dropoff_latitude",
    "end_lon": "dropoff_longitude",
    "pulocationid": "PULocationID",
    "dolocationid": "DOLocationID",
}

# Names that are canonical already, whatever their case in the file.
CANONICAL_NAMES = (
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "tip_amount",
    "total_amount",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
)

_PIECES = re.compile(r"\w+|\W+")


def sanitize_name(name: str) -> str:
    """The longest run of word or of non-word characters, the first one on ties."""
    pieces = _PIECES.findall(name)
    return max(pieces, key=len) if pieces else name


def sanitize_columns(df: DataFrame, last_only: bool = False) -> DataFrame:
    """Strip stray characters from header names.

    ``last_only`` touches the last name alone and keeps what precedes its first
    stray character.
    """
    names = list(df.columns)
    if last_only:
        names[-1] = re.split(r"\W+", names[-1])[0]
    else:
        names = [sanitize_name(name) for name in names]
    return df.toDF(*names)


def canonical_name(name: str) -> str:
    lowered = name.lower()
    if lowered in HEADER_NAMES:
        return HEADER_NAMES[lowered]
    return lowered if lowered in CANONICAL_NAMES else name


def unify_columns(df: DataFrame) -> DataFrame:
    """Give every header dialect the same column names."""
    return df.toDF(*[canonical_name(name) for name in df.columns])

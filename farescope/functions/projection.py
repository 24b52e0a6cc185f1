"""Lambert conformal conic coordinates to degrees, as Column arithmetic."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ConicProjection:
    """Two standard parallels; angles in degrees, offsets in the file's own unit."""

    semi_major: float
    inverse_flattening: float
    false_easting: float
    false_northing: float
    central_meridian: float
    parallel_1: float
    parallel_2: float
    origin_latitude: float
    unit_in_metres: float


# The New York state plane, Long Island zone, in US survey feet (EPSG 2263).
NEW_YORK_LONG_ISLAND_FEET = ConicProjection(
    semi_major=6378137.0,
    inverse_flattening=298.257222101,
    false_easting=984250.0,
    false_northing=0.0,
    central_meridian=-74.0,
    parallel_1=40.0 + 2.0 / 3.0,
    parallel_2=41.0 + 1.0 / 30.0,
    origin_latitude=40.0 + 1.0 / 6.0,
    unit_in_metres=0.3048006096012192,
)

def cone_constants(p: ConicProjection) -> dict[str, float]:
    """e (eccentricity), n, F and rho0 of the projection."""
    flattening = 1.0 / p.inverse_flattening
    e = math.sqrt(flattening * (2.0 - flattening))

    def m(lat):
        return math.cos(lat) / math.sqrt(1.0 - (e * math.sin(lat)) ** 2)

    def t(lat):
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1.0 - s) / (1.0 + s)) ** (e / 2)

    lat1, lat2, lat0 = (math.radians(v) for v in (p.parallel_1, p.parallel_2, p.origin_latitude))
    n = (math.log(m(lat1)) - math.log(m(lat2))) / (math.log(t(lat1)) - math.log(t(lat2)))
    big_f = m(lat1) / (n * t(lat1) ** n)
    return {"e": e, "n": n, "F": big_f, "rho0": p.semi_major * big_f * t(lat0) ** n}


def latitude_series(e: float) -> list[float]:
    """Coefficients a0, a1, ... of latitude = chi + sin(2 chi) (a0 + k (a1 + k (a2 + ...))), k = cos(2 chi).

    chi is the conformal latitude. The series in the third flattening ends after its fifth
    power, which leaves less than 1e-12 degrees on the Earth.
    """
    root = math.sqrt(1.0 - e * e)
    n = (1.0 - root) / (1.0 + root)
    # The published series of multiples of 2 chi.
    d2 = 2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4 + 26 / 45 * n**5
    d4 = 7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4 + 2704 / 315 * n**5
    d6 = 56 / 15 * n**3 - 136 / 35 * n**4 - 1262 / 105 * n**5
    d8 = 4279 / 630 * n**4 - 332 / 35 * n**5
    d10 = 4174 / 315 * n**5
    return [d2 - d6 + d10, 2 * d4 - 4 * d8, 4 * d6 - 12 * d10, 8 * d8, 16 * d10]


def lcc_to_lonlat(
    x: Column,
    y: Column,
    p: ConicProjection = NEW_YORK_LONG_ISLAND_FEET,
    once: Callable[[Column, Callable[[Column], Column]], Column] = lambda value, use: use(value),
) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of projected coordinates, for a cone open to the north.

    The latitude is a closed series of the conformal latitude. ``once`` may bind a value that is
    used several times, where Spark doesn't share equal parts of an expression by itself.
    """
    c = cone_constants(p)
    n, series = c["n"], latitude_series(c["e"])
    east = (x - p.false_easting) * p.unit_in_metres
    north = F.lit(c["rho0"]) - (y - p.false_northing) * p.unit_in_metres
    lon = F.degrees(F.atan2(east, north) / n) + p.central_meridian
    t = F.pow(F.hypot(east, north) / (p.semi_major * c["F"]), F.lit(1.0 / n))

    def latitude(chi: Column) -> Column:
        def corrected(k: Column) -> Column:
            total = F.lit(series[-1])
            for a in reversed(series[:-1]):
                total = total * k + F.lit(a)
            return chi + F.sin(chi * 2) * total

        return once(F.cos(chi * 2), corrected)

    return lon, F.degrees(once(F.lit(math.pi / 2) - F.atan(t) * 2, latitude))

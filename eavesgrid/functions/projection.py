"""Longitude/latitude to Lambert-93 (EPSG:2154) as a closed-form column expression.

Lambert conformal conic with two standard parallels, formulas as published for EPSG method 9802.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import map_points, point

SRID_LAMBERT93 = 2154

# Lambert-93 parameters (degrees, metres) and the GRS80 ellipsoid.
LAT_0, LON_0, LAT_1, LAT_2 = 46.5, 3.0, 49.0, 44.0
X_0, Y_0 = 700000.0, 6600000.0
GRS80_A, GRS80_INV_F = 6378137.0, 298.257222101


def _constants() -> tuple[float, float, float, float]:
    f = 1.0 / GRS80_INV_F
    e = math.sqrt(2 * f - f * f)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi: float) -> float:
        es = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (e / 2)

    p0, p1, p2 = (math.radians(v) for v in (LAT_0, LAT_1, LAT_2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    return e, n, GRS80_A * big_f, GRS80_A * big_f * t(p0) ** n


ECCENTRICITY, CONE, RADIUS_SCALE, RADIUS_ORIGIN = _constants()


def lambert93_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    es = F.lit(ECCENTRICITY) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(ECCENTRICITY / 2))
    r = F.lit(RADIUS_SCALE) * F.pow(t, F.lit(CONE))
    theta = F.lit(CONE) * F.radians(lon - F.lit(LON_0))
    return F.lit(X_0) + r * F.sin(theta), F.lit(Y_0 + RADIUS_ORIGIN) - r * F.cos(theta)


def reproject_lambert93(geom: Column) -> Column:
    """Every vertex from degrees (x = longitude, y = latitude) to Lambert-93 metres."""
    return map_points(geom, lambda p: point(*lambert93_xy(p["x"], p["y"])))

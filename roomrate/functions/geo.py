"""Great-circle distance.

Fixed value that must match the reference's distances: Earth radius
R = 6371 km (the comparables files reproduce with it; 6378.137 does not).
Haversine form, so the anchor itself is exactly 0 km; ``least(1, .)``
guards the ``asin`` against rounding just above 1 for antipodal points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(float(c))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_col(lon2)) - F.radians(_col(lon1))
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def haversine_km_py(lat1: float, lon1: float, lat2: float, lon2: float,
                    radius_km: float = EARTH_RADIUS_KM) -> float:
    """Plain-Python twin, used by tests as brute-force ground truth."""
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * radius_km * math.asin(math.sqrt(min(1.0, h)))

"""Great-circle distance and salary helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference point (Sydney) and earth radius in km.
SYDNEY_LAT = -33.8688
SYDNEY_LON = 151.2093
EARTH_RADIUS_KM = 6371


def distance_from_sydney_km(lat: Column, lon: Column) -> Column:
    """Spherical law of cosines, rounded to whole km.

    A missing point is taken to be Sydney itself (distance 0).  The acos
    argument is clamped to [-1, 1] so rounding can never produce NaN.
    """
    lat0, lon0 = F.radians(F.lit(SYDNEY_LAT)), F.radians(F.lit(SYDNEY_LON))
    la = F.radians(F.coalesce(lat, F.lit(SYDNEY_LAT)))
    lo = F.radians(F.coalesce(lon, F.lit(SYDNEY_LON)))
    cos_c = F.cos(lat0) * F.cos(la) * F.cos(lo - lon0) + F.sin(lat0) * F.sin(la)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos_c))
    return F.round(F.lit(EARTH_RADIUS_KM) * F.acos(clamped), 0)


def mid_salary(min_salary: Column, max_salary: Column) -> Column:
    """``(min + max) / 2``; NULL when either bound is NULL."""
    return (min_salary + max_salary) / F.lit(2.0)

"""Column expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points in degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial course from the first point to the second, 0 to 360."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.when(b != 0, a / b)


def pct_change(now: Column, before: Column) -> Column:
    """Change in percent, null where there is nothing to compare with."""
    return F.when(before != 0, 100.0 * (now - before) / before)


def week_start(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.trunc(day, "week")


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))

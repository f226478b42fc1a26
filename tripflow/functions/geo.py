"""Point columns and great-circle distance, all as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.constants import EARTH_RADIUS_M


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_point(lat: str | Column, lon: str | Column) -> Column:
    """True when both coordinates are present and in range."""
    lat, lon = _col(lat), _col(lon)
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def haversine_m(
    lat1: str | Column,
    lon1: str | Column,
    lat2: str | Column,
    lon2: str | Column,
    radius_m: float = EARTH_RADIUS_M,
) -> Column:
    """Spherical distance in metres between two lat/lon points (degrees)."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    # least() guards asin against a rounding overshoot above 1 for antipodal points
    return F.lit(2.0 * radius_m) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def snap(coord: str | Column, decimals: int = 3) -> Column:
    """Coordinate rounded half away from zero, widened to double first.

    Rounding a float32 value directly gives a different cell than rounding the
    same reading stored as double, so always widen before rounding.
    """
    return F.round(_col(coord).cast("double"), decimals)


def point_text(lat: str | Column, lon: str | Column) -> Column:
    """``"lat,lon"`` text of a point (null when either part is null)."""
    return F.concat(_col(lat).cast("string"), F.lit(","), _col(lon).cast("string"))


def point_part(text: str | Column, index: int) -> Column:
    """Coordinate ``index`` (0 = lat, 1 = lon) back out of ``"lat,lon"`` text;
    null for missing parts or bad text."""
    return F.try_element_at(F.split(_col(text), ","), F.lit(index + 1)).try_cast("double")

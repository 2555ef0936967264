"""Geodesic column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.columns import col_of

EARTH_RADIUS_M = 6378137.0  # fixed value: equatorial radius used for haversine distances


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres between two (lat, lon) in degrees."""
    p1, p2 = F.radians(col_of(lat1)), F.radians(col_of(lat2))
    dp = p2 - p1
    dl = F.radians(col_of(lon2)) - F.radians(col_of(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(a)))

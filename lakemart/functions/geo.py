"""Great-circle distance from built-in trigonometry (stays inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371


def great_circle_km(from_lat: Column, from_lng: Column, to_lat: Column, to_lng: Column) -> Column:
    """Spherical law of cosines. The cosine is clamped to [-1, 1]: rounding can push it outside, where acos is NaN."""
    lat1, lat2 = F.radians(from_lat), F.radians(to_lat)
    turn = F.radians(to_lng) - F.radians(from_lng)
    cosine = F.cos(lat1) * F.cos(lat2) * F.cos(turn) + F.sin(lat1) * F.sin(lat2)
    return F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))) * F.lit(float(EARTH_RADIUS_KM))

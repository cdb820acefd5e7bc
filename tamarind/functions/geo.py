"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: earth radius in km.
EARTH_RADIUS_KM = 6373.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * radius_km) * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - chord)))

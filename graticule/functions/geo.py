"""Great-circle distance on a sphere of radius 6371 km."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def distance_km_np(lat1, lon1, lat2, lon2):
    """Same formula for arrays inside a task."""
    dlat, dlon = np.radians(lat2 - lat1) / 2, np.radians(lon2 - lon1) / 2
    a = np.sin(dlat) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(dlon) ** 2
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(a, 1.0)))

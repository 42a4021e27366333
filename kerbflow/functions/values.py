"""Null handling, ratios, unit-carrying text and ground distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
CAR_LENGTH_M = 4.9


def zero_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def watts(text: Column) -> Column:
    """"100W" or "100 w" to 100.0; null when no number is left."""
    return strip_watt_unit(text).try_cast("double")


def strip_watt_unit(text: Column) -> Column:
    return F.regexp_replace(text, "[Ww ]", "")


def ground_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance in metres between two points given in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    x = F.radians(lon2 - lon1) * F.cos((phi1 + phi2) / 2.0)
    y = phi2 - phi1
    return F.sqrt(x * x + y * y) * F.lit(EARTH_RADIUS_M)


def vehicle_capacity(length_m: Column) -> Column:
    """How many car lengths fit, rounded half up."""
    return F.floor(length_m / F.lit(CAR_LENGTH_M) + F.lit(0.5)).cast("long")

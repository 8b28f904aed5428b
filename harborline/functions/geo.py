"""Distances, bearings and positions along a route."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KM_PER_DEGREE = 111.32
KM_PER_NAUTICAL_MILE = 1.852
EARTH_RADIUS_KM = 6371.0


def _degrees_apart(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = lat2 - lat1, lon2 - lon1
    return F.sqrt(dlat * dlat + dlon * dlon)


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = (lat2 - lat1) * F.lit(KM_PER_DEGREE), (lon2 - lon1) * F.lit(KM_PER_DEGREE)
    return F.sqrt(dlat * dlat + dlon * dlon)


def geo_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, mode: str = "degrees") -> Column:
    """``degrees`` scales plain degree distance by the radius, which is only meaningful in ratios;
    ``haversine`` is the great-circle distance."""
    if mode == "degrees":
        return F.lit(EARTH_RADIUS_KM) * _degrees_apart(lat1, lon1, lat2, lon2)
    if mode != "haversine":
        raise ValueError(f"unknown distance mode {mode!r}")
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def transit_hours(km: Column, knots: Column) -> Column:
    """Sailing time; null at zero speed."""
    return F.try_divide(km, knots * F.lit(KM_PER_NAUTICAL_MILE))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(lon2 - lon1, lat2 - lat1)) + F.lit(360.0), F.lit(360.0))


def manhattan_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.abs(lat1 - lat2) + F.abs(lon1 - lon2)


def unit_interval(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def eta_progress(eta_hours: Column, total_days: Column) -> Column:
    """Share of the voyage done, from the remaining hours; half way when the length is unknown."""
    done = unit_interval(F.lit(1.0) - F.try_divide(eta_hours, total_days * F.lit(24.0)))
    return F.when(total_days > 0, done).otherwise(F.lit(0.5))


def point_on_path(path: Column, progress: Column) -> Column:
    """Struct ``lat, lon`` at ``progress`` (0..1) along an ordered array of points."""
    clamped = unit_interval(progress)
    segments = F.size(path) - F.lit(1)
    segment = F.least(F.floor(clamped * segments).cast("int"), segments - F.lit(1))
    within = clamped * segments - segment
    start, end = F.element_at(path, segment + 1), F.element_at(path, segment + 2)

    def between(axis: str) -> Column:
        return F.round(start[axis] + (end[axis] - start[axis]) * within, 6).alias(axis)

    return F.when(F.size(path) >= 2, F.struct(between("lat"), between("lon")))

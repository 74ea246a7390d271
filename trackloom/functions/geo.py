"""Spherical geometry and grid cells."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column

EARTH_RADIUS_KM = 6371.0


def in_bbox(lat: Column | str, lon: Column | str, box: Mapping[str, float]) -> Column:
    """Inside the box, edges included."""
    return as_column(lat).between(box["lat_min"], box["lat_max"]) & as_column(lon).between(
        box["lon_min"], box["lon_max"]
    )


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Great-circle distance. The root is clamped to 1 so antipodes cannot give NaN."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = F.radians(as_column(lon2) - as_column(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), 2.0) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_dlambda), 2.0
    )
    # greatest/least skip nulls, so a missing coordinate has to be kept by hand
    clamped = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped))


def bearing_deg(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Initial course from the first point to the second, 0 up to 360 degrees."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    dlambda = F.radians(as_column(lon2) - as_column(lon1))
    east = F.sin(dlambda) * F.cos(phi2)
    north = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlambda)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def interpolate_position(
    lat1: Column | str,
    lon1: Column | str,
    lat2: Column | str,
    lon2: Column | str,
    progress: Column | str,
) -> tuple[Column, Column]:
    """Latitude and longitude at a share of the straight way between two points."""
    share = as_column(progress)

    def between(a, b):
        return as_column(a) + (as_column(b) - as_column(a)) * share

    return between(lat1, lat2), between(lon1, lon2)


def grid_bin(c: Column | str, degrees: float = 0.5) -> Column:
    """Centre of the grid line nearest to the coordinate."""
    return F.round(as_column(c) / degrees) * degrees


def grid_key(lat_bin: Column | str, lon_bin: Column | str) -> Column:
    return F.concat_ws(",", as_column(lat_bin), as_column(lon_bin))

"""Map projection, distances and grid cells as Column expressions (JVM only, no UDF).

Every function takes Columns or numbers and returns a Column or a pair of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84 axis and flattening, UTM scale, metres of a degree.
SEMI_MAJOR, FLATTENING, UTM_SCALE = 6378137.0, 1 / 298.257223563, 0.9996
EARTH_RADIUS, LAT_METRES, LON_METRES = 6371000.0, 110540.0, 111320.0
GRID_STEP = 0.001

_E2 = 2 * FLATTENING - FLATTENING**2
_EP2 = _E2 / (1 - _E2)
_N = (1 - math.sqrt(1 - _E2)) / (1 + math.sqrt(1 - _E2))
#: Series of the meridian arc: factors of phi, -sin 2phi, sin 4phi, -sin 6phi.
_ARC = (
    1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256,
    3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024,
    15 * _E2**2 / 256 + 45 * _E2**3 / 1024,
    35 * _E2**3 / 3072,
)
#: Series of the footpoint latitude: factors of sin 2mu, 4mu, 6mu, 8mu.
_FOOT = (3 * _N / 2 - 27 * _N**3 / 32, 21 * _N**2 / 16 - 55 * _N**4 / 32, 151 * _N**3 / 96, 1097 * _N**4 / 512)

Number = Column | float | int


def _c(x: Number) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def utm_zone(epsg: Column) -> tuple[Column, Column]:
    """Zone number and whether it is on the northern half, of a UTM EPSG code."""
    return F.pmod(epsg, F.lit(100)), epsg < 32700


def _central_meridian(zone: Column) -> Column:
    return F.radians((zone - 1) * 6.0 - 177.0)


def to_utm(lon: Number, lat: Number, zone: Number, north: Column | bool) -> tuple[Column, Column]:
    """Easting and northing in metres of a point in degrees."""
    north = north if isinstance(north, Column) else F.lit(north)
    phi = F.radians(_c(lat))
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    radius = SEMI_MAJOR / F.sqrt(1 - _E2 * sin * sin)
    t, c, a = tan * tan, _EP2 * cos * cos, cos * (F.radians(_c(lon)) - _central_meridian(_c(zone)))
    arc = SEMI_MAJOR * (_ARC[0] * phi - _ARC[1] * F.sin(2 * phi) + _ARC[2] * F.sin(4 * phi) - _ARC[3] * F.sin(6 * phi))
    east = UTM_SCALE * radius * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * _EP2) * F.pow(a, 5) / 120) + 500000.0
    rise = a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * _EP2) * F.pow(a, 6) / 720
    return east, UTM_SCALE * (arc + radius * tan * rise) + F.when(north, 0.0).otherwise(10000000.0)


def from_utm(east: Number, northing: Number, zone: Number, north: Column | bool) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a UTM point."""
    north = north if isinstance(north, Column) else F.lit(north)
    y = _c(northing) - F.when(north, 0.0).otherwise(10000000.0)
    mu = y / UTM_SCALE / (SEMI_MAJOR * _ARC[0])
    phi = mu
    for k, factor in enumerate(_FOOT, 1):
        phi = phi + factor * F.sin(2 * k * mu)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    es = _E2 * sin * sin
    radius, t, c = SEMI_MAJOR / F.sqrt(1 - es), tan * tan, _EP2 * cos * cos
    curve = SEMI_MAJOR * (1 - _E2) / F.pow(1 - es, 1.5)
    d = (_c(east) - 500000.0) / (radius * UTM_SCALE)
    fall = d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * _EP2) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * _EP2 - 3 * c * c) * F.pow(d, 6) / 720
    aside = (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * _EP2 + 24 * t * t) * F.pow(d, 5) / 120) / cos
    return F.degrees(_central_meridian(_c(zone)) + aside), F.degrees(phi - radius * tan / curve * fall)


def epsg_of_tile(grid: Column) -> Column:
    """UTM EPSG code of an MGRS tile code, with or without ``MGRS-``: zone digits, then a band letter, from N on north."""
    bare = F.regexp_replace(grid, "^MGRS-", "")
    band = F.regexp_extract(bare, "^[0-9]*([^0-9])", 1)
    zone = F.regexp_extract(bare, "^([0-9]*)", 1)
    return F.when((band == "") | (band >= "N"), 32600).otherwise(32700) + F.coalesce(zone.try_cast("int"), F.lit(0))


def lat_degrees(metres: Number) -> Column:
    return _c(metres) / LAT_METRES


def lon_degrees(metres: Number, lat: Number) -> Column:
    return _c(metres) / (LON_METRES * F.cos(F.radians(_c(lat))))


def pad_box(west: Column, south: Column, east: Column, north: Column, km: float) -> tuple[Column, Column, Column, Column]:
    """The box with ``km`` more on each side, at 111 km a degree and the latitude of its middle."""
    if km == 0:
        return west, south, east, north
    up = km / 111.0
    aside = km / (111.0 * F.cos(F.radians((south + north) / 2)))
    return west - aside, south - up, east + aside, north + up


def box_area_km2(west: Column, south: Column, east: Column, north: Column) -> Column:
    return (north - south) * 111.0 * (east - west) * 111.0 * F.cos(F.radians((south + north) / 2))


def cell(x: Number) -> Column:
    """Integer grid cell of a coordinate, ties away from zero."""
    scaled = _c(x) / GRID_STEP
    return (F.signum(scaled) * F.floor(F.abs(scaled) + 0.5)).cast("long")


def cell_key(lon: Number, lat: Number) -> Column:
    """Printed cell, three decimals each."""
    return F.format_string("%.3f,%.3f", cell(lon) * GRID_STEP, cell(lat) * GRID_STEP)


def arc_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a sphere for near points: what clustering measures with."""
    dy, dx = F.radians(lat2 - lat1), F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) * 0.5))
    return EARTH_RADIUS * F.sqrt(dy * dy + dx * dx)


def offset_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> tuple[Column, Column]:
    """East and north metres from the first point to the second: what triage measures with."""
    return (lon2 - lon1) * LON_METRES * F.cos(F.radians((lat1 + lat2) / 2)), (lat2 - lat1) * LAT_METRES


def plane_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return F.hypot(*offset_metres(lon1, lat1, lon2, lat2))


def angle_between(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Unsigned angle of two vectors in degrees; null if one has no length."""
    a, b = F.hypot(ax, ay), F.hypot(bx, by)
    there = (a > 0) & (b > 0)
    cosine = (ax * bx + ay * by) / F.when(there, a * b)
    return F.when(there, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment; a segment without length is its point."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    at = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(square > 0, square)))).otherwise(0.0)
    return F.hypot(px - ax - at * dx, py - ay - at * dy)

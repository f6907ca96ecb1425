"""Distances, bounding boxes and the latitude-aware grid used as join key."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180
# Sanity box around Germany as west, south, east, north.
GERMANY = (5.87, 47.27, 15.04, 55.06)


def rad(degrees: Column) -> Column:
    return degrees * F.lit(math.pi) / F.lit(180.0)


def haversine_m(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column, radius: float = EARTH_RADIUS_M) -> Column:
    half_lat = F.sin(rad(lat_b - lat_a) / 2)
    half_lng = F.sin(rad(lng_b - lng_a) / 2)
    h = half_lat * half_lat + F.cos(rad(lat_a)) * F.cos(rad(lat_b)) * half_lng * half_lng
    return F.lit(2 * radius) * F.asin(F.sqrt(h))


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    return haversine_m(lat_a, lng_a, lat_b, lng_b, EARTH_RADIUS_M / 1000)


def anchor_distance2(lng: Column, lat: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Squared distance in degrees to the centre of a box, longitude shrunk by latitude."""
    d_lng = (lng - (w + e) / 2) * F.cos(rad(lat))
    d_lat = lat - (s + n) / 2
    return d_lng * d_lng + d_lat * d_lat


def in_box(lng: Column, lat: Column, w, s, e, n) -> Column:
    return lng.between(w, e) & lat.between(s, n)


def in_germany(lng: Column, lat: Column) -> Column:
    w, s, e, n = GERMANY
    return in_box(lng, lat, F.lit(w), F.lit(s), F.lit(e), F.lit(n))


def parse_coordinate(text: Column) -> Column:
    """Leading number of a text, as a lenient float parser reads it; otherwise null."""
    return F.regexp_extract(text, r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)", 1).try_cast("double")


def valid_point(lng: Column, lat: Column) -> Column:
    finite = lng.isNotNull() & lat.isNotNull() & ~F.isnan(lng) & ~F.isnan(lat)
    return F.coalesce(finite & lng.between(-180, 180) & lat.between(-90, 90), F.lit(False))


# The grid. Rows are bands of constant height in degrees; within a band the
# columns widen with latitude. A point lies in one cell; a disc of the radius
# touches about four cells of twice its size.


def grid_step(radius_m: float) -> float:
    """Half a cell height in degrees: the radius with a small safety margin."""
    return radius_m / METRES_PER_DEGREE * 1.001


def _column_width(row: Column, step: float) -> Column:
    edge = F.greatest(F.abs(row), F.abs(row + 1)) * F.lit(2 * step)
    return F.lit(2 * step) / F.cos(rad(F.least(edge, F.lit(89.0))))


def cell_of(lng: Column, lat: Column, step: float) -> list[Column]:
    row = F.floor(lat / F.lit(2 * step))
    return [row.alias("cell_row"), F.floor(lng / _column_width(row, step)).alias("cell_col")]


def cells_around(lng: Column, lat: Column, step: float) -> Column:
    """Array of all cells that a disc of the grid's radius can touch."""
    reach = F.lit(step) / F.cos(rad(F.least(F.abs(lat) + F.lit(step), F.lit(89.0))))
    rows = F.sequence(F.floor((lat - F.lit(step)) / F.lit(2 * step)), F.floor((lat + F.lit(step)) / F.lit(2 * step)))

    def columns(row: Column) -> Column:
        width = _column_width(row, step)
        cols = F.sequence(F.floor((lng - reach) / width), F.floor((lng + reach) / width))
        return F.transform(cols, lambda col: F.struct(row.alias("cell_row"), col.alias("cell_col")))

    return F.flatten(F.transform(rows, columns))


def tile_of(value: Column, step: float) -> Column:
    return F.floor(value / F.lit(step)) * F.lit(step)

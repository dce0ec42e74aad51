"""Great-circle distance, bounding boxes and a latitude/longitude grid, as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import DISTANCE_BANDS, EARTH_RADIUS

# Widens boxes and cell ranges a little, so that rounding can only add candidates and never lose one.
SLACK = 1e-7


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance in metres; NULL when any coordinate is NULL."""
    lat1, lng1, lat2, lng2 = (F.radians(x) for x in (lat1, lng1, lat2, lng2))
    half = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2.0)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lng2 - lng1) / 2), F.lit(2.0)
    )
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(half))


def near_box(lat: Column, lng: Column, at_lat: float, at_lng: float, metres: float) -> Column:
    """Cheap predicate that holds for every point within ``metres`` of the given one; it reaches the scan."""
    reach = math.degrees(metres / EARTH_RADIUS) + SLACK
    box = lat.between(at_lat - reach, at_lat + reach)
    if abs(at_lat) + reach >= 90:  # the circle holds a pole: every longitude can be inside
        return box
    spread = math.degrees(math.asin(math.sin(math.radians(reach)) / math.cos(math.radians(at_lat)))) + SLACK
    west, east = at_lng - spread, at_lng + spread
    if west < -180:
        return box & ((lng >= west + 360) | (lng <= east))
    if east > 180:
        return box & ((lng >= west) | (lng <= east - 360))
    return box & lng.between(west, east)


def distance_band(distance: Column) -> Column:
    out = F.when(distance <= DISTANCE_BANDS[0][0], DISTANCE_BANDS[0][1])
    for limit, label in DISTANCE_BANDS[1:]:
        out = out.when(distance <= limit, label)
    return out


def _band(lat: Column, step: float) -> Column:
    return F.floor((lat + 90) / step)


def _cells_around(band: Column, step: float) -> Column:
    """Number of cells in a latitude band, such that none is wider than the band is high."""
    south, north = band * step - 90, (band + 1) * step - 90
    widest = F.when(south > 0, south).when(north < 0, north).otherwise(0.0)
    return F.greatest(F.lit(1).cast("long"), F.ceil(360 * F.cos(F.radians(widest)) / step))


def home_cell(lat: Column, lng: Column, side: float) -> Column:
    """Grid cell ``struct(band, slot)`` of a point. Any two points of a cell are at most 2 * side metres apart."""
    step = math.degrees(side / EARTH_RADIUS)
    band = _band(lat, step)
    cells = _cells_around(band, step)
    return F.struct(band.alias("band"), F.pmod(F.floor((lng + 180) / 360 * cells), cells).alias("slot"))


def wholly_within(lat: Column, lng: Column, band: Column, slot: Column, side: float, metres: float) -> Column:
    """Whether every point of a grid cell is surely within ``metres``: its corners are, and it does not reach round to
    the far side of the globe, where its inside can be farther away than its corners."""
    step = math.degrees(side / EARTH_RADIUS)
    cells = _cells_around(band, step)
    south, west, width = band * step - 90, slot / cells * 360 - 180, 360 / cells
    near = (cells >= 8) & (F.abs(F.pmod(west + width / 2 - lng + 540, F.lit(360)) - 180) < 90)
    for corner_lat in (F.greatest(south, F.lit(-90.0)), F.least(south + step, F.lit(90.0))):
        for corner_lng in (west, west + width):
            near = near & (haversine(lat, lng, corner_lat, corner_lng) <= metres * (1 - SLACK))
    return near


def reached_cells(lat: Column, lng: Column, side: float, metres: float) -> Column:
    """Array of every grid cell that can hold a point within ``metres``, poles and date line included."""
    step = math.degrees(side / EARTH_RADIUS)
    reach = math.degrees(metres / EARTH_RADIUS) + SLACK
    ratio = F.lit(math.sin(math.radians(min(reach, 90.0)))) / F.cos(F.radians(lat))
    spread = F.when(F.abs(lat) + reach >= 90, 180.0).otherwise(F.degrees(F.asin(ratio)) + SLACK)

    def slots(band: Column) -> Column:
        cells = _cells_around(band, step)
        first = F.floor((lng - spread + 180) / 360 * cells)
        last = F.least(F.floor((lng + spread + 180) / 360 * cells), first + cells - 1)
        return F.transform(
            F.sequence(first, last),
            lambda slot: F.struct(band.alias("band"), F.pmod(slot, cells).alias("slot")),
        )

    bands = F.sequence(_band(F.greatest(lat - reach, F.lit(-90.0)), step), _band(F.least(lat + reach, F.lit(90.0)), step))
    return F.flatten(F.transform(bands, slots))

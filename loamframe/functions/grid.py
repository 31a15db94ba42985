"""Latitude bands cut into cells of about a search radius, which turn distance
searches into equi-joins (``band`` ... ``search_cells``)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamframe.constants import EARTH_RADIUS_KM

KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180.0


def band(lat: Column, radius_km: Column) -> Column:
    return F.floor((lat + 90.0) * KM_PER_DEGREE / radius_km)


def _edges(b: Column, radius_km: Column) -> tuple[Column, Column]:
    """Absolute latitudes of a band's border nearer to and farther from the equator."""
    height = radius_km / KM_PER_DEGREE
    south, north = F.abs(b * height - 90.0), F.abs((b + 1) * height - 90.0)
    return F.least(south, north), F.least(F.lit(90.0), F.greatest(south, north))


def band_cells(b: Column, radius_km: Column) -> Column:
    """Number of cells in a band; each is at least a radius wide."""
    far = _edges(b, radius_km)[1]
    return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(far)) * KM_PER_DEGREE / radius_km))


def band_cell(lon: Column, cells: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) / 360.0 * cells), cells)


def cell_span_km(b: Column, cells: Column, radius_km: Column) -> Column:
    """Bound on the distance of two points in one cell of the band.

    Half the chord between two points, over the earth's radius, is at most the
    diagonal of half the band's height and half the cell's greatest width.
    """
    height = radius_km / KM_PER_DEGREE
    crosses_equator = (b * height - 90.0 < 0) & ((b + 1) * height - 90.0 > 0)
    near = F.when(crosses_equator, 0.0).otherwise(_edges(b, radius_km)[0])
    width = 2.0 * math.pi * EARTH_RADIUS_KM * F.cos(F.radians(near)) / cells
    half_chord = F.hypot(radius_km, width) / (2.0 * EARTH_RADIUS_KM)
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), half_chord)) * (1 + 1e-9)


def search_cells(lat: Column, lon: Column, grid_km: Column, radius_km: Column) -> Column:
    """array<struct<band, cell>> that hold everything within ``radius_km``.

    Needs ``radius_km <= grid_km``, so the own and the two next bands suffice.
    """
    own = band(lat, grid_km)
    angle = radius_km / EARTH_RADIUS_KM
    ratio = F.try_divide(F.sin(angle), F.cos(F.radians(lat)))
    around_pole = (ratio >= 1.0) | ratio.isNull() | (angle >= math.pi / 2)
    reach = F.when(around_pole, 180.0).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0))))) + 1e-9

    def in_band(step: Column) -> Column:
        b = own + step
        cells = band_cells(b, grid_km)
        first = F.floor((lon - reach + 180.0) / 360.0 * cells)
        last = F.floor((lon + reach + 180.0) / 360.0 * cells)
        span = F.sequence(first, F.least(last, first + cells - 1))
        return F.transform(span, lambda c: F.struct(b.alias("band"), F.pmod(c, cells).alias("cell")))

    return F.flatten(F.transform(F.array(*[F.lit(s).cast("long") for s in (-1, 0, 1)]), in_band))

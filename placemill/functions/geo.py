"""Geometry expressions on lon/lat doubles: distances, search cells, tile indexes, numeric parsing."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill import vocab

_NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*\z"


def parse_degrees(c: Column) -> Column:
    """Text to double; anything that is not a plain number gives NULL."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def equirectangular_m(lon: Column, lat: Column, other_lon: Column, other_lat: Column) -> Column:
    """Metres on a local flat map scaled at the *first* point's latitude."""
    return F.sqrt(
        F.pow((other_lon - lon) * vocab.METRES_PER_DEGREE_LON * F.cos(F.radians(lat)), F.lit(2))
        + F.pow((other_lat - lat) * vocab.METRES_PER_DEGREE_LAT, F.lit(2))
    )


@dataclass(frozen=True)
class Degrees:
    """Planar distance in degrees, at most ``radius`` (inclusive)."""

    radius: float

    def within(self, lon: Column, lat: Column, other_lon: Column, other_lat: Column) -> Column:
        dx, dy = other_lon - lon, other_lat - lat
        return dx * dx + dy * dy <= F.lit(self.radius * self.radius)

    @property
    def reach_lat(self) -> float:
        return self.radius

    def lon_span(self, length: float, cos_lat: Column) -> Column:
        return F.lit(length)


@dataclass(frozen=True)
class Metres:
    """Equirectangular distance in metres, at most ``radius`` (inclusive)."""

    radius: float

    def within(self, lon: Column, lat: Column, other_lon: Column, other_lat: Column) -> Column:
        return equirectangular_m(lon, lat, other_lon, other_lat) <= F.lit(float(self.radius))

    @property
    def reach_lat(self) -> float:
        return self.radius / vocab.METRES_PER_DEGREE_LAT

    def lon_span(self, length: float, cos_lat: Column) -> Column:
        return F.least(F.lit(360.0), F.lit(length / vocab.METRES_PER_DEGREE_LON) / cos_lat)


class SearchGrid:
    """Square cells whose side is a share of the radius.

    Rows have equal height; the cell width follows the latitude of the row, so there are as few cells to search as
    possible from the equator to the poles. With a side of ``TOGETHER`` any two points of one cell are within the radius.
    """

    TOGETHER = 0.999 / math.sqrt(2)  # a little less than the half diagonal, so that rounding cannot break the promise
    _GROW = 1.001                    # keeps rounding from missing a cell at the rim

    def __init__(self, metric: Degrees | Metres, side: float):
        self.metric, self.side = metric, side
        self.height = metric.reach_lat * side
        self.reach = metric.reach_lat * self._GROW

    def _edge_cos(self, row: Column) -> tuple[Column, Column]:
        lower, upper = F.abs(row * F.lit(self.height)), F.abs((row + 1) * F.lit(self.height))
        pole, floor = F.lit(90.0), F.lit(1e-12)
        return (F.greatest(F.cos(F.radians(F.least(lower, upper, pole))), floor),
                F.greatest(F.cos(F.radians(F.least(F.greatest(lower, upper), pole))), floor))

    def row(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.height))

    def column(self, lon: Column, row: Column) -> Column:
        widest_cos, _ = self._edge_cos(row)
        return F.floor(lon / self.metric.lon_span(self.metric.radius * self.side, widest_cos))

    def rows_near(self, lat: Column) -> Column:
        return F.sequence(self.row(lat - F.lit(self.reach)), self.row(lat + F.lit(self.reach)))

    def columns_near(self, lon: Column, row: Column) -> Column:
        _, narrowest_cos = self._edge_cos(row)
        reach = self.metric.lon_span(self.metric.radius * self._GROW, narrowest_cos)
        return F.sequence(self.column(lon - reach, row), self.column(lon + reach, row))


def is_point(lon: Column, lat: Column) -> Column:
    """Both coordinates present and finite; never NULL."""
    finite = lambda c: F.coalesce(F.abs(c) < F.lit(math.inf), F.lit(False))  # noqa: E731  NaN sorts above infinity
    return finite(lon) & finite(lat)


def tile_x(lon: Column, zoom: int) -> Column:
    n = 1 << zoom
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((lon + 180.0) / 360.0 * F.lit(float(n)))))


def tile_y(lat: Column, zoom: int) -> Column:
    n = 1 << zoom
    phi = F.radians(F.greatest(F.lit(-85.0511287798), F.least(F.lit(85.0511287798), lat)))
    rel = (F.lit(1.0) - F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)) / F.lit(2.0)
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(rel * F.lit(float(n)))))

"""Points, distances and the latitude/longitude grid, as column expressions.

A point is a pair of double columns ``lon``, ``lat`` in degrees. Everything
here stays inside whole-stage code generation; there is no Python UDF.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
_WKT_NUMBER = r"([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"
_WKT_POINT = rf"^\s*POINT\s*\(\s*{_WKT_NUMBER}\s+{_WKT_NUMBER}\s*\)\s*$"


def haversine_m(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, earth_radius_m: float = EARTH_RADIUS_M
) -> Column:
    """Great-circle distance in metres; NULL if any coordinate is NULL."""
    half_dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = F.pow(half_dlat, F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_dlon, F.lit(2.0))
    # antipodal points can push h a rounding error above one; least() alone
    # would turn a NULL coordinate into a distance
    metres = F.lit(2.0 * earth_radius_m) * F.asin(F.least(F.sqrt(h), F.lit(1.0)))
    known = lon1.isNotNull() & lat1.isNotNull() & lon2.isNotNull() & lat2.isNotNull()
    return F.when(known, metres)


def within_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius_m: float) -> Column:
    """True where the two points are at most ``radius_m`` apart (inclusive)."""
    return haversine_m(lon1, lat1, lon2, lat2) <= F.lit(float(radius_m))


def point_wkt(lon: Column, lat: Column) -> Column:
    """``POINT(lon lat)`` text; NULL if a coordinate is NULL."""
    return F.concat(
        F.lit("POINT("), lon.cast("double").cast("string"), F.lit(" "), lat.cast("double").cast("string"), F.lit(")")
    )


def _wkt_part(wkt: Column, group: int) -> Column:
    text = F.regexp_extract(wkt, _WKT_POINT, group)
    return F.when(text != "", text.try_cast("double"))


def wkt_lon(wkt: Column) -> Column:
    """Longitude of a ``POINT(lon lat)`` text, NULL for any other text."""
    return _wkt_part(wkt, 1)


def wkt_lat(wkt: Column) -> Column:
    """Latitude of a ``POINT(lon lat)`` text, NULL for any other text."""
    return _wkt_part(wkt, 2)


def valid_point(lon: Column, lat: Column) -> Column:
    """True for a usable pair: NULL and NaN never take part in a distance join."""
    return lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)


@dataclass(frozen=True)
class Grid:
    """Latitude bands cut into longitude cells, each about ``radius_m`` wide.

    Every point lies in exactly one cell. ``reached_cells`` lists, without
    repeats, every cell that holds any point within the radius, also across
    the antimeridian and over a pole. So a radius join is an equi-join on the
    cell followed by the exact distance test. Cell widths only affect speed.
    """

    radius_m: float

    def __post_init__(self) -> None:
        if not 0 <= self.radius_m < EARTH_RADIUS_M * math.pi / 2:
            raise ValueError(f"radius_m must lie in [0, a quarter circumference), not {self.radius_m}")

    @property
    def _angle(self) -> float:
        return self.radius_m / EARTH_RADIUS_M

    @property
    def reach_deg(self) -> float:
        """Latitude reach of the radius, with slack for rounding."""
        return math.degrees(self._angle) * (1 + 1e-9) + 1e-9

    @property
    def band_deg(self) -> float:
        return max(self.reach_deg * (1 + 1e-6), 1e-5)

    def band(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.band_deg))

    def cells_in(self, band: Column) -> Column:
        """Number of cells round the globe in a band."""
        edge = F.least(
            F.greatest(F.abs(band * F.lit(self.band_deg)), F.abs((band + 1) * F.lit(self.band_deg))), F.lit(89.9)
        )
        sine = F.least(F.lit(1.0), F.lit(math.sin(self._angle)) / F.cos(F.radians(edge)))
        width = F.greatest(F.degrees(F.asin(sine)) * F.lit(1 + 1e-6), F.lit(1e-5))
        return F.greatest(F.lit(1).cast("long"), F.floor(F.lit(360.0) / width))

    def cell_at(self, lon: Column, cells: Column) -> Column:
        """Cell number before wrapping round the globe."""
        return F.floor((lon + F.lit(180.0)) / (F.lit(360.0) / cells))

    def lon_reach(self, lat: Column) -> Column:
        """Largest longitude difference of any point within the radius."""
        sine = F.lit(math.sin(self._angle)) / F.cos(F.radians(lat))
        # cos(90 degrees) is a tiny positive double, so the quotient exists;
        # a circle that holds a pole reaches every longitude
        return F.when(
            (sine < 1.0) & (F.abs(lat) + F.lit(self.reach_deg) < 90.0),
            F.degrees(F.asin(F.least(sine, F.lit(1.0)))) * F.lit(1 + 1e-9) + F.lit(1e-8),
        ).otherwise(F.lit(180.0))

    def reached_bands(self, lat: Column) -> Column:
        reach = F.lit(self.reach_deg)
        return F.sequence(self.band(lat - reach), self.band(lat + reach))

    def reached_cells(self, lon: Column, lat: Column, cells: Column) -> Column:
        """Array of wrapped cell numbers of one band; a run of at most
        ``cells`` neighbours, so no number repeats."""
        reach = self.lon_reach(lat)
        first = self.cell_at(lon - reach, cells)
        last = self.cell_at(lon + reach, cells)
        run = F.sequence(first, F.least(last, first + cells - 1))
        return F.transform(run, lambda c: F.pmod(c, cells))

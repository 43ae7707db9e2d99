"""Column-level functions: geography and feature expressions."""

from tatemono.functions.features import (
    addr_group,
    age_years,
    area_recover,
    growth_rate,
    interaction,
    station_recover,
    unit_price,
    walk_recover,
    ym_to_months,
)
from tatemono.functions.geo import (
    EARTH_RADIUS_M,
    haversine_m,
    point_wkt,
    wkt_lat,
    wkt_lon,
    within_m,
)

__all__ = [
    "EARTH_RADIUS_M",
    "addr_group",
    "age_years",
    "area_recover",
    "growth_rate",
    "haversine_m",
    "interaction",
    "point_wkt",
    "station_recover",
    "unit_price",
    "walk_recover",
    "within_m",
    "wkt_lat",
    "wkt_lon",
    "ym_to_months",
]

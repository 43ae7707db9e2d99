"""Nearest station, nearest land price and the feature mart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tatemono.functions import age_years, growth_rate, station_recover, walk_recover
from tatemono.operators.geojoin import nearest_within
from tatemono.operators.joins import lookup_join
from tatemono.operators.parallel import side_by_side
from tatemono.operators.rows import tagged_union
from tatemono.plans.staging import YEARS
from tatemono.sources import scratch

RADIUS_M = 5000.0

# The columns of the mart and of the listings it starts from.
MART_COLUMNS = [
    "id", "data_type", "target_price", "house_area", "floor_count", "building_age", "lon", "lat",
    "building_id", "full_address", "addr_group", "station_name", "city_name", "final_walk_dist",
    "nearest_land_price", "land_growth_rate",
]
_BASE_COLUMNS = [
    "id", "data_type", "target_price", "house_area", "floor_count", "year_built", "target_ym", "full_address",
    "addr_group", "eki_name_raw", "walk_dist_raw", "lon", "lat", "building_id",
]


def base_records(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training and test listings in one table; test rows have no price."""
    return tagged_union({"train": train, "test": test}, "data_type").select(*_BASE_COLUMNS)


def buildings_by_type(train: DataFrame, test: DataFrame) -> DataFrame:
    """Distinct building points, tagged by the table they come from."""
    point = ["building_id", "lon", "lat"]
    return tagged_union(
        {"train": train.select(*point).distinct(), "test": test.select(*point).distinct()}, "data_type"
    )


def buildings(train: DataFrame, test: DataFrame) -> DataFrame:
    """Distinct building points over both tables."""
    point = ["building_id", "lon", "lat"]
    return train.select(*point).unionByName(test.select(*point)).distinct()


def nearest_station(buildings_by_type: DataFrame, stations: DataFrame, radius_m: float = RADIUS_M) -> DataFrame:
    """Nearest station per building and table, within the radius."""
    return nearest_within(
        buildings_by_type,
        stations,
        keys=["building_id", "data_type"],
        radius_m=radius_m,
        tiebreak=["station_name", "city_name"],
        distance="recovered_walk_dist",
    ).select("building_id", "data_type", "station_name", "city_name", "recovered_walk_dist")


def nearest_land(
    buildings: DataFrame, land_prices: DataFrame, radius_m: float = RADIUS_M, years: Sequence[int] = YEARS
) -> DataFrame:
    """Price and growth of the nearest land point per building. The point is
    chosen by distance alone, so its price may be NULL."""
    latest, base = f"price_{years[0]}", f"price_{years[1]}"
    near = nearest_within(
        buildings,
        land_prices.select("podb_land_price_id", "land_lon", "land_lat", latest, base),
        keys=["building_id"],
        radius_m=radius_m,
        tiebreak=["podb_land_price_id"],
        right_point=("land_lon", "land_lat"),
    )
    return near.select(
        "building_id",
        F.col(latest).alias("nearest_land_price"),
        F.col(base).alias(f"land_{base}"),
        growth_rate(F.col(latest), F.col(base)).alias("land_growth_rate"),
    )


def listing_points(base: DataFrame) -> DataFrame:
    """Stored table of the distinct building points of each table, with the
    number of listings at each."""
    counted = base.groupBy("building_id", "data_type", "lon", "lat").agg(F.count(F.lit(1)).alias("listings"))
    return scratch.store(counted, "points")


def join_models(base: DataFrame, points: DataFrame, station: DataFrame, land: DataFrame) -> DataFrame:
    """The feature mart, one row per listing.

    Everything that depends on the building alone is brought together per
    building first and joined once, so that the listings are shuffled once at
    most.
    """
    per_building = scratch.store(
        points.where(F.col("building_id").isNotNull())
        .groupBy("building_id", "data_type")
        .agg(F.sum("listings").alias("listings"))
        .join(station.withColumnRenamed("station_name", "nearest_station"), ["building_id", "data_type"], "left")
        .join(land.select("building_id", "nearest_land_price", "land_growth_rate"), "building_id", "left"),
        "per_building",
    )
    joined = lookup_join(base, per_building, ["building_id", "data_type"], spread_by=["id"], count="listings")
    return joined.withColumns(
        {
            "building_age": age_years(F.col("target_ym"), F.col("year_built")),
            "station_name": station_recover(F.col("eki_name_raw"), F.col("nearest_station")),
            "final_walk_dist": walk_recover(F.col("walk_dist_raw"), F.col("recovered_walk_dist")),
        }
    ).select(*MART_COLUMNS)


def mart(
    train: DataFrame,
    test: DataFrame,
    stations: DataFrame,
    land_prices: DataFrame,
    radius_m: float = RADIUS_M,
    years: Sequence[int] = YEARS,
    write: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The feature mart from the staged tables. ``write`` may store the two
    lookups, ``nearest_station`` and ``nearest_land``, on the way."""
    base = base_records(train, test)
    points = listing_points(base)
    distinct_points = points.select("building_id", "lon", "lat").distinct()
    keep = write or (lambda df, name: df)
    station, land = side_by_side(
        base.sparkSession,
        [
            lambda: keep(nearest_station(points, stations, radius_m), "nearest_station"),
            lambda: keep(nearest_land(distinct_points, land_prices, radius_m, years), "nearest_land"),
        ],
    )
    return join_models(base, points, station, land)


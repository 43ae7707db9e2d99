"""Staged tables: typed, renamed, with recovered areas and address groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.functions import addr_group, area_recover, wkt_lat, wkt_lon
from tatemono.operators.rows import conditional_pivot, global_row_number
from tatemono.sources import scratch
from tatemono.sources.readers import ROW_ADDRESS

# The land-price class and the research years that are read.
RESIDENTIAL = "住宅地"
YEARS = (2025, 2023, 2021)


def _listing(lenient: bool) -> list[Column]:
    def cast(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind) if lenient else F.col(name).cast(kind)

    return [
        cast("building_id", "string").alias("building_id"),
        area_recover(
            cast("unit_area", "double"), cast("unit_area_min", "double"), cast("unit_area_max", "double")
        ).alias("house_area"),
        cast("floor_count", "double").alias("floor_count"),
        cast("year_built", "int").alias("year_built"),
        cast("target_ym", "int").alias("target_ym"),
        cast("full_address", "string").alias("full_address"),
        addr_group(F.col("full_address")).alias("addr_group"),
        cast("lon", "double").alias("lon"),
        cast("lat", "double").alias("lat"),
        cast("eki_name1", "string").alias("eki_name_raw"),
        cast("walk_distance1", "double").alias("walk_dist_raw"),
    ]


_TRAIN_COLUMNS = [
    "id", "building_id", "target_price", "house_area", "floor_count", "year_built", "target_ym",
    "full_address", "addr_group", "lon", "lat", "eki_name_raw", "walk_dist_raw",
]
# Sort order of the training ids: the two declared keys, then the rest of the
# row, so that equal ids can only fall on equal rows.
_TRAIN_ORDER = [
    "building_id", "full_address", "target_price", "house_area", "floor_count", "year_built", "target_ym",
    "lon", "lat", "eki_name_raw", "walk_dist_raw",
]


def type_train(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Typed training rows without an id."""
    price = F.col("money_room").try_cast("double") if lenient else F.col("money_room").cast("double")
    address = [c for c in ROW_ADDRESS if c in raw.columns]
    return raw.select(price.alias("target_price"), *_listing(lenient), *address)


def stage_train(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Training listings. They carry no id, so the row number in the order of
    building and address becomes one. The rows are sorted and stored at once,
    when this is called; the result scans that table.

    ``lenient`` turns values of the wrong type into NULL instead of an error.
    """
    staged = type_train(raw, lenient)
    address = [c for c in ROW_ADDRESS if c in raw.columns]
    order = [F.col(c).asc_nulls_last() for c in [*_TRAIN_ORDER, *address]]
    numbered = global_row_number(staged, order, "_number", "train")
    return numbered.withColumn("id", F.col("_number").cast("string")).select(*_TRAIN_COLUMNS)


def stage_test(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Test listings, with the raw town name."""
    return raw.select(
        F.col("id").cast("string").alias("id"),
        *_listing(lenient),
        F.col("addr2_name").cast("string").alias("town_name_raw"),
    )


def stage_stations(raw: DataFrame) -> DataFrame:
    """Station points."""
    return raw.select(
        "station_name", "city_name", F.col("longitude").cast("double"), F.col("latitude").cast("double")
    )


def stage_land_prices(
    points: DataFrame, series: DataFrame, years: Sequence[int] = YEARS, land_class: str = RESIDENTIAL
) -> DataFrame:
    """One row per land point of the class, one price column per year.

    ``points`` has either ``lon``/``lat`` or a WKT column
    ``point_land_price``. Only the series of the class are pivoted, and before
    the join, so the join sees one row per id on one side and one per place on
    the other. The ids of the class are stored first, to measure them.
    """
    if "point_land_price" in points.columns:
        points = points.withColumns(
            {"lon": wkt_lon(F.col("point_land_price")), "lat": wkt_lat(F.col("point_land_price"))}
        )
    places = (
        points.where(F.col("rlc_index_name") == land_class)
        .select(
            "podb_land_price_id",
            "address",
            F.col("lon").cast("double").alias("land_lon"),
            F.col("lat").cast("double").alias("land_lat"),
        )
        .distinct()
    )
    ids = scratch.store(places.select("podb_land_price_id").distinct(), "land_ids")
    if scratch.measure(ids).broadcastable:
        ids = F.broadcast(ids)
    of_class = series.join(ids, "podb_land_price_id", "left_semi")
    prices = conditional_pivot(
        of_class, ["podb_land_price_id"], "research_year", {y: f"price_{y}" for y in years}, "posted_land_price"
    )
    return places.join(prices, "podb_land_price_id")

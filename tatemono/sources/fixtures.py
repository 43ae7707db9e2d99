"""The five raw tables, derived from the driver's star schema.

Every expression is plain SQL that Spark and DuckDB read alike, so the same
text serves the Spark plan and the reference query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tatemono.sources.readers import ROW_ADDRESS, with_row_address

# Years and land class that stand in for 2025 / 2023 / 2021 and the
# residential class.
YEARS = (2000, 1998, 1996)
LAND_CLASS = "HOUSEHOLD"
IS_TRAIN = "l_shipdate < TIMESTAMP '2000-01-01 00:00:00'"


def _coordinate(base: int, key: str, prime: int, modulus: int) -> str:
    return f"{base} + cast(({key} * {prime}) % {modulus} as double) / cast({modulus} as double)"


def _point(key: str, lon_prime: int, lat_prime: int, unless: str | None = None) -> tuple[str, str]:
    pair = _coordinate(139, key, lon_prime, 10007), _coordinate(35, key, lat_prime, 10009)
    return tuple(f"case when {unless} then null else {c} end" for c in pair) if unless else pair


_BUILDING_LON, _BUILDING_LAT = _point("p_partkey", 7919, 104729, unless="p_partkey % 101 = 0")
_STATION_LON, _STATION_LAT = _point("s_suppkey", 15485863, 32452843)
_LAND_LON, _LAND_LAT = _point("c_custkey", 49979687, 86028121)

_LISTING = {
    "building_id": "cast(l_partkey as string)",
    "unit_area": "case when l_orderkey % 7 = 0 then null else l_quantity end",
    "unit_area_min": "case when l_orderkey % 49 = 0 then null else l_quantity - cast(0.5 as double) end",
    "unit_area_max": "case when l_orderkey % 49 = 0 then null else l_quantity + cast(0.5 as double) end",
    "floor_count": "p_size",
    "year_built": "(1950 + l_partkey % 70) * 100 + 1 + l_partkey % 12",
    "target_ym": "cast(year(l_shipdate) * 100 + month(l_shipdate) as string)",
    "full_address": "p_brand || ' ' || p_type || ' ' || p_name",
    "lon": _BUILDING_LON,
    "lat": _BUILDING_LAT,
    "eki_name1": "case when l_partkey % 5 = 0 then '＊＊＊＊' when l_partkey % 11 = 0 then null"
    " else 'EKI_' || cast(l_partkey % 200 as string) end",
    "walk_distance1": "case when l_orderkey % 3 = 0 then null else l_orderkey % 25 + 1 end",
}

_LISTING_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_extendedprice as decimal(18,2)))"
_MONEY = "l_extendedprice"
_PLANTED_MONEY = (
    "l_quantity * 1000 * (1 + cast(l_partkey % 10 as double) / cast(10 as double))"
    " + p_retailprice * 5 + l_extendedprice * cast(0.02 as double)"
)

TRAIN = {"money_room": _MONEY, **_LISTING}
PLANTED_TRAIN = {"money_room": _PLANTED_MONEY, **_LISTING}
TEST = {"id": _LISTING_ID, **_LISTING, "addr2_name": "p_type"}
STATIONS = {"station_name": "s_name", "city_name": "n_name", "longitude": _STATION_LON, "latitude": _STATION_LAT}
LAND_POINTS = {
    "podb_land_price_id": "c_custkey",
    "address": "c_name",
    "rlc_index_name": "c_mktsegment",
    "lon": _LAND_LON,
    "lat": _LAND_LAT,
}
LAND_SERIES = {
    "podb_land_price_id": "o_custkey",
    "research_year": "cast(year(o_orderdate) as int)",
    "posted_land_price": "o_totalprice",
}
# Training listings as a feed of texts, some of which do not fit their columns.
DIRTY_TRAIN = {
    "target_ym": "target_ym",
    "building_id": "building_id",
    "money_room": "case when floor_count = 7 then '1e40' else cast(cast(floor(money_room) as bigint) as string) end",
    "year_built": "case when walk_distance1 = 4 then 'unknown' when walk_distance1 = 9 then cast(year_built as string) || '.5'"
    " else cast(year_built as string) end",
    "full_address": "full_address",
    "renovation_date": "case when floor_count = 11 then '2020-02-30' else '2020-02-28' end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, expressions: dict[str, str], *carry: str) -> DataFrame:
    return df.selectExpr(*[f"{text} as {name}" for name, text in expressions.items()], *carry)


class RawTables:
    """The raw tables over a driver folder; a file is opened when a table that
    needs it is first asked for. ``planted`` swaps in a learnable target for
    model checks."""

    def __init__(self, spark: SparkSession, sf_dir: str, planted: bool = False):
        self._read = lambda name: table(spark, sf_dir, name)
        self._train_columns = PLANTED_TRAIN if planted else TRAIN

    @cached_property
    def _lines(self) -> DataFrame:
        return self._read("lineitem")

    @cached_property
    def _parts(self) -> DataFrame:
        return self._read("part")

    @cached_property
    def train(self) -> DataFrame:
        lines = with_row_address(self._lines).where(IS_TRAIN)
        return project(lines.join(self._parts, F.col("l_partkey") == F.col("p_partkey")), self._train_columns, *ROW_ADDRESS)

    @cached_property
    def test(self) -> DataFrame:
        return project(self._lines.where(f"not ({IS_TRAIN})").join(self._parts, F.col("l_partkey") == F.col("p_partkey")), TEST)

    @cached_property
    def stations(self) -> DataFrame:
        of_nation = F.col("s_nationkey") == F.col("n_nationkey")
        return project(self._read("supplier").join(self._read("nation"), of_nation), STATIONS)

    @cached_property
    def land_points(self) -> DataFrame:
        return project(self._read("customer"), LAND_POINTS)

    @cached_property
    def land_series(self) -> DataFrame:
        return project(self._read("orders"), LAND_SERIES)


def raw_tables(spark: SparkSession, sf_dir: str, planted: bool = False) -> RawTables:
    return RawTables(spark, sf_dir, planted)


def _select(expressions: dict[str, str], source: str) -> str:
    columns = ",\n  ".join(f"{text} as {name}" for name, text in expressions.items())
    return f"select\n  {columns}\nfrom {source}"


# The same five tables as SQL text, for the reference queries.
RAW_SQL = {
    "raw_train": _select(TRAIN, f"lineitem join part on l_partkey = p_partkey where {IS_TRAIN}"),
    "raw_test": _select(TEST, f"lineitem join part on l_partkey = p_partkey where not ({IS_TRAIN})"),
    "raw_stations": _select(STATIONS, "supplier join nation on s_nationkey = n_nationkey"),
    "raw_points": _select(LAND_POINTS, "customer"),
    "raw_series": _select(LAND_SERIES, "orders"),
}

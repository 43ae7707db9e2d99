"""One registered query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tatemono import functions as fn
from tatemono.operators import encode, model
from tatemono.operators.geojoin import nearest_within, radius_join
from tatemono.operators.joins import lookup_join
from tatemono.operators.rows import approx_medians, global_row_number
from tatemono.plans import mart as mart_plan
from tatemono.plans import score as score_plan
from tatemono.plans import staging
from tatemono.sources import checked, fixtures, readers, schemas, scratch, sinks

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Staged tables of one driver folder; each is built when first read."""

    def __init__(self, spark: SparkSession, sf_dir: str, planted: bool = False):
        self.raw = fixtures.raw_tables(spark, sf_dir, planted)
        self._train: DataFrame | None = None

    @property
    def train(self) -> DataFrame:
        if self._train is None:
            self._train = staging.stage_train(self.raw.train)
        return self._train

    @property
    def test(self) -> DataFrame:
        return staging.stage_test(self.raw.test)

    @property
    def stations(self) -> DataFrame:
        return staging.stage_stations(self.raw.stations)

    @property
    def land_prices(self) -> DataFrame:
        return staging.stage_land_prices(
            self.raw.land_points, self.raw.land_series, fixtures.YEARS, fixtures.LAND_CLASS
        )

    @property
    def base(self) -> DataFrame:
        return mart_plan.base_records(self.train, self.test)

    @property
    def unnumbered_train(self) -> DataFrame:
        """Typed training rows for queries that need no row number."""
        return staging.type_train(self.raw.train)

    def stored_base(self, *columns: str) -> DataFrame:
        """Columns of all listings, with the building age among them, as a
        stored table for operators that read their input several times."""
        aged = self.base.withColumn("building_age", fn.age_years(F.col("target_ym"), F.col("year_built")))
        return scratch.store(aged.select("data_type", "id", *columns), "base")

    def listings(self) -> DataFrame:
        """Raw listings of both tables."""
        return self.raw.train.unionByName(self.raw.test, allowMissingColumns=True)

    def mart(self) -> DataFrame:
        return mart_plan.mart(self.train, self.test, self.stations, self.land_prices, years=fixtures.YEARS)

    def stored_mart(self) -> DataFrame:
        return scratch.store(self.mart(), "mart")


def _metres(column: str) -> Column:
    """Distances agree between engines to far less than a millimetre."""
    return F.round(F.col(column), 3).alias(column)


def _unit_mean(column: str) -> Column:
    """Engines round a quotient to ten decimals in slightly different ways,
    so means of unit prices agree to about eleven digits."""
    return F.round(F.col(column), 6).alias(column)


def stg_train(spark, sf_dir):
    return Tables(spark, sf_dir).train


def stg_test(spark, sf_dir):
    return Tables(spark, sf_dir).test


def stg_stations(spark, sf_dir):
    return Tables(spark, sf_dir).stations


def land_pivot(spark, sf_dir):
    return Tables(spark, sf_dir).land_prices


def buildings_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mart_plan.buildings_by_type(t.unnumbered_train, t.test)


def buildings_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mart_plan.buildings(t.unnumbered_train, t.test)


def base_union(spark, sf_dir):
    return Tables(spark, sf_dir).base


def addr_group(spark, sf_dir):
    address = F.col("full_address")
    return Tables(spark, sf_dir).listings().select("full_address", fn.addr_group(address).alias("addr_group"))


def area_recover(spark, sf_dir):
    columns = ["unit_area", "unit_area_min", "unit_area_max"]
    house_area = fn.area_recover(*[F.col(c) for c in columns]).alias("house_area")
    return Tables(spark, sf_dir).listings().select("building_id", *columns, house_area)


def building_age(spark, sf_dir):
    ym = F.col("target_ym").cast("int")
    return (
        Tables(spark, sf_dir)
        .listings()
        .withColumns(
            {
                "target_months": fn.ym_to_months(ym).cast("long"),
                "building_age": fn.age_years(ym, F.col("year_built")),
            }
        )
        .select("building_id", "target_ym", F.col("year_built").cast("long").alias("year_built"), "target_months", "building_age")
    )


def growth_rate(spark, sf_dir):
    latest, base = (f"price_{y}" for y in fixtures.YEARS[:2])
    rate = fn.growth_rate(F.col(latest), F.col(base)).alias("land_growth_rate")
    return Tables(spark, sf_dir).land_prices.select("podb_land_price_id", latest, base, rate)


def station_recover(spark, sf_dir):
    nearest = F.concat(F.lit("NEAR_"), F.col("building_id"))
    name = fn.station_recover(F.col("eki_name1"), nearest).alias("station_name")
    return Tables(spark, sf_dir).listings().select("building_id", "eki_name1", name)


def walk_recover(spark, sf_dir):
    metres = fn.walk_recover(F.col("walk_distance1"), F.col("unit_area_max") * 10).alias("final_walk_dist")
    return Tables(spark, sf_dir).listings().select("building_id", "walk_distance1", "unit_area_max", metres)


def unit_price(spark, sf_dir):
    area = fn.area_recover(F.col("unit_area"), F.col("unit_area_min"), F.col("unit_area_max"))
    price = fn.unit_price(F.col("money_room"), area - F.lit(10.0)).alias("unit_price")
    return Tables(spark, sf_dir).raw.train.select("building_id", "money_room", price)


def interaction(spark, sf_dir):
    area = fn.area_recover(F.col("unit_area"), F.col("unit_area_min"), F.col("unit_area_max"))
    age = fn.age_years(F.col("target_ym").cast("int"), F.col("year_built"))
    product = fn.interaction(area, age).alias("area_x_age")
    return Tables(spark, sf_dir).listings().select("building_id", "target_ym", product)


def distance(spark, sf_dir):
    """Each listed building against the supplier's station."""
    part = fixtures.project(
        fixtures.table(spark, sf_dir, "part"), {k: fixtures.TEST[k] for k in ("lon", "lat")}, "p_partkey"
    )
    supplier = fixtures.project(
        fixtures.table(spark, sf_dir, "supplier"),
        {k: fixtures.STATIONS[k] for k in ("longitude", "latitude")},
        "s_suppkey",
    )
    pairs = fixtures.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    metres = fn.haversine_m(F.col("lon"), F.col("lat"), F.col("longitude"), F.col("latitude"))
    return (
        pairs.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_partkey", "l_suppkey", F.round(metres, 3).alias("dist_m"))
    )


def wkt(spark, sf_dir):
    """Points to text and back; the text in four decimals, which all engines
    print alike."""
    lon, lat = F.col("lon"), F.col("lat")
    points = Tables(spark, sf_dir).raw.land_points.withColumn("_wkt", fn.point_wkt(lon, lat))
    return points.select(
        "podb_land_price_id",
        fn.wkt_lon(F.col("_wkt")).alias("lon"),
        fn.wkt_lat(F.col("_wkt")).alias("lat"),
        fn.point_wkt(F.round(lon, 4), F.round(lat, 4)).alias("wkt"),
    )


def within_radius(spark, sf_dir):
    t = Tables(spark, sf_dir)
    points = mart_plan.buildings_by_type(t.unnumbered_train, t.test)
    pairs = radius_join(points, t.stations, mart_plan.RADIUS_M)
    return pairs.select("building_id", "data_type", "station_name", "city_name", _metres("dist_m"))


def nearest_station(spark, sf_dir):
    t = Tables(spark, sf_dir)
    points = mart_plan.buildings_by_type(t.unnumbered_train, t.test)
    near = mart_plan.nearest_station(points, t.stations)
    return near.withColumn("recovered_walk_dist", _metres("recovered_walk_dist"))


def nearest_land(spark, sf_dir):
    t = Tables(spark, sf_dir)
    points = mart_plan.buildings(t.unnumbered_train, t.test)
    return mart_plan.nearest_land(points, t.land_prices, years=fixtures.YEARS)


def mart(spark, sf_dir):
    return Tables(spark, sf_dir).mart().withColumn("final_walk_dist", _metres("final_walk_dist"))


def row_id(spark, sf_dir):
    """Number all order lines; the order columns leave only full copies equal."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.col(c).asc_nulls_last() for c in lines.columns]
    return global_row_number(lines, order, "row_id").withColumn("row_id", F.col("row_id").cast("long"))


def median_impute(spark, sf_dir):
    rows = Tables(spark, sf_dir).stored_base("building_age", "house_area")
    return encode.median_impute(rows, ["building_age", "house_area"])


def label_encode(spark, sf_dir):
    rows = Tables(spark, sf_dir).stored_base("eki_name_raw", "addr_group")
    return encode.label_encode(rows, ["eki_name_raw", "addr_group"], score_plan.ROW_KEY)


def kfold(spark, sf_dir):
    return _folds(spark, sf_dir, 3)


def kfold4(spark, sf_dir):
    return _folds(spark, sf_dir, 4)


def kfold_even(spark, sf_dir):
    """Folds whose sizes differ by one at most."""
    rows = scratch.store(Tables(spark, sf_dir).base.select("data_type", "id"), "base")
    return encode.kfold_even(rows, "id", 3, where=F.col("data_type") == "train")


def median_approx(spark, sf_dir):
    """Per column: its values, and whether the approximate median is within the rank error."""
    columns, error = ["building_age", "house_area"], 0.001
    rows = Tables(spark, sf_dir).stored_base(*columns)
    medians = approx_medians(rows, columns, error)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value"), F.lit(medians[c]).alias("m")) for c in columns])).alias("cell")
    values = rows.select(cells).select("cell.*").where("value is not null")
    n, below, upto = F.count(F.lit(1)), F.count_if(F.col("value") < F.col("m")), F.count_if(F.col("value") <= F.col("m"))
    within = (below <= n * (0.5 + error)) & (upto >= n * (0.5 - error))
    return values.groupBy("name").agg(n.alias("n"), within.alias("within"))


def _folds(spark, sf_dir, k):
    folds = score_plan.with_folds(Tables(spark, sf_dir).base, k)
    return folds.select("data_type", "id", "fold")


def _encoded(spark, sf_dir):
    rows = Tables(spark, sf_dir).stored_base("target_price", "house_area", "building_age", "building_id", "addr_group")
    encoded = score_plan.target_encoded(rows)
    return encoded.select("data_type", "id", "fold", "bldg_te", _unit_mean("addr_te"))


def oof_te(spark, sf_dir):
    return _encoded(spark, sf_dir).where(F.col("data_type") == "train")


def test_te(spark, sf_dir):
    return _encoded(spark, sf_dir).where(F.col("data_type") == "test").drop("fold")


def feature_matrix(spark, sf_dir):
    matrix = score_plan.features(Tables(spark, sf_dir).stored_mart())
    return matrix.withColumns(
        {"final_walk_dist": _metres("final_walk_dist"), "addr_te": _unit_mean("addr_te")}
    )


def log_target(spark, sf_dir):
    price = F.col("money_room")
    return Tables(spark, sf_dir).raw.train.select(
        "building_id",
        "money_room",
        F.round(F.log1p(price), 9).alias("log_price"),
        F.round(F.expm1(F.log1p(price)), 4).alias("back"),
    )


def _predictions(spark, sf_dir):
    """Stand-in predictions of three models: listed prices off by a percent,
    in log space."""
    lines = fixtures.table(spark, sf_dir, "lineitem")
    test = fixtures.project(
        lines.where(f"not ({fixtures.IS_TRAIN})"), {"id": fixtures.TEST["id"]}, "l_extendedprice"
    )
    return test.select(
        "id", "l_extendedprice", *[F.log1p(F.col("l_extendedprice") * F.lit(f)).alias(f"log_{i}") for i, f in enumerate((1.0, 1.01, 1.02))]
    )


def ensemble(spark, sf_dir):
    price = model.mean_price([F.col(f"log_{i}") for i in range(3)])
    return _predictions(spark, sf_dir).select("id", F.round(price, 6).alias("price"))


def mae(spark, sf_dir):
    priced = Tables(spark, sf_dir).raw.train.withColumn("guess", F.col("unit_area") * F.lit(1000.0))
    return model.mean_absolute_error(priced, "money_room", "guess")


def submission(spark, sf_dir):
    """Quarter steps, so that many predictions lie halfway between integers."""
    lines = fixtures.table(spark, sf_dir, "lineitem")
    rows = fixtures.project(lines, {"id": fixtures.TEST["id"], "is_test": f"not ({fixtures.IS_TRAIN})"}, "l_quantity")
    priced = rows.withColumn("price", F.col("l_quantity") * F.lit(0.25))
    return model.submission(priced, test=F.col("is_test"))


def gbt_prices(spark, sf_dir):
    """Planted target, fitted with the defaults: ``id, price`` of the test listings."""
    return score_plan.score(Tables(spark, sf_dir, planted=True).stored_mart())


def gbt(spark, sf_dir):
    """Every test listing gets a price within the range of the training prices,
    with a margin of a factor of two; SQL has no model to compare it with."""
    mart = Tables(spark, sf_dir, planted=True).stored_mart()
    prices = score_plan.score(mart)
    seen = mart.agg(F.min("target_price").alias("low"), F.max("target_price").alias("high")).first()
    within = F.col("price").between(seen["low"] / 2, seen["high"] * 2)
    return prices.select("id", F.coalesce(within, F.lit(False)).alias("priced"))


def gbt_stump(spark, sf_dir):
    """One feature of two values, one round of one split: a price is the mean,
    over the folds, of the other folds' mean in log space for its value."""
    rows = Tables(spark, sf_dir).stored_base("target_price", "building_id")
    odd = (F.col("building_id").cast("int") % 2).cast("double").alias("odd")
    folded = score_plan.with_folds(rows).select("data_type", "id", "fold", "target_price", odd)
    table = scratch.store(model.assemble(folded, ["odd"]), "stump")
    models = model.fit_folds(table, "target_price", rounds=1, depth=1, learning_rate=1.0)
    priced = model.predict_ensemble(table.where("data_type = 'test'"), models)
    return priced.select("id", F.round("price", 4).alias("price"))


def gbt_gate(spark, sf_dir):
    """Planted target, fitted with the defaults. Per fold: its rows, the error
    of the median guess over all training rows, whether the held-out error is
    below half of it, and how many test listings there are and are priced."""
    mart = Tables(spark, sf_dir, planted=True).stored_mart()
    scored = score_plan.fit_and_score(mart)
    train = mart.where("data_type = 'train'")
    middle = train.agg(F.median("target_price")).first()[0]
    guess = model.mean_absolute_error(train.withColumn("_guess", F.lit(middle)), "target_price", "_guess", "guess_mae")
    prices = scored.prices.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("price") > 0).alias("priced_rows"))
    # one row per fold, and one row each
    return scored.errors.join(guess, F.lit(True)).join(prices, F.lit(True)).select(
        F.col("fold").cast("long").alias("fold"), "rows", F.round("guess_mae", 4).alias("guess_mae"),
        (F.col("mae") < F.col("guess_mae") / 2).alias("beats_guess"), "test_rows", "priced_rows",
    )


def lookup_spread(spark, sf_dir):
    """Parts joined to their order lines with nothing broadcast and small slices."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    counts = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("_rows"))
    part = fixtures.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    dim = scratch.store(part.join(counts, "l_partkey"), "parts")
    spread_by = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return lookup_join(lines, dim, ["l_partkey"], spread_by, "_rows", slice_rows=8, broadcast_bytes=0)


def radius_spread(spark, sf_dir):
    """The radius join with nothing broadcast and cells cut into small slices."""
    t = Tables(spark, sf_dir)
    points = mart_plan.buildings_by_type(t.unnumbered_train, t.test)
    pairs = radius_join(points, t.stations, mart_plan.RADIUS_M, slice_rows=4, broadcast_bytes=0)
    return pairs.select("building_id", "data_type", "station_name", "city_name", _metres("dist_m"))


def nearest_crowded(spark, sf_dir):
    """The nearest station by the point tree, with nothing broadcast."""
    t = Tables(spark, sf_dir)
    points = mart_plan.buildings_by_type(t.unnumbered_train, t.test)
    near = nearest_within(
        points, t.stations, ["building_id", "data_type"], mart_plan.RADIUS_M, ["station_name", "city_name"],
        cell_points=1, node_points=1, slice_rows=50, broadcast_bytes=0,
    )
    return near.select(
        "building_id", "data_type", "station_name", "city_name", _metres("dist_m")
    ).withColumnRenamed("dist_m", "recovered_walk_dist")


def landing_train(spark, sf_dir):
    """Training listings written with the declared schema, read back as a
    landing folder, and typed."""
    raw = Tables(spark, sf_dir).raw.train.drop(*readers.ROW_ADDRESS)
    declared = spark.createDataFrame([], schemas.TRAIN).schema
    path = scratch.new_path(spark, "landing")
    raw.select(
        *[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared]
    ).write.parquet(path)
    landed = sinks.load_table(readers.read_train(spark, path), scratch.new_path(spark, "landed"))
    return staging.type_train(landed).select("building_id", "target_price", "house_area", "floor_count", "year_built", "target_ym", "full_address")


def rejects(spark, sf_dir):
    """A dirty CSV feed of the training listings: how often each bad value was
    rejected, and how many rows were good and were not."""
    names = spark.createDataFrame([], schemas.TRAIN).columns
    feed = fixtures.project(Tables(spark, sf_dir).raw.train, fixtures.DIRTY_TRAIN)
    path = scratch.new_path(spark, "dirty")
    feed.select(*[F.col(c) if c in feed.columns else F.lit(None).cast("string").alias(c) for c in names]).write.csv(path)
    found = checked.read_checked(spark, path, schemas.TRAIN, "csv")
    values = found.rejects.groupBy("column", "text", "reason").agg(F.count(F.lit(1)).alias("n"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("column", "text")]
    good = found.good.select(*nothing, F.lit("good rows").alias("reason"))
    bad = found.rejects.select("file", "row").distinct().select(*nothing, F.lit("rejected rows").alias("reason"))
    rows = good.unionByName(bad).groupBy("column", "text", "reason").agg(F.count(F.lit(1)).alias("n"))
    return values.unionByName(rows).withColumnRenamed("column", "bad_column")


def mart_files(spark, sf_dir):
    """The mart as a stored model and a table view, read back by upper-case names."""
    stored = sinks.write_model(Tables(spark, sf_dir).mart(), scratch.new_path(spark, "model"))
    view = sinks.register_view(readers.upper_names(stored), "tatemono_mart_upper")
    columns = [F.col(c.upper()).alias(c) for c in stored.columns]
    return view.select(*columns).withColumn("final_walk_dist", _metres("final_walk_dist"))


def submission_file(spark, sf_dir):
    """The submission written as CSV, and once more over it, and read back."""
    path = scratch.new_path(spark, "submission")
    for _ in range(2):
        sinks.write_submission(submission(spark, sf_dir), path)
    return readers.read_submission(spark, path)


QUERIES: dict[str, Query] = {
    "q_stg_train": stg_train,
    "q_stg_test": stg_test,
    "q_stg_stations": stg_stations,
    "q_land_pivot": land_pivot,
    "q_buildings_all": buildings_all,
    "q_buildings_distinct": buildings_distinct,
    "q_base_union": base_union,
    "q_addr_group": addr_group,
    "q_area_recover": area_recover,
    "q_building_age": building_age,
    "q_growth_rate": growth_rate,
    "q_station_recover": station_recover,
    "q_walk_recover": walk_recover,
    "q_unit_price": unit_price,
    "q_interaction": interaction,
    "q_distance": distance,
    "q_wkt": wkt,
    "q_radius_join": within_radius,
    "q_nearest_station": nearest_station,
    "q_nearest_land": nearest_land,
    "q_mart": mart,
    "q_row_id": row_id,
    "q_median_impute": median_impute,
    "q_label_encode": label_encode,
    "q_kfold": kfold,
    "q_kfold4": kfold4,
    "q_kfold_even": kfold_even,
    "q_median_approx": median_approx,
    "q_oof_te": oof_te,
    "q_test_te": test_te,
    "q_feature_matrix": feature_matrix,
    "q_log_target": log_target,
    "q_ensemble": ensemble,
    "q_mae": mae,
    "q_submission": submission,
    "q_gbt": gbt,
    "q_gbt_stump": gbt_stump,
    "q_gbt_gate": gbt_gate,
    "q_lookup_spread": lookup_spread,
    "q_radius_spread": radius_spread,
    "q_nearest_crowded": nearest_crowded,
    "q_landing_train": landing_train,
    "q_rejects": rejects,
    "q_mart_files": mart_files,
    "q_submission_file": submission_file,
}

"""Staging, lookups, mart and scoring on hand-made tables; sources and sinks."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from tatemono.operators import encode
from tatemono.plans import jobs
from tatemono.plans import mart as mart_plan
from tatemono.plans import score as score_plan
from tatemono.plans import staging
from tatemono.sources import fixtures, readers, schemas, scratch, sinks

LISTING = (
    "building_id string, unit_area decimal(38,8), unit_area_min decimal(38,7), unit_area_max decimal(38,7),"
    " floor_count bigint, year_built bigint, target_ym string, full_address string, lon decimal(38,7),"
    " lat decimal(38,7), eki_name1 string, walk_distance1 bigint"
)


def listing(building="b1", area=50, low=None, high=None, address="東京都港区芝公園四丁目二番八号", lon=139.75, lat=35.65, station="＊＊＊＊", walk=None, built=200001, ym="202307"):
    from decimal import Decimal

    def dec(v):
        return None if v is None else Decimal(str(v))

    return (building, dec(area), dec(low), dec(high), 10, built, ym, address, dec(lon), dec(lat), station, walk)


def train_frame(spark, rows):
    return spark.createDataFrame([(price, *r) for price, r in rows], f"money_room bigint, {LISTING}")


def test_frame(spark, rows):
    return spark.createDataFrame([(i, *r, "town") for i, r in rows], f"id string, {LISTING}, addr2_name string")


test_frame.__test__ = False


def stations(spark):
    return staging.stage_stations(
        spark.createDataFrame(
            [("芝公園", "港区", 139.751, 35.651), ("遠い駅", "大田区", 139.80, 35.65), ("三田", "港区", 139.77, 35.65)],
            schemas.STATIONS,
        )
    )


def land(spark):
    points = [
        (1, "near", "住宅地", "POINT(139.7501 35.6501)"),
        (2, "next", "住宅地", "POINT(139.755 35.655)"),
        (3, "shop", "商業地", "POINT(139.75 35.65)"),
        (4, "unpriced", "住宅地", "POINT(139.75 35.65)"),
    ]
    series = [(1, 2025, None), (1, 2023, 100.0), (2, 2025, 220.0), (2, 2023, 200.0), (2, 2021, 150.0), (3, 2025, 999.0), (2, 2025, 210.0)]
    return staging.stage_land_prices(
        spark.createDataFrame(points, schemas.LAND_POINTS), spark.createDataFrame(series, schemas.LAND_SERIES)
    )


def test_train_ids_follow_building_and_address(spark):
    rows = [(3, listing("b2", address="x")), (2, listing("b10", address="z")), (1, listing("b10", address="a")), (9, listing(None))]
    got = {r["target_price"]: r["id"] for r in staging.stage_train(train_frame(spark, rows)).collect()}
    assert got == {1.0: "1", 2.0: "2", 3.0: "3", 9.0: "4"}


def test_staging_types_and_columns(spark):
    train = staging.stage_train(train_frame(spark, [(5, listing(area=None, low=40, high=60))]))
    kinds = dict(train.dtypes)
    assert kinds["house_area"] == kinds["lon"] == kinds["target_price"] == kinds["walk_dist_raw"] == "double"
    assert kinds["year_built"] == kinds["target_ym"] == "int" and kinds["id"] == "string"
    row = train.first()
    assert (row["house_area"], row["target_ym"], row["addr_group"]) == (50.0, 202307, "東京都港区芝公園四丁目二")
    test = staging.stage_test(test_frame(spark, [("t1", listing())]))
    assert "town_name_raw" in test.columns and test.first()["id"] == "t1"


def test_lenient_staging_turns_bad_numerals_into_null(spark):
    raw = train_frame(spark, [(5, listing(ym="2023-07"))])
    assert staging.stage_train(raw, lenient=True).first()["target_ym"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.type_train(raw).collect()


def test_land_pivot(spark):
    rows = {r["podb_land_price_id"]: r for r in land(spark).collect()}
    assert set(rows) == {1, 2}  # class filter; ids without a series drop out
    assert (rows[1]["price_2025"], rows[1]["price_2023"], rows[1]["price_2021"]) == (None, 100.0, None)
    assert (rows[2]["price_2025"], rows[2]["price_2023"], rows[2]["price_2021"]) == (220.0, 200.0, 150.0)
    assert (rows[2]["land_lon"], rows[2]["land_lat"]) == (139.755, 35.655)


def test_mart_on_hand_made_rows(spark):
    train = staging.stage_train(
        train_frame(
            spark,
            [
                (100, listing("b1")),
                (200, listing("b1", station="浜松町", walk=5, address="別")),
                (300, listing("far", lon=150.0, station=None)),
                (400, listing("nowhere", lon=None, walk=3)),
                (500, listing(None)),
            ],
        )
    )
    test = staging.stage_test(test_frame(spark, [("t1", listing("b1", lon=139.77)), ("t2", listing("b3", station="****"))]))
    rows = mart_plan.mart(train, test, stations(spark), land(spark)).collect()
    assert len(rows) == 7 and rows[0].__fields__ == mart_plan.MART_COLUMNS
    by = {(r["data_type"], r["target_price"] or r["id"]): r for r in rows}

    masked = by["train", 100.0]
    assert (masked["station_name"], masked["city_name"]) == ("芝公園", "港区")
    assert 100 < masked["final_walk_dist"] < 200 and masked["building_age"] == pytest.approx(23.5)
    # nearest land point wins although its latest price is missing
    assert masked["nearest_land_price"] is None and masked["land_growth_rate"] is None

    named = by["train", 200.0]
    assert (named["station_name"], named["city_name"], named["final_walk_dist"]) == ("浜松町", "港区", 400.0)

    far = by["train", 300.0]
    assert far["station_name"] is None and far["final_walk_dist"] is None
    lost = by["train", 400.0]
    assert lost["station_name"] == None and lost["final_walk_dist"] == 240.0  # noqa: E711
    unnamed = by["train", 500.0]
    assert unnamed["station_name"] is None and unnamed["city_name"] is None

    # same building elsewhere in the test table: own station, shared land point
    assert by["test", "t1"]["station_name"] == "三田" and by["test", "t1"]["target_price"] is None
    assert by["test", "t2"]["station_name"] == "****"


def test_mart_is_the_same_without_broadcasts(spark, monkeypatch):
    raw = fixtures.raw_tables(spark, "/root/testdata/sf0.001")
    args = (
        staging.stage_train(raw.train),
        staging.stage_test(raw.test),
        staging.stage_stations(raw.stations),
        staging.stage_land_prices(raw.land_points, raw.land_series, fixtures.YEARS, fixtures.LAND_CLASS),
    )
    plain = mart_plan.mart(*args, years=fixtures.YEARS).collect()
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    sliced = mart_plan.mart(*args, years=fixtures.YEARS)
    assert len(plain) == args[0].count() + args[1].count()
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain))


def test_score_end_to_end(spark):
    rng = random.Random(3)
    def some(i):
        return listing(f"b{i % 9}", area=rng.choice([None, 30 + i % 40]), lon=139.75 + (i % 9) / 500, station=rng.choice(["＊＊＊＊", "浜松町", None]))

    train = staging.stage_train(train_frame(spark, [(10_000 + 100 * (i % 40), some(i)) for i in range(120)]))
    test = staging.stage_test(test_frame(spark, [(f"t{i}", some(i)) for i in range(30)]))
    mart = scratch.store(mart_plan.mart(train, test, stations(spark), land(spark)), "mart")
    matrix = score_plan.features(mart)
    assert matrix.count() == 150
    assert matrix.where("data_type = 'train' and (bldg_te is null or addr_te is null or fold is null)").count() == 0
    assert matrix.where("house_area is null or building_age is null").count() == 0
    out = score_plan.score(mart, rounds=3, learning_rate=0.3, depth=3)
    prices = {r["id"]: r["price"] for r in out.collect()}
    assert len(prices) == 30 and all(9_000 < p < 15_000 for p in prices.values())


def test_schemas_and_reader(spark, tmp_path):
    train, test = (spark.createDataFrame([], s) for s in (schemas.TRAIN, schemas.TEST))
    assert len(train.columns) == len(test.columns) == 149
    assert train.columns[:3] == ["target_ym", "money_room", "building_id"] and test.columns[0] == "id"
    assert {c for c in train.columns if c in test.columns and train.schema[c].dataType != test.schema[c].dataType} == {
        "land_setback", "land_road_cond", "snapshot_land_area", "snapshot_land_shidou", "house_area", "money_rimawari_now",
    }
    land_dir = str(tmp_path / "csv")
    spark.createDataFrame([("三田", "港区", 139.7, 35.6)], schemas.STATIONS).write.csv(land_dir)
    landed = readers.read_stations(spark, land_dir, "csv")
    table = sinks.load_table(landed, str(tmp_path / "stations"))
    assert table.collect() == landed.collect() and table.count() == 1
    addressed = readers.with_row_address(readers.read_stations(spark, str(tmp_path / "stations")))
    assert addressed.first()["_src_row"] == 0
    assert readers.upper_names(table).columns == ["STATION_NAME", "CITY_NAME", "LONGITUDE", "LATITUDE"]


def test_sinks_replace_and_write_plain_csv(spark, tmp_path):
    path = str(tmp_path / "model")
    sinks.write_model(spark.range(5), path)
    assert sinks.write_model(spark.range(2), path).count() == 2
    assert readers.read_model(spark, path).count() == 2
    sinks.register_view(spark.range(3), "three_rows")
    assert spark.sql("select count(*) from three_rows").first()[0] == 3
    assert sinks.save_model_table(spark.range(3), "saved_model").count() == 3
    spark.sql("drop table saved_model")
    out = str(tmp_path / "submission")
    for _ in range(2):
        sinks.write_submission(spark.createDataFrame([("a", 5), ("b", 7)], "id string, price bigint"), out, single_file=True)
    files = glob.glob(out + "/*.csv")
    assert len(files) == 1 and sorted(open(files[0]).read().split()) == ["a,5", "b,7"]


class FakeSession:
    """Just the settings that decide where scratch tables go."""

    def __init__(self, settings, master):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_is_the_one_the_cluster_names(spark):
    named = FakeSession({scratch.CHECKPOINT_CONF: "hdfs://name/shared/"}, "yarn")
    assert scratch.shared_folder(named) == "hdfs://name/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(FakeSession({}, "spark://host:7077"))
    assert scratch.shared_folder(FakeSession({}, "local[4]")) == scratch.shared_folder(FakeSession({}, "local[*]"))


def test_scope_removes_its_own_tables_only(spark):
    outside = scratch.store(spark.range(3), "kept")
    with scratch.scope(spark):
        inside = scratch.store(spark.range(4), "gone")
        with scratch.scope(spark):
            scratch.store(spark.range(5), "gone")
        assert inside.count() == 4
    assert outside.count() == 3 and scratch.store(spark.range(2), "kept").count() == 2
    with pytest.raises(Exception, match="(?i)does not exist|FILE_NOT_EXIST"):
        inside.count()


def test_scratch_store_and_measure(spark):
    stored = scratch.store(spark.range(4).withColumn("s", F.lit("x")), "t")
    size = scratch.measure(stored)
    assert size.rows == 4 and size.bytes > 100 and size.broadcastable
    assert scratch.measure(stored.where("id > 9")).bytes == 0


def landed(spark, raw, folder, fmt):
    """The raw tables written with their declared schemas, decimals included."""
    declared = {"train": schemas.TRAIN, "test": schemas.TEST, "stations": schemas.STATIONS}
    paths = {name: f"{folder}/{name}" for name in ("train", "test", "stations", "land_points", "land_series")}
    for name, schema in declared.items():
        have = getattr(raw, name)
        fields = spark.createDataFrame([], schema).schema
        have.select(
            *[(F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
        ).write.format(fmt).save(paths[name])
    raw.land_points.select(
        "podb_land_price_id", "address", "rlc_index_name", F.expr("concat('POINT(', lon, ' ', lat, ')')").alias("point_land_price")
    ).write.format(fmt).save(paths["land_points"])
    raw.land_series.write.format(fmt).save(paths["land_series"])
    return paths


def test_declared_whole_numbers_are_decimals(spark):
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schemas.TRAIN).schema}
    assert kinds["money_room"] == kinds["year_built"] == "decimal(38,0)" and "bigint" not in kinds.values()


def test_runs_from_paths_to_paths(spark, tmp_path):
    raw = fixtures.raw_tables(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "models")
    settings = {"years": fixtures.YEARS, "land_class": fixtures.LAND_CLASS}
    paths = landed(spark, raw, str(tmp_path / "parquet"), "parquet")
    before = set(glob.glob(scratch.shared_folder(spark) + "/tatemono-*/*"))
    mart = jobs.build_mart(spark, paths, out, **settings)
    assert mart.columns == mart_plan.MART_COLUMNS and mart.count() == 6000
    assert mart.where("nearest_land_price is not null").count() > 100
    assert readers.read_model(spark, f"{out}/nearest_station").count() == 24
    prices = jobs.score_mart(
        spark, f"{out}/mart", str(tmp_path / "csv"), errors=str(tmp_path / "errors"), rounds=2, depth=3, interaction_feature=True
    )
    assert prices.count() == 1638 and prices.where("price is null").count() == 0
    assert spark.read.parquet(str(tmp_path / "errors")).where("mae > 0 and rounds <= 2").count() == 3
    assert set(glob.glob(scratch.shared_folder(spark) + "/tatemono-*/*")) == before  # both runs cleaned up

    from_csv = jobs.build_mart(spark, landed(spark, raw, str(tmp_path / "text"), "csv"), str(tmp_path / "models2"), fmt="csv", **settings)
    tables = {name: spark.read.schema(s).parquet(paths[name]) for name, s in jobs._SCHEMAS.items()}
    from_tables = jobs.build_mart(spark, tables, str(tmp_path / "models3"), **settings)
    rows = sorted(map(str, mart.collect()))
    assert sorted(map(str, from_csv.collect())) == rows and sorted(map(str, from_tables.collect())) == rows


def test_land_series_are_filtered_before_the_pivot(spark):
    plan = land(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the plan reads from its last step to its first


def test_features_are_the_same_without_broadcasts_and_from_single_encoders(spark, monkeypatch):
    """A missing address group and one spelled like the label of a missing
    one share a code but not a mean."""
    rows = [
        ("train" if i % 4 else "test", str(i), None if i % 4 == 0 else 1000.0 + 7 * (i % 11), 20.0 + i % 3, 1.0, 5.0, 139.0, 35.0,
         f"b{i % 5}", "a", [None, "None", "x", "y"][i % 3 if i % 2 else 3], ["s", None][i % 2], "c", 80.0, None, 0.5)
        for i in range(200)
    ]
    mart = scratch.store(
        spark.createDataFrame(
            rows,
            "data_type string, id string, target_price double, house_area double, floor_count double, building_age double,"
            " lon double, lat double, building_id string, full_address string, addr_group string, station_name string,"
            " city_name string, final_walk_dist double, nearest_land_price double, land_growth_rate double",
        ),
        "mart",
    )
    def collected(df):
        return {(r["data_type"], r["id"]): r for r in df.collect()}

    plain = collected(score_plan.features(mart))
    single = collected(encode.label_encode(score_plan.target_encoded(mart), score_plan.CATEGORIES, score_plan.ROW_KEY))
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    assert collected(score_plan.features(mart)) == plain
    assert len(plain) == 200
    for key, row in plain.items():
        for c in ("bldg_te", "addr_te", "station_name_id", "city_name_id", "addr_group_id"):
            assert row[c] == single[key][c]

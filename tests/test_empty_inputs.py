"""Operators on tables without rows, or without usable ones."""

from pyspark.sql import functions as F

from tatemono.operators import encode
from tatemono.operators.geojoin import nearest_within, radius_join
from tatemono.operators.joins import lookup_join
from tatemono.operators.rows import exact_medians
from tatemono.sources import scratch

LEFT = "k string, lon double, lat double"
RIGHT = "name string, longitude double, latitude double"


def test_distance_joins(spark):
    one_left = spark.createDataFrame([("a", 139.0, 35.0)], LEFT)
    one_right = spark.createDataFrame([("s", 139.0, 35.0)], RIGHT)
    none_left, none_right = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    for left, right, n in [(one_left, one_right, 1), (none_left, one_right, 0), (one_left, none_right, 0), (none_left, none_right, 0)]:
        assert radius_join(left, right, 10.0).count() == n
        assert nearest_within(left, right, ["k"], 10.0, ["name"]).count() == n
    assert nearest_within(one_left, one_right, ["k"], 0.0, ["name"]).first()["dist_m"] == 0.0


def test_encoders(spark):
    none = spark.createDataFrame([], "id string, key string, v double, fold long")
    assert exact_medians(none, ["v"]) == {"v": None}
    assert encode.median_impute(none, ["v"]).count() == 0
    assert encode.label_encode(none, ["key"], ["id"]).count() == 0
    only_test = spark.createDataFrame([("1", "a", None, None)], none.schema)
    assert encode.target_encode(only_test, "key", "v", "te", ["id"]).first()["te"] is None


def test_lookup_in_an_empty_table_keeps_every_row(spark, never_broadcast):
    rows = spark.range(10).withColumn("key", F.lit("a"))
    dim = scratch.store(spark.createDataFrame([], "key string, n long, x int"), "none")
    assert lookup_join(rows, dim, ["key"], ["id"], count="n").where("x is null").count() == 10

"""Global row numbers, medians, pivots, unions and skew-proof joins."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tatemono.operators import joins
from tatemono.operators import rows as rows_module
from tatemono.operators.joins import broadcast_threshold, lookup_join, spread_join
from tatemono.operators.rows import conditional_pivot, exact_medians, global_row_number, tagged_union
from tatemono.sources import scratch


def test_row_number_follows_the_global_order_with_nulls_last(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.randint(0, 500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    order = [F.col(c).asc_nulls_last() for c in ("k", "v", "i")]
    got = {r["i"]: r["n"] for r in global_row_number(df, order, "n").collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], r[2]))
    assert got == {row[2]: n for n, row in enumerate(want, 1)}


def test_row_number_of_copies_and_of_nothing(spark):
    df = spark.createDataFrame([("x", 1)] * 50 + [("a", 2)] * 3, "k string, v int")
    numbered = global_row_number(df, [F.col("k").asc_nulls_last()], "n").collect()
    assert sorted(r["n"] for r in numbered) == list(range(1, 54))
    assert {r["n"] for r in numbered if r["k"] == "a"} == {1, 2, 3}
    assert global_row_number(df.where("v = 9"), [F.col("k")], "n").collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_median_equals_the_sorted_middle(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, float("nan"), 7.0, rng.uniform(-5, 5), float(rng.randint(0, 9))]),
            rng.choice([1.0, 2.0, 2.0, 2.0]),
            None,
        )
        for _ in range(200 + seed)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    want = [v for v, _, _ in rows if v is not None and v == v]
    assert exact_medians(df, ["a", "b", "c"]) == {
        "a": statistics.median(want), "b": statistics.median([r[1] for r in rows]), "c": None,
    }


def test_median_looks_at_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(rows_module, "BLOCK_VALUES", 3)
    values = [float(i * 7 % 101) for i in range(100)] + [50.0] * 9
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_medians(df, ["x"]) == {"x": statistics.median(values)}


def test_median_small_cases(spark):
    def median(values):
        return exact_medians(spark.createDataFrame([(v,) for v in values], "x double"), ["x"])["x"]

    assert median([1.0, 2.0, 4.0, 8.0, None]) == 3.0
    assert median([1.0, 2.0, float("nan")]) == 1.5
    assert median([5.0, 5.0, 5.0, 1.0]) == 5.0
    assert median([None, None]) is None


def test_pivot_keeps_keys_without_wanted_values(spark):
    df = spark.createDataFrame(
        [(1, 2025, 5.0), (1, 2025, 9.0), (1, 2023, 4.0), (2, 1999, 3.0), (3, 2023, None)], "k int, y int, p double"
    )
    out = conditional_pivot(df, ["k"], "y", {2025: "p25", 2023: "p23"}, "p")
    assert sorted(map(tuple, out.collect())) == [(1, 9.0, 4.0), (2, None, None), (3, None, None)]


def test_tagged_union_matches_by_name_and_types_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, price double")
    b = spark.createDataFrame([(3,)], "x int")
    out = tagged_union({"train": a, "test": b}, "kind")
    assert out.schema["price"].dataType.simpleString() == "double"
    assert sorted(map(tuple, out.select("x", "price", "kind").collect())) == [(1, 2.0, "train"), (3, None, "test")]


def skewed(spark, n=900):
    """A third of the rows with one key, a third without a key."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
    )


def dimension(rows):
    return scratch.store(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("key is null or key <> 'k7'"), "dim"
    )


def test_lookup_join_gives_the_same_rows_whatever_the_way(spark, monkeypatch):
    rows = skewed(spark)
    dim = dimension(rows)
    want = sorted(map(tuple, rows.join(dim.drop("n"), "key", "left").select("id", "key", "first").collect()), key=str)
    plain = lookup_join(rows, dim, ["key"], ["id"], count="n")
    assert "n" not in plain.columns
    assert sorted(map(tuple, plain.select("id", "key", "first").collect()), key=str) == want
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    sliced = lookup_join(rows, dim, ["key"], ["id"], count="n", slice_rows=20)
    assert sorted(map(tuple, sliced.select("id", "key", "first").collect()), key=str) == want
    assert sum(r[2] is None for r in want) > 300


def test_lookup_join_spreads_the_hot_key(spark, never_broadcast):
    """No task gets more than a few slices of the hot key or the NULL key."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = skewed(spark, 9000)
        joined = lookup_join(rows, dimension(rows), ["key"], ["id"], count="n", slice_rows=100)
        per_task = joined.groupBy(F.spark_partition_id().alias("p"), "key").count()
        most = {r["key"]: r["m"] for r in per_task.groupBy("key").agg(F.max("count").alias("m")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert most["hot"] < 1000 and most[None] < 1000  # of 3000 each


def test_spread_join_equals_plain_join_with_hot_keys_on_both_sides(spark):
    left = skewed(spark, 300).withColumnRenamed("id", "l")
    right = skewed(spark, 240).withColumnRenamed("id", "r")
    want = left.join(right, "key").select("l", "r").collect()
    got = spread_join(left, right, ["key"], slice_rows=9).select("l", "r").collect()
    assert len(got) == len(want) > 8000
    assert set(map(tuple, got)) == set(map(tuple, want))


def test_spread_join_splits_exact_copies(spark, never_broadcast):
    """Two thousand copies of one row on the left, sixty on the right."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(2000).select(F.lit("copy").alias("key"), F.lit(1).alias("l"))
        right = spark.range(60).select(F.lit("copy").alias("key"), F.lit(2).alias("r"))
        joined = spread_join(left, right, ["key"], slice_rows=50)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 2000 * 60
    assert max(per_task) < 120_000 / 5


def test_spread_join_never_broadcasts_the_copies_it_makes(spark):
    """Their number is unknown to the optimizer, which sees small stored tables."""
    left, right = (spark.range(300).selectExpr("id % 3 as key", f"id as {name}") for name in "lr")
    joined = spread_join(left, right, ["key"], slice_rows=4)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert [kind for kind in ("SortMergeJoin", "BroadcastHashJoin") if re.search(rf"{kind} \[[^\]]*_lslot", plan)] == ["SortMergeJoin"]
    assert joined.count() == 30_000


def test_spread_join_does_not_copy_rows_once_per_small_slice(spark, monkeypatch):
    """Slices of four rows made 250,000 copies of either side for these 1,000,000 pairs."""
    left, right = (spark.range(1000).selectExpr("'hot' as key", f"id as {name}") for name in "lr")
    copies, real = [], type(left).hint
    monkeypatch.setattr(type(left), "hint", lambda self, *a: copies.append(self.count()) or real(self, *a))
    joined = spread_join(left, right, ["key"], slice_rows=4)
    assert copies == [1000 * joins.GRID_COPIES]
    found = joined.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l", "r").alias("pairs")).first()
    assert found["n"] == found["pairs"] == 1_000_000


def test_slices_of_a_grid_grow_to_a_full_one_and_no_further(spark):
    counts = spark.createDataFrame([(n,) for n in (1, 5, 64, 65, 6000, 320_000, 10**6, 10**12)], "n long")
    few = counts.select(joins._grid_slices(F.col("n"), 4)).collect()
    assert [r[0] for r in few] == [1, 2, 16, 16, 16, 16, 50, 50_000_000]
    many = counts.select(joins._grid_slices(F.col("n"), 200_000)).collect()
    assert [r[0] for r in many] == [1, 1, 1, 1, 1, 2, 5, 5_000_000]


def test_broadcast_hot_keys_are_bounded_at_any_size():
    """Keys above the threshold fit in the limit, because their rows would
    not fit in the table otherwise; the slice size is never touched."""
    for total in (10**9, 10**12, 10**15):
        least = broadcast_threshold(total, 60.0, 32 << 20)
        assert total // (least + 1) * 60 <= 32 << 20
    assert broadcast_threshold(10**12, 60.0, 10) is None


@pytest.mark.parametrize("limit", [0, 120, 1 << 20])
def test_large_hot_table_is_split_between_broadcast_and_shuffle(spark, limit):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).alias("key"))
    dim = dimension(rows.withColumn("key", F.col("key").cast("string"))).withColumn("key", F.col("key").cast("long"))
    dim = scratch.store(dim, "dim")
    want = sorted(map(tuple, rows.join(dim.drop("n"), "key", "left").select("id", "key", "first").collect()))
    got = lookup_join(rows, dim, ["key"], ["id"], "n", slice_rows=20, broadcast_bytes=limit)
    assert sorted(map(tuple, got.select("id", "key", "first").collect())) == want
    other = rows.select(F.col("id").alias("r"), "key").where("id < 400")
    pairs = spread_join(rows, other, ["key"], slice_rows=30, broadcast_bytes=limit)
    assert pairs.count() == rows.join(other, "key").count()


def test_spread_join_stores_no_side_without_a_hot_key(spark, monkeypatch):
    stored = []
    real = scratch.store
    monkeypatch.setattr(scratch, "store", lambda df, name: stored.append(name) or real(df, name))
    left = spark.range(50).select((F.col("id") % 10).alias("key"), F.col("id").alias("l"))
    right = spark.range(20).select((F.col("id") % 10).alias("key"), F.col("id").alias("r"))
    assert spread_join(left, right, ["key"], slice_rows=5).count() == 100
    assert stored == ["hot"]
    assert spread_join(left, right, ["key"], slice_rows=4).count() == 100
    assert stored == ["hot", "hot", "spread", "spread"]

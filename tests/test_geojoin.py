"""Radius join and nearest lookup against brute force."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tatemono.functions.geo import EARTH_RADIUS_M, haversine_m
from tatemono.operators import geojoin
from tatemono.operators.geojoin import nearest_within, radius_join
from tatemono.sources import scratch


def metres(lon1, lat1, lon2, lat2):
    a, b = math.radians(lat1), math.radians(lat2)
    h = (
        math.sin((b - a) / 2) ** 2
        + math.cos(a) * math.cos(b) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def cloud(seed, centres, per_centre, spread):
    rng = random.Random(seed)
    points = []
    for lon, lat in centres:
        for _ in range(per_centre):
            y = max(-90.0, min(90.0, lat + rng.uniform(-spread, spread)))
            wide = spread / max(0.01, math.cos(math.radians(y)))
            x = (lon + rng.uniform(-wide, wide) + 180.0) % 360.0 - 180.0
            points.append((x, y))
    return points


CENTRES = [(180.0, 0.0), (0.0, 0.0), (139.5, 45.0), (-179.99, 60.0), (20.0, 80.0), (10.0, 89.97), (0.0, -89.99), (77.0, 90.0)]


def frames(spark, left, right):
    lefts = spark.createDataFrame([(f"b{i}", x, y) for i, (x, y) in enumerate(left)], "k string, lon double, lat double")
    rights = spark.createDataFrame(
        [(f"s{i}", x, y) for i, (x, y) in enumerate(right)], "name string, longitude double, latitude double"
    )
    return lefts, rights


def brute_pairs(left, right, radius):
    return {
        (f"b{i}", f"s{j}")
        for i, p in enumerate(left)
        for j, q in enumerate(right)
        if metres(*p, *q) <= radius
    }


def brute_nearest(left, right, radius):
    best = {}
    for i, p in enumerate(left):
        d, name = min((metres(*p, *q), f"s{j}") for j, q in enumerate(right))
        if d <= radius:
            best[f"b{i}"] = (name, round(d, 3))
    return best


def nearest(left, right, radius, **options):
    rows = nearest_within(left, right, ["k"], radius, ["name"], **options).collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: (r["name"], round(r["dist_m"], 3)) for r in rows}


@pytest.mark.parametrize("radius", [5_000.0, 50_000.0])
def test_radius_join_equals_all_pairs_everywhere(spark, radius):
    left, right = cloud(1, CENTRES, 25, 0.3), cloud(2, CENTRES, 25, 0.3)
    got = radius_join(*frames(spark, left, right), radius).select("k", "name").collect()
    want = brute_pairs(left, right, radius)
    assert len(got) == len(want) > 100
    assert {tuple(r) for r in got} == want


def test_radius_join_with_sliced_hot_cells(spark, never_broadcast):
    left, right = cloud(3, [(139.7, 35.6)], 80, 0.02), cloud(4, [(139.7, 35.6)], 60, 0.02)
    left, right = left + left[:1] * 40, right + right[:1] * 30  # copies of one place
    got = radius_join(*frames(spark, left, right), 1500.0, slice_rows=7).select("k", "name").collect()
    want = brute_pairs(left, right, 1500.0)
    assert len(got) == len(want) > 1000
    assert {tuple(r) for r in got} == want


def test_radius_is_inclusive_and_null_points_never_match(spark):
    left = spark.createDataFrame(
        [("a", 139.0, 35.0), ("n", None, 35.0), ("m", 139.0, None), ("x", float("nan"), 35.0)],
        "k string, lon double, lat double",
    )
    right = spark.createDataFrame([("s", 139.03, 35.01), ("t", None, None)], "name string, longitude double, latitude double")
    exact = left.crossJoin(right).select(haversine_m(*[F.col(c) for c in ("lon", "lat", "longitude", "latitude")]).alias("d"))
    d = exact.where("d is not null and not isnan(d)").first()["d"]
    assert [(r["k"], r["name"]) for r in radius_join(left, right, d).collect()] == [("a", "s")]
    assert radius_join(left, right, math.nextafter(d, 0)).collect() == []


def test_nearest_equals_brute_force_everywhere(spark):
    left, right = cloud(5, CENTRES, 20, 0.2), cloud(6, CENTRES, 20, 0.2)
    want = brute_nearest(left, right, 5_000.0)
    assert len(want) > 20
    assert nearest(*frames(spark, left, right), 5_000.0) == want


@pytest.mark.parametrize("small", [True, False])
def test_nearest_in_crowded_cells_searches_the_tree(spark, monkeypatch, small):
    """A third of all points of both sides in one spot, some of them far from
    the searching points, next to sparse regions."""
    if not small:
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    centres = [(139.70, 35.60), (139.72, 35.62), (180.0, 0.0), (10.0, 89.99)]
    left = cloud(7, centres, 40, 0.03) + cloud(8, [(139.70, 35.60)], 80, 0.0005)
    right = cloud(9, centres, 40, 0.03) + cloud(10, [(139.71, 35.61)], 150, 0.0002)
    right += [right[-1]] * 20
    used = []
    real = geojoin._PointTree.search
    monkeypatch.setattr(geojoin._PointTree, "search", lambda self, *a: used.append(self.depth) or real(self, *a))
    got = nearest(*frames(spark, left, right), 5_000.0, cell_points=10, node_points=3, slice_rows=13)
    assert used and used[0] >= 2
    assert got == brute_nearest(left, right, 5_000.0)


def test_nearest_tie_and_several_points_of_a_key(spark):
    left = spark.createDataFrame(
        [("tie", 0.0, 0.0), ("two", 10.0, 0.0), ("two", 10.5, 0.0), (None, 0.0, 0.001)], "k string, lon double, lat double"
    )
    right = spark.createDataFrame(
        [("west", -0.01, 0.0), ("east", 0.01, 0.0), ("far", 10.02, 0.0), ("near", 10.501, 0.0)],
        "name string, longitude double, latitude double",
    )
    rows = {r["k"]: r["name"] for r in nearest_within(left, right, ["k"], 5000.0, ["name"]).collect()}
    assert rows == {"tie": "east", "two": "near", None: "east"}


def test_grid_join_plan_has_no_nested_loop(spark, never_broadcast, capsys):
    left, right = frames(spark, cloud(1, CENTRES, 5, 0.1), cloud(2, CENTRES, 5, 0.1))
    radius_join(left, right, 5000.0).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_a_large_radius_join_reads_the_left_side_once_and_has_tasks_by_its_tests(spark, monkeypatch):
    """The sides are few bytes: adaptive execution would bring them together
    in one task, and the optimizer would broadcast the right one."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    left, right = cloud(41, [(139.5, 35.5)], 300, 0.3), cloud(42, [(139.5, 35.5)], 200, 0.3)
    lefts, rights = frames(spark, left, right)
    monkeypatch.setattr(geojoin, "TASK_PAIRS", 100)
    pairs = radius_join(lefts.mapInArrow(seen, lefts.schema), rights, 5000.0, broadcast_bytes=0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    got = pairs.select("k", "name", F.spark_partition_id().alias("task")).collect()
    assert {(r["k"], r["name"]) for r in got} == brute_pairs(left, right, 5000.0) and len(got) > 300
    assert reads.value == len(left)
    assert len({r["task"] for r in got}) > 2 * spark.sparkContext.defaultParallelism


def test_a_missing_name_loses_a_tie(spark):
    left = spark.createDataFrame([("k", 0.0, 0.0)], "k string, lon double, lat double")
    right = spark.createDataFrame(
        [(None, 0.01, 0.0, "x"), ("named", 0.01, 0.0, None), (None, -0.01, 0.0, "a")],
        "name string, longitude double, latitude double, city string",
    )
    assert [r["name"] for r in nearest_within(left, right, ["k"], 5000.0, ["name", "city"]).collect()] == ["named"]
    only = right.where("name is null")
    assert [r["city"] for r in nearest_within(left, only, ["k"], 5000.0, ["name", "city"]).collect()] == ["a"]


def test_nearest_plan_makes_no_pairs_and_no_sorted_aggregate(spark, monkeypatch):
    plans = []
    real = scratch.store

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(scratch, "store", watched)
    plans.append(nearest_within(*frames(spark, cloud(1, CENTRES, 5, 0.1), cloud(2, CENTRES, 5, 0.1)), ["k"], 5000.0, ["name"])._jdf.queryExecution().executedPlan().toString())
    text = "\n".join(plans)
    assert "SortAggregate" not in text and "NestedLoop" not in text and "array_min" in text


def _exchanges_of(plan, columns):
    """Shuffles whose rows carry all these columns."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return _exchanges_of(plan.initialPlan(), columns)
    names = {plan.output().apply(i).name() for i in range(plan.output().size())}
    own = plan.nodeName() == "Exchange" and columns <= names
    children = plan.children()
    return own + sum(_exchanges_of(children.apply(i), columns) for i in range(children.size()))


def test_the_search_of_crowded_cells_shuffles_the_left_points_twice_at_most(spark, monkeypatch):
    """However deep the tree, with nothing broadcast and lists in several parts."""
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
    plans, depths = [], []
    real_store, real_search = scratch.store, geojoin._PointTree.search

    def watched_search(self, *a):
        monkeypatch.setattr(scratch, "store", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan()) or real_store(df, name))
        found = real_search(self, *a)
        plans.append(found._jdf.queryExecution().executedPlan())
        monkeypatch.setattr(scratch, "store", real_store)
        depths.append(self.depth)
        return found

    monkeypatch.setattr(geojoin._PointTree, "search", watched_search)
    left, right = cloud(21, [(139.7, 35.6)], 60, 0.02), cloud(22, [(139.7, 35.6)], 60, 0.02) + cloud(23, [(139.71, 35.61)], 60, 0.00002)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = nearest(*frames(spark, left, right), 5_000.0, cell_points=2, node_points=2, slice_rows=50)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_nearest(left, right, 5_000.0)
    assert depths[0] >= 4
    assert 1 <= sum(_exchanges_of(plan, {"lon", "lat"}) for plan in plans) <= 2


def test_a_dense_spot_far_off_and_equally_near_places(spark):
    """All left points away from a spot with most places; a ring of places
    around one of them, all in one list of several parts."""
    ring = [(10.0 + 0.01 * math.cos(a / 20 * math.pi), 0.01 * math.sin(a / 20 * math.pi)) for a in range(40)]
    left = [(10.0, 0.0)] + cloud(24, [(139.70, 35.60)], 30, 0.005)
    right = ring + cloud(25, [(139.73, 35.60)], 200, 0.00001)
    want = brute_nearest(left, right, 5_000.0)
    got = nearest(*frames(spark, left, right), 5_000.0, cell_points=8, node_points=4)
    assert {k: d for k, (_, d) in got.items()} == {k: d for k, (_, d) in want.items()} and len(got) > 20
    assert {k: v for k, v in got.items() if k != "b0"} == {k: v for k, v in want.items() if k != "b0"}


def test_the_search_is_dealt_over_many_tasks(spark, monkeypatch):
    """Few points are few bytes, but each is compared with hundreds of places."""
    stored, real = {}, scratch.store
    monkeypatch.setattr(scratch, "store", lambda df, name: stored.setdefault(name, real(df, name)))
    nearest(*frames(spark, cloud(31, CENTRES, 60, 0.1), cloud(32, CENTRES, 5, 0.1)), 5_000.0)
    assert len(stored["spots"].inputFiles()) > spark.sparkContext.defaultParallelism


def test_only_places_that_may_be_the_nearest_reach_the_exact_distance(monkeypatch):
    monkeypatch.setattr(geojoin, "_PAIRS_AT_ONCE", 7)
    places = [[(0.01 * i, 0.0, i) for i in range(1, 6)], [(1.01, 0.0, 7), (0.99, 0.0, 8), (1.5, 0.0, 9)], [(5.0, 5.0, 3)]]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64()), ("_rank", pa.int64())]))
    lists = pa.array([[dict(zip(("x", "y", "_rank"), p, strict=True)) for p in row] for row in places], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([0.0, 1.0, 2.0]), pa.array([0.0] * 3), lists], names=["lon", "lat", "_places"])
    parts = list(geojoin._without_farther(iter([batch.slice(0, 1), batch.slice(1)])))
    assert [[p["_rank"] for p in row] for part in parts for row in part.column(2).to_pylist()] == [[1], [7, 8], [3]]
    assert [v for part in parts for v in part.column(0).to_pylist()] == [0.0, 1.0, 2.0]

"""Radius join and nearest-point lookup.

Both are equi-joins on a latitude/longitude grid followed by the exact
distance test. The right-hand points, usually the smaller side, are listed in
every cell they can reach; a left-hand point lies in one cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.functions.geo import EARTH_RADIUS_M, Grid, haversine_m, valid_point
from tatemono.operators.joins import lookup_join, small_or_spread_join, spread_join
from tatemono.operators.rows import global_row_number
from tatemono.sources import scratch

CELL = ["_band", "_cell"]
NODE = [*CELL, "_row", "_column"]
PLOT = ["_plot_band", "_plot_cell", "_plot_row", "_plot_column"]
# Rows of one cell and side that meet in one task: about 4e8 distance tests.
PAIR_SLICE_ROWS = 20_000
# Distance tests of a radius join for which a task is made: some ten seconds.
TASK_PAIRS = 20_000_000
# A cell that lists more points than this is searched through a point tree.
CELL_POINTS = 512
# Points below one tree node at the level where the search lists them.
NODE_POINTS = 32
# Points that a plot of the left side may list; every left point tries them all.
PLOT_POINTS = 96
# Files of the searching points per core.
SEARCH_WAVES = 2
# Distances that a task estimates in one step.
_PAIRS_AT_ONCE = 1 << 19
# Each tree level cuts a node into 4 x 4; a leaf is a millimetre-sized spot.
_STEP_BITS = 2
_TREE_LEVELS = 11

Point = tuple[str, str]


def _in_cell(df: DataFrame, point: Point, grid: Grid) -> DataFrame:
    """Add the one cell of each point; points without coordinates go."""
    lon, lat = F.col(point[0]), F.col(point[1])
    return (
        df.where(valid_point(lon, lat))
        .withColumn("_band", grid.band(lat))
        .withColumn("_cells", grid.cells_in(F.col("_band")))
        .withColumn("_cell", F.pmod(grid.cell_at(lon, F.col("_cells")), F.col("_cells")))
        .drop("_cells")
    )


def _in_reached_cells(df: DataFrame, point: Point, grid: Grid) -> DataFrame:
    """One row per cell that holds any place within the radius of the point."""
    lon, lat = F.col(point[0]), F.col(point[1])
    return (
        df.where(valid_point(lon, lat))
        .withColumn("_band", F.explode(grid.reached_bands(lat)))
        .withColumn("_cells", grid.cells_in(F.col("_band")))
        .withColumn("_cell", F.explode(grid.reached_cells(lon, lat, F.col("_cells"))))
        .drop("_cells")
    )


def _distance(a: Point, b: Point) -> Column:
    return haversine_m(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1]))


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius_m: float,
    left_point: Point = ("lon", "lat"),
    right_point: Point = ("longitude", "latitude"),
    distance: str = "dist_m",
    slice_rows: int = PAIR_SLICE_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """All pairs at most ``radius_m`` apart, with their distance.

    Column names of the two sides must differ. The right side is broadcast up
    to ``broadcast_bytes`` (default: the limit of ``scratch``). Beyond, the
    left side is stored, since its cells are counted before they are joined,
    and the tasks follow the number of distance tests: the pairs in a cell grow
    with the product of its rows, which the bytes of the sides don't show.
    """
    grid = Grid(radius_m)
    cells = _in_cell(left, left_point, grid)
    listed = scratch.store(_in_reached_cells(right, right_point, grid), "listed")
    if scratch.fits(listed, broadcast_bytes):
        pairs = cells.join(F.broadcast(listed), CELL)
    else:
        cells = scratch.store(cells, "cells")
        pairs = spread_join(cells, listed, CELL, slice_rows, tasks=_pair_tasks(cells, listed))
    return (
        pairs.withColumn(distance, _distance(left_point, right_point))
        .where(F.col(distance) <= F.lit(float(radius_m)))
        .drop(*CELL)
    )


def _pair_tasks(cells: DataFrame, listed: DataFrame) -> int:
    """Tasks for the distance tests between two stored sides."""
    left, right = (df.groupBy(*CELL).agg(F.count(F.lit(1)).cast("double").alias(n)) for df, n in ((cells, "_l"), (listed, "_r")))
    tests = left.join(right, CELL).agg(F.sum(F.col("_l") * F.col("_r"))).first()[0] or 0.0
    return max(SEARCH_WAVES * cells.sparkSession.sparkContext.defaultParallelism, math.ceil(tests / TASK_PAIRS))


def _least(found: DataFrame, by: list[str]) -> DataFrame:
    """Smallest distance ``_d`` per group and, of equal ones, the smallest
    ``_rank``. Numbers only, so both steps aggregate in hash tables."""
    ties = found.groupBy(*by, "_d").agg(F.min("_rank").alias("_rank"))
    return ties.groupBy(*by).agg(F.min_by("_rank", "_d").alias("_rank"), F.min("_d").alias("_d"))


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    radius_m: float,
    tiebreak: Sequence[str],
    left_point: Point = ("lon", "lat"),
    right_point: Point = ("longitude", "latitude"),
    distance: str = "dist_m",
    cell_points: int = CELL_POINTS,
    node_points: int = NODE_POINTS,
    slice_rows: int = PAIR_SLICE_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """For each key of ``left`` the nearest row of ``right`` in the radius.

    A key with several points takes the best distance over all of them. Equal
    distances are decided by ``tiebreak``, then by the other right columns,
    NULL last. Keys without a match are absent.

    The right rows are numbered in the order that decides ties, so that the
    search handles numbers only. Each coordinate of the left side is searched
    once. A cell that lists few points holds them in one array, and a left
    point takes the least of it; no pair becomes a row. The other cells are cut
    into plots, each with an array of the points that may be nearest to
    any of its left points, found by a search of whole plots in a tree of the
    right-hand points. The left points themselves are only brought to their
    plots, whatever the depth of the tree.
    """
    grid = Grid(radius_m)
    keys = list(keys)
    others = [c for c in right.columns if c not in {*tiebreak, *right_point}]
    payload = [*tiebreak, *others]
    x, y = right_point

    usable = right.where(valid_point(F.col(x), F.col(y))).select(*payload, x, y)
    order = [F.col(c).asc_nulls_last() for c in [*payload, x, y]]
    ranked = scratch.store(global_row_number(usable, order, "_rank", "places"), "ranked")
    places = ranked.groupBy(x, y).agg(F.min("_rank").alias("_rank"))
    listed = scratch.store(_in_reached_cells(places, right_point, grid), "listed")

    who = list(left_point)
    spots = left.where(valid_point(*[F.col(c) for c in who])).groupBy(*who).agg(F.count(F.lit(1)).alias("_count"))
    # small in bytes but much to compute, so their files are as many as the tasks that search
    spots = scratch.store(spots.repartition(SEARCH_WAVES * left.sparkSession.sparkContext.defaultParallelism), "spots")
    searchers = _in_cell(spots.select(*who), left_point, grid)

    counted = listed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_points"))
    crowded = scratch.store(counted.where(F.col("_points") > cell_points).select(*CELL), "crowded")
    any_crowded = not crowded.isEmpty()
    direct = listed.join(crowded, CELL, "left_anti") if any_crowded else listed
    arrays = direct.groupBy(*CELL).agg(F.collect_list(F.struct(x, y, "_rank")).alias("_places"))  # few points each
    arrays = scratch.store(arrays, "cells")
    met = small_or_spread_join(searchers, arrays, CELL, scratch.fits(arrays, broadcast_bytes), slice_rows)
    found = _nearest_listed(met, left_point, right_point)
    if any_crowded:
        dense = listed.join(crowded, CELL, "left_semi").drop(*CELL).distinct()
        tree = _PointTree(
            scratch.store(dense, "crowded-places"), right_point, grid, node_points, slice_rows, broadcast_bytes,
            list_points=min(cell_points, PLOT_POINTS),
        )
        cells = F.broadcast(crowded) if scratch.fits(crowded, broadcast_bytes) else crowded
        found = found.unionByName(tree.search(searchers.join(cells, CELL, "left_semi"), left_point))
    found = found.where(F.col("_d") <= F.lit(float(radius_m)))

    per_spot = scratch.store(found.join(spots, who), "nearest")
    by_key = lookup_join(left.select(*keys, *who), per_spot, who, keys, "_count", slice_rows, broadcast_bytes)
    best = scratch.store(_least(by_key.where(F.col("_rank").isNotNull()).select(*keys, "_d", "_rank"), keys), "best")
    uses = best.groupBy("_rank").agg(F.count(F.lit(1)).alias("_count"))
    dim = scratch.store(ranked.select("_rank", *payload).join(uses, "_rank"), "chosen")
    named = lookup_join(best, dim, ["_rank"], keys, "_count", slice_rows, broadcast_bytes)
    return named.select(*keys, F.col("_d").alias(distance), *payload)


def _metres(point: Point, lon: Column, lat: Column) -> Column:
    return haversine_m(F.col(point[0]), F.col(point[1]), lon, lat)


def _without_farther(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a longitude, a latitude and an array of places, left with the
    places that may be the nearest: those whose half chord is the least up to
    far more than rounding (six micrometres). The distance itself, and ties,
    are for Spark's own arithmetic to decide."""
    for batch in batches:
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + _PAIRS_AT_ONCE, "right")))
            part = batch.slice(start, stop - start)
            lists = part.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            places = lists.flatten()
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            lon, lat = (np.radians(part.column(i).to_numpy()) for i in (0, 1))
            x, y = (np.radians(places.field(i).to_numpy()) for i in (0, 1))
            with np.errstate(invalid="ignore"):
                h = np.sin((y - np.repeat(lat, lengths)) / 2) ** 2
                h += np.repeat(np.cos(lat), lengths) * np.cos(y) * np.sin((x - np.repeat(lon, lengths)) / 2) ** 2
                chord = np.sqrt(h)
            keep = chord <= np.repeat(np.fmin.reduceat(chord, first) * (1 + 1e-9) + 1e-12, lengths)
            kept = np.concatenate([[0], np.cumsum(np.add.reduceat(keep, first, dtype=np.int32))]).astype(np.int32)
            near = pa.ListArray.from_arrays(pa.array(kept), places.filter(pa.array(keep)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), near.cast(lists.type)], names=part.schema.names)
            start = stop


def _nearest_listed(met: DataFrame, left_point: Point, right_point: Point) -> DataFrame:
    """The least of the array ``_places`` beside each left point."""
    x, y = right_point
    met = met.select(*left_point, "_places")
    met = met.mapInArrow(_without_farther, met.schema)
    near = F.array_min(
        F.transform("_places", lambda p: F.struct(_metres(left_point, p[x], p[y]).alias("_d"), p["_rank"].alias("_rank")))
    )
    return met.select(*left_point, near.alias("_near")).select(*left_point, "_near._d", "_near._rank")


def _located(df: DataFrame, point: Point, grid: Grid) -> DataFrame:
    """Add the place of each point inside its cell, in steps of the finest level."""
    lon, lat = F.col(point[0]), F.col(point[1])
    # a longitude of 180 shares the cell of -180 and must share its box
    level_lon = F.when(lon >= 180.0, lon - 360.0).otherwise(lon)
    scale = F.lit(float(1 << (_STEP_BITS * _TREE_LEVELS)))
    top = F.lit((1 << (_STEP_BITS * _TREE_LEVELS)) - 1).cast("long")
    row = lat / F.lit(grid.band_deg) - F.floor(lat / F.lit(grid.band_deg))
    column = (level_lon + 180.0) / (F.lit(360.0) / F.col("_width")) - F.col("_cell")
    return (
        df.withColumn("_width", grid.cells_in(F.col("_band")))
        .withColumn("_row", F.greatest(F.least(F.floor(row * scale), top), F.lit(0).cast("long")))
        .withColumn("_column", F.greatest(F.least(F.floor(column * scale), top), F.lit(0).cast("long")))
        .withColumn("_level_lon", level_lon)
        .drop("_width")
    )


def _boxes(located: DataFrame, lat: str, *more: Column) -> DataFrame:
    """Bounding box of the points in each node."""
    return located.groupBy(*NODE).agg(
        F.min("_level_lon").alias("_west"),
        F.max("_level_lon").alias("_east"),
        F.min(lat).alias("_south"),
        F.max(lat).alias("_north"),
        *more,
    )


def _centre_and_reach(x: str, y: str, reach: str) -> list[Column]:
    """The centre of a box and its reach in metres, by the way along the
    meridian, then along the parallel."""
    to_m = F.lit(EARTH_RADIUS_M * (1 + 1e-9))
    flattest = F.when(
        (F.col("_south") <= 0) & (F.col("_north") >= 0), F.lit(0.0)
    ).otherwise(F.least(F.abs("_south"), F.abs("_north")))
    metres = to_m * (
        F.radians(F.col("_north") - F.col("_south")) / 2
        + F.cos(F.radians(flattest)) * F.radians(F.col("_east") - F.col("_west")) / 2
    ) + F.lit(1e-6)
    return [
        ((F.col("_west") + F.col("_east")) / 2).alias(x),
        ((F.col("_south") + F.col("_north")) / 2).alias(y),
        metres.alias(reach),
    ]


def _node_of(level: int) -> dict[str, Column]:
    shift = (_TREE_LEVELS - level) * _STEP_BITS
    return {c: F.shiftright(F.col(c), shift) for c in ("_row", "_column")}


class _PointTree:
    """Grid cells cut into 4 x 4 again and again; each level is a stored table
    with the box and the number of the points in each node.

    The left points are cut in the same way, into plots. A search keeps, per
    plot, the nodes whose nearest possible place is not beyond the farthest
    possible place of another node or the radius, seen from anywhere in the
    plot. A plot whose nodes hold few points is done; the others are cut.
    """

    def __init__(
        self,
        places: DataFrame,
        point: Point,
        grid: Grid,
        node_points: int,
        slice_rows: int,
        broadcast_bytes: int | None = None,
        list_points: int = PLOT_POINTS,
    ):
        self.point, self.grid, self.slice_rows, self.broadcast_bytes = point, grid, slice_rows, broadcast_bytes
        self.list_points = max(1, list_points)
        self.placed = scratch.store(_located(_in_cell(places, point, grid), point, grid), "placed")
        # levels are made until every node is small; the last one may keep
        # nodes whose points are only millimetres apart
        self.levels: list[DataFrame] = []
        most = node_points + 1
        while most > node_points and len(self.levels) <= _TREE_LEVELS:
            cut = self.placed.withColumns(_node_of(len(self.levels)))
            nodes = scratch.store(_boxes(cut, point[1], F.count(F.lit(1)).alias("_points")), "nodes")
            self.levels.append(nodes)
            most = nodes.agg(F.max("_points")).first()[0] or 0
        self.depth = len(self.levels) - 1

    def _at(self, level: int) -> DataFrame:
        return self.levels[level].select(*NODE, "_points", *_centre_and_reach("_x", "_y", "_reach"))

    def _plots(self, located: DataFrame, lat: str) -> list[DataFrame]:
        """Boxes of the left points in each plot of each level. Only the finest
        plots are made from the points, coarser ones from the next finer."""
        levels = [scratch.store(_boxes(located.withColumns(_node_of(self.depth)), lat), "plots")]
        for _ in range(self.depth):
            finer = levels[-1].withColumns({c: F.shiftright(F.col(c), _STEP_BITS) for c in ("_row", "_column")})
            corners = {"_west": F.min, "_east": F.max, "_south": F.min, "_north": F.max}
            coarser = finer.groupBy(*NODE).agg(*[least(c).alias(c) for c, least in corners.items()])
            levels.append(scratch.store(coarser, "plots"))
        return levels[::-1]

    def _roots(self) -> DataFrame:
        """For each cell the top nodes from which some place reaches it."""
        x, y = self.point
        own = {c: f"_from{c}" for c in CELL}
        reaching = self.placed.select(x, y, *CELL).withColumnsRenamed(own)
        pairs = _in_reached_cells(reaching, self.point, self.grid).select(*CELL, *own.values()).distinct()
        roots = pairs.join(self._at(0).withColumnsRenamed(own), list(own.values()))
        cells = dict(zip(CELL, PLOT[:2], strict=True))
        return scratch.store(roots.withColumnsRenamed(cells).withColumnsRenamed({f: c for c, f in own.items()}), "roots")

    def search(self, searchers: DataFrame, point: Point) -> DataFrame:
        """Distance ``_d`` and ``_rank`` of the nearest place of every left
        point that has one in the radius, and of some that have none."""
        who = list(point)
        located = scratch.store(_located(searchers, point, self.grid), "searchers")
        plots = self._plots(located, point[1])
        top = plots[0].select(
            *[F.col(n).alias(p) for n, p in zip(NODE, PLOT, strict=True)], *_centre_and_reach("_px", "_py", "_preach")
        )
        pairs = self._prune(self._join(top, self._roots(), PLOT[:2]))
        lists = None
        for level in range(self.depth + 1):
            total = F.sum("_points").over(Window.partitionBy(*PLOT))
            pairs = scratch.store(pairs.withColumn("_total", total), "pairs")
            done = F.lit(level == self.depth) | (F.col("_total") <= self.list_points)
            listed = self._lists(pairs.where(done), level)
            lists = listed if lists is None else lists.unionByName(listed)
            rest = pairs.where(~done)
            if rest.isEmpty():
                break
            pairs = self._descend(rest.drop("_total"), plots[level + 1], level + 1)

        lists = scratch.store(lists, "lists")
        own = [
            F.struct(F.lit(n).alias("_level"), *[_node_of(n)[c].alias(f"_plot{c}") for c in ("_row", "_column")])
            for n in range(level + 1)
        ]
        cells = [F.col(c).alias(p) for c, p in zip(CELL, PLOT, strict=False)]
        sought = located.select(*who, *cells, F.explode(F.array(*own)).alias("_own")).select(*who, *PLOT[:2], "_own.*")
        small = scratch.fits(lists, self.broadcast_bytes)
        met = small_or_spread_join(sought, lists.drop("_part"), ["_level", *PLOT], small, self.slice_rows)
        found = _nearest_listed(met, point, self.point)
        parted = lists.agg(F.max("_part")).first()[0] or 0
        return _least(found.repartition(*who), who) if parted else found

    def _lists(self, done: DataFrame, level: int) -> DataFrame:
        """The places in the nodes of each plot, in arrays of about
        ``list_points``; a plot has several only where many places are about
        equally near."""
        x, y = self.point
        places = self.placed.withColumns(_node_of(level)).select(*NODE, x, y, "_rank")
        listed = self._join(done.select(*PLOT, *NODE, "_total"), places, NODE)
        parts = F.ceil(F.col("_total") / F.lit(self.list_points))
        return (
            listed.withColumn("_part", F.pmod(F.xxhash64(x, y), parts))
            .groupBy(*PLOT, "_part")
            .agg(F.collect_list(F.struct(x, y, "_rank")).alias("_places"))
            .withColumn("_level", F.lit(level))
        )

    def _descend(self, pairs: DataFrame, plots: DataFrame, level: int) -> DataFrame:
        """The same pairs one level deeper: first the plots are cut, then,
        of what is left, the nodes."""
        inner = {"_row": "_inner_row", "_column": "_inner_column"}
        outer = {c: F.shiftright(F.col(i), _STEP_BITS) for c, i in inner.items()}
        finer = plots.select(*NODE, *_centre_and_reach("_px", "_py", "_preach")).withColumnsRenamed(inner).withColumns(outer)
        finer = finer.withColumnsRenamed(dict(zip(NODE, PLOT, strict=True)))
        cut = self._join(pairs.drop("_px", "_py", "_preach"), finer, PLOT).drop("_plot_row", "_plot_column")
        cut = self._prune(cut.withColumnsRenamed({i: f"_plot{c}" for c, i in inner.items()}))
        children = self._at(level).withColumnsRenamed(inner).withColumns(outer)
        cut = self._join(cut.drop("_x", "_y", "_reach", "_points"), children, NODE).drop("_row", "_column")
        return self._prune(cut.withColumnsRenamed({i: c for c, i in inner.items()}))

    def _join(self, pairs: DataFrame, nodes: DataFrame, on: list[str]) -> DataFrame:
        nodes = scratch.store(nodes, "side")
        small = scratch.fits(nodes, self.broadcast_bytes)
        return small_or_spread_join(pairs if small else scratch.store(pairs, "pairs"), nodes, on, small, self.slice_rows)

    def _prune(self, pairs: DataFrame) -> DataFrame:
        """Drop nodes that cannot hold the nearest place of any point of the
        plot. A plot has a few dozen nodes, so the window stays small."""
        to_centre = haversine_m(F.col("_px"), F.col("_py"), F.col("_x"), F.col("_y"))
        reach = F.col("_reach") + F.col("_preach")
        farthest = F.min(F.col("_to") + reach).over(Window.partitionBy(*PLOT))
        slack = F.lit(1e-3)
        return (
            pairs.withColumn("_to", to_centre)
            .where(F.col("_to") - reach <= F.lit(float(self.grid.radius_m)) + slack)
            .withColumn("_bound", farthest)
            .where(F.col("_to") - reach <= F.col("_bound") + slack)
            .drop("_to", "_bound")
        )

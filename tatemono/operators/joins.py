"""Equi-joins that stay balanced when one key holds a large share of the rows.

A side is broadcast only if its measured size is small. Otherwise both sides
are shuffled, and a key with too many rows is cut into slices: its rows on one
side are spread over the slices by a hash, its rows on the other side are
copied to each slice. No row is dropped. The size of a slice is bounded,
whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.sources import scratch

# Rows of one key that a single task may hold.
SLICE_ROWS = 200_000
# A grid of slices copies a row at most so often, unless its slices are full.
GRID_COPIES = 16
# A full slice of a grid, if ``slice_rows`` is less.
GRID_SLICE_ROWS = 20_000


def _slices(count: Column, rows_per_slice: int) -> Column:
    return F.ceil(count / F.lit(rows_per_slice))


def _grid_slices(count: Column, slice_rows: int) -> Column:
    """Slices of one side of a key, each of which takes a copy of every row of
    the other side. Very small slices would copy more rows than they pair, so
    beyond ``GRID_COPIES`` slices first their size grows, up to that of a full
    one, and only then their number."""
    full = _slices(count, max(slice_rows, GRID_SLICE_ROWS))
    return F.greatest(full, F.least(_slices(count, slice_rows), F.lit(GRID_COPIES).cast("long")))


def _slot(spread_by: Sequence[str], slices: Column) -> Column:
    return F.pmod(F.xxhash64(*spread_by), slices)


def _every_slot(slices: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))


def broadcast_threshold(total_rows: int, key_bytes: float, limit: int) -> int | None:
    """Fewer keys than fit in ``limit`` bytes have more rows than this; None
    if not one key fits."""
    fitting = int(limit // max(key_bytes, 1.0))
    return total_rows // fitting if fitting > 0 else None


def _with_slices(rows: DataFrame, hot: DataFrame, keys: list[str], total: int, limit: int) -> DataFrame:
    """Left join of ``rows`` to the stored table of hot keys, which holds a row
    count ``_hot`` besides the columns to add.

    The table is broadcast if it is small. If not, its hottest keys, as many
    as are surely small, are broadcast, and the rows of the others, none of
    which has very many, are shuffled.
    """
    size = scratch.measure(hot)
    if size.bytes <= limit:
        return rows.join(F.broadcast(hot.drop("_hot")), keys, "left")
    least = broadcast_threshold(total, size.bytes / size.rows, limit)
    if least is None:
        return rows.join(hot.drop("_hot"), keys, "left")
    hottest = hot.where(F.col("_hot") > least).drop("_hot")
    warm = hot.where(F.col("_hot") <= least).drop("_hot")
    others = rows.join(F.broadcast(hottest), keys, "left_anti").join(warm, keys, "left")
    return rows.join(F.broadcast(hottest), keys).unionByName(others)


def lookup_join(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    count: str,
    slice_rows: int = SLICE_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left join of ``rows`` to ``dim``, which has one row per key.

    ``dim`` should be a stored table: its size is measured here, and it is
    broadcast up to ``broadcast_bytes`` (default: the limit of ``scratch``).
    Its column ``count`` holds how many rows have the key; it does not reach
    the result. ``spread_by`` names columns that tell rows of the same key
    apart, such as a row id; they must not change when a lost task runs again.
    """
    keys = list(keys)
    limit = scratch.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    size = dim.agg(
        F.sum(scratch.row_bytes(dim)).alias("bytes"), F.sum(count).alias("rows"), F.max(count).alias("most")
    ).first()
    if (size["bytes"] or 0) <= limit:
        return rows.join(F.broadcast(dim.drop(count)), keys, "left")

    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    # rows without a key match nothing and may go anywhere
    anywhere = F.when(no_key, F.xxhash64(*spread_by))
    if (size["most"] or 0) <= slice_rows:
        spread = rows.withColumn("_slot", F.coalesce(anywhere, F.lit(0).cast("long")))
        copies = dim.drop(count).withColumn("_slot", F.lit(0).cast("long"))
        return spread.join(copies, [*keys, "_slot"], "left").drop("_slot")
    hot = scratch.store(
        dim.where(F.col(count) > slice_rows).select(
            *keys, _slices(F.col(count), slice_rows).alias("_slices"), F.col(count).alias("_hot")
        ),
        "hot",
    )
    slices = F.coalesce(F.col("_slices"), F.lit(1).cast("long"))
    spread = _with_slices(rows, hot, keys, size["rows"], limit)
    spread = spread.withColumn("_slot", F.coalesce(anywhere, _slot(spread_by, slices)))
    copies = _with_slices(dim.drop(count), hot, keys, size["rows"], limit).withColumn("_slot", _every_slot(slices))
    return spread.drop("_slices").join(copies.drop("_slices"), [*keys, "_slot"], "left").drop("_slot")


def _numbered(df: DataFrame, out: str) -> DataFrame:
    """Stored table with a number per row. Stored, so that the numbers stay
    when a task runs again; they tell even exact copies apart."""
    return scratch.store(df.withColumn(out, F.monotonically_increasing_id()), "spread")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    slice_rows: int = SLICE_ROWS,
    broadcast_bytes: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Inner many-to-many equi-join; a hot key becomes a grid of slices.

    A slice pairs at most about ``slice_rows`` rows of either side of a key,
    also if they are copies of one row; where that makes more than
    ``GRID_COPIES`` slices of a side, up to ``GRID_SLICE_ROWS``. The keys of both
    sides are counted first; only rows of hot keys are stored, to number them. With
    ``tasks`` both sides are dealt to that many tasks, however few bytes they
    have, and merged: for sides of few rows and very many pairs.
    """

    def meet(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        if tasks is None:
            return a.join(b, on)
        return a.repartition(tasks, *on).join(b.repartition(tasks, *on).hint("merge"), on)

    keys = list(keys)
    limit = scratch.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    left_counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ln"))
    right_counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rn"))
    hot = scratch.store(
        left_counts.join(right_counts, keys)
        .where((F.col("_ln") > slice_rows) | (F.col("_rn") > slice_rows))
        .select(
            *keys,
            _grid_slices(F.col("_ln"), slice_rows).alias("_ls"),
            _grid_slices(F.col("_rn"), slice_rows).alias("_rs"),
            (F.col("_ln") + F.col("_rn")).alias("_hot"),
        ),
        "hot",
    )
    total = hot.agg(F.sum("_hot").alias("n")).first()["n"]
    if total is None:
        return meet(left, right, keys)

    def split(side: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = _with_slices(side, hot, keys, total, limit)
        return marked.where(F.col("_ls").isNull()).drop("_ls", "_rs"), marked.where(F.col("_ls").isNotNull())

    left_cold, left_hot = split(left)
    right_cold, right_hot = split(right)
    left_rows = (
        _numbered(left_hot, "_lrow")
        .withColumn("_lslot", _slot(["_lrow"], F.col("_ls")))
        .withColumn("_rslot", _every_slot(F.col("_rs")))
        .drop("_ls", "_rs", "_lrow")
    )
    right_rows = (
        _numbered(right_hot, "_rrow")
        .withColumn("_rslot", _slot(["_rrow"], F.col("_rs")))
        .withColumn("_lslot", _every_slot(F.col("_ls")))
        .drop("_ls", "_rs", "_rrow")
    )
    # the optimizer knows the sizes before the copies are made, so its own
    # choice may be to broadcast all copies of one side, through the driver
    pairs = meet(left_rows, right_rows.hint("merge"), [*keys, "_lslot", "_rslot"]).drop("_lslot", "_rslot")
    return meet(left_cold, right_cold, keys).unionByName(pairs)


def small_or_spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], small: bool, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Inner join: broadcast ``right`` if it was measured as small, else cut
    hot keys into slices."""
    if small:
        return left.join(F.broadcast(right), list(keys))
    return spread_join(left, right, keys, slice_rows)

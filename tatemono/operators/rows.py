"""Row ids, pivots and tagged unions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.sources import scratch

BLOCK_VALUES = 100_000  # distinct values that the median looks at in one task
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these


def _range_sorted(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Stored table in global order: ``_part`` numbers the ranges, ``_pos``
    the rows inside one. Stored, since both must stay as first computed."""
    address = F.col("_address")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_address", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright(address, _POSITION_BITS),
                "_pos": address.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
            }
        )
        .drop("_address")
    )
    return scratch.store(placed, name)


def global_row_number(df: DataFrame, order: Sequence[Column], out: str, name: str = "ranked") -> DataFrame:
    """``row_number() over (order by ...)`` without a single-task sort.

    Rows are range-partitioned and sorted; the count of rows in earlier ranges
    is added to the position inside the range. Only one row per range passes
    through the unpartitioned window. ``order`` should identify a row, or else
    copies of one row share a task and get their numbers in any order.
    """
    placed = _range_sorted(df, order, name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.store(
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")),
        "offsets",
    )
    number = F.col("_before") + F.col("_pos") + F.lit(1)
    # offsets has one row per range, so never more than the shuffle partitions
    return placed.join(F.broadcast(offsets), "_part").withColumn(out, number).drop("_part", "_pos", "_before")


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column; NULL and NaN skipped, mean of the middle
    two of an even count, ``None`` without any value.

    Values are counted first, so that copies cost nothing, then put in global
    order. Counts of blocks of neighbours tell which blocks hold a middle rank;
    only those are sorted by a window, at most ``BLOCK_VALUES`` rows each.
    """
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.*")
    counted = (
        values.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = _range_sorted(counted, [F.col("name"), F.col("value")], "median")
    placed = placed.withColumn("_block", F.floor(F.col("_pos") / F.lit(BLOCK_VALUES)))
    block = ["name", "_part", "_block"]
    by_name = Window.partitionBy("name")
    before = by_name.orderBy("_part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy(*block)
        .agg(F.sum("n").alias("rows"))
        .select(
            *block,
            "rows",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
            F.sum("rows").over(by_name).alias("total"),
        )
    )
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (start <= rank) & (rank < start + size)

    middle = ranges.where(
        holds(low, F.col("before"), F.col("rows")) | holds(high, F.col("before"), F.col("rows"))
    ).select(*block, "before", "total")
    running = Window.partitionBy(*block).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    # at most two blocks per column, so the broadcast side stays tiny
    ranked = placed.join(F.broadcast(middle), block).withColumn(
        "start", F.col("before") + F.coalesce(F.sum("n").over(running), F.lit(0))
    )
    start, size = F.col("start"), F.col("n")
    found = (
        ranked.where(holds(low, start, size) | holds(high, start, size))
        .groupBy("name")
        .agg(((F.min("value") + F.max("value")) / 2).alias("median"))
        .collect()  # one row per column
    )
    medians = {row["name"]: row["median"] for row in found}
    return {c: medians.get(c) for c in columns}


def approx_medians(df: DataFrame, columns: Sequence[str], rank_error: float) -> dict[str, float | None]:
    """Median of each column within a rank error: the share of smaller values
    is off one half by at most ``rank_error``. NULL and NaN are skipped.

    One aggregation with a quantile sketch per column, whose size depends on
    the error only and which is merged without a shuffle of values. The value
    returned is always one of the column.
    """
    accuracy = math.ceil(1 / rank_error)
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), 0.5, accuracy).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return dict(zip(columns, row, strict=True))


def conditional_pivot(
    df: DataFrame, keys: Sequence[str], on: str, values: Mapping[object, str], measure: str
) -> DataFrame:
    """One column per wanted value of ``on``: the maximum of ``measure`` over
    the rows with that value. A single partial aggregation; keys that have
    none of the values stay, with NULLs."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(on) == F.lit(value), F.col(measure))).alias(name) for value, name in values.items()]
    )


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by name with a literal tag column; a column that a part lacks
    is NULL there, typed as in the other part."""
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in parts.items()]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result

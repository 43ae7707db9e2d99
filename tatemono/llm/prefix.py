"""Rows in one global order, with running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.sources import scratch

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these

PART, POS = "_part", "_pos"


def in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Stored table in global order: ``_part`` numbers its ranges, ``_pos`` the
    rows inside one. ``order`` should tell rows apart, so that no range grows
    with the number of equal rows."""
    address = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_address", address)
    placed = placed.withColumns(
        {
            PART: F.shiftright("_address", _POSITION_BITS),
            POS: F.col("_address").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    return scratch.store(placed.drop("_address"), name)


def totals_before(placed: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Per range (and group): its total and that of the earlier ranges. At
    most one row per range, and per range and group."""
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(*by, PART).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    return scratch.store(blocks.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))), "blocks")


def running_in_block(value: str, by: Sequence[str] = ()) -> Column:
    """Total of ``value`` up to and with the row, inside its range (and group)."""
    window = Window.partitionBy(*by, PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(window)

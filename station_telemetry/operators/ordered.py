"""Numbering and running totals over keys of any size, for any order.

For orders that are not one whole number (see `slices` for those). Rows are range-partitioned on
key and order, so a large key spans many tasks, then written once with their position. Each
partition's totals are small; carrying them over the partitions of a key gives every row its
place. The written copy is what makes the two readings agree: a second run of the range shuffle
could choose other bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.session import written

_HELPERS = ("_position", "_part", "_first", "_before", "_total")
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _placed(df: DataFrame, keys: list[str], order_by: list[str], partitions: int | None) -> DataFrame:
    ranges = [*keys, *order_by]
    if partitions is None:
        spread = df.repartitionByRange(*ranges)
    else:
        spread = df.repartitionByRange(partitions, *ranges)
    placed = spread.sortWithinPartitions(*ranges).withColumn(
        "_position", F.monotonically_increasing_id()
    )
    return written(placed, "ordered").withColumn(
        "_part", F.shiftright("_position", _POSITION_BITS)
    )


def _carried(placed: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """Per (key, partition): the key's total before and overall, and its first position here.

    Written, so that its size is known: Spark broadcasts it when small instead of shuffling the
    rows once more.
    """
    key = Window.partitionBy(*keys)
    earlier = key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return written(
        placed.groupBy(*keys, "_part")
        .agg(F.sum(amount).alias("_here"), F.min("_position").alias("_first"))
        .select(
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            F.col("_part").alias("_c_part"),
            "_first",
            F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_here").over(key).alias("_total"),
        ),
        "carried",
    )


def _with_carried(placed: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    match = F.col("_part") == F.col("_c_part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return placed.join(carried, match).drop("_c_part", *[f"_c_{k}" for k in keys])


def number_rows(
    df: DataFrame, keys: list[str], order_by: list[str], into: str, partitions: int | None = None
) -> DataFrame:
    """Consecutive numbers from 1 within `keys`, in the order of `order_by` (a total order)."""
    placed = _placed(df, keys, order_by, partitions)
    carried = _carried(placed, keys, F.lit(1))
    return (
        _with_carried(placed, carried, keys)
        .withColumn(into, F.col("_before") + F.col("_position") - F.col("_first") + 1)
        .drop(*_HELPERS)
    )


def running_sum(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    amount: str,
    into: str,
    total: str,
    partitions: int | None = None,
) -> DataFrame:
    """Sum of `amount` over this row and all before it within `keys`, and over the whole key.

    `order_by` must be a total order.
    """
    placed = _placed(df, keys, order_by, partitions)
    carried = _carried(placed, keys, F.col(amount))
    upto = (
        Window.partitionBy(*keys, "_part")
        .orderBy("_position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_carried(placed.withColumn("_local", F.sum(amount).over(upto)), carried, keys)
        .withColumn(into, F.col("_before") + F.col("_local"))
        .withColumn(total, F.col("_total"))
        .drop("_local", *_HELPERS)
    )

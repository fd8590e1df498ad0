"""Order-dependent work over keys of any size, in two levels.

A plain `row_number`/`lag`/running sum over `partitionBy(key)` sorts a whole key in one task, and
one station may hold a third of all rows. When the order column is a unique whole number (an
offset, a sequence number), the key is cut into slices of consecutive numbers instead:

1. per (key, slice), the window runs over at most 2**SLICE_BITS numbers;
2. one summary row per slice is carried across slices by a window over the summaries.

The rows and the summaries are hash-partitioned by the same (key, slice), and a key's slices
spread over the cluster. Keys and order values must not be null. The numbers should be dense, as
offsets and sequence numbers are: far apart, they make as many slices as rows, and `ordered` is
the better tool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_BITS = 18
SLICE = "_slice"


def cut(df: DataFrame, order: str, bits: int = SLICE_BITS) -> DataFrame:
    """Adds the slice number of each row."""
    return df.withColumn(SLICE, F.shiftright(F.col(order), bits))


def within(keys: list[str], order: str) -> Window:
    """Window over the rows of one slice."""
    return Window.partitionBy(*keys, SLICE).orderBy(order)


def across(keys: list[str]) -> Window:
    """Window over the slice summaries of one key."""
    return Window.partitionBy(*keys).orderBy(SLICE)


def total_before(amount: Column, keys: list[str]) -> Column:
    """Sum of `amount` over the slices before this one."""
    earlier = across(keys).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(earlier), F.lit(0))


def number_rows(
    df: DataFrame, keys: list[str], order: str, into: str, bits: int = SLICE_BITS
) -> DataFrame:
    """Consecutive numbers from 1 within `keys`, in the order of a unique whole-number column."""
    rows = cut(df, order, bits)
    starts = (
        rows.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, SLICE, total_before(F.col("_rows"), keys).alias("_before"))
    )
    return (
        rows.withColumn("_local", F.row_number().over(within(keys, order)))
        .join(starts, [*keys, SLICE])
        .withColumn(into, F.col("_before") + F.col("_local"))
        .drop(SLICE, "_local", "_before")
    )

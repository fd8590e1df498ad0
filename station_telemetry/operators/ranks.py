"""Exact ranks without a sort, and sketches that merge.

A rank is found by narrowing: rows are counted in bins of their value, and only the bin that holds
the rank is looked at again. What is shuffled is a count for each bin and task, whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.session import written

BINS = 1_024
#: Size parameter of the sketches, and the error of ranks, as a share of the rows, they stay within.
SKETCH_K = 4_096
RANK_ERROR = 0.0025
_LARGEST = 1.7976931348623157e308  # fixed value: the largest double


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Never falls as the value rises; the ends have bins of their own, so every round narrows.

    Logarithms keep long tails apart. Infinities are ends at some time, and NaN is above all.
    """
    as_double = lambda c: F.least(F.greatest(c.cast("double"), F.lit(-_LARGEST)), F.lit(_LARGEST)) / 2
    inside = F.log1p(as_double(value) - as_double(low))
    share = F.coalesce(F.try_divide(inside, F.log1p(as_double(high) - as_double(low))), F.lit(0.5))
    middle = 1 + F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    return F.when(value == low, 0).when(value == high, BINS + 1).otherwise(middle)


def values_at(rows: DataFrame, series: str, value: str, wanted: DataFrame) -> DataFrame:
    """(_of, name, value) for wanted (_of, name, rank, low, high): the value at each rank of a series.

    Ranks count from 1; low and high are the least and greatest value of the series. The wanted ranks
    are a few rows a series, whose size Spark knows, as they are written after each round.
    """
    open_ = written(wanted.select("_of", "name", "rank", "low", "high", F.lit(0).cast("bigint").alias("before")), "ranks")
    found = []
    while True:
        found.append(open_.where("low <=> high").select("_of", "name", F.col("low").alias("value")))
        open_ = open_.where("not (low <=> high)")
        if open_.isEmpty():
            break
        ranges = open_.select("_of", "low", "high").distinct()
        here = F.col(series).eqNullSafe(F.col("_of")) & F.col(value).between(F.col("low"), F.col("high"))
        counted = (
            rows.select(series, value)
            .join(ranges, here)
            .groupBy("_of", "low", "high", _bin(F.col(value), F.col("low"), F.col("high")).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("bin_low"), F.max(value).alias("bin_high"))
        )
        upto = Window.partitionBy("_of", "low", "high").orderBy("bin")
        placed = counted.withColumn("upto", F.sum("n").over(upto)).select(
            F.col("_of").alias("_bin_of"), F.col("low").alias("_low"), F.col("high").alias("_high"), "n", "upto", "bin_low", "bin_high"
        )
        holds = (
            F.col("_of").eqNullSafe(F.col("_bin_of"))
            & F.col("low").eqNullSafe(F.col("_low"))
            & F.col("high").eqNullSafe(F.col("_high"))
        )
        rest = F.col("rank") - F.col("before")
        open_ = written(
            open_.join(placed, holds)
            .where((rest <= F.col("upto")) & (rest > F.col("upto") - F.col("n")))
            .select(
                "_of", "name", "rank", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"),
                (F.col("before") + F.col("upto") - F.col("n")).alias("before"),
            ),
            "ranks",
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def sketches(measurements: DataFrame, series: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """(series, count, total, max, sketch) of one batch, to be kept and merged later."""
    v = F.col(value).cast("double")
    return measurements.where(v.isNotNull()).groupBy(series).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(v).alias("total"),
        F.max(v).alias("max"),
        F.kll_sketch_agg_double(v, k).alias("sketch"),
    )


def merged(kept: DataFrame, series: str) -> DataFrame:
    """Sketches of any number of batches as one a series, in the same columns."""
    return kept.groupBy(series).agg(
        F.sum("count").alias("count"),
        F.sum("total").alias("total"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def summary_of(kept: DataFrame, series: str, percentiles: dict[str, int]) -> DataFrame:
    """count, mean, percentiles and max of merged sketches; ranks are off by RANK_ERROR at most.

    That is over three times what sketches of this size stay within in 99 of 100 cases.
    """
    quantile = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100).cast("double"))
    return kept.select(
        series,
        "count",
        (F.col("total") / F.col("count")).alias("mean"),
        *[quantile(p).alias(name) for name, p in percentiles.items()],
        "max",
    )

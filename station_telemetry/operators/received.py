"""Which numbers have arrived, as bitmaps of fixed size.

One bitmap of 4 KiB tells which of 32,768 consecutive numbers of a key are there. Tasks build their
own bitmaps before the shuffle, so what is shuffled is bitmaps, never a row for each number, and
copies of a number vanish by themselves. Bitmaps of several batches merge by OR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.session import written

SPAN = 32_768  # fixed value: the numbers of one of Spark's bitmaps
_GAP = "struct<missing_from:bigint,missing_to:bigint>"


def bitmaps(readings: DataFrame, by: tuple[str, ...] = ("station_id",), number: str = "s_no") -> DataFrame:
    """(…by, bucket, bits, last): the bitmap of each bucket and the highest number in it."""
    n = F.col(number)
    return (
        readings.where(n.isNotNull())
        .select(*by, F.bitmap_bucket_number(n).alias("bucket"), F.bitmap_bit_position(n).alias("_bit"), n.alias("_n"))
        .groupBy(*by, "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bits"), F.max("_n").alias("last"))
    )


def merged(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Bitmaps of several batches as one; a number counts once however many batches have it."""
    for other in more:
        first = first.unionByName(other)
    keys = [c for c in first.columns if c not in ("bits", "last")]
    return first.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"), F.max("last").alias("last"))


def totals(maps: DataFrame) -> DataFrame:
    """(…by, expected, received): highest and different numbers of each key."""
    keys = [c for c in maps.columns if c not in ("bucket", "bits", "last")]
    return maps.groupBy(*keys).agg(
        F.max("last").alias("expected"), F.sum(F.bitmap_count("bits")).alias("received")
    )


def _named(value: Column, use) -> Column:
    """`use` of a value that is worked out once, however often it occurs there."""
    return F.transform(F.array(value), use)[0]


def _places(bits: Column) -> Column:
    """Positions of the bits that are set, ascending; a bitmap's lowest bit comes first in a byte."""

    def word(i: Column) -> Column:
        return F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")

    def set_ones(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.lit(SPAN - 1))
        inside = lambda p: F.lit(56) - F.shiftright(p % 64, 3) * 8 + p % 8
        return F.filter(at, lambda p: F.getbit(words[F.shiftright(p, 6)], inside(p)) == 1)

    return _named(F.transform(F.sequence(F.lit(0), F.lit(SPAN // 64 - 1)), word), set_ones)


def gaps(maps: DataFrame) -> DataFrame:
    """Runs of missing numbers from 1 on: (…by, missing_from, missing_to, missing).

    Runs inside a bitmap come from its bits; runs across bitmaps from the last number before it.
    """
    keys = [c for c in maps.columns if c not in ("bucket", "bits", "last")]
    known = written(maps.where(F.col("bucket") >= 1), "bitmaps")
    before = F.lag("last", 1, 0).over(Window.partitionBy(*keys).orderBy("bucket"))
    carried = known.select(*keys, "bucket", before.alias("_before"))
    base = (F.col("bucket") - 1) * SPAN + 1

    def runs(places: Column) -> Column:
        n = F.size(places)
        between = F.zip_with(
            F.slice(places, F.lit(1), n - 1),
            F.slice(places, F.lit(2), n - 1),
            lambda a, b: F.struct((base + a + 1).alias("missing_from"), (base + b - 1).alias("missing_to")),
        )
        inner = F.filter(between, lambda g: g["missing_from"] <= g["missing_to"])
        return F.struct((base + places[0]).alias("first"), inner.alias("inner"))

    none = F.array().cast(f"array<{_GAP}>")
    whole = F.struct(base.alias("first"), none.alias("inner"))
    found = F.when(F.bitmap_count("bits") == SPAN, whole).otherwise(_named(_places(F.col("bits")), runs))
    border = F.struct((F.col("_before") + 1).alias("missing_from"), (F.col("_found.first") - 1).alias("missing_to"))
    return (
        known.withColumn("_found", found)
        .join(carried, [*keys, "bucket"])
        .select(*keys, F.inline(F.concat(F.array(border), F.col("_found.inner"))))
        .where(F.col("missing_from") <= F.col("missing_to"))
        .withColumn("missing", F.col("missing_to") - F.col("missing_from") + 1)
    )

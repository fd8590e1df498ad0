"""Analyses of the ingested readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.functions import utc_date
from station_telemetry.operators import ranks, received, slices

# The percentiles of the summary.
PERCENTILES = {"p50": 50, "p95": 95, "p99": 99}
EXPLODE_STEP = 65_536


def battery_distribution(documents: DataFrame, exclude_not_available: bool = False) -> DataFrame:
    """Readings and share in percent per battery status.

    The window without keys runs over the grouped rows, one per state of the enum.
    """
    status = F.col("battery_status")
    rows = documents.where(status != "NOT_AVAILABLE") if exclude_not_available else documents
    everything = Window.partitionBy()
    return (
        rows.groupBy("battery_status")
        .agg(F.count(F.lit(1)).alias("readings"))
        .withColumn(
            "share_pct",
            F.col("readings").cast("double") * 100 / F.sum("readings").over(everything),
        )
    )


def archive_manifest(readings: DataFrame) -> DataFrame:
    """Records per (station_id, date), the partitions a flush writes."""
    return readings.groupBy(
        F.col("stationId").alias("station_id"), utc_date(F.col("statusTimeStamp")).alias("date")
    ).agg(F.count(F.lit(1)).alias("records"))


def dropped_per_station(
    documents: DataFrame, by: tuple[str, ...] = ("station_id",), unique: bool = False
) -> DataFrame:
    """Messages lost per station, from gaps in numbers that start at 1.

    Numbers are combined into bitmaps before the shuffle (`received`). Say `unique` when no number
    occurs twice, as in the document table: a plain count then does. Losses after the last received
    number are invisible, and a restarted counter hides losses unless rows are grouped by epoch too
    (`with_epoch`, then `by=("station_id", "epoch")`).
    """
    if unique:
        known = documents.where(F.col("s_no").isNotNull())
        counted = known.groupBy(*by).agg(F.max("s_no").alias("expected"), F.count("s_no").alias("received"))
    else:
        counted = received.totals(received.bitmaps(documents, by))
    return dropped(counted)


def dropped(counted: DataFrame) -> DataFrame:
    """Adds dropped and drop_rate to expected and received."""
    return counted.withColumn("dropped", F.col("expected") - F.col("received")).withColumn(
        "drop_rate", F.col("dropped").cast("double") / F.col("expected")
    )


def drop_rate_total(dropped: DataFrame) -> DataFrame:
    """One row over all stations, from `dropped_per_station`."""
    return dropped.agg(
        F.sum("expected").alias("expected"),
        F.sum("received").alias("received"),
        F.sum("dropped").alias("dropped"),
    ).withColumn("drop_rate", F.col("dropped").cast("double") / F.col("expected"))


def sequence_gaps(
    documents: DataFrame, by: tuple[str, ...] = ("station_id",), number: str = "s_no"
) -> DataFrame:
    """Runs of missing numbers from 1 on: (…by, missing_from, missing_to, missing).

    From bitmaps of the received numbers (`received`), which a copy of a number doesn't change.
    """
    return received.gaps(received.bitmaps(documents.dropna(subset=[*by]), by, number))


def missing_numbers(gaps: DataFrame) -> DataFrame:
    """Every missing number of `sequence_gaps`, one row each.

    Gaps are cut into ever smaller steps, so no row carries more than EXPLODE_STEP of them however
    long a gap is. A corrupt number far ahead still means as many rows as it leaves out; the gaps
    themselves are the bounded form.
    """
    keys = [c for c in gaps.columns if not c.startswith("missing")]
    pieces = gaps.select(*keys, F.col("missing_from").alias("_from"), F.col("missing_to").alias("_to"))
    for step in (EXPLODE_STEP**3, EXPLODE_STEP**2, EXPLODE_STEP, 1):
        begin = F.explode(F.sequence(F.col("_from"), F.col("_to"), F.lit(step).cast("bigint"))).alias("_begin")
        pieces = pieces.select(*keys, "_to", begin).select(
            *keys, F.col("_begin").alias("_from"), F.least(F.col("_begin") + (step - 1), F.col("_to")).alias("_to")
        )
    return pieces.select(*keys, F.col("_from").alias("s_no"))


def with_epoch(
    readings: DataFrame,
    station: str = "station_id",
    number: str = "s_no",
    arrival: str = "offset",
    bits: int = slices.SLICE_BITS,
) -> DataFrame:
    """Adds `epoch`, which grows by one whenever a station's number falls below the previous one.

    `arrival` is a unique whole number per station. Each slice reports its resets and its first
    and last number; resets at slice borders are found between those summaries.
    """
    keys = [station]
    resets = F.when(F.col(number) < F.lag(number).over(slices.within(keys, arrival)), 1).otherwise(0)
    marked = slices.cut(readings, arrival, bits).withColumn("_reset", resets)
    border = F.when(F.col("_first") < F.lag("_last").over(slices.across(keys)), 1).otherwise(0)
    upto = slices.across(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (
        marked.groupBy(station, slices.SLICE)
        .agg(
            F.sum("_reset").alias("_inside"),
            F.min_by(number, arrival).alias("_first"),
            F.max_by(number, arrival).alias("_last"),
        )
        .withColumn("_border", border)
        .select(
            station,
            slices.SLICE,
            (F.sum("_border").over(upto) + slices.total_before(F.col("_inside"), keys)).alias(
                "_base"
            ),
        )
    )
    local = F.sum("_reset").over(
        slices.within(keys, arrival).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marked.withColumn("_local", local)
        .join(carried, [station, slices.SLICE])
        .withColumn("epoch", F.col("_base") + F.col("_local"))
        .drop(slices.SLICE, "_reset", "_local", "_base")
    )


def measurement_summary(
    measurements: DataFrame, series: str, value: str, exact: bool = True
) -> DataFrame:
    """count, mean, nearest-rank p50/p95/p99 and max per series.

    Exact percentiles are found by counting rows in ever narrower bins of the value (`ranks`), which
    neither sorts nor copies them; `exact=False` takes them from a sketch in one pass instead. For
    sketches that are kept and merged, see `ranks.sketches`.
    """
    known = measurements.where(F.col(value).isNotNull())
    totals = [
        F.count(F.lit(1)).alias("count"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
    ]
    if not exact:
        sketched = [F.percentile_approx(value, p / 100, 10_000).alias(n) for n, p in PERCENTILES.items()]
        return known.groupBy(series).agg(*totals, *sketched).select(
            series, "count", "mean", *PERCENTILES, "max"
        )

    ends = known.groupBy(F.col(series).alias("_of")).agg(
        F.count(F.lit(1)).alias("_all"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    # Whole-number ceil(p * n / 100), so the rank is exact for any count.
    wanted = F.explode(F.create_map(*[F.lit(x) for x in sum(PERCENTILES.items(), ())])).alias("name", "percent")
    rank = F.call_function("div", F.col("_all") * F.col("percent") + 99, F.lit(100))
    found = ranks.values_at(known, series, value, ends.select("*", wanted).withColumn("rank", rank))
    picked = found.groupBy("_of").pivot("name", list(PERCENTILES)).agg(F.first("value"))
    return (
        known.groupBy(series)
        .agg(*totals)
        .join(picked, F.col(series).eqNullSafe(F.col("_of")))
        .select(series, "count", "mean", *PERCENTILES, "max")
    )


def rate_per_window(
    measurements: DataFrame, event_time: str, value: str, width: str = "1 second"
) -> DataFrame:
    """Operations, operations per second, average and maximum per tumbling event-time window."""
    window = F.window(event_time, width)
    seconds = (
        F.unix_millis(F.col("window.end")) - F.unix_millis(F.col("window.start"))
    ).cast("double") / 1000
    return (
        measurements.groupBy(window.alias("window"))
        .agg(
            F.count(F.lit(1)).alias("ops"),
            F.avg(value).alias("avg_value"),
            F.max(value).alias("max_value"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "ops",
            (F.col("ops") / seconds).alias("ops_per_sec"),
            "avg_value",
            "max_value",
        )
    )

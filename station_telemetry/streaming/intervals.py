"""Maintained gaps: which numbers have arrived, as runs kept in streaming state.

State is a map per station and range of numbers, from the first number of a run to its last, in
RocksDB. A late number makes a run longer, joins two, or begins one, so gaps shrink, close or
split; a repeated one changes nothing. Every range a batch touches is handed on whole, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from station_telemetry.session import prepare_state
from station_telemetry.sinks.keyed import KeyedTable

RANGE_BITS = 16

RANGES = T.StructType(
    [
        T.StructField("range_id", T.StringType()),
        T.StructField("station_id", T.LongType()),
        T.StructField("range", T.LongType()),
        T.StructField("firsts", T.ArrayType(T.LongType())),
        T.StructField("lasts", T.ArrayType(T.LongType())),
        T.StructField("received", T.LongType()),
    ]
)


def joined_runs(firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and neighbouring runs as one, in order."""
    order = np.argsort(firsts, kind="stable")
    firsts, lasts = firsts[order], np.maximum.accumulate(lasts[order])
    begins = np.ones(len(firsts), bool)
    begins[1:] = firsts[1:] > lasts[:-1] + 1
    return firsts[begins], lasts[np.append(np.flatnonzero(begins)[1:], len(firsts)) - 1]


class Runs(StatefulProcessor):
    """Adds the numbers of a batch to the runs of one station and range."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getMapState("runs", "first bigint", "last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = {int(first[0]): int(last[0]) for first, last in self.runs.iterator()}
        numbers = np.unique(np.concatenate([part["s_no"].to_numpy(np.int64) for part in rows]))
        old = np.array(sorted(known.items()), np.int64).reshape(-1, 2)
        firsts, lasts = joined_runs(np.concatenate([old[:, 0], numbers]), np.concatenate([old[:, 1], numbers]))
        now = dict(zip(firsts.tolist(), lasts.tolist()))
        for first in known.keys() - now.keys():
            self.runs.removeKey((first,))
        for first, last in now.items():
            if known.get(first) != last:
                self.runs.updateValue((first,), (last,))
        yield pd.DataFrame(
            {
                "range_id": [f"{key[0]}-{key[1]}"],
                "station_id": [key[0]],
                "range": [key[1]],
                "firsts": [firsts.tolist()],
                "lasts": [lasts.tolist()],
                "received": [int((lasts - firsts + 1).sum())],
            }
        )

    def close(self) -> None:
        pass


def runs_of(documents: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Runs of received numbers, for each range of 2**bits numbers that a micro-batch touches.

    Rows without station or number, and numbers below one, take no part. A hot station is as many
    keys as it has ranges.
    """
    n = F.col("s_no")
    known = documents.where(F.col("station_id").isNotNull() & (n >= 1))
    return (
        known.select("station_id", F.shiftright(n, bits).alias("range"), "s_no")
        .groupBy("station_id", "range")
        .transformWithStateInPandas(Runs(), RANGES, "Update", "None")
    )


def runs_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, RANGES, "range_id", "received")


def gap_feed(documents: DataFrame, table: KeyedTable, checkpoint: str, bits: int = RANGE_BITS) -> DataStreamWriter:
    """Keeps the table of ranges; a batch writes the ranges it touches."""
    prepare_state(documents.sparkSession)

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, table.place(batch, batch_id))

    return runs_of(documents, bits).writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)


def gaps_of(ranges: DataFrame) -> DataFrame:
    """Runs of missing numbers from 1 on: (station_id, missing_from, missing_to, missing)."""
    ends = ranges.select("station_id", "range", F.element_at("lasts", -1).alias("last"))
    before = F.lag("last", 1, 0).over(Window.partitionBy("station_id").orderBy("range"))
    carried = ends.select("station_id", "range", before.alias("before"))
    gaps = F.zip_with(
        F.concat(F.array("before"), F.slice("lasts", F.lit(1), F.size("lasts") - 1)),
        "firsts",
        lambda last, first: F.struct((last + 1).alias("missing_from"), (first - 1).alias("missing_to")),
    )
    return (
        ranges.join(carried, ["station_id", "range"])
        .select("station_id", F.inline(gaps))
        .where("missing_from <= missing_to")
        .withColumn("missing", F.col("missing_to") - F.col("missing_from") + 1)
    )

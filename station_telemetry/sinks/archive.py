"""Writing the Parquet archive: one folder per station and UTC day, and in it one per batch.

The batch folder is what makes a retry harmless: it replaces what the first try left, and touches
nothing else. Batch and streaming writes share the layout, so either may add to any archive.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from station_telemetry.functions import utc_date
from station_telemetry.schemas import STATUS
from station_telemetry.sinks.generations import position_of

log = logging.getLogger(__name__)

PARTITIONS = ("station_id", "date", "batch")


def _usable():
    return F.col("stationId").isNotNull() & F.col("statusTimeStamp").isNotNull()


def archive_rows(readings: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with their partition columns, rejected readings without a station or time)."""
    rows = (
        readings.where(_usable())
        .select(*STATUS.names, *keep)
        .withColumn("station_id", F.col("stationId"))
        .withColumn("date", utc_date(F.col("statusTimeStamp")))
    )
    return rows, readings.where(~_usable())


def beside(root: str, what: str) -> str:
    """A folder for an archive's own records; inside the root it would look like a partition."""
    return f"{root.rstrip('/')}-{what}"


def write_archive(
    readings: DataFrame,
    root: str,
    records_per_file: int = 0,
    batch: str | None = None,
    keep: tuple[str, ...] = (),
) -> int:
    """Adds readings to the archive and returns how many were rejected.

    Rejects go to `<root>-rejects/batch=…`. Rebalancing gathers a folder's rows into few files,
    and AQE splits a folder that is larger than the advisory partition size over several tasks,
    so a hot station does not become one. Writing the same `batch` again replaces it. `keep` names
    further columns for the archive.
    """
    name = batch or uuid.uuid4().hex
    seen = Observation()
    counted = readings.observe(seen, F.count_if(~_usable()).alias("rejected"))
    rows, _ = archive_rows(counted, keep)
    (
        rows.withColumn("batch", F.lit(name))
        .hint("rebalance", "station_id", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", records_per_file)
        .parquet(root)
    )
    rejected = seen.get["rejected"]
    if rejected:
        path = f"{beside(root, 'rejects')}/batch={name}"
        log.warning("%d readings without station or time: %s", rejected, path)
        archive_rows(readings, keep)[1].write.mode("overwrite").parquet(path)
    return rejected


def archive_writer(readings: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """The streaming form: each micro-batch is one batch of the archive.

    A retried micro-batch replaces its folders, and a new checkpoint writes new ones.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        place = position_of(batch, batch_id, beside(root, "generations"))
        write_archive(batch, root, batch=f"stream-{place}")

    return readings.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)

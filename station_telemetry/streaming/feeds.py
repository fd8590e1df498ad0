"""The continuous queries over the feed. Inputs are streaming frames from any source."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from station_telemetry import files
from station_telemetry.functions import record_json
from station_telemetry.operators import analytics, openmeteo
from station_telemetry.operators.documents import (
    drop_replays,
    has_required_fields,
    normalize,
    one_spelling,
    required_fields,
)
from station_telemetry.operators.rain import rain_events
from station_telemetry.operators.state import keyed_messages, latest
from station_telemetry.schemas import SNAPSHOT, STATUS, STREAM_ORDER
from station_telemetry.session import scratch, written
from station_telemetry.sinks import generations
from station_telemetry.sinks.archive import archive_writer, beside, write_archive
from station_telemetry.sinks.keyed import KeyedTable
from station_telemetry.sinks.topics import file_writer, rain_frame

log = logging.getLogger(__name__)

_GENERATION_BITS = 44  # of a payload message's offset: generation above, sequence number below


def rain_feed(messages: DataFrame, encoded: Column | None = None) -> DataFrame:
    """Rain events as a topic frame, JSON unless another encoding is passed; stateless."""
    return rain_frame(rain_events(messages), encoded)


def archive_feed(messages: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Every reading into the archive; messages without one are left out."""
    return archive_writer(messages.where("value is not null").select("value.*"), root, checkpoint)


def epoch_feed(messages: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Every reading into the archive, with its offset and the epoch of its station's counter.

    An epoch begins whenever a number falls below the one before it in arrival order. Within a batch
    resets are found in slices, so a hot station is many tasks; from batch to batch each station's
    last number and epoch go on from `<root>-epochs/position=<batch>/`, one row a station. A retried
    batch starts from the same rows and overwrites its folders; a new checkpoint begins anew, and what
    it reads again gets the same epochs. Offsets must be unique within a station. Readings without
    station, number or offset have no epoch.
    """

    def carried(spark: SparkSession, folder: str, place: int) -> DataFrame:
        schema = "stationId bigint, _number bigint, _epoch bigint"
        names = files.child_names(spark, folder)
        first = place - place % generations.GENERATION_SIZE
        earlier = sorted(p for p in (int(n.partition("=")[2]) for n in names if n.startswith("position=")) if first <= p < place)
        if not earlier:
            return spark.createDataFrame([], schema)
        for old in earlier[:-1]:
            files.remove_folder(spark, f"{folder}/position={old}")
        return spark.read.schema(schema).parquet(f"{folder}/position={earlier[-1]}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = generations.position_of(batch, batch_id, beside(root, "generations"))
        folder = beside(root, "epochs")
        rows = batch.where("value is not null").select("value.*", "offset")
        if rows.isEmpty():  # nothing to write, and the next batch goes on from an earlier one
            return
        with scratch(spark):
            ordered = rows.dropna(subset=["stationId", "sequenceNumber", "offset"])
            marked = written(analytics.with_epoch(ordered, "stationId", "sequenceNumber", "offset"), "epochs")
            ends = marked.groupBy("stationId").agg(
                F.min_by("sequenceNumber", "offset").alias("first"),
                F.max_by("sequenceNumber", "offset").alias("last"),
                F.max("epoch").alias("own"),
            )
            begin = F.coalesce("_epoch", F.lit(0)) + F.when(F.col("first") < F.col("_number"), 1).otherwise(0)
            before = carried(spark, folder, place)
            begins = written(
                ends.join(before, "stationId", "full").select(
                    "stationId", begin.alias("begin"), F.coalesce("last", "_number").alias("_number"),
                    F.coalesce(begin + F.col("own"), F.col("_epoch")).alias("_epoch"),
                ),
                "begins",
            )
            numbered = marked.join(begins.select("stationId", "begin"), "stationId").withColumn(
                "epoch", F.col("epoch") + F.col("begin")
            )
            unplaced = rows.where("stationId is null or sequenceNumber is null or offset is null")
            every = numbered.drop("begin").unionByName(unplaced.withColumn("epoch", F.lit(None).cast("bigint")))
            write_archive(every, root, batch=f"stream-{place}", keep=("offset", "epoch"))
            begins.select("stationId", "_number", "_epoch").write.mode("overwrite").parquet(f"{folder}/position={place}")

    return messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def rejects_feed(rejected: DataFrame | None, messages: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """What the keyed feeds can't use, once for all of them, as (key, text, offset).

    That is undecodable text, if the source tells it apart, and messages without a key or without a
    value, whatever they came as; the text of a value that is null is null.
    """
    unusable = keyed_messages(messages)[1].select("key", record_json(F.col("value")).alias("text"), "offset")
    every = unusable if rejected is None else rejected.unionByName(unusable)
    return file_writer(every, root, checkpoint)


def latest_feed(messages: DataFrame) -> DataFrame:
    """Latest reading per station as streaming state, for `complete` or `update` output."""
    kept, _ = keyed_messages(messages)
    return (
        kept.groupBy("key")
        .agg(F.max_by("value", "offset").alias("value"), F.max("offset").alias("offset"))
        .withColumn("value", record_json(F.col("value")))
    )


def latest_table(spark: SparkSession, root: str, timed: bool = False) -> KeyedTable:
    """The newest reading per key: of the last batch, or of the latest time whatever its batch.

    Tables made before messages carried time and partition read these as null, which come first.
    """
    order = T.StructType([*STREAM_ORDER.fields, T.StructField("offset", T.LongType())])
    columns = T.StructType([*SNAPSHOT.fields, *order.fields])
    return KeyedTable(spark, root, columns, "key", tuple(order.names), by_order=timed)


def _settle(table: KeyedTable, batch_id: int, compact_every: int | None) -> None:
    """Bounds the change log: compacts after so many batches, and removes what two compactions replaced."""
    if compact_every and batch_id % compact_every == compact_every - 1:
        table.compact()
        table.vacuum(keep=1)


def latest_table_feed(
    messages: DataFrame, table: KeyedTable, checkpoint: str, compact_every: int | None = None
) -> DataStreamWriter:
    """Latest reading per station into a keyed table; each batch adds one row per station seen."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        kept, _ = keyed_messages(batch)
        marks = [F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STREAM_ORDER]
        newest = latest(kept.select("key", "value", *marks, "offset"), "key", table.order)
        table.upsert(
            newest.withColumn("value", record_json(F.col("value"))), table.place(batch, batch_id)
        )
        _settle(table, batch_id, compact_every)

    return messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def ingest_feed(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    mixed: bool = False,
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Archive rows (with `arrived`) as documents into the table, rows without ids as rejects.

    `mixed` takes files of both spellings, read as ARCHIVE_MIXED. The rejects are counted while
    the documents are written, so files are read a second time only for batches that have some. A
    batch is committed after both are written, and a retry overwrites them.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        position = table.place(batch, batch_id)
        seen = Observation()
        if mixed:
            batch = one_spelling(batch)
        missing = ~has_required_fields(batch)
        counted = batch.observe(seen, F.count_if(missing).alias("rejected"))
        table.upsert(normalize(counted, keep=("arrived",)), position)
        if seen.get["rejected"]:
            path = f"{table.root}/rejects/position={position}"
            log.warning("%d rows without station or number: %s", seen.get["rejected"], path)
            required_fields(batch)[1].write.mode("overwrite").parquet(path)
        _settle(table, batch_id, compact_every)

    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def dedup_feed(documents: DataFrame, root: str, checkpoint: str, within: str = "1 hour") -> DataStreamWriter:
    """Documents without replays, as files; state is bounded by time.

    A number of a station passes once. Spark remembers it until the newest event time seen is `within`
    past its own; a replay that comes later than that is older than the watermark, and so are documents
    that come so late for the first time: both are left out, and counted in the query's progress.
    """
    return file_writer(drop_replays(documents, within), root, checkpoint)


def payload_feed(payloads: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Third-party payloads (payload, stationId, arrived) as numbered readings.

        <root>/readings/generation=<g>/position=<batch>/   readings
        <root>/messages/batch=<g>-<batch>/                 the same as messages, for the other feeds
        <root>/rejects/generation=<g>/position=<batch>/    payloads that do not parse or have no time
        <root>/numbers/generation=<g>/position=<batch>/    last number per station after the batch

    Numbers go on from the batch before. A retried batch starts from the same numbers and
    overwrites its folders. A new checkpoint reads all payloads again and begins a generation,
    whose readings replace the earlier ones (`payload_readings`); its messages carry higher
    offsets, so they come later for every feed. Each batch is numbered in parallel, however few
    the stations are.
    """

    def last_numbers(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
        schema = T.StructType(
            [T.StructField("stationId", T.LongType()), T.StructField("_last", T.LongType())]
        )
        names = files.child_names(spark, folder)
        earlier = [n for n in (int(n.partition("=")[2]) for n in names) if n < batch_id]
        if not earlier:
            return spark.createDataFrame([], schema)
        for old in sorted(earlier)[:-1]:
            files.remove_folder(spark, f"{folder}/position={old}")
        return spark.read.schema(schema).parquet(f"{folder}/position={max(earlier)}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = generations.generation(batch.sparkSession, f"{root}/generations", generations.run_of(batch))
        with scratch(batch.sparkSession):
            number_and_write(batch, batch_id, run)

    def number_and_write(batch: DataFrame, batch_id: int, run: int) -> None:
        spark = batch.sparkSession

        def folder(kind: str) -> str:
            return f"{root}/{kind}/generation={run}"

        lines = batch.withColumn("line", F.monotonically_increasing_id())
        marked = written(openmeteo.mark_payloads(lines), "payloads")
        before = last_numbers(spark, folder("numbers"), batch_id)
        start = F.coalesce(F.col("_last"), F.lit(0))
        numbered = written(
            openmeteo.assign_sequence(marked.where("ok").drop("ok"), ["arrived", "line"])
            .join(before, "stationId", "left")
            .withColumn("sequenceNumber", F.col("sequenceNumber") + start)
            .drop("_last"),
            "numbered",
        )
        good, untimed = openmeteo.to_readings(numbered)
        good.drop("payload").write.mode("overwrite").parquet(f"{folder('readings')}/position={batch_id}")
        (
            good.select(
                F.col("stationId").cast("string").alias("key"),
                F.struct(*STATUS.names).alias("value"),
                (F.lit(run << _GENERATION_BITS) + F.col("sequenceNumber")).alias("offset"),
            )
            .write.mode("overwrite")
            .parquet(f"{root}/messages/batch={run}-{batch_id}")
        )
        unparsed = marked.where("not ok").drop("ok", "message")
        rejected = unparsed.unionByName(untimed.select(*unparsed.columns))
        rejected.write.mode("overwrite").parquet(f"{folder('rejects')}/position={batch_id}")
        reached = numbered.groupBy("stationId").agg(F.max("sequenceNumber").alias("_last"))
        (
            reached.unionByName(before)
            .groupBy("stationId")
            .agg(F.max("_last").alias("_last"))
            .write.mode("overwrite")
            .parquet(f"{folder('numbers')}/position={batch_id}")
        )

    return payloads.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def payload_readings(spark: SparkSession, root: str, kind: str = "readings") -> DataFrame:
    """The readings (or rejects) of the newest generation of a payload feed."""
    names = files.child_names(spark, f"{root}/{kind}")
    newest = max(int(n.removeprefix("generation=")) for n in names if n.startswith("generation="))
    return spark.read.parquet(f"{root}/{kind}/generation={newest}")

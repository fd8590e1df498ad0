"""The status stream: subscribe, decode, or read landed copies of it.

Every source yields (key, value, offset), batch or stream, so the operators do not depend on
where messages come from. Each streaming query has its own checkpoint and sees every message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from station_telemetry.functions import frame_payload
from station_telemetry.operators.wire import decode_json_split
from station_telemetry.schemas import STATUS, STATUS_AVRO, STATUS_TOPIC, STREAM

# A flush happens at this many records or after this delay, whichever is first.
FLUSH_RECORDS = 10_000
FLUSH_DELAY = "30s"

# Spark passes over files that are this much older than the newest it has seen. Files may keep old
# times when they are copied or restored, so the limit lies beyond any real age.
ANY_AGE = "36500d"


def kafka_options(
    servers: str, topic: str = STATUS_TOPIC, flush_policy: bool = False, **extra: str
) -> dict[str, str]:
    """Options of the Kafka source, from the earliest message.

    `flush_policy` starts a micro-batch at FLUSH_RECORDS waiting messages or after FLUSH_DELAY.
    Pass `maxOffsetsPerTrigger` to bound the batches that work off a long backlog.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if flush_policy:
        options |= {"minOffsetsPerTrigger": str(FLUSH_RECORDS), "maxTriggerDelay": FLUSH_DELAY}
    return options | extra


def subscribe(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Raw Kafka records. Needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def avro_value(raw: Column) -> Column:
    """Registry-framed Avro. Needs the spark-avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(frame_payload(raw), STATUS_AVRO)


def decode(raw: DataFrame, value: Column) -> DataFrame:
    """Kafka records to messages by an expression that fails on what it can't decode."""
    return raw.select(F.col("key").cast("string").alias("key"), value.alias("value"), *_arrival(raw))


def decode_texts(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kafka records with JSON values: (messages, rejected (key, text, offset)).

    A null value is a message without a reading. Text that is no such record is rejected; it
    never becomes a reading of nulls.
    """
    keyed = raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("text"), *_arrival(raw)
    )
    order = keyed.columns[2:]
    nothing = F.lit(None).cast(STATUS)
    silent = keyed.where(F.col("text").isNull()).select("key", nothing.alias("value"), *order)
    good, bad = decode_json_split(keyed.where(F.col("text").isNotNull()), "text", "value", STATUS)
    return good.select("key", "value", *order).unionByName(silent), bad.select("key", "text", "offset")


def _arrival(raw: DataFrame) -> list[Column]:
    """The order of a message: its offset, after time and partition where `timed` has marked them.

    A key stays in one partition while the number of partitions does. Where it was changed, only the
    broker's time tells which of a key's messages is newer.
    """
    marks = [F.col(c) for c in ("millis", "partition") if "millis" in raw.columns]
    return [F.col("offset").cast("bigint").alias("offset"), *marks]


def timed(raw: DataFrame) -> DataFrame:
    """Raw records whose messages are ordered across partitions: by broker's time, partition, offset.

    The three stay columns of their own, so any number of messages may share a millisecond.
    """
    return raw.withColumn("millis", F.unix_millis(F.col("timestamp"))).withColumn("partition", F.col("partition").cast("int"))


def landed_messages(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Messages landed as Parquet files, in the folder or anywhere below it."""
    reader = (spark.readStream.option("maxFileAge", ANY_AGE) if streaming else spark.read).schema(STREAM)
    if streaming and files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def landed_texts(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw records (key, value as text, offset) landed as Parquet files."""
    reader = spark.readStream.option("maxFileAge", ANY_AGE) if streaming else spark.read
    return reader.schema("key string, value string, offset bigint").parquet(path)


def landed_payloads(
    spark: SparkSession, path: str, station_id: int, streaming: bool = False, by_name: bool = False
) -> DataFrame:
    """Third-party JSON payloads landed as text, one per line: (payload, stationId, arrived).

    `arrived` orders them by file time, file and split. Within a split, lines are read in order
    by one task. `by_name` leaves the time out, for collectors that write several files at once and
    name them in the order of their payloads, as a range-partitioned Spark job does.
    """
    reader = spark.readStream.option("maxFileAge", ANY_AGE) if streaming else spark.read
    time = F.lit(0).cast("bigint") if by_name else F.unix_millis(F.col("_metadata.file_modification_time"))
    return reader.text(path).select(
        F.col("value").alias("payload"),
        F.lit(station_id).cast("bigint").alias("stationId"),
        F.struct(
            time.alias("millis"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
        ).alias("arrived"),
    )

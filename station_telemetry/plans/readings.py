"""Station readings derived from the `events` table (see FIXTURES.md).

Each event is one reading of one of ten stations, which numbers its readings from 1. The
analyses of drops and gaps ask for a feed that lost one number in ten; all other queries read
every event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from station_telemetry.functions import battery_from_fraction
from station_telemetry.operators.documents import normalize
from station_telemetry.schemas import STATUS
from station_telemetry.session import new_folder

REPLAY_SHIFT = 10_000_000_000  # fixed value: replayed copies arrive after all originals


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their station, and `k` from the JSON property.

    The property always has the one field, so a pattern finds it far faster than a JSON parser.
    """
    k = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("stationId", F.col("event_id") % 10 + 1)
        .withColumn("sequenceNumber", F.call_function("div", F.col("event_id"), F.lit(10)) + 1)
        .withColumn("k", k)
        .withColumn("millis", F.unix_millis(F.col("ts").cast("timestamp")))
    )


def readings(spark: SparkSession, sf_dir: str, lossy: bool = False) -> DataFrame:
    """Received readings as STATUS columns plus `offset`, `user_id` and `event_type`; one scan.

    `lossy` drops one sequence number in ten of every station.
    """
    sent = events(spark, sf_dir)
    if lossy:
        sent = sent.where(F.col("sequenceNumber") % 10 != 3)
    humidity = F.col("event_id") * 37 % 101
    wind = F.col("event_id") * 29 % 101
    return sent.select(
        F.col("event_id").alias("offset"),
        "user_id",
        "event_type",
        "stationId",
        "sequenceNumber",
        battery_from_fraction(F.col("k") / 100).alias("batteryStatus"),
        F.col("millis").alias("statusTimeStamp"),
        F.struct(
            humidity.cast("int").alias("humidity"),
            F.col("value").alias("temperature"),
            wind.cast("double").alias("windSpeed"),
        ).alias("weatherStatus"),
    )


def as_messages(status: DataFrame, key: str = "stationId") -> DataFrame:
    return status.select(
        F.col(key).cast("string").alias("key"), F.struct(*STATUS.names).alias("value"), "offset"
    )


def messages(spark: SparkSession, sf_dir: str, key: str = "stationId") -> DataFrame:
    """The readings as (key, value, offset)."""
    return as_messages(readings(spark, sf_dir), key)


def documents(spark: SparkSession, sf_dir: str, lossy: bool = False) -> DataFrame:
    return normalize(readings(spark, sf_dir, lossy), keep=("offset",))


def restarted(documents: DataFrame, after: int = 400) -> DataFrame:
    """Counters restart: numbers above `after` begin at 1 again."""
    number = F.col("s_no")
    return documents.withColumn("s_no", F.when(number > after, number - after).otherwise(number))


def land(df: DataFrame, label: str) -> str:
    """Writes rows to a new folder of the shared directory, for file streams to pick up."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return path


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One third-party JSON payload per event; error events yield text that does not parse."""
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.lit(900).alias("interval"),
        F.col("value").alias("temperature_2m"),
        (F.col("event_id") * 37 % 101).cast("int").alias("relative_humidity_2m"),
        F.lit(12.5).cast("double").alias("wind_speed_10m"),
    )
    text = F.to_json(F.struct(current.alias("current")))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("payload_id"),
        F.when(F.col("event_type") == "error", "bad").otherwise(text).alias("payload"),
        F.lit(100).cast("bigint").alias("stationId"),
    )

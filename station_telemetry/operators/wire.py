"""Readings to and from the records that travel on the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry.functions import known_battery, record_json, station_key
from station_telemetry.schemas import BATTERY_STATES, STATUS

_CORRUPT = "_corrupt"


def _as_wire_record(battery: Column) -> Column:
    weather = F.col("weatherStatus")
    return F.struct(
        F.col("stationId").cast("bigint").alias("stationId"),
        F.col("sequenceNumber").cast("bigint").alias("sequenceNumber"),
        battery.alias("batteryStatus"),
        F.col("statusTimeStamp").cast("bigint").alias("statusTimeStamp"),
        F.struct(
            weather["humidity"].cast("int").alias("humidity"),
            weather["temperature"].cast("double").alias("temperature"),
            weather["windSpeed"].cast("double").alias("windSpeed"),
        ).alias("weatherStatus"),
    )


def to_wire(readings: DataFrame) -> DataFrame:
    """Readings to wire records in `value`; a battery name outside the enum fails the query."""
    battery = F.col("batteryStatus")
    message = F.concat(F.lit(f"battery status is not one of {', '.join(BATTERY_STATES)}: "), battery)
    checked = F.when(known_battery(battery), battery).otherwise(F.raise_error(message))
    return readings.withColumn("value", _as_wire_record(checked))


def to_wire_split(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same without failing: (records, rejected readings)."""
    battery = F.col("batteryStatus")
    good = readings.where(known_battery(battery)).withColumn("value", _as_wire_record(battery))
    return good, readings.where(~known_battery(battery))


def publish_frame(records: DataFrame, encoded: Column | None = None) -> DataFrame:
    """(key, value) ready for the stream: key is the station id as text, value the encoded record.

    JSON by default; pass `encoded` to use another encoding of `value`.
    """
    return records.select(
        station_key(F.col("value.stationId")).alias("key"),
        (record_json(F.col("value")) if encoded is None else encoded).alias("value"),
    )


def encode_json(df: DataFrame, record: str = "value", into: str = "json") -> DataFrame:
    return df.withColumn(into, record_json(F.col(record)))


def decode_json(
    df: DataFrame, text: str = "json", into: str = "value", schema: T.StructType = STATUS
) -> DataFrame:
    """JSON text to a record; the query fails on text that is not such a record."""
    return df.withColumn(into, F.from_json(F.col(text), schema, {"mode": "FAILFAST"}))


def decode_json_marked(
    df: DataFrame, text: str = "json", into: str = "value", schema: T.StructType = STATUS, mark: str = "ok"
) -> DataFrame:
    """The same without failing: `mark` tells records from text that is null, empty or malformed."""
    probed = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json(F.col(text), probed, {"columnNameOfCorruptRecord": _CORRUPT})
    # Unpacked from a one-element array, the record is parsed once per row. As a plain column it
    # would be parsed again in each filter that Spark pushes below it.
    parsed = df.select(*[c for c in df.columns if c != into], F.explode(F.array(record)).alias(into))
    ok = F.col(into).isNotNull() & F.col(f"{into}.{_CORRUPT}").isNull()
    return parsed.withColumn(mark, ok).withColumn(into, F.col(into).dropFields(_CORRUPT))


def decode_json_split(
    df: DataFrame, text: str = "json", into: str = "value", schema: T.StructType = STATUS
) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, rows whose text is null, empty or malformed)."""
    marked = decode_json_marked(df, text, into, schema, "_ok")
    return marked.where("_ok").drop("_ok"), marked.where("not _ok").drop("_ok", into)

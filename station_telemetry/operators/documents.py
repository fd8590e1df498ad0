"""Archive rows to normalised documents keyed by station and sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry.functions import document_id, epoch_seconds
from station_telemetry.functions.columns import MILLIS_ABOVE
from station_telemetry.operators.state import latest
from station_telemetry.schemas import ABSENT_HUMIDITY, ABSENT_STAMP, ABSENT_TEXT

_IDS = (("station_id", "stationId"), ("s_no", "sequenceNumber"))


def _first_non_null(df: DataFrame, names: tuple[str, str]) -> Column:
    present = [F.col(n).cast("bigint") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("bigint")


def _present(df: DataFrame, snake: str, camel: str) -> str | None:
    """The snake_case column if the data has it, even when its value is null; else camelCase."""
    return next((name for name in (snake, camel) if name in df.columns), None)


def decode_battery(df: DataFrame, column: str) -> Column:
    """Battery status as text; some writers store the enum as bytes."""
    is_bytes = isinstance(df.schema[column].dataType, T.BinaryType)
    return F.decode(F.col(column), "UTF-8") if is_bytes else F.col(column).cast("string")


def _weather(df: DataFrame) -> Column:
    name = _present(df, "weather", "weatherStatus")
    fields = set() if name is None else set(df.schema[name].dataType.names)

    def field(kind: str, *choices: str) -> Column:
        found = next((c for c in choices if c in fields), None)
        return (F.lit(None) if found is None else F.col(name)[found]).cast(kind)

    return F.struct(
        field("int", "humidity").alias("humidity"),
        field("double", "temperature").alias("temperature"),
        field("double", "wind_speed", "windSpeed").alias("wind_speed"),
    )


def has_required_fields(df: DataFrame) -> Column:
    station, number = (_first_non_null(df, names) for names in _IDS)
    return station.isNotNull() & number.isNotNull()


def required_fields(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with station and sequence number, rejected rows)."""
    ok = has_required_fields(df)
    return df.where(ok), df.where(~ok)


def normalize(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """camelCase or snake_case archive rows to documents; rows without an id are left out.

    Ids fall back to the other name when null; the other fields only when the column is absent.
    That is decided from the schema; rows of files of both spellings go through `one_spelling` first.
    `keep` names further columns to carry along.
    """
    station, number = (_first_non_null(df, names) for names in _IDS)
    battery = _present(df, "battery_status", "batteryStatus")
    stamp = _present(df, "status_timestamp", "statusTimeStamp")
    raw_stamp = (F.lit(None) if stamp is None else F.col(stamp)).cast("bigint")
    in_millis = F.when(raw_stamp > MILLIS_ABOVE, raw_stamp).otherwise(raw_stamp * 1000)
    return df.where(has_required_fields(df)).select(
        document_id(station, number).alias("doc_id"),
        station.alias("station_id"),
        number.alias("s_no"),
        (F.lit(None).cast("string") if battery is None else decode_battery(df, battery)).alias(
            "battery_status"
        ),
        epoch_seconds(raw_stamp).alias("status_timestamp"),
        F.timestamp_millis(in_millis).alias("event_time"),
        _weather(df).alias("weather"),
        *keep,
    )


def one_spelling(df: DataFrame) -> DataFrame:
    """Rows read as ARCHIVE_MIXED with one column for the battery, the time and the weather each.

    A file that has the snake_case column keeps what it says there, null too, even when all its rows
    are null; a file without it has its camelCase column read. The reader tells the two apart by the
    value it puts where a column is absent, so no row is compared with others of its file. Spark's
    vectorized Parquet reader must be on, as it is by default.
    """
    for snake, camel, absent in (
        ("battery_status", "batteryStatus", F.col("battery_status") == F.lit(ABSENT_TEXT)),
        ("status_timestamp", "statusTimeStamp", F.col("status_timestamp") == F.lit(ABSENT_STAMP)),
        ("weather", "weatherStatus", F.col("weather.humidity") == F.lit(ABSENT_HUMIDITY)),
    ):
        other = F.col(camel)
        if snake == "weather":
            other = F.when(
                other.isNotNull(),
                F.struct(
                    other["humidity"].alias("humidity"),
                    other["temperature"].alias("temperature"),
                    other["windSpeed"].alias("wind_speed"),
                ),
            )
        df = df.withColumn(snake, F.when(absent, other).otherwise(F.col(snake))).drop(camel)
    return df


def replace_by_id(documents: DataFrame, order: str) -> DataFrame:
    """One document per id: the one that came last by `order` replaces the others whole."""
    return latest(documents, "doc_id", order)


def drop_replays(documents: DataFrame, within: str = "1 hour") -> DataFrame:
    """Streaming form for byte-identical replays: keeps the first, with state bounded by time."""
    return documents.withWatermark("event_time", within).dropDuplicatesWithinWatermark(
        ["station_id", "s_no"]
    )

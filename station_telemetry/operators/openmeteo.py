"""Open-Meteo payloads to station readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from station_telemetry.functions import iso_to_millis
from station_telemetry.operators import ordered, slices
from station_telemetry.operators.wire import decode_json_marked, decode_json_split
from station_telemetry.schemas import OPENMETEO

OPENMETEO_STATION = 100  # fixed value: the adapter's station id


def parse_payloads(payloads: DataFrame, text: str = "payload") -> tuple[DataFrame, DataFrame]:
    """JSON payloads to (parsed rows with the record in `message`, rejected rows)."""
    return decode_json_split(payloads, text, "message", OPENMETEO)


def mark_payloads(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """All payloads with the record in `message` and `ok`, which tells whether it parsed."""
    return decode_json_marked(payloads, text, "message", OPENMETEO)


def assign_sequence(
    parsed: DataFrame, order_by: list[str], station: str = "stationId", dense: bool = False
) -> DataFrame:
    """Numbers every parsed payload of a station from 1, in `order_by` (a total order).

    Payloads that did not parse take no number; those that parse but cannot be mapped do. All
    payloads usually belong to one station, so neither way keeps a station in one task: rows are
    range-partitioned by the order. Where the caller knows the order to be one dense whole number,
    such as an offset, `dense` cuts it into slices instead, which needs no written copy.
    """
    if dense:
        if len(order_by) != 1:
            raise ValueError("a dense order is one column")
        return slices.number_rows(parsed, [station], order_by[0], "sequenceNumber")
    return ordered.number_rows(parsed, [station], order_by, "sequenceNumber")


def _reading(sequence: Column, station: Column) -> list[Column]:
    current = F.col("message.current")

    # An absent number in a payload reads as zero, as it does for the adapter.
    def number(name: str) -> Column:
        return F.coalesce(current[name], F.lit(0))

    return [
        station.cast("bigint").alias("stationId"),
        sequence.cast("bigint").alias("sequenceNumber"),
        F.lit("NOT_AVAILABLE").alias("batteryStatus"),
        iso_to_millis(current["time"]).alias("statusTimeStamp"),
        F.struct(
            number("relative_humidity_2m").alias("humidity"),
            number("temperature_2m").alias("temperature"),
            number("wind_speed_10m").alias("windSpeed"),
        ).alias("weatherStatus"),
    ]


def to_readings(
    numbered: DataFrame, sequence: str = "sequenceNumber", station: str = "stationId"
) -> tuple[DataFrame, DataFrame]:
    """Numbered payloads to (readings, rejects); a payload without a valid time is rejected."""
    others = [c for c in numbered.columns if c not in (sequence, station, "message")]
    mapped = numbered.select(*others, "message", *_reading(F.col(sequence), F.col(station)))
    timed = F.col("statusTimeStamp").isNotNull()
    return mapped.where(timed).drop("message"), mapped.where(~timed)

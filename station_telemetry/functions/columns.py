"""Column expressions of the feed. All are built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from station_telemetry.schemas import BATTERY_STATES

# Classifier bounds, milliseconds threshold, archive file name, ISO local time.
BATTERY_LOW_BELOW = 0.3
BATTERY_MID_BELOW = 0.7
MILLIS_ABOVE = 100_000_000_000
ARCHIVE_FILE_NAME = r"^part-(\d+)-.*\.parquet$"
ISO_LOCAL_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"

# Registry framing puts a zero byte and a four-byte schema id before the payload.
REGISTRY_MAGIC = "00"
REGISTRY_PREFIX_BYTES = 5


def utc_date(millis: Column) -> Column:
    """Epoch milliseconds to the UTC calendar date (session time zone must be UTC)."""
    return F.to_date(F.timestamp_millis(millis))


def epoch_seconds(stamp: Column) -> Column:
    """Milliseconds to whole seconds when above the threshold, otherwise unchanged."""
    seconds = F.call_function("div", stamp, F.lit(1000))
    return F.when(stamp > MILLIS_ABOVE, seconds).otherwise(stamp)


def iso_to_millis(text: Column) -> Column:
    """ISO local date-time, seconds optional, read as UTC; null when it does not parse.

    The pattern admits the shape and the cast checks the values, which costs less than a parser
    with optional parts.
    """
    return F.unix_millis(F.when(text.rlike(ISO_LOCAL_TIME), text.try_cast("timestamp")))


def battery_from_fraction(fraction: Column) -> Column:
    return (
        F.when(fraction < BATTERY_LOW_BELOW, F.lit("LOW"))
        .when(fraction < BATTERY_MID_BELOW, F.lit("MID"))
        .when(fraction.isNotNull(), F.lit("HIGH"))
    )


def known_battery(status: Column) -> Column:
    """True for a battery state of the schema, and for null, which the schema allows."""
    return status.isNull() | status.isin(*BATTERY_STATES)


def station_key(station_id: Column) -> Column:
    return station_id.cast("string")


def document_id(station_id: Column, s_no: Column) -> Column:
    """`<station>-<sequence>`; null when either part is null."""
    return F.concat(station_id.cast("string"), F.lit("-"), s_no.cast("string"))


def record_json(record: Column) -> Column:
    """A record as JSON text, null fields kept; a null record stays null."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def printable_text(value: Column) -> Column:
    """Bytes as UTF-8 text, or as `0x…` hex when they are not valid UTF-8."""
    raw = value.cast("binary")
    text = raw.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.concat(F.lit("0x"), F.hex(raw)))


def file_timestamp(name: Column) -> Column:
    """Milliseconds in a foreign archive's file name; null when the name does not match.

    Only for archives whose writer puts the flush time there. Spark's own part files match the
    same pattern, but their number is a task id.
    """
    digits = F.regexp_extract(name, ARCHIVE_FILE_NAME, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def frame_payload(value: Column) -> Column:
    """The Avro body of a registry-framed message."""
    return F.substring(value, REGISTRY_PREFIX_BYTES + 1, 2_147_483_647)


def framed(payload: Column, schema_id: int) -> Column:
    """An Avro body with the registry prefix before it."""
    return F.concat(F.unhex(F.lit(f"{REGISTRY_MAGIC}{schema_id:08x}")), payload)

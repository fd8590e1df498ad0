"""Fixed schemas of the station feed, its archive and its documents."""

from pyspark.sql import types as T

# The battery states a station can report.
BATTERY_STATES = ("LOW", "MID", "HIGH", "NOT_AVAILABLE")

# Stream names.
STATUS_TOPIC = "stations-status"
RAIN_TOPIC = "rain-events"

_weather_fields = [
    T.StructField("humidity", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
]

WEATHER = T.StructType([*_weather_fields, T.StructField("windSpeed", T.DoubleType())])

STATUS = T.StructType(
    [
        T.StructField("stationId", T.LongType()),
        T.StructField("sequenceNumber", T.LongType()),
        T.StructField("batteryStatus", T.StringType()),
        T.StructField("statusTimeStamp", T.LongType()),
        T.StructField("weatherStatus", WEATHER),
    ]
)

RAIN = T.StructType(
    [T.StructField("stationId", T.LongType()), T.StructField("humidity", T.IntegerType())]
)

# A message as it arrives: `offset` is the arrival order within a key.
STREAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", STATUS),
        T.StructField("offset", T.LongType()),
    ]
)

# What orders messages across partitions, where the source tells it.
STREAM_ORDER = T.StructType([T.StructField("millis", T.LongType()), T.StructField("partition", T.IntegerType())])

# The archive keeps stationId in the file and repeats it as a partition column. Reading with
# this schema keeps station_id a BIGINT; partition inference would make it an INT.
ARCHIVE = T.StructType(
    [
        *STATUS.fields,
        T.StructField("station_id", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)

# An archive that also tells the arrival order and the run of a station's counter.
ARCHIVE_EPOCHS = T.StructType(
    [*ARCHIVE.fields, T.StructField("offset", T.LongType()), T.StructField("epoch", T.LongType())]
)

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("station_id", T.LongType()),
        T.StructField("s_no", T.LongType()),
        T.StructField("battery_status", T.StringType()),
        T.StructField("status_timestamp", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField(
            "weather",
            T.StructType([*_weather_fields, T.StructField("wind_speed", T.DoubleType())]),
        ),
    ]
)

# What a snake_case column reads as in files that lack it; in files that have it, null stays null.
# Spark fills columns that a file lacks with their existence default. No reading has these values.
ABSENT_TEXT = "\u0000"
ABSENT_STAMP = -(2**63)
ABSENT_HUMIDITY = -(2**31)


def _unless_absent(name: str, kind: T.DataType, otherwise: str) -> T.StructField:
    return T.StructField(name, kind, True, {"EXISTS_DEFAULT": otherwise})


# An archive file of either spelling, with the folder of the batch that wrote it.
ARCHIVE_MIXED = T.StructType(
    [
        *STATUS.fields,
        T.StructField("s_no", T.LongType()),
        _unless_absent("battery_status", T.StringType(), "'\\u0000'"),
        _unless_absent("status_timestamp", T.LongType(), f"CAST('{ABSENT_STAMP}' AS BIGINT)"),
        _unless_absent(
            "weather",
            DOCUMENT["weather"].dataType,
            f"named_struct('humidity', CAST('{ABSENT_HUMIDITY}' AS INT), 'temperature', 0D, 'wind_speed', 0D)",
        ),
        T.StructField("station_id", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)

SNAPSHOT = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

# The fields of a payload.
OPENMETEO = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("generationtime_ms", T.DoubleType()),
        T.StructField("utc_offset_seconds", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_abbreviation", T.StringType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField(
            "current_units",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("interval", T.StringType()),
                    T.StructField("temperature_2m", T.StringType()),
                    T.StructField("relative_humidity_2m", T.StringType()),
                    T.StructField("wind_speed_10m", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "current",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("interval", T.IntegerType()),
                    T.StructField("temperature_2m", T.DoubleType()),
                    T.StructField("relative_humidity_2m", T.IntegerType()),
                    T.StructField("wind_speed_10m", T.DoubleType()),
                ]
            ),
        ),
    ]
)


# Avro schemas of the messages, for registry-framed streams.
STATUS_AVRO = """
{"type": "record", "name": "AvroWeatherStatusMessage", "fields": [
  {"name": "stationId", "type": ["null", "long"], "default": null},
  {"name": "sequenceNumber", "type": ["null", "long"], "default": null},
  {"name": "batteryStatus", "default": null, "type": ["null",
    {"type": "enum", "name": "BatteryStatus", "symbols": ["LOW", "MID", "HIGH", "NOT_AVAILABLE"]}]},
  {"name": "statusTimeStamp", "type": "long"},
  {"name": "weatherStatus", "type": {"type": "record", "name": "WeatherStatus", "fields": [
    {"name": "humidity", "type": "int"},
    {"name": "temperature", "type": "double"},
    {"name": "windSpeed", "type": "double"}]}}]}
"""
RAIN_AVRO = """
{"type": "record", "name": "AvroRainMessage", "fields": [
  {"name": "stationId", "type": ["null", "long"], "default": null},
  {"name": "humidity", "type": "int"}]}
"""

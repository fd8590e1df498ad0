"""Rain alerts: readings whose humidity is above the threshold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAIN_ABOVE_HUMIDITY = 70  # fixed value; exactly 70 is not rain


def rain_events(messages: DataFrame) -> DataFrame:
    """(key, value) messages to (key, stationId, humidity). Null values never match.

    Stateless, so it runs unchanged on a stream, and the filter reaches the file scan.
    """
    return messages.where(F.col("value.weatherStatus.humidity") > RAIN_ABOVE_HUMIDITY).select(
        "key",
        F.col("value.stationId").alias("stationId"),
        F.col("value.weatherStatus.humidity").alias("humidity"),
    )

"""CSV export of a snapshot."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.functions import printable_text

# Blanks stay, an empty text is written quoted, and a null as nothing: both read back as they were.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "emptyValue": "",
    "quoteAll": "true",
}


def export_csv(snapshot: DataFrame, folder: str) -> str:
    """Writes key,value as CSV below `folder`, named by epoch milliseconds; returns the path.

    One part file per task: the snapshot is not gathered into one.
    """
    path = f"{folder.rstrip('/')}/{time.time_ns() // 1_000_000}.csv"
    text = [printable_text(F.col(c)).alias(c) for c in ("key", "value")]
    snapshot.select(*text).write.options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS, multiLine="true").schema("key string, value string").csv(path)

"""Reading the Parquet archive, as a whole or file by file as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry.files import make_folder
from station_telemetry.functions import file_timestamp
from station_telemetry.functions.columns import ARCHIVE_FILE_NAME
from station_telemetry.schemas import ARCHIVE
from station_telemetry.sources.status import ANY_AGE


def archive_scan(spark: SparkSession, root: str, schema: T.StructType = ARCHIVE) -> DataFrame:
    """All rows of an archive. Filters on station_id and date select folders.

    Archives with and without a folder per batch are read alike.
    """
    return spark.read.schema(schema).parquet(root).select(schema.names)


def archive_stream(
    spark: SparkSession,
    root: str,
    schema: T.StructType = ARCHIVE,
    files_per_batch: int | None = None,
    time_in_name: bool = False,
) -> DataFrame:
    """New archive files, each exactly once, with the arrival order of their rows in `arrived`.

    The checkpoint remembers files, not a time, so files that share a stamp, arrive late or carry
    an old time are not missed. Files with other names are skipped, which `unexpected_files`
    counts, and a missing root counts as empty.
    `time_in_name` orders files by the flush time in their name, for archives that carry it.
    """
    make_folder(spark, root)
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    reader = (
        spark.readStream.schema(with_batch)
        .option("pathGlobFilter", "part-*.parquet")
        .option("maxFileAge", ANY_AGE)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    name = F.col("_metadata.file_name")
    modified = F.unix_millis(F.col("_metadata.file_modification_time"))
    return (
        reader.parquet(root)
        .where(name.rlike(ARCHIVE_FILE_NAME))
        .withColumn(
            "arrived",
            F.struct(
                (file_timestamp(name) if time_in_name else modified).alias("millis"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("row"),
            ),
        )
    )


def unexpected_files(spark: SparkSession, root: str) -> DataFrame:
    """(file) below an archive whose names no archive writer gives: unfinished or foreign ones."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    own = name.rlike(ARCHIVE_FILE_NAME) | name.startswith("_") | name.startswith(".")
    return listed.select(F.col("path").alias("file")).where(~own)

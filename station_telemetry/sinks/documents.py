"""The searchable document table and its catalog entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry.schemas import DOCUMENT
from station_telemetry.sinks.keyed import KeyedTable

# Order of a document within a batch: file time, file, row in the file.
ARRIVED = T.StructType(
    [
        T.StructField("millis", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("row", T.LongType()),
    ]
)


# Numbers of a station that share a folder of the snapshot, some 200 MB of documents.
RANGE_NUMBERS = 1 << 22


def number_range(doc_id: Column) -> Column:
    """`<station>-<range>` of a document id, or `other` for ids of another form."""
    part = lambda n: F.regexp_extract(doc_id, r"^(-?\d+)-(-?\d+)$", n)
    span = F.floor(part(2).try_cast("bigint") / RANGE_NUMBERS).cast("string")
    return F.coalesce(F.concat(part(1), F.lit("-"), span), F.lit("other"))


def document_table(spark: SparkSession, root: str) -> KeyedTable:
    """Documents by id. A batch of new numbers touches the newest ranges of its stations only."""
    columns = T.StructType([*DOCUMENT.fields, T.StructField("arrived", ARRIVED)])
    return KeyedTable(spark, root, columns, "doc_id", "arrived", range_of=number_range)


def ensure_target(
    spark: SparkSession, name: str, path: str, schema: T.StructType = DOCUMENT
) -> None:
    """Creates an external table with the declared types; an existing one is left as it is."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def index_writer(documents: DataFrame, index: str, **options: str):
    """Batch writer for an external search index, replacing by id. Needs its connector."""
    return (
        documents.write.format("es")
        .mode("append")
        .options(**{"es.mapping.id": "doc_id", "es.write.operation": "index", **options})
        .option("es.resource", index)
    )

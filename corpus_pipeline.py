"""From raw documents to packed training sequences, in stages over the whole table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and reread before
the next; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from station_telemetry.llm import decontamination, packing, quality_classifier, simhash_pivots
from station_telemetry.llm import suffix_array_dedup
from station_telemetry.llm.common import prepare, stored


#: Words the tokenizer remembers: fewer than it would alone, as workers hold memory of earlier stages.
MEMORY_WORDS = 60_000


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    prepare(spark)
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash_pivots.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of long strings that occur again."""
    prepare(spark)
    return suffix_array_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    prepare(spark)
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left and their places in sequences of tokens."""
    prepare(spark)
    found = packing.packed_pieces(docs, columns=["doc_id"], memory_words=MEMORY_WORDS)
    return found.select("row.doc_id", *found.columns[1:])


STAGES = [
    ("quality classifier", accept),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: Models, fingerprints and tokenizers are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Token counts by source, language and tokenizer version, maintained by deltas.

A batch of changes becomes signed counts: an insert adds a document's tokens, a delete takes away
what was counted for it, and a revision does both. Counts add up, so a batch's rows are summed for
each key and appended to the totals' increments; totals are the sum of all increments. A batch is
written as the partition of its number, replacing whatever an earlier try of the same batch left:
committing it again changes nothing.

Two tables lie below a root: `ledger` (signed counts of each document) and `increments` (signed
counts of each key), both partitioned by batch. A change needs what the ledger holds for its
documents from earlier batches; only those rows are joined.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from station_telemetry import files
from station_telemetry.llm.common import picked, stored
from station_telemetry.llm.tokens import WordTokens, texts_of, tokenizer_path
from station_telemetry.session import new_folder

TOKENIZER = "word_bpe_49k.json"
#: Documents that share a key go to so many partial sums before the final one.
KEYS = ("source", "lang", "version")

_LEDGER = "doc_id long, source string, lang string, version string, tokens long, documents long, batch long"
_INCREMENT = "source string, lang string, version string, tokens long, documents long, batch long"


def counted(rows: DataFrame, path: str) -> DataFrame:
    """Adds tokens: the number of ids of `text` by the tokenizer at `path`; null text has none."""
    kept = [c for c in rows.columns if c != "text"]

    def scan(batches):
        for batch in batches:
            tokens = WordTokens.of(path)
            n = [len(ids) // 4 for ids in tokens.encode(texts_of(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(n, pa.int64())], names=[*kept, "tokens"]
            )

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(scan, f"{fields}, tokens long")


class TokenRollup:
    """The two tables below `root`, a folder of the shared store."""

    def __init__(self, spark: SparkSession, root: str, path: str | None = None, version: str = TOKENIZER):
        self.spark, self.root, self.version = spark, root, version
        self.path = path or tokenizer_path(TOKENIZER)

    def _table(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        folder = f"{self.root}/{name}"
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(folder)
        return rows if before is None else rows.where(F.col("batch") < before)

    def _write(self, rows: DataFrame, name: str, batch: int) -> None:
        # The batch owns its partition, so a second try replaces the first.
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Applies changes (op, doc_id, text, source, lang) as batch `batch`.

        Batches come in order: only the last one may be tried again, and numbers may be left out. A batch
        without changes adds nothing.

        op is insert, delete or revise; at most one change for a document in a batch. A delete or
        revision takes away what the ledger of earlier batches holds for the doc_id under any version,
        nothing if it is unknown, so a document is counted under the version of its last change. Inserts of a doc_id that is there add to it, so repeated rows count each. A
        null doc_id can be inserted but not found again. Null source and lang are keys like others.
        """
        new = picked(changes, "op", "doc_id", "text", "source", "lang").where("op <> 'delete'")
        plus = counted(new.select(F.col("doc_id").cast("long"), "source", "lang", "text"), self.path).select(
            "doc_id", "source", "lang", F.lit(self.version).alias("version"), "tokens", F.lit(1).cast("long").alias("documents")
        )
        gone = changes.where("op <> 'insert'").select(changes["doc_id"].cast("long").alias("doc_id")).distinct()
        held = self._table("ledger", _LEDGER, before=batch)
        minus = (
            held.join(gone, "doc_id", "left_semi")
            .groupBy("doc_id", *KEYS)
            .agg((-F.sum("tokens")).alias("tokens"), (-F.sum("documents")).alias("documents"))
            .where("documents <> 0 or tokens <> 0")
        )
        self._write(plus.unionByName(minus), "ledger", batch)
        own = self._table("ledger", _LEDGER).where(F.col("batch") == batch)
        sums = own.groupBy(*KEYS).agg(F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"))
        self._write(sums, "increments", batch)

    def totals(self) -> DataFrame:
        """(source, lang, version, tokens, documents): what is counted now; keys without documents go."""
        sums = self._table("increments", _INCREMENT).groupBy(*KEYS)
        return sums.agg(F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents")).where("documents <> 0")


def history(documents: DataFrame) -> list[DataFrame]:
    """A history of the whole table: all rows come in, changed texts are revised, copies deleted.

    The revision takes white space off the ends of lines and texts; the delete, documents whose
    text is that of one with a smaller doc_id.
    """
    rows = picked(documents, "doc_id", "text", "source", "lang")
    inserted = rows.select(F.lit("insert").alias("op"), "*")
    tidy = F.regexp_replace(F.trim(F.col("text")), "[ \\t]+\\n", "\n")
    revised = rows.withColumn("tidy", tidy).where("tidy <> text").select(
        F.lit("revise").alias("op"), "doc_id", F.col("tidy").alias("text"), "source", "lang"
    )
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    keyed = rows.select("doc_id", digest.alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = keyed.join(first, "digest").where("doc_id > first").select("doc_id").distinct()
    nothing = F.lit(None).cast("string")
    deleted = copies.select(
        F.lit("delete").alias("op"), "doc_id", nothing.alias("text"), nothing.alias("source"), nothing.alias("lang")
    )
    return [inserted, revised, deleted]


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    changes = history(documents)
    for batch, rows in enumerate(changes):
        rollup.commit(batch, rows)
    rollup.commit(len(changes) - 1, changes[-1])  # tried again, as after a lost driver
    return rollup.totals()

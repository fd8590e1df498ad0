"""Bounded samples of labelled documents, and scoring of all documents by a broadcast table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import pieces, with_row

#: Bytes of text scored at once: a score's arrays take some 80 bytes for each, in every Python worker.
SCORE_BYTES = 1 << 18


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the doc_id as text, mod `modulus`; a null doc_id counts as the text ""."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, max_bytes: int
) -> DataFrame:
    """(text, label, place) of at most `rows` labelled documents, those with the smallest id hashes.

    The limit applies to the label table, before any text is read; texts above `max_bytes` are no
    training material. Rows without doc_id or label aren't used.
    """
    chosen = (
        labels.select(labels["doc_id"].alias("id"), labels[label].cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable)
        .withColumn("place", F.xxhash64("id"))
        .orderBy("place", "id", "label")
        .limit(rows)
    )
    texts = documents.select(documents["doc_id"].alias("id"), documents["text"].alias("text"))
    # At most `rows` small rows, whatever the corpus.
    return (
        texts.where(F.octet_length("text") <= max_bytes)
        .join(F.broadcast(chosen), "id")
        .select("text", "label", "place")
    )


def trained(sample: DataFrame, fit: Callable[[list[str], np.ndarray], bytes]) -> bytes:
    """Runs `fit` on the sample in one task, in order of place, text and label, and fetches the model."""

    def scan(batches):
        got = [b for b in batches if b.num_rows]
        texts, labels = [], np.zeros(0, np.int64)
        if got:
            table = pa.Table.from_batches(got).sort_by([(n, "ascending") for n in ("place", "text", "label")])
            texts, labels = table.column("text").to_pylist(), table.column("label").to_numpy()
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(texts, labels)], pa.binary())})

    # A shuffle, so that only the sample comes to one task, and documents are read by many.
    row = sample.repartition(1).mapInArrow(scan, "model binary").first()
    return bytes(row["model"]) if row else fit([], np.zeros(0, np.int64))  # no sample, no task


Score = Callable[[np.ndarray, np.ndarray, object], np.ndarray]


def scored(documents: DataFrame, model: object, score: Score, columns: list[str] | None = None) -> DataFrame:
    """Columns row (a document's columns, or those named) and score, from 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            found = [score(data, offsets, shared.value) for _, _, data, offsets in pieces(batch.column("text"), SCORE_BYTES)]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(values.astype(np.float64))], names=["row", "score"]
            )

    rows = with_row(documents, columns)
    return rows.mapInArrow(scan, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

"""Toxicity by logistic regression trained with the FTRL-proximal rule.

Features are hashed words, pairs of neighbouring words and pairs with one or two words skipped,
each counted as present or not. Every coordinate has its own learning rate, and the L1 term leaves
most weights at zero: only the others are broadcast, as a sorted array of buckets and weights.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import mixed, word_bounds, word_hashes
from station_telemetry.llm.labelled import labelled_sample, logistic, remainder, scored, trained

#: Bounds of the training sample: rows, and bytes of a text.
TRAIN_ROWS = 12_000
TRAIN_BYTES = 1 << 15
BUCKETS = 1 << 20
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.0
THRESHOLD = 0.3

_EDGE = np.zeros(256, bool)
_EDGE[[b for b in range(0x80) if not (chr(b).isalnum() or chr(b) == "'")]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, with the row of each. ASCII punctuation separates words as spaces do."""
    plain = np.where(_EDGE[data], np.uint8(32), _LOWER[data])
    starts, stops, bounds = word_bounds(plain, offsets)
    words = word_hashes(plain, starts, stops)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(bounds))
    found, rows = [words], [row]
    for gap in (1, 2, 3):
        if len(words) > gap:
            same = row[:-gap] == row[gap:]
            pair = mixed(words[:-gap] + np.uint64(gap)) * np.uint64(3) + words[gap:]
            found.append(mixed(pair[same]))
            rows.append(row[:-gap][same])
    return (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int32), np.concatenate(rows)


def fit(texts: list[str], labels: np.ndarray) -> bytes:
    """Sorted buckets (int32) and weights (float32) of the coordinates that aren't zero, bias last."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    rows = []
    for text, label in zip(texts, labels.tolist()):
        data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        buckets, _ = features(data, np.array([0, len(data)]))
        rows.append((np.append(np.unique(buckets), BUCKETS), float(label)))

    def weights(z: np.ndarray, n: np.ndarray, l1) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    l1 = np.full(BUCKETS + 1, L1)
    l1[BUCKETS] = 0  # the bias is free
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, label = rows[k]
            w = weights(z[at], n[at], l1[at])
            g = float(logistic(w.sum())) - label
            own = n[at]
            z[at] += g - (np.sqrt(own + g * g) - np.sqrt(own)) / ALPHA * w
            n[at] = own + g * g
    w = weights(z, n, l1)
    kept = np.append(np.flatnonzero(w[:-1]), BUCKETS)
    return kept.astype("<i4").tobytes() + w[kept].astype("<f4").tobytes()


def score(data: np.ndarray, offsets: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    kept, weights = model
    used = np.zeros(BUCKETS + 1, bool)
    used[kept] = True
    total = np.full(len(offsets) - 1, float(weights[-1]))
    buckets, rows = features(data, offsets)
    hit = used[buckets]
    once = np.unique(rows[hit].astype(np.int64) * (BUCKETS + 1) + buckets[hit])
    values = weights[np.searchsorted(kept, once % (BUCKETS + 1))]
    np.add.at(total, once // (BUCKETS + 1), values)
    return logistic(total)


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    modulus: int = 4,
    held: int = 2,
    train_rows: int = TRAIN_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Columns row, held_out, score (of toxic 1) and predicted, for each row of documents.

    Trained on at most `train_rows` labelled rows whose remainder isn't `held`. Null and empty
    texts have the bias alone. Repeated documents get equal scores; without labels all scores are
    one half. An empty table gives an empty table.
    """
    usable = remainder(F.col("id"), modulus) != held
    sample = labelled_sample(documents, labels, "toxic", usable, train_rows, TRAIN_BYTES)
    packed = trained(sample, fit)
    half = len(packed) // 2
    model = (np.frombuffer(packed[:half], "<i4"), np.frombuffer(packed[half:], "<f4"))
    needed = columns if columns is None else list(dict.fromkeys([*columns, "doc_id"]))
    return (
        scored(documents, model, score, needed)
        .withColumn("held_out", remainder(F.col("row.doc_id"), modulus) == held)
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_scores(documents, labels, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted"
    )

"""Supervised subword embeddings: a quality classifier over hashed words and character n-grams.

Each word and each run of three or four characters (white space marks the ends of words) has a
learned vector, found by hashing. A document is the mean of its features' vectors and of one that
all documents have; a softmax layer on top gives the classes. Vectors and layer are trained by
stochastic gradient descent, a document at a time. As the layer is linear, a trained model is
folded to one number for each feature: the vectors' product with the difference of the classes'
rows, which is what a score needs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import mixed, range_hash, sums_before, word_bounds
from station_telemetry.llm.labelled import labelled_sample, logistic, remainder, scored, trained

#: Bounds of the training sample: rows, and bytes of a text.
TRAIN_ROWS = 4_000
TRAIN_BYTES = 1 << 15
BUCKETS = 1 << 17
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.8
THRESHOLD = 0.5


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket of each word, 3-gram and 4-gram: arrays of buckets and each row's bounds in them."""
    begins = (data & 0xC0) != 0x80
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(begins, out=before[1:])
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    bounds = before[offsets]
    if len(chars) != bounds[-1]:  # not valid UTF-8: bytes stand for characters
        chars, bounds = data.astype(np.uint32), offsets
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    wide = np.where(space, 32, chars).astype(np.uint64)
    starts, stops, words = word_bounds(np.where(space, 32, 97).astype(np.uint8), bounds)
    take = np.uint64(BUCKETS - 1)
    out = [((range_hash(sums_before(wide), starts, stops) & take).astype(np.int32), words)]
    for size in (3, 4):
        n = len(wide) - size + 1
        if n <= 0:
            out.append((np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)))
            continue
        total = wide[:n] * np.uint64(0x9E3779B97F4A7C15)
        good = np.ones(n, bool)
        for k in range(1, size):
            total ^= (wide[k : n + k] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * k)) << np.uint64(7 * k)
            if k < size - 1:
                good &= ~space[k : n + k]
        for end in bounds[1:-1].tolist():
            good[max(0, end - size + 1) : end] = False
        where = np.flatnonzero(good)
        found = (mixed(total[where] + np.uint64(size)) & take).astype(np.int32)
        out.append((found, np.searchsorted(where, bounds)))
    return out


def fit(texts: list[str], labels: np.ndarray) -> bytes:
    """The folded model: a float32 for each bucket, and last that of the feature all have."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1, 1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), np.float32)
    rows = []
    for text, label in zip(texts, labels.tolist()):
        data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        found = [f for f, _ in features(data, np.array([0, len(data)]))]
        bucket, count = np.unique(np.concatenate([*found, [BUCKETS]]).astype(np.int32), return_counts=True)
        # All rows stay in memory: counts in as few bytes as they need.
        rows.append((bucket, count.astype(np.min_scalar_type(int(count.max()))), int(count.sum()), int(label)))
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            bucket, count, total, label = rows[k]
            weight = (count.astype(np.int64) / total).astype(np.float32)
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            own = vectors[bucket]
            mean = weight @ own
            logits = layer @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            vectors[bucket] = own - (rate * weight)[:, None] * (p @ layer)[None, :]
            layer -= rate * p[:, None] * mean[None, :]
    return (vectors @ (layer[1] - layer[0])).astype("<f4").tobytes()


def score(data: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    total, count = np.full(n, float(model[-1])), np.ones(n)
    for buckets, bounds in features(data, offsets):
        sums = np.zeros(len(buckets) + 1)
        np.cumsum(model[buckets], out=sums[1:], dtype=np.float64)
        total += np.diff(sums[bounds])
        count += np.diff(bounds)
    return logistic(total / count)


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    modulus: int = 3,
    held: int = 1,
    train_rows: int = TRAIN_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Columns row, held_out, score (of quality 1) and predicted, for each row of documents.

    Trained on at most `train_rows` labelled rows whose remainder isn't `held`. Null and empty
    texts have only the feature all have. Repeated documents get equal scores; without labels all
    scores are one half. An empty table gives an empty table.
    """
    usable = remainder(F.col("id"), modulus) != held
    sample = labelled_sample(documents, labels, "quality", usable, train_rows, TRAIN_BYTES)
    model = np.frombuffer(trained(sample, fit), "<f4")
    needed = columns if columns is None else list(dict.fromkeys([*columns, "doc_id"]))
    return (
        scored(documents, model, score, needed)
        .withColumn("held_out", remainder(F.col("row.doc_id"), modulus) == held)
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good; same columns."""
    good = quality_scores(documents, labels).where("predicted = 1")
    return good.select(*[F.col(f"row.`{c}`") for c in documents.columns])


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents, labels, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted"
    )

"""Hard negatives by angles to reference directions.

Components become whole numbers, so scores are exact inner products. Every row keeps its norm and
its angles to a few reference directions, the mean vectors of classes of labels. For an anchor at
angle a and a row at angle t from the same direction, the angle between the two lies between |a - t|
and a + t; over all directions that gives an interval of cosines, and times both norms an interval
of scores, widened for rounding. Only rows whose interval reaches into a window that is still open,
the k best so far or the band of scores asked for, are scored as whole numbers.

Anchors are taken in blocks of bounded size, each sent to all tasks; a task reads its rows once for
a block and hands on the k best for each anchor, so what is shuffled doesn't grow with the rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.llm.common import stored
from station_telemetry.operators.ordered import running_sum
from station_telemetry.session import new_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Reference directions.
DIRECTIONS = 8
#: Anchors sent to the tasks at once.
BLOCK = 16_384
_ROWS = 2_048
_ANCHORS = 512
_EXACT = float(1 << 53)
_CARRIED = "uid long, vec_id long, label int, q array<long>"


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, label, q): rows that take part, their components as floor(scale * x).

    Rows with a null vec_id, label or vector, or any null or non-finite component, take no part.
    """
    x, v = embeddings["embedding"], embeddings["vec_id"]
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = embeddings.where(v.isNotNull() & embeddings["label"].isNotNull() & x.isNotNull() & finite)
    return kept.select(
        F.monotonically_increasing_id().alias("uid"),
        v.cast("long").alias("vec_id"),
        embeddings["label"].cast("int").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("q"),
    )


def _matrix(lists: pa.Array, dimension: int) -> np.ndarray:
    """Rows of numbers as a matrix; shorter ones end with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes == dimension).all():
        return values.reshape(-1, dimension)
    out = np.zeros((len(sizes), dimension), values.dtype)
    out[np.arange(dimension) < sizes[:, None]] = values
    return out


def _totals(dimension: int, directions: int):
    def scan(batches):
        total = np.zeros((directions, dimension))
        for batch in batches:
            np.add.at(total, batch.column("label").to_numpy() % directions, _matrix(batch.column("q"), dimension))
        which, place = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"class": which.ravel(), "place": place.ravel(), "total": total.ravel()})

    return scan


def reference_directions(vectors: DataFrame, dimension: int, directions: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors, one for each class of labels: the direction of the class's sum.

    What comes to the driver is `directions * dimension` numbers, whatever the rows.
    """
    sums = (
        vectors.select("label", "q")
        .mapInArrow(_totals(dimension, directions), "class long, place long, total double")
        .groupBy("class", "place")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    out = np.zeros((directions, dimension))
    for r in sums:
        out[r["class"], r["place"]] = r["total"]
    size = np.linalg.norm(out, axis=1)
    out[size == 0, :1] = 1
    return out / np.linalg.norm(out, axis=1, keepdims=True) if dimension else out


def _angles(q: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of every row to every direction, from what lies along it and what is left across it."""
    q = q.astype(np.float64)
    along = q @ directions.T
    across = np.empty_like(along)
    for k, d in enumerate(directions):
        across[:, k] = np.linalg.norm(q - along[:, k : k + 1] * d, axis=1)
    return np.arctan2(across, along)


def _measured(directions: np.ndarray):
    def scan(batches):
        for batch in batches:
            q = _matrix(batch.column("q"), directions.shape[1])
            if q.size and np.abs(q).max() >= 1 << 31:
                raise ValueError("components beyond 31 bits: scores would not fit a long")
            angles = _angles(q, directions)
            flat = pa.array(angles.ravel())
            offsets = pa.array(np.arange(len(q) + 1, dtype=np.int32) * directions.shape[0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.linalg.norm(q.astype(np.float64), axis=1)), pa.ListArray.from_arrays(offsets, flat)],
                names=[*batch.schema.names, "norm", "angles"],
            )

    return scan


def with_angles(vectors: DataFrame, directions: np.ndarray) -> DataFrame:
    """Adds the norm and the angles to the reference directions."""
    return vectors.mapInArrow(_measured(directions), f"{_CARRIED}, norm double, angles array<double>")


class Rows:
    """Some rows in numpy: ids, labels, whole components, norms, cosines and sines of the angles."""

    def __init__(self, table: pa.Table, dimension: int, directions: int):
        get = lambda n: table.column(n).combine_chunks()
        self.uid, self.vec_id, self.label = (get(n).to_numpy() for n in ("uid", "vec_id", "label"))
        self.q = _matrix(get("q"), dimension)
        self.norm = get("norm").to_numpy()
        angles = _matrix(get("angles"), directions)
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        most = float(np.abs(self.q).max(initial=0))
        self.most = most

    def take(self, where: np.ndarray) -> "Rows":
        out = object.__new__(Rows)
        for name in ("uid", "vec_id", "label", "q", "norm", "cos", "sin"):
            setattr(out, name, getattr(self, name)[where])
        out.most = self.most
        return out


def bounds(anchors: Rows, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that the angles allow for each anchor and row, safe for rounding."""
    least = greatest = None
    for k in range(anchors.cos.shape[1]):
        along = np.multiply.outer(anchors.cos[:, k], rows.cos[:, k])
        across = np.multiply.outer(anchors.sin[:, k], rows.sin[:, k])
        high, low = along + across, along - across
        if least is None:
            least, greatest = low, high
        else:
            np.maximum(least, low, out=least)
            np.minimum(greatest, high, out=greatest)
    size = np.multiply.outer(anchors.norm, rows.norm)
    slack = size * 1e-9 + 1
    return least * size - slack, greatest * size + slack


def scores(rows: Rows, anchors: Rows, a: int, where: np.ndarray) -> np.ndarray:
    """Exact inner products of one anchor with some rows."""
    if rows.most * anchors.most * rows.q.shape[1] < _EXACT:
        return (rows.q[where].astype(np.float64) @ anchors.q[a].astype(np.float64)).astype(np.int64)
    return rows.q[where] @ anchors.q[a]


class Best:
    """The k best (score, vec_id, uid) so far, higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.score, self.vec_id, self.uid = k, *(np.zeros(0, np.int64),) * 3

    @property
    def worst(self) -> float:
        """Scores below this have no place any more."""
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        new = score >= self.worst
        score, vec_id, uid = (np.concatenate(p) for p in zip((self.score, self.vec_id, self.uid), (score[new], vec_id[new], uid[new])))
        first = np.lexsort((uid, vec_id, -score))[: self.k]
        self.score, self.vec_id, self.uid = score[first], vec_id[first], uid[first]


def _chunks(batches, dimension: int, directions: int):
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n >= _ROWS:
            yield Rows(pa.Table.from_batches(waiting), dimension, directions)
            waiting, n = [], 0
    if n:
        yield Rows(pa.Table.from_batches(waiting), dimension, directions)


def _found(best: dict) -> pa.RecordBatch:
    keys = [(*key, b) for key, b in best.items() if len(b.score)]
    column = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
    return pa.RecordBatch.from_arrays(
        [
            column([np.full(len(b.score), a) for a, _, b in keys], pa.int64()),
            column([np.full(len(b.score), p) for _, p, b in keys], pa.int32()),
            *[column([getattr(b, n) for *_, b in keys], pa.int64()) for n in ("score", "vec_id", "uid")],
        ],
        names=["anchor", "which", "score", "vec_id", "uid"],
    )


_FOUND = "anchor long, which int, score long, vec_id long, uid long"


def _nearest_of_label(block, k: int):
    """For each anchor of a block, the k best other rows of its label among a task's rows."""

    def scan(batches):
        anchors: Rows = block.value["anchors"]
        best = {(u, 0): Best(k) for u in anchors.uid.tolist()}
        for rows in _chunks(batches, anchors.q.shape[1], anchors.cos.shape[1]):
            for label in np.intersect1d(anchors.label, rows.label):
                own, among = np.flatnonzero(anchors.label == label), rows.take(rows.label == label)
                for at in range(0, len(own), _ANCHORS):
                    _add_nearest(anchors.take(own[at : at + _ANCHORS]), among, best, k)
        yield _found(best)

    return scan


def _add_nearest(anchors: Rows, rows: Rows, best: dict, k: int) -> None:
    low, high = bounds(anchors, rows)
    same = anchors.uid[:, None] == rows.uid
    low[same] = high[same] = -np.inf
    # The k-th greatest lower bound is a score that k rows reach.
    floor = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)
    floor = np.maximum(floor, [best[u, 0].worst for u in anchors.uid.tolist()])
    reached = (high >= floor[:, None]) & ~same
    for a in np.flatnonzero(reached.any(axis=1)).tolist():
        where = np.flatnonzero(reached[a])
        best[int(anchors.uid[a]), 0].add(scores(rows, anchors, a, where), rows.vec_id[where], rows.uid[where])


def _in_windows(block, k: int):
    """For each anchor and positive, the k best rows of other labels inside the positive's window."""

    def scan(batches):
        anchors: Rows = block.value["anchors"]
        least, most = block.value["least"], block.value["most"]
        best = {(u, p): Best(k) for i, u in enumerate(anchors.uid.tolist()) for p in np.flatnonzero(least[i] <= most[i]).tolist()}
        for rows in _chunks(batches, anchors.q.shape[1], anchors.cos.shape[1]):
            for at in range(0, len(anchors.uid), _ANCHORS):
                own = np.arange(at, min(at + _ANCHORS, len(anchors.uid)))
                _add_negatives(anchors.take(own), rows, least[own], most[own], best)
        yield _found(best)

    return scan


def _add_negatives(anchors: Rows, rows: Rows, least: np.ndarray, most: np.ndarray, best: dict) -> None:
    uids = anchors.uid.tolist()
    open_from = np.full(least.shape, np.inf)
    for i, p in np.argwhere(least <= most).tolist():
        open_from[i, p] = max(least[i, p], best[uids[i], p].worst)
    low, high = bounds(anchors, rows)
    reached = reduce(
        np.logical_or,
        [(high >= open_from[:, p : p + 1]) & (low <= most[:, p : p + 1]) for p in range(least.shape[1])],
    )
    reached &= anchors.label[:, None] != rows.label
    for a in np.flatnonzero(reached.any(axis=1)).tolist():
        where = np.flatnonzero(reached[a])
        score = scores(rows, anchors, a, where)
        for p in np.flatnonzero(least[a] <= most[a]).tolist():
            inside = (score >= open_from[a, p]) & (score <= most[a, p])
            if inside.any():
                best[uids[a], p].add(score[inside], rows.vec_id[where[inside]], rows.uid[where[inside]])


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best over all tasks; Spark limits every task to k a key before the shuffle."""
    order = Window.partitionBy("anchor", "which").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = 80,
    most_percent: int = 100,
    directions: int = DIRECTIONS,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` is a written table (uid, vec_id, label, q) and `anchors` some of its rows. An anchor's
    positives are the first other rows of its label, higher scores first, then smaller vec_id; for
    each, the first rows of other labels with a score between `least_percent` and `most_percent` of the
    positive's. Rows count by themselves: a repeated vec_id is a row as any other, and a copy of the
    anchor's row may be its positive. Shorter vectors count as ending in zeros. A label of one row, a
    negative positive score and an empty table give no rows. Components beyond 31 bits stop the job.
    """
    spark = vectors.sparkSession
    dimension = vectors.agg(F.max(F.size("q"))).first()[0] or 0
    around = reference_directions(vectors, dimension, directions)
    measured = stored(with_angles(vectors, around), "angles")
    numbered = stored(
        running_sum(anchors.select("uid").withColumn("one", F.lit(1).cast("long")), [], ["uid"], "one", into="n", total="all"),
        "anchors",
    )
    count = numbered.count()
    path = new_folder(spark, "negatives")
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    schema = ", ".join(f"{n} {'int' if n == 'rank' else 'long'}" for n in names)
    spark.createDataFrame([], schema).write.parquet(f"{path}/block=-1")
    for k in range(-(-count // block)):
        own = numbered.where((F.col("n") > k * block) & (F.col("n") <= (k + 1) * block)).select("uid")
        taken = Rows(measured.join(own, "uid", "left_semi").orderBy("uid").toArrow(), dimension, directions)
        # A task sends `positives` rows an anchor; the driver gets as many, for one block.
        sent = spark.sparkContext.broadcast({"anchors": taken})
        near = measured.mapInArrow(_nearest_of_label(sent, positives), _FOUND)
        near = stored(_first(near, positives), "positives")
        least, most = np.full((len(taken.uid), positives), np.inf), np.full((len(taken.uid), positives), -np.inf)
        kept = near.select("anchor", "rank", "score").toArrow()
        at, place = np.searchsorted(taken.uid, kept["anchor"].to_numpy()), kept["rank"].to_numpy() - 1
        score = kept["score"].to_numpy()
        least[at, place] = -(-least_percent * score // 100)
        most[at, place] = most_percent * score // 100
        sent_windows = spark.sparkContext.broadcast({"anchors": taken, "least": least, "most": most})
        inside = measured.mapInArrow(_in_windows(sent_windows, negatives), _FOUND)
        ids = measured.join(own, "uid", "left_semi").select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        chosen = near.select(
            "anchor", (F.col("rank") - 1).alias("which"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        (
            _first(inside, negatives)
            .join(chosen, ["anchor", "which"])
            .join(ids, "anchor")
            .withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .select(*names)
            .write.parquet(f"{path}/block={k}")
        )
        sent.destroy()
        sent_windows.destroy()
    return spark.read.schema(schema).parquet(path).select(*names)


def op11_hard_negative_mining(spark, sf_dir: str) -> DataFrame:
    label, v = F.col("label"), F.col("vec_id")
    vectors = stored(
        whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn(
            "label", F.when(v % 7 == 0, (label + 1) % 10).otherwise(label)
        ),
        "vectors",
    )
    return hard_negatives(vectors, vectors.where(v % 100 == 0))

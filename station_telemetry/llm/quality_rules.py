"""Quality rules: fixed limits first, then an isolation forest on the rules' statistics.

The forest is fitted on every document that passes the limits: each is dealt to a tree, a tree splits
its documents at random places of random statistics, and a document that few splits isolate is an
anomaly. Trees grow a level at a time; a level takes one pass, which counts the documents at each node
and finds their ranges. Statistics are scaled by what is usual in good documents and drawn by their
range, so that splits tend to fall where there is something unusual; none is clipped. The path length
below which a document goes is calibrated on all labelled documents.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import (
    mixed,
    pieces,
    range_hash,
    stored,
    sums_before,
    with_row,
    word_bounds,
)

TREES = 128  # a power of two
#: A tree gets at least so many documents: small tables are dealt to several trees.
TREE_ROWS = 32
LEVELS = math.ceil(math.log2(TREE_ROWS))
#: Bins that what is usual is read from: so many in a statistic's least width, wider where it is large.
WIDTH_BINS = 256
#: Mean paths are multiples of one over this.
PATH_STEPS = 1_024
#: Of the good labelled documents, at most this share may go.
MOST_LOST = 0.01

#: Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated windows of three
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Least usual width of a statistic: of n_words, and of the other counts per word.
LEAST_WIDTH = np.array([200, 0.7, 0.01, 0.01, 0.02])


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=before[1:])
    return np.diff(before[bounds])


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys that occur more than once; of these, which aren't the first of their kind."""
    by = np.argsort(keys, kind="stable")
    ranked = keys[by]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    shared = ~fresh
    shared[:-1] |= ~fresh[1:]
    return by[shared], by[~fresh]


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each row, in columns."""
    n = len(offsets) - 1
    starts, stops, bounds = word_bounds(data, offsets)
    row = np.repeat(np.arange(n), np.diff(bounds))
    words = range_hash(before := sums_before(data), starts, stops)
    inside = ~_IS_SPACE[data] & ((data & 0xC0) != 0x80)
    repeated = np.zeros(len(words), bool)
    if len(words) > 2:
        three = mixed(mixed(words[:-2]) * np.uint64(3) + words[1:-1]) * np.uint64(5) + words[2:]
        whole = np.flatnonzero(row[:-2] == row[2:])
        shared, _ = _twice(mixed(three[whole]) ^ mixed(row[whole].astype(np.uint64)))
        for k in range(3):
            repeated[whole[shared] + k] = True
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:][data == 10] = True
    line_start = np.flatnonzero(edge[:-1]) if len(data) else np.zeros(0, np.int64)
    line_stop = np.append(line_start[1:], len(data))
    # A line ends before its line feed; only the last of a text has none.
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    if len(line_start):
        line_stop = line_stop - ((line_stop > line_start) & (data[np.maximum(line_stop - 1, 0)] == 10))
    with_word = np.searchsorted(starts, line_stop) > np.searchsorted(starts, line_start)
    line_start, line_stop, line_row = line_start[with_word], line_stop[with_word], line_row[with_word]
    key = range_hash(before, line_start, line_stop) ^ mixed(line_row.astype(np.uint64) + np.uint64(1))
    _, later = _twice(key)
    return np.stack(
        [
            np.diff(bounds),
            _per_row(inside, offsets),
            _per_row(_IS_SYMBOL[data], offsets),
            np.bincount(line_row[later], minlength=n),
            _per_row(repeated, bounds),
        ],
        axis=1,
    )


def _counted(batches):
    for batch in batches:
        found = [counts(data, offsets) for _, _, data, offsets in pieces(batch.column("text"))]
        values = np.concatenate(found) if found else np.zeros((0, len(COUNTS)), np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), *[pa.array(values[:, k].astype(np.int64)) for k in range(len(COUNTS))]],
            names=["row", *COUNTS],
        )


def statistics(documents: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns row (a document's columns, or those named), COUNTS and base_failed."""
    rows = with_row(documents, columns)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_counted, schema).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


def per_word(values: np.ndarray) -> np.ndarray:
    """The rules' statistics: n_words, and the other counts per word."""
    return np.concatenate([values[:, :1], values[:, 1:] / np.maximum(values[:, :1], 1)], axis=1)


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, the roots first: statistic (-1: leaf), place of the split, children, path at leaves."""

    middle: np.ndarray
    width: np.ndarray
    column: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray

    def features(self, values: np.ndarray) -> np.ndarray:
        """Statistics as the trees see them: small where usual, then as a logarithm; always increasing."""
        z = (per_word(values) - self.middle) / self.width
        return np.sign(z) * np.log1p(np.abs(z) ** 3)

    def reached(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The nodes without a split that rows come to from the nodes they are at."""
        at = at.copy()
        inner = np.flatnonzero(self.column[at] >= 0)
        while len(inner):
            node = at[inner]
            below = rows[inner, self.column[node]] < self.place[node]
            at[inner] = np.where(below, self.left[node], self.right[node])
            inner = inner[self.column[at[inner]] >= 0]
        return at


def _usual_path(n: float) -> float:
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def binned(values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(statistic, bin, number of rows) of each statistic's bins."""
    bins = np.floor(np.log1p(per_word(values) / LEAST_WIDTH) * WIDTH_BINS).astype(np.int64)
    found = [np.unique(bins[:, k], return_counts=True) for k in range(len(COUNTS))]
    statistic = np.repeat(np.arange(len(COUNTS)), [len(at) for at, _ in found])
    return statistic, np.concatenate([at for at, _ in found]), np.concatenate([n for _, n in found])


def usual(statistic: np.ndarray, bins: np.ndarray, n: np.ndarray, tail: float) -> Forest:
    """A forest without trees: middle and width of the statistics, from the numbers of rows in their bins."""
    middle, width = np.zeros(len(COUNTS)), LEAST_WIDTH.copy()
    for k in np.unique(statistic).tolist():
        own = np.flatnonzero(statistic == k)
        own = own[np.argsort(bins[own])]
        upto = np.cumsum(n[own])
        at = np.searchsorted(upto, np.array([tail, 0.5, 1 - tail]) * (upto[-1] - 1), "right")
        low, middle[k], high = np.expm1(bins[own[at]] / WIDTH_BINS) * LEAST_WIDTH[k]
        width[k] = max(high - middle[k], middle[k] - low, LEAST_WIDTH[k])
    none = np.zeros(0, np.int64)
    return Forest(middle, width, none, np.zeros(0), none, none, np.zeros(0))


def ranges(values: np.ndarray, deal: np.ndarray, fitted: Forest, trees_each: int) -> tuple[np.ndarray, ...]:
    """(node, number of rows, least and greatest features) of the nodes still open, for rows dealt to trees by `deal`."""
    rows = fitted.features(values)
    own = np.tile(np.arange(len(rows)), trees_each)
    dealt = mixed(deal.astype(np.uint64))
    step = (dealt >> np.uint64(32)) | np.uint64(1)  # odd, so that a row's trees differ
    tree = (dealt[own] + step[own] * np.repeat(np.arange(trees_each, dtype=np.uint64), len(rows))) % np.uint64(TREES)
    at = fitted.reached(rows[own], tree.astype(np.int64))
    open_ = np.flatnonzero(np.isnan(fitted.path[at]))
    own, at = own[open_], at[open_]
    by = np.argsort(at, kind="stable")
    own, at = own[by], at[by]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    if not len(first):
        return at, first, np.zeros((0, len(COUNTS))), np.zeros((0, len(COUNTS)))
    return (
        at[first],
        np.diff(np.append(first, len(at))),
        np.minimum.reduceat(rows[own], first),
        np.maximum.reduceat(rows[own], first),
    )


def split(fitted: Forest, found: tuple[np.ndarray, ...], depth: int, share: float, rng: np.random.Generator) -> Forest:
    """The forest after a level: open nodes get a random split and open children, or become leaves.

    `share` is what a row counts for if a tree's rows count as TREE_ROWS in all: a node whose rows count
    for one or less is isolated, however many they are.
    """
    column, place, left, right, path = (
        getattr(fitted, name).tolist() for name in ("column", "place", "left", "right", "path")
    )
    for k in np.flatnonzero(np.isnan(fitted.path)).tolist():
        path[k] = float(depth)
    node, n, low, high = found
    for i in np.argsort(node).tolist():
        k, span = int(node[i]), high[i] - low[i]
        varied = np.flatnonzero(span > 0)
        if depth >= LEVELS or n[i] * share <= 1 or not len(varied):
            path[k] += _usual_path(n[i] * share)
            continue
        column[k] = int(rng.choice(varied, p=span[varied] / span[varied].sum()))
        place[k] = float(rng.uniform(low[i, column[k]], high[i, column[k]]))
        left[k], right[k] = len(column), len(column) + 1
        for values, value in ((column, -1), (place, 0.0), (left, 0), (right, 0), (path, math.nan)):
            values += [value, value]
    return Forest(
        fitted.middle, fitted.width, np.array(column), np.array(place), np.array(left), np.array(right), np.array(path)
    )


def grown(unfitted: Forest, n: int, level) -> Forest:
    """Trees on `n` rows. `level` gives the `ranges` of all rows for a forest and the trees a row is dealt to."""
    if not n:
        return unfitted
    trees_each = min(TREES, -(-TREES * TREE_ROWS // n))
    share = min(1.0, TREES * TREE_ROWS / (n * trees_each))
    rng = np.random.default_rng(7)
    whole = np.zeros(TREES, np.int64)
    fitted = Forest(
        unfitted.middle, unfitted.width, whole - 1, np.zeros(TREES), whole, whole, np.full(TREES, math.nan)
    )
    for depth in range(LEVELS + 1):
        fitted = split(fitted, level(fitted, trees_each), depth, share, rng)
    return fitted


def forest(values: np.ndarray, good: np.ndarray | None = None) -> Forest:
    """The forest of rows in memory; what is usual comes from good rows or, without any, from the rows' inner part."""
    some = good is not None and len(good) > 0
    unfitted = usual(*binned(good if some else values), 0.01 if some else 0.1)
    deal = np.arange(len(values))
    return grown(unfitted, len(values), lambda fitted, trees_each: ranges(values, deal, fitted, trees_each))


def mean_paths(values: np.ndarray, fitted: Forest) -> np.ndarray:
    rows = fitted.features(values)
    total = np.zeros(len(rows))
    trees = TREES if len(fitted.path) else 0
    for tree in range(trees):
        total += fitted.path[fitted.reached(rows, np.full(len(rows), tree))]
    return np.floor(total * (PATH_STEPS / TREES)) / PATH_STEPS


def best_limit(paths: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The path length below which documents go, from the numbers of good and bad ones of each path, ascending.

    Most bad ones, and few good ones, are below it.
    """
    if not good.sum() or not bad.sum():
        return -1.0
    lost = (np.cumsum(good) - good) / good.sum()
    caught = (np.cumsum(bad) - bad) / bad.sum()
    return float(paths[np.argmax(np.where(lost <= MOST_LOST, caught - lost, -1))])


def calibrated(paths: np.ndarray, good: np.ndarray) -> float:
    limits, at = np.unique(paths, return_inverse=True)
    count = lambda flags: np.bincount(at[flags], minlength=len(limits))
    return best_limit(limits, count(good), count(~good))


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1)


def _binned(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in binned(_values(batch))], names=["statistic", "bin", "n"])


def _ranges(shared, trees_each: int):
    def scan(batches):
        fitted = pickle.loads(shared.value)
        names = ["node", "n", *[f"low{k}" for k in range(len(COUNTS))], *[f"high{k}" for k in range(len(COUNTS))]]
        for batch in batches:
            node, n, low, high = ranges(_values(batch), batch.column("deal").to_numpy(), fitted, trees_each)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node, n, *low.T, *high.T)], names=names)

    return scan


def _paths(shared):
    def scan(batches):
        fitted = pickle.loads(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(mean_paths(_values(batch), fitted)), batch.column("good")], names=["path", "good"]
            )

    return scan


def _columns(rows: list, n: int) -> list[np.ndarray]:
    return [np.array([r[k] for r in rows]) for k in range(n)]


def usual_of(rows: DataFrame, tail: float) -> Forest:
    """`usual` of all rows; a row of counts for each bin goes to the driver."""
    counted = rows.select(*COUNTS).mapInArrow(_binned, "statistic long, bin long, n long")
    found = counted.groupBy("statistic", "bin").agg(F.sum("n").alias("n")).collect()
    return usual(*_columns(found, 3), tail)


def forest_of(rows: DataFrame, unfitted: Forest) -> Forest:
    """Trees on all rows (deal, COUNTS); for each level, the ranges of its nodes go to the driver."""
    lows, highs = ([f"{end}{k}" for k in range(len(COUNTS))] for end in ("low", "high"))
    schema = "node long, n long, " + ", ".join(f"{c} double" for c in [*lows, *highs])

    def level(fitted: Forest, trees_each: int) -> tuple[np.ndarray, ...]:
        shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(fitted))
        found = (
            rows.select("deal", *COUNTS)
            .mapInArrow(_ranges(shared, trees_each), schema)
            .groupBy("node")
            .agg(F.sum("n"), *[F.min(c) for c in lows], *[F.max(c) for c in highs])
            .collect()
        )
        shared.destroy()
        at, n, *ends = _columns(found, 2 + 2 * len(COUNTS))
        return at, n, np.stack(ends[: len(COUNTS)], axis=1), np.stack(ends[len(COUNTS) :], axis=1)

    return grown(unfitted, rows.count(), level)


def limit_of(marked: DataFrame, fitted: Forest) -> float:
    """The limit that all labelled rows (good, COUNTS) give; the numbers at each path go to the driver."""
    shared = marked.sparkSession.sparkContext.broadcast(pickle.dumps(fitted))
    found = (
        marked.mapInArrow(_paths(shared), "path double, good boolean")
        .groupBy("path")
        .agg(F.count_if("good"), F.count_if(~F.col("good")))
        .orderBy("path")
        .collect()
    )
    return best_limit(*_columns(found, 3))


def _judged(shared):
    def scan(batches):
        fitted, limit = pickle.loads(shared.value)
        for batch in batches:
            normal = mean_paths(_values(batch), fitted) >= limit
            normal &= ~batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(normal)], names=[*batch.schema.names, "kept"]
            )

    return scan


def judged(documents: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """`statistics` and kept. The forest is fitted on all rows past the base rules, the limit on all that are labelled.

    Words are bytes other than space and the controls from tab to carriage return. Null and empty
    texts have no words and fail the base rules, as do all below 50 words. Repeated rows get equal
    verdicts, and a label that is given twice counts once; without labels of both kinds the base rules
    decide alone. An empty table gives an empty table.
    """
    needed = columns if columns is None else list(dict.fromkeys([*columns, "doc_id"]))
    table = stored(statistics(documents, needed), "statistics")
    usable = table.where(~F.col("base_failed")).withColumn("id", F.col("row.doc_id"))
    chosen = (
        labels.select(labels["doc_id"].alias("id"), labels["quality"].cast("int").alias("quality"))
        .where("id is not null and quality is not null")
        .select("id", (F.col("quality") == 1).alias("good"))
        .distinct()
    )
    marked = stored(usable.join(chosen, "id").select("good", *COUNTS), "marked")
    kinds = {r[0] for r in marked.select("good").distinct().collect()}
    unfitted = usual_of(marked.where("good"), 0.01) if True in kinds else usual_of(usable, 0.1)
    fitted, limit = unfitted, -1.0
    if len(kinds) == 2:
        deal = F.xxhash64("id", *COUNTS).alias("deal")
        fitted = forest_of(usable.select(deal, *COUNTS), unfitted)
        limit = limit_of(marked, fitted)
    shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps((fitted, limit)))
    row = table.schema["row"].dataType.simpleString()
    schema = f"row {row}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"
    return table.mapInArrow(_judged(shared), schema)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judged(documents, labels, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept"
    )

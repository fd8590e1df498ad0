"""Removal of word sequences that occur earlier, by suffix trees over groups of contexts.

Groups of contexts come from `repeats`: a short prefix of words (an anchor) files a window, and
groups too large for memory are split by further ones, and at last by all words of a window. Within a group the suffixes are split by
their first words, each part again by the next ones, and so on: the nodes of the group's suffix
tree, level by level. Parts of one suffix are leaves and go no further. What is still together at
the depth of a window is an internal node whose label is a repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm import repeats

WIDTH = 20
#: Words of distinct contexts in one group above which it is split: what one task holds in memory.
GROUP_WORDS = 1 << 20
#: Bits of the numbers that stand for a node and its next words.
_KEY_BITS = 63


def deep_nodes(
    words: np.ndarray, starts: np.ndarray, depth: int, copies: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (indexes into `starts`) that share `depth` words with another, and their node.

    A suffix that has `copies` shares its words with them.
    A level adds as many words as fit into one number beside the node, one at least: a group with
    2**31 words of text would still have room.
    """
    left = np.arange(len(starts))
    copies = np.ones(len(starts), np.int64) if copies is None else copies
    node = np.zeros(len(starts), np.int64)
    nodes, at = 1, 0
    bits = max(1, int(words.max()).bit_length()) if len(words) else 1
    while at < depth and len(left):
        take = min((_KEY_BITS - (nodes - 1).bit_length()) // bits, depth - at)
        if not take:
            raise OverflowError("nodes and words of a group don't fit into one number")
        key = node
        for k in range(take):
            key = (key << bits) | words[starts[left] + at + k]
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        count = np.diff(np.append(first, len(key)))
        left = left[by]
        shared = np.repeat(np.add.reduceat(copies[left], first) > 1, count)
        left = left[shared]
        node = np.repeat(np.arange(len(first)), count)[shared]
        nodes = len(first)
        at += take
    return left, node


def later_ones(width: int):
    """Which windows of some contexts have an equal one that starts earlier, among them or their copies.

    `docs` and `starts` are the earliest places of the contexts. A window with copies goes at all other
    places of its context, and at the earliest too if an equal one of another context starts before it.
    """

    def search(
        texts: list[bytes], windows: np.ndarray, docs: np.ndarray, starts: np.ndarray, copies: np.ndarray | None = None
    ) -> np.ndarray:
        numbers: dict[bytes, int] = {}
        words: list[int] = []
        lengths = []
        for text in texts:
            own = text.split(b" ")
            lengths.append(len(own))
            words += [numbers.setdefault(w, len(numbers)) for w in own]
        total = int(windows.sum())
        row = np.repeat(np.arange(len(texts)), windows)
        own = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
        begins = (np.cumsum(lengths) - lengths)[row] + own
        times = np.ones(total, np.int64) if copies is None else np.repeat(copies, windows)
        found, node = deep_nodes(np.array(words, np.int64), begins, width, times)
        hit = np.zeros(total, np.int8)
        if len(found):
            hit[found[times[found] > 1]] = repeats.GOES_LATER
            doc, start = docs[row[found]], starts[row[found]] + own[found]
            by = np.lexsort((start, doc, node))
            node, doc, start = node[by], doc[by], start[by]
            first = np.flatnonzero(np.diff(node, prepend=-1))
            count = np.diff(np.append(first, len(node)))
            later = (doc != np.repeat(doc[first], count)) | (start != np.repeat(start[first], count))
            hit[found[by][later]] = repeats.GOES
        return hit

    return search


def _removed(batches):
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for data, spans in zip(repeats.unsqueezed(batch), batch.column("spans").to_pylist()):
            words = data.split()
            n_words.append(len(words))
            gone = 0
            for a, b in reversed(repeats.merged(spans)):
                del words[a:b]
                gone += b - a
            n_removed.append(gone)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["row", "n_words", "n_removed", "kept"],
        )


def removed(
    documents: DataFrame,
    width: int = WIDTH,
    group_units: int = GROUP_WORDS,
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """For each document: row (the columns named), n_words, n_removed and kept (words left, UTF-8).

    A word goes if a window of `width` words that covers it has an equal one that starts earlier:
    in a document with a smaller doc_id or earlier in the same. A null doc_id counts as larger
    than all others. Repeated rows are one document: neither is earlier than the other. Null and
    empty texts have no words. An empty table gives an empty table.
    """
    cut = repeats.Cut(width, max(1, 1 << (width // 5).bit_length() - 1) if width > 4 else 1, words=True)
    ranges = repeats.repeated_ranges(documents, cut, later_ones(width), group_units)
    joined = repeats.with_spans(documents, ranges, list(columns))
    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_removed, f"row {row}, n_words long, n_removed long, kept binary")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return removed(documents).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )

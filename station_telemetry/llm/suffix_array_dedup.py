"""Removal of long byte strings that occur again, by suffix arrays of shards.

Shards hold every distinct context of a group of anchors (see `repeats`). Each is sorted by
induction (`induced`): suffixes are classified, leftmost-smaller substrings sorted recursively, and
the rest induced linearly. Permuted common prefixes then tell which windows have a twin.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm import repeats
from station_telemetry.llm.induced import permuted_common_prefixes, suffix_array

WIDTH = 200


def twins(width: int):
    """Which windows of some contexts have an equal one elsewhere among them or their copies.

    Equal windows are neighbours in the suffix array; the copies of their contexts are added up.
    """

    def search(
        texts: list[bytes], windows: np.ndarray, docs: np.ndarray, starts: np.ndarray, copies: np.ndarray
    ) -> np.ndarray:
        joined = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8).astype(np.uint16) + 2
        stops = np.cumsum([len(t) + 1 for t in texts])
        joined[stops - 1] = 1  # ends of contexts: no byte has this symbol
        joined[-1] = 0
        order = suffix_array(joined)
        _, common = permuted_common_prefixes(joined, order)
        times = np.zeros(len(joined), np.int64)
        begins = np.concatenate([[0], stops[:-1]])
        inside = np.repeat(begins - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
        places = inside + np.arange(len(inside))
        times[places] = np.repeat(copies, windows)
        first = common[order] < width
        first[0] = True
        first = np.flatnonzero(first)
        again = np.repeat(np.add.reduceat(times[order], first) > 1, np.diff(np.append(first, len(order))))
        goes = np.zeros(len(joined), np.int8)
        goes[order[again]] = repeats.GOES
        return goes[places]

    return search


def _removed(batches):
    for batch in batches:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for data, spans in zip(repeats.unsqueezed(batch), batch.column("spans").to_pylist()):
            spans = repeats.merged(spans)
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(sum(b - a for a, b in spans))
            out["n_spans"].append(len(spans))
            out["kept"].append(b"".join(kept))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                *[pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")],
                pa.array(out["kept"], pa.binary()),
            ],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _decoded(batches):
    for batch in batches:
        texts = [kept.decode("utf-8", "ignore") for kept in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def removed(
    documents: DataFrame,
    width: int = WIDTH,
    group_units: int = repeats.GROUP_UNITS,
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """For each document: row (the columns named), n_bytes, n_removed, n_spans and kept (the bytes left).

    A byte goes if a `width`-byte string that covers it also starts anywhere else, in the same
    document or another. Null counts as empty, an empty or short text stays as it is. Documents
    with equal doc_ids are different documents, and repeated rows are copies of each other. An
    empty table gives an empty table.
    """
    gram = 1 << ((width // 4).bit_length() - 1)
    cut = repeats.Cut(width, max(8, min(32, gram)), words=False)
    ranges = repeats.repeated_ranges(documents, cut, twins(width), group_units)
    joined = repeats.with_spans(documents, ranges, list(columns))
    row = joined.schema["row"].dataType.simpleString()
    schema = f"row {row}, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(_removed, schema)


def deduplicated(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with what `removed` finds cut out of their text; same columns.

    Where a cut falls inside a character, the rest of that character goes as well.
    """
    others = [c for c in documents.columns if c != "text"]
    found = removed(documents, width, columns=tuple(others))
    clean = found.mapInArrow(_decoded, f"row {found.schema['row'].dataType.simpleString()}, text string")
    return clean.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def op6_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return removed(documents).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )

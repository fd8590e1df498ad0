"""Where a window of units may occur twice: sampled anchors, exact by construction.

A window of `width` units holds `width - gram + 1` grams. Its anchor is the leftmost of those with
the smallest hash, so equal windows have equal anchors at equal places. Neighbouring windows share
anchors: a text falls into *runs* of windows with one anchor each, about 2 / (width - gram + 2) a
unit. A window whose anchor occurs once in the corpus occurs once itself. Anchors are counted over
the whole corpus; the repeated ones go into a bit table whose size is bounded, and runs it doesn't
rule out travel on, with the units they cover (their *context*). A full table lets more runs
through; it never drops one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import mixed

MAX_TABLE_BITS = 1 << 29
_SLICE_BITS = 1 << 20


def gram_hashes(units: np.ndarray, gram: int, seed: int = 0) -> np.ndarray:
    """A hash of each `gram` consecutive units, which are 64-bit numbers; gram is a power of two."""
    out, have = units, 1
    while have < gram:
        a, b = out[: len(out) - have], out[have:]
        out = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * seed) + b * np.uint64(
            0xD6E8FEB86659FD93 + 4 * seed
        )
        have *= 2
    return mixed(out) if have > 1 else mixed(out + np.uint64(seed))


def byte_gram_hashes(data: np.ndarray, gram: int = 32, seed: int = 0) -> np.ndarray:
    """The same over bytes: eight at a time are read as one number first."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    eights = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
    out, have = eights, 8
    while have < gram:
        a, b = out[: len(out) - have], out[have:]
        out = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * seed) + b * np.uint64(
            0xD6E8FEB86659FD93 + 4 * seed
        )
        have *= 2
    return mixed(out)


def smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` consecutive values."""
    out, have = values, 1
    while 2 * have <= span:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = span - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(
    hashes: np.ndarray, bounds: np.ndarray, width: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of many texts laid end to end, whose units begin at `bounds`.

    For each run its anchor, text, first window and window after the last (in units from the
    beginning). Windows never cross from one text into the next.
    """
    none = np.zeros(0, np.int64)
    span = width - gram + 1
    n = int(bounds[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), none, none, none
    least = smallest(hashes, span)[:n]
    opens = np.zeros(n + 1, bool)
    opens[1:n] = (hashes[: n - 1] == least[:-1]) | (hashes[span : span + n - 1] < least[:-1])
    closed = np.zeros(n + 1, bool)
    closed[n] = True
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        last = max(begin, end - width + 1)
        closed[last:end] = True
        if begin < last:
            opens[begin] = True
    edges = opens.copy()
    edges[0] |= closed[0]
    edges[1:] |= closed[1:] & ~closed[:-1]
    edges = np.flatnonzero(edges)
    starts_here = ~closed[edges]
    first = edges[starts_here]
    stop = edges[np.flatnonzero(starts_here) + 1]
    return least[first], np.searchsorted(bounds, first, "right") - 1, first, stop


def _places(anchors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the table for each anchor, both in the same slice."""
    mask = np.uint64(min(bits, _SLICE_BITS) - 1)
    base = (anchors >> np.uint64(40)) % np.uint64(max(1, bits // _SLICE_BITS)) * np.uint64(_SLICE_BITS)
    return base + (anchors & mask), base + ((anchors >> np.uint64(20)) & mask)


def repeated_table(counted: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the anchors of `counted` (column anchor), at most MAX_TABLE_BITS, and their number."""
    spark = counted.sparkSession
    size = counted.count()
    bits = min(MAX_TABLE_BITS, max(_SLICE_BITS, 1 << max(1, (16 * size - 1).bit_length())))
    slices = bits // _SLICE_BITS

    def fill(batches):
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            anchors = batch.column("anchor").to_numpy(zero_copy_only=False).view(np.uint64)
            for places in _places(anchors, bits):
                which = (places // np.uint64(_SLICE_BITS)).astype(np.int64)
                order = np.argsort(which, kind="stable")
                which, inner = which[order], (places[order] % np.uint64(_SLICE_BITS)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(which, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(which))):
                    table = tables.setdefault(int(which[a]), np.zeros(_SLICE_BITS, bool))
                    table[inner[a:b]] = True
        for k, table in tables.items():
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array([k], pa.int64()), "bits": [np.packbits(table).tobytes()]}
            )

    by_slice = (
        counted.withColumn("_slice", F.shiftrightunsigned("anchor", 40) % F.lit(slices))
        .repartition(min(slices, 64), "_slice")
        .select("anchor")
    )
    table = np.zeros(bits // 8, np.uint8)
    # The table is bounded by MAX_TABLE_BITS whatever the corpus, and each slice comes from one task.
    for row in by_slice.mapInArrow(fill, "slice long, bits binary").toLocalIterator():
        at = row["slice"] * (_SLICE_BITS // 8)
        table[at : at + _SLICE_BITS // 8] |= np.frombuffer(row["bits"], np.uint8)
    return table, size


def may_repeat(table: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    bits = 8 * len(table)
    a, b = _places(anchors, bits)
    set_at = lambda p: (table[p >> np.uint64(3)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & 1
    return (set_at(a) & set_at(b)).astype(bool)


def count_repeated(anchors: DataFrame) -> DataFrame:
    """Anchors that occur twice or more; rows are (anchor, n), summed per task before the shuffle."""
    return anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n >= 2").select("anchor")

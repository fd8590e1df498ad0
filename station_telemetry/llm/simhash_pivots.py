"""Near-duplicates by SimHash fingerprints, with tables of distances to pivots.

Fingerprints of texts that differ in a few of 64 bits are linked. Equal fingerprints collapse
first. Of five blocks of bits, three differing bits leave two intact, so a linked pair meets in one
of ten buckets, each named by two blocks. Every fingerprint carries its row of the pivot table, the
Hamming distances to `PIVOTS` fixed reference fingerprints: by the triangle inequality a pair whose
rows differ by more than the radius anywhere can't be linked, and most pairs of a bucket are
discarded so; survivors are verified. A bucket yields a spanning forest of its links at most, and
components follow from the forests.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import mixed, picked, stored, text_key
from station_telemetry.llm.components import components

RADIUS = 3
SHINGLE = 3
#: Reference fingerprints: eight, so that a row of the table fits one long, a byte each.
PIVOTS = mixed(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_PAIRS = tuple(combinations(range(5), 2))
#: Groups up to this size are compared pair by pair; larger ones by growing components.
_PAIRWISE = 64
#: Larger buckets are split by further bits, so that a template's many variants reach many tasks.
CROWDED = 4_096


def fingerprints_of(texts: list[bytes | None], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: a bit is set if more than half of the shingles' hashes have it."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_digest
    hashes: list[bytes] = []
    counts: list[int] = []
    rows: list[int] = []

    def flush() -> None:
        if rows:
            bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8)).reshape(-1, 64)
            first = np.cumsum([0, *counts[:-1]])
            ones = np.add.reduceat(bits, first, axis=0, dtype=np.uint32)
            major = 2 * ones > np.array(counts, np.uint32)[:, None]
            out[rows] = np.packbits(major, axis=1).view(">u8").ravel()
        hashes.clear(), counts.clear(), rows.clear()

    for row, text in enumerate(texts):
        words = text.lower().split() if text else ()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) < shingle:
            hashes.append(digest(joined, 42))
            counts.append(1)
        else:
            stops = list(accumulate(map(len, words), lambda a, b: a + b + 1))
            starts = [0, *(s + 1 for s in stops[: len(words) - shingle])]
            hashes += [digest(joined[a:b], 42) for a, b in zip(starts, stops[shingle - 1 :])]
            counts.append(len(starts))
        rows.append(row)
        if len(hashes) > 1 << 16:
            flush()
    flush()
    return out


def _fingerprinted(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tkey"), pa.array(fingerprints_of(texts).view(np.int64))],
            names=["doc_id", "tkey", "fp"],
        )


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, tkey, fp): a hash of the text and the 64 bits as a long, a row for each row."""
    rows = documents.select(documents["doc_id"].alias("doc_id"), documents["text"].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", text_key().alias("tkey"), "text").mapInArrow(
        _fingerprinted, f"doc_id {kind}, tkey long, fp long"
    )


def pivot_rows(fps: np.ndarray) -> np.ndarray:
    """The table: distance to each pivot, a byte each."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.uint8)


def _bucketed(batches):
    shift = [np.uint64(s) for s, _ in _BLOCKS]
    mask = [np.uint64((1 << w) - 1) for _, w in _BLOCKS]
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        table = pivot_rows(fps).view(np.int64).ravel()
        for k, (i, j) in enumerate(_PAIRS):
            bucket = (np.uint64(k) << np.uint64(26)) | (((fps >> shift[i]) & mask[i]) << np.uint64(13))
            bucket |= (fps >> shift[j]) & mask[j]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": bucket.view(np.int64),
                    "shared": np.full(len(fps), _SHARED[k]).view(np.int64),
                    "pivots": table,
                    "fp": fps.view(np.int64),
                }
            )


#: For each pair of blocks the bits that members of its buckets share.
_SHARED = np.array(
    [sum(((1 << w) - 1) << s for s, w in (_BLOCKS[i], _BLOCKS[j])) for i, j in _PAIRS], np.uint64
)


def _split(radius: int):
    """Members of crowded buckets, dealt anew by parts of the bits that they needn't share yet.

    The bits left are cut into radius + 1 parts; two members that differ in `radius` bits or fewer
    share one of the parts, and meet in its bucket.
    """

    def split(batches):
        for batch in batches:
            get = lambda n: batch.column(n).to_numpy().view(np.uint64)
            bucket, shared, fps = get("bucket"), get("shared"), get("fp")
            for mask in np.unique(shared).tolist():
                mine = np.flatnonzero(shared == np.uint64(mask))
                left = [b for b in range(64) if not mask >> b & 1]
                for k, bits in enumerate(np.array_split(left, radius + 1)):
                    part = np.uint64(sum(1 << int(b) for b in bits))
                    into = mixed(mixed(bucket[mine] + np.uint64(k + 1)) ^ (fps[mine] & part))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": into.view(np.int64),
                            "shared": np.full(len(mine), np.uint64(mask) | part).view(np.int64),
                            "pivots": batch.column("pivots").take(pa.array(mine)),
                            "fp": fps[mine].view(np.int64),
                        }
                    )

    return split


def buckets(fps: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """(bucket, pivots, fp): distinct fingerprints in all their buckets, none above `crowded`.

    Every pair at `radius` or fewer differing bits shares a bucket. Buckets above the limit are split
    four times at most: then eleven bits are left, and 2,048 fingerprints are as many as there can be.
    """
    kind = "bucket long, shared long, pivots long, fp long"
    rows = fps.mapInArrow(_bucketed, kind)
    done = []
    for _ in range(4):
        large = rows.groupBy("bucket").count().where(F.col("count") > crowded).select("bucket")
        large = stored(large, "crowded")
        if large.isEmpty():
            break
        done.append(rows.join(large, "bucket", "left_anti"))
        rows = stored(rows.join(large, "bucket", "left_semi").select("bucket", "shared", "pivots", "fp").mapInArrow(_split(radius), kind), "split")
    for part in done:
        rows = rows.unionByName(part)
    return rows.select("bucket", "pivots", "fp")


def _near(table: np.ndarray, a, b, radius: int) -> np.ndarray:
    """Pairs whose rows of the table differ by at most the radius in every column."""
    return (np.abs(table[a] - table[b]) <= radius).all(axis=-1)


def _forest(fps: np.ndarray, table: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of one large group, sorted by the first pivot's distance."""
    first = table[:, 0]
    fresh = np.ones(len(fps), bool)
    a, b = [], []
    for seed in range(len(fps)):
        if not fresh[seed]:
            continue
        fresh[seed] = False
        todo = [seed]
        while todo:
            at = todo.pop()
            lo = np.searchsorted(first, first[at] - radius, "left")
            hi = np.searchsorted(first, first[at] + radius, "right")
            near = lo + np.flatnonzero(fresh[lo:hi])
            near = near[_near(table, near, at, radius)]
            near = near[np.bitwise_count(fps[near] ^ fps[at]) <= radius]
            fresh[near] = False
            a += [at] * len(near)
            b += near.tolist()
            todo += near.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _linked(radius: int):
    def links(bucket: np.ndarray, fps: np.ndarray, packed: np.ndarray):
        table = np.ascontiguousarray(packed).view(np.uint8).reshape(-1, 8).astype(np.int16)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        size = np.diff(np.append(first, len(bucket)))
        found = []
        for f, n in zip(first[size > _PAIRWISE].tolist(), size[size > _PAIRWISE].tolist()):
            by = f + np.argsort(table[f : f + n, 0], kind="stable")
            a, b = _forest(fps[by], table[by], radius)
            found.append((by[a], by[b]))
        stop = np.repeat(np.where(size <= _PAIRWISE, first + size, 0), size)
        left = np.flatnonzero(stop > np.arange(len(bucket)) + 1)
        step = 1
        while len(left):
            a, b = left, left + step
            near = _near(table, a, b, radius)
            a, b = a[near], b[near]
            linked = np.bitwise_count(fps[a] ^ fps[b]) <= radius
            found.append((a[linked], b[linked]))
            step += 1
            left = left[stop[left] > left + step]
        for a, b in found:
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": fps[a].view(np.int64), "b": fps[b].view(np.int64)})

    def scan(batches):
        rest: pa.Table | None = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            rest = own if rest is None else pa.concat_tables([rest, own])
            if rest.num_rows < 50_000:
                continue
            buckets = rest.column("bucket").to_numpy()
            cut = int(np.searchsorted(buckets, buckets[-1], "left"))
            if cut:
                yield from whole(rest.slice(0, cut))
                rest = rest.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from whole(rest)

    def whole(rows: pa.Table):
        get = lambda n: rows.column(n).to_numpy()
        yield from links(get("bucket"), get("fp").view(np.uint64), get("pivots"))

    return scan


def links(fps: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """(a, b) of distinct fingerprints (column fp) at `radius` or fewer differing bits.

    Pairs in buckets of up to 64 all appear; larger buckets give links that span their components.
    """
    if not 0 <= radius <= 3:
        raise ValueError("buckets of two of five blocks find at most three differing bits")
    return (
        buckets(fps, radius, crowded)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_linked(radius), "a long, b long")
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, tkey, fp, root, component_id), a row for each row of documents.

    Words are bytes other than space and the controls from tab to carriage return, A-Z lower-cased.
    Null, empty and blank texts have the fingerprint zero, which links like any other. component_id
    is the smallest doc_id reachable over links, null where all of a component's are null, and root
    the component's smallest fingerprint; repeated rows have equal fingerprints. An empty table
    gives an empty table.
    """
    fps = stored(fingerprints(documents), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(named.join(smallest, "root").select("fp", "root", "component_id"), "classes")
    return fps.join(classes, "fp").select("doc_id", "tkey", "fp", "root", "component_id")


def representatives(documents: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id; same columns.

    Of rows that share that doc_id, one with the smallest text hash stays. A null doc_id counts as
    larger than all others.
    """
    last = F.col("doc_id").isNull()
    heads = (
        near_duplicates(documents)
        .groupBy("root")
        .agg(F.min(F.struct(last.alias("last"), "doc_id", "tkey")).alias("head"))
        .select(_row_key(F.col("head.doc_id"), F.col("head.tkey")).alias("_row_key"))
    )
    rows = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("row"),
        _row_key(documents["doc_id"], F.xxhash64(F.coalesce(documents["text"], F.lit("")))).alias("_row_key"),
    )
    kept = rows.join(heads, "_row_key", "left_semi").groupBy("_row_key").agg(F.first("row").alias("row"))
    return kept.select(*[F.col(f"row.`{c}`") for c in documents.columns])


def _row_key(doc_id, tkey):
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), tkey.cast("string"))


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    documents = picked(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

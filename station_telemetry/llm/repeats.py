"""Windows that occur more than once in a corpus, found through sampled anchors and group by group.

Shared by the two substring operators, which differ in their units (bytes or words), in how a
group of contexts is searched, and in which of several equal windows stays.

1. Every text is cut into runs of windows with one anchor (`winnow`); anchors are counted.
2. Runs whose anchor may repeat are written with their place and, once for each task, the units
   they cover: their context.
3. Equal contexts are counted, summed per task before the shuffle, however often they occur. Where
   an anchor has several contexts, or one that occurs again, they go to the anchor's group, a copy
   from each task at most; one copy with its count is searched by a suffix array or suffix tree, and
   nothing is removed but by its verdict. A group above `GROUP_UNITS`
   is split by further anchors, taken with other hashes, which equal windows share as well. Where
   `SPLITS` of these leave a group of words above it, its windows are compared whole, by a shuffle.
4. The verdicts are joined back to the places, as ranges of units for each document. Texts cross
   the network once, compressed.

Documents are told apart by doc_id and a hash of the text, so repeated doc_ids are no problem.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm import winnow
from station_telemetry.llm.common import (
    pieces,
    range_hash,
    stored,
    sums_before,
    text_key,
    word_bounds,
    word_hashes,
)

#: Units of distinct contexts in one group above which it is split, and how often.
GROUP_UNITS = 4_000_000
SPLITS = 3
#: Bytes of contexts searched together.
SHARD_BYTES = 1 << 20
#: Contexts whose text a task remembers to have sent.
SENT = 2_000_000

_RUNS = "anchor long, digest long, doc long, tkey long, start int, windows int, text binary"
_CONTEXTS = "route long, anchor long, digest long, base int, windows int, n long, doc long, start int, text binary"


@dataclass(frozen=True)
class Cut:
    """Bytes or words in windows of `width` units; anchors are grams of `gram` units."""

    width: int
    gram: int
    words: bool

    def units(self, data: np.ndarray, offsets: np.ndarray, seed: int = 0):
        """Gram hashes, row bounds in units, prefix sums for digests, and bytes of units a to b."""
        if not self.words:
            hashes = winnow.byte_gram_hashes(data, self.gram, seed)
            return hashes, offsets, lambda: sums_before(data), lambda a, b: data[a:b].tobytes()
        starts, stops, bounds = word_bounds(data, offsets)
        each = word_hashes(data, starts, stops)
        return (
            winnow.gram_hashes(each, self.gram, seed),
            bounds,
            lambda: sums_before(each),
            lambda a, b: b" ".join(data[starts[a] : stops[b - 1]].tobytes().split()),
        )


def _anchors(cut: Cut):
    def scan(batches):
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                hashes, bounds, _, _ = cut.units(data, offsets)
                anchors, _, _, _ = winnow.runs(hashes, bounds, cut.width, cut.gram)
                values, counts = np.unique(anchors, return_counts=True)
                yield pa.RecordBatch.from_pydict({"anchor": values.view(np.int64), "n": counts.astype(np.int64)})

    return scan


def _runs(cut: Cut, shared):
    def scan(batches):
        table = shared.value
        sent: set[int] = set()
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            if len(sent) > SENT:
                sent.clear()
            for first, _, data, offsets in pieces(batch.column(2)):
                hashes, bounds, sums, text_of = cut.units(data, offsets)
                anchors, rows, begin, stop = winnow.runs(hashes, bounds, cut.width, cut.gram)
                keep = winnow.may_repeat(table, anchors)
                if not keep.any():
                    continue
                anchors, rows, begin, stop = anchors[keep], rows[keep], begin[keep], stop[keep]
                digests = range_hash(sums(), begin, stop + cut.width - 1)
                texts = []
                for key, a, b in zip((anchors ^ digests).tolist(), begin.tolist(), stop.tolist()):
                    texts.append(None if key in sent else text_of(a, b + cut.width - 1))
                    sent.add(key)
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": anchors.view(np.int64),
                        "digest": digests.view(np.int64),
                        "doc": docs[first + rows],
                        "tkey": keys[first + rows],
                        "start": (begin - bounds[rows]).astype(np.int32),
                        "windows": (stop - begin).astype(np.int32),
                        "text": pa.array(texts, pa.binary()),
                    }
                )

    return scan


def _among(shared):
    """Rows whose anchor may have several contexts, or one that occurs again."""

    def scan(batches):
        table = shared.value
        for batch in batches:
            anchors = batch.column("anchor").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(winnow.may_repeat(table, anchors)))

    return scan


def _split(cut: Cut, seed: int):
    """Contexts of crowded groups, cut again by anchors with another hash."""

    def scan(batches):
        for batch in batches:
            names = ("route", "anchor", "digest", "base", "windows", "n", "doc", "start")
            got = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            for first, _, data, offsets in pieces(batch.column("text")):
                hashes, bounds, _, text_of = cut.units(data, offsets, seed)
                anchors, rows, begin, stop = winnow.runs(hashes, bounds, cut.width, cut.gram)
                rows, at = first + rows, (begin - bounds[rows]).astype(np.int32)
                route = winnow.mixed(got["route"].view(np.uint64)[rows] + np.uint64(seed)) ^ anchors
                yield pa.RecordBatch.from_pydict(
                    {
                        "route": route.view(np.int64),
                        "anchor": got["anchor"][rows],
                        "digest": got["digest"][rows],
                        "base": got["base"][rows] + at,
                        "windows": (stop - begin).astype(np.int32),
                        "n": got["n"][rows],
                        "doc": got["doc"][rows],
                        "start": got["start"][rows] + at,
                        "text": pa.array(
                            [text_of(a, b + cut.width - 1) for a, b in zip(begin.tolist(), stop.tolist())],
                            pa.binary(),
                        ),
                    }
                )

    return scan


def _windows(width: int):
    """The windows of contexts of words, one by one: their words, and their places."""

    def scan(batches):
        for batch in batches:
            names = ("text", "anchor", "digest", "base", "windows", "n", "doc", "start")
            for text, anchor, digest, base, windows, n, doc, start in zip(*[batch.column(c).to_pylist() for c in names]):
                words = text.split(b" ")
                at = np.arange(windows, dtype=np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "window": pa.array([b" ".join(words[k : k + width]) for k in range(windows)], pa.binary()),
                        "anchor": np.full(windows, anchor, np.int64),
                        "digest": np.full(windows, digest, np.int64),
                        "at": base + at,
                        "copies": np.full(windows, n, np.int64),
                        "doc": np.full(windows, doc, np.int64),
                        "start": start + at,
                    }
                )

    return scan


_WINDOWS = "window binary, anchor long, digest long, at int, copies long, doc long, start int"


def _compared(contexts: DataFrame, width: int) -> DataFrame:
    """What `_searched` finds, for contexts of words in groups of any size: no task holds a group.

    Equal windows are summed per task before the shuffle, and compared byte by byte.
    """
    each = stored(contexts.mapInArrow(_windows(width), _WINDOWS), "windows")
    equal = (
        each.groupBy("window")
        .agg(F.sum("copies").alias("n"), F.min(F.struct("doc", "start")).alias("earliest"))
        .where("n > 1")
    )
    first = F.struct("doc", "start") == F.col("earliest")
    hits = each.join(stored(equal, "equal"), "window").withColumn("others", first).where("not others or copies > 1")
    return hits.select("anchor", "digest", F.col("at").alias("from"), (F.col("at") + 1).alias("to"), "others")


#: Where the windows of contexts go, from their texts, numbers of windows, earliest places and copies.
Search = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: A window stays, goes at all places but the earliest, or goes at all.
STAYS, GOES_LATER, GOES = 0, 1, 2

_VERDICT = "anchor long, digest long, from int, to int, others boolean"


def one_each(table: pa.Table) -> pa.Table:
    """A row for each context and base: the first text, and the place of the counted row."""
    keys = [table.column(n).to_numpy() for n in ("route", "anchor", "digest", "base")]
    text = table.column("text").combine_chunks()
    with_text = ~text.is_null().to_numpy(zero_copy_only=False)
    counted = ~table.column("doc").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    fresh = np.ones(table.num_rows, bool)
    fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    group = np.cumsum(fresh) - 1
    n = int(group[-1]) + 1
    source, place = np.full(n, -1), np.full(n, -1)
    source[group[with_text][::-1]] = np.flatnonzero(with_text)[::-1]
    place[group[counted][::-1]] = np.flatnonzero(counted)[::-1]
    whole = (source >= 0) & (place >= 0)
    taken = table.take(pa.array(place[whole]))
    return taken.set_column(taken.schema.get_field_index("text"), "text", text.take(pa.array(source[whole])))


def _searched(search: Search, shard_bytes: int):
    """Runs `search` on whole groups, several at a time; rows come sorted by route."""

    def ranges(rows: list[pa.RecordBatch]):
        table = one_each(pa.Table.from_batches(rows).combine_chunks())
        get = lambda n: table.column(n).to_numpy()
        windows = get("windows")
        if not table.num_rows:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            names = ("anchor", "digest", "from", "to", "others")
            return pa.RecordBatch.from_pydict({n: pa.array([], t) for n, t in zip(names, kinds)})
        hit = search(table.column("text").to_pylist(), windows, get("doc"), get("start"), get("n"))
        bounds = np.concatenate([[0], np.cumsum(windows)])
        edge = np.zeros(len(hit) + 1, np.int8)
        edge[:-1] = hit
        new_row = np.zeros(len(hit) + 1, bool)
        new_row[bounds[:-1]] = True
        opens = np.flatnonzero((edge != STAYS) & ((np.diff(edge, prepend=0) != 0) | new_row))
        closing = np.append(edge[1:], 0)
        closes = np.flatnonzero((edge != STAYS) & ((closing != edge) | np.append(new_row[1:], True)))
        row = np.searchsorted(bounds, opens, "right") - 1
        base = get("base")[row] - bounds[row]
        return pa.RecordBatch.from_pydict(
            {
                "anchor": get("anchor")[row],
                "digest": get("digest")[row],
                "from": (opens + base).astype(np.int32),
                "to": (closes + 1 + base).astype(np.int32),
                "others": edge[opens] == GOES_LATER,
            }
        )

    def scan(batches):
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while batch.num_rows:
                routes = batch.column("route").to_numpy()
                if size >= shard_bytes:
                    last = waiting[-1].column("route")[-1].as_py()
                    stop = int(np.searchsorted(routes, last, "right")) if routes[0] == last else 0
                    if stop:
                        waiting.append(batch.slice(0, stop))
                        batch = batch.slice(stop)
                    if batch.num_rows:
                        yield ranges(waiting)
                        waiting, size = [], 0
                    continue
                lengths = np.cumsum(pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy())
                fits = min(int(np.searchsorted(lengths, shard_bytes - size)) + 1, batch.num_rows)
                waiting.append(batch.slice(0, fits))
                size += int(lengths[fits - 1])
                batch = batch.slice(fits)
        if waiting:
            yield ranges(waiting)

    return scan


def repeated_ranges(
    documents: DataFrame, cut: Cut, search: Search, group_units: int = GROUP_UNITS
) -> DataFrame:
    """Ranges of units to remove: (doc, tkey, spans), spans being an array of (from, to).

    `search` tells what goes; the earliest of equal windows, which it may spare, is that of the smallest
    doc_id, then start. A null doc_id comes after all others.
    """
    spark = documents.sparkSession
    order = F.coalesce(documents["doc_id"].cast("long"), F.lit((1 << 63) - 1))
    docs = documents.select(order.alias("doc"), documents["text"].alias("text"))
    counted = docs.select("text").mapInArrow(_anchors(cut), "anchor long, n long")
    table, _ = winnow.repeated_table(stored(winnow.count_repeated(counted), "anchors"))
    shared = spark.sparkContext.broadcast(table)  # at most MAX_TABLE_BITS, whatever the corpus
    found = stored(
        docs.select("doc", text_key().alias("tkey"), "text").mapInArrow(_runs(cut, shared), _RUNS), "runs"
    )
    places = found.drop("text")
    counts = places.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc", "start")).alias("earliest"),
        F.first("windows").alias("windows"),
    )
    counts = stored(counts, "contexts")
    contested = stored(
        counts.groupBy("anchor")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.max("n").alias("most"),
            F.sum(F.col("windows") + cut.width - 1).alias("units"),
        )
        .where("k >= 2 or most >= 2"),
        "contested",
    )
    several, _ = winnow.repeated_table(contested.select("anchor"))
    shared_several = spark.sparkContext.broadcast(several)
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("n", "long"), ("doc", "long"), ("start", "int"))]
    texts = found.where("text is not null").select("anchor", "digest", "windows", *nothing, "text")
    known = counts.select(
        "anchor",
        "digest",
        "windows",
        "n",
        F.col("earliest.doc").alias("doc"),
        F.col("earliest.start").alias("start"),
        F.lit(None).cast("binary").alias("text"),
    )
    contexts = (
        texts.unionByName(known)
        .mapInArrow(_among(shared_several), texts.schema)
        .select(F.col("anchor").alias("route"), "anchor", "digest", F.lit(0).alias("base"), "windows", "n", "doc", "start", "text")
    )
    crowded = contested.where(F.col("units") > group_units).select(F.col("anchor").alias("route"))
    compared = None
    for seed in range(1, SPLITS + 1):
        if crowded.isEmpty():
            break
        contexts = stored(contexts, "groups")
        calm = contexts.join(crowded, "route", "left_anti").select(contexts.columns)
        # A context of a crowded group is put together before it is cut, summed per task first.
        whole = (
            contexts.join(crowded, "route", "left_semi")
            .groupBy("route", "anchor", "digest", "base", "windows")
            .agg(*[F.max(c).alias(c) for c in ("n", "doc", "start", "text")])
            .where("text is not null and doc is not null")
        )
        split = stored(whole.mapInArrow(_split(cut, seed), _CONTEXTS), "split")
        crowded = (
            split.groupBy("route")
            .agg(F.sum(F.col("windows") + cut.width - 1).alias("units"))
            .where(F.col("units") > group_units)
            .select("route")
        )
        if cut.words and seed == SPLITS and not crowded.isEmpty():
            # Windows that share all these anchors are mostly equal: more splits would part few of them.
            compared = _compared(split.join(crowded, "route", "left_semi"), cut.width)
            split = split.join(crowded, "route", "left_anti").select(contexts.columns)
        contexts = calm.unionByName(split)
    searched = (
        contexts.repartition("route")
        .sortWithinPartitions("route", "anchor", "digest", "base")
        .mapInArrow(_searched(search, SHARD_BYTES), _VERDICT)
    )
    if compared is not None:
        searched = searched.unionByName(compared)
    verdicts = searched.groupBy("anchor", "digest").agg(F.collect_list(F.struct("from", "to", "others")).alias("ranges"))
    first = F.struct("doc", "start") == F.col("earliest")
    known = counts.join(verdicts, ["anchor", "digest"]).select("anchor", "digest", "earliest", "ranges")
    known = stored(known, "verdicts")  # with both sides as tables, a crowded context's join can be split
    return (
        places.join(known, ["anchor", "digest"])
        .select(
            "doc",
            "tkey",
            "start",
            F.explode("ranges").alias("range"),
            first.alias("first"),
        )
        .where("not (first and range.others)")
        .select(
            "doc",
            "tkey",
            (F.col("start") + F.col("range.from")).alias("from"),
            (F.col("start") + F.col("range.to") + cut.width - 1).alias("to"),
        )
        .groupBy("doc", "tkey")
        .agg(F.sort_array(F.collect_set(F.struct("from", "to"))).alias("spans"))
    )


def _squeezed(batches):
    for batch in batches:
        press = zstandard.ZstdCompressor(level=1).compress
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        columns = [batch.column(n) for n in ("row", "doc", "tkey")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([press(t or b"") for t in texts], pa.binary())],
            names=["row", "doc", "tkey", "squeezed"],
        )


def unsqueezed(batch: pa.RecordBatch) -> list[bytes]:
    return [zstandard.decompress(t) for t in batch.column("squeezed").to_pylist()]


def with_spans(documents: DataFrame, ranges: DataFrame, columns: list[str]) -> DataFrame:
    """Columns row (the named columns), squeezed (the text's bytes) and spans (null: none)."""
    order = F.coalesce(documents["doc_id"].cast("long"), F.lit((1 << 63) - 1))
    rows = documents.select(
        F.struct(*[documents[c] for c in columns]).alias("row"), order.alias("doc"), documents["text"].alias("text")
    ).withColumn("tkey", text_key())
    row = rows.schema["row"].dataType.simpleString()
    small = rows.mapInArrow(_squeezed, f"row {row}, doc long, tkey long, squeezed binary")
    return small.join(ranges, ["doc", "tkey"], "left").select("row", "squeezed", "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted ranges with overlapping and touching ones put together."""
    out: list[tuple[int, int]] = []
    for span in spans or ():
        a, b = span["from"], span["to"]
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out

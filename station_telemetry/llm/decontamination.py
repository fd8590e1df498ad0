"""Benchmark decontamination by a generalised suffix automaton of the benchmark's words.

Training words stream through the automaton, which tracks the longest piece of an item that ends
at each word. Where that length reaches a window, the window's state names the items. Words that no
item has, or pairs of neighbours that none has, end every match, so only stretches without them are
walked: whole-text numpy finds the stretches, the automaton decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry.llm.common import stored, with_row

WINDOW = 13
#: Words of benchmark items in one automaton, which is broadcast; more items make further passes.
BLOCK_WORDS = 400_000

#: Bytes 0-9, a-z and from 0x80 make words, A-Z are lower-cased, the rest separates.
_TO_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words_of(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return data.translate(_TO_WORDS).split()


class Automaton:
    """States of all substrings of the items' words, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        numbered = []
        for name, words in items:
            if not words:
                continue
            own = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            numbered.append((name, own))
            last = 0
            for symbol in own:
                last = self._extend(last, symbol)
        self.names: dict[tuple[int, int], set[str]] = {}
        for name, own in numbered:
            size = min(window, len(own))
            state, have = 0, 0
            for i, symbol in enumerate(own):
                state, have = self.step(state, have, symbol)
                if i + 1 >= size:
                    self.names.setdefault((self.at_length(state, size), size), set()).add(name)
        self.sizes = sorted({size for _, size in self.names})
        pairs = {a * len(self.vocabulary) + b for _, own in numbered for a, b in zip(own, own[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, symbol, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at != -1 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at != -1:
            to = self.next[at][symbol]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._clone(at, symbol, to)
        return new

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(link)
        return len(self.length) - 1

    def _clone(self, at: int, symbol: int, of: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[of]), self.link[of])
        self.link[of] = copy
        while at != -1 and self.next[at].get(symbol) == of:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, have: int, symbol: int) -> tuple[int, int]:
        """The longest suffix of what was read that is a piece of an item, one word further."""
        while state and symbol not in self.next[state]:
            state = self.link[state]
            have = self.length[state]
        to = self.next[state].get(symbol)
        return (0, 0) if to is None else (to, have + 1)

    def at_length(self, state: int, size: int) -> int:
        """The state of the last `size` words of what `state` matched."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def found(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside windows of items, and those items."""
        ranges: list[tuple[int, int]] = []
        names: set[str] = set()
        if not self.sizes or len(words) < self.sizes[0]:
            return ranges, names
        get = self.vocabulary.get
        numbers = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        pair = numbers[:-1] * len(self.vocabulary) + numbers[1:]
        joined = np.zeros(len(words) + 1, bool)  # entry i: words i - 1 and i follow each other in an item
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[1:-1] = (self.pairs[at] == pair) & (numbers[:-1] >= 0) & (numbers[1:] >= 0)
        begins = np.flatnonzero(~joined[:-1] & (numbers >= 0))
        ends = np.flatnonzero(~joined[1:] & (numbers >= 0)) + 1
        long = ends - begins >= self.sizes[0]
        for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
            state = have = 0
            for i, symbol in enumerate(numbers[begin:end].tolist(), begin):
                state, have = self.step(state, have, symbol)
                for size in self.sizes:
                    if size > have:
                        break
                    named = self.names.get((self.at_length(state, size), size))
                    if named:
                        names |= named
                        if ranges and ranges[-1][1] >= i + 1 - size:
                            ranges[-1] = (min(ranges[-1][0], i + 1 - size), i + 1)
                            while len(ranges) > 1 and ranges[-2][1] >= ranges[-1][0]:
                                begun, _ = ranges.pop()
                                ranges[-1] = (min(ranges[-1][0], begun), i + 1)
                        else:
                            ranges.append((i + 1 - size, i + 1))
        return ranges, names


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    rows = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item"), benchmark["text"].alias("text")
    )
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if words:
            block.append((row["item"], words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


_FOUND = "n_words long, ranges array<struct<from: int, to: int>>, items array<string>"


def _scan(shared):
    range_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def scan(batches):
        automaton = shared.value
        for batch in batches:
            n_words, ranges, items = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(text)
                found, names = automaton.found(words)
                n_words.append(len(words))
                ranges.append([{"from": a, "to": b} for a, b in found])
                items.append(sorted(names))
            keep = [batch.column(n) for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(n_words, pa.int64()), pa.array(ranges, range_type), pa.array(items, pa.list_(pa.string()))],
                names=[*[n for n in batch.schema.names if n != "text"], "n_words", "ranges", "items"],
            )

    return scan


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    columns: list[str] | None = None,
) -> DataFrame:
    """For each document: row (its columns, or those named), n_words, ranges of hit words, items (distinct names).

    A window is `window` consecutive words of an item, or a shorter item whole. Null and empty
    texts have no words and no hits. Items that share an id count once; a null item_id counts as
    the name "". Repeated documents each get their row; an empty benchmark hits nothing.
    """
    rows = with_row(documents, columns)
    row = rows.schema["row"].dataType.simpleString()
    spark = documents.sparkSession
    passes = []
    for block in _blocks(benchmark, block_words):
        passes.append(spark.sparkContext.broadcast(Automaton(block, window)))
    if not passes:
        passes.append(spark.sparkContext.broadcast(Automaton([], window)))
    if len(passes) == 1:
        return rows.mapInArrow(_scan(passes[0]), f"row {row}, {_FOUND}")
    # Too many items for one automaton: a pass for each block, put together per text.
    keyed = rows.withColumn("tkey", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = None
    for shared in passes:
        one = keyed.drop("row").mapInArrow(_scan(shared), f"tkey string, {_FOUND}").where("size(items) > 0")
        one = stored(one, "hits").withColumn("ranges", F.explode_outer("ranges"))
        found = one if found is None else found.unionByName(one)
    found = found.groupBy("tkey").agg(
        F.sort_array(F.collect_set("ranges")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    joined = keyed.join(found, "tkey", "left")
    return joined.select("row", "text", "ranges", "items").mapInArrow(_counted, f"row {row}, {_FOUND}")


def _counted(batches):
    from station_telemetry.llm.repeats import merged

    for batch in batches:
        ranges = [
            [{"from": a, "to": b} for a, b in merged(sorted(r or (), key=lambda x: x["from"]))]
            for r in batch.column("ranges").to_pylist()
        ]
        items = [x or [] for x in batch.column("items").to_pylist()]
        n_words = [len(words_of(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(n_words, pa.int64()),
                pa.array(ranges, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["row", "n_words", "ranges", "items"],
        )


def judged(found: DataFrame, coverage: int = 20) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated: one word in `coverage` or more is hit."""
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"])
    names = F.array_join("items", ",")
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(names.cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words")))
    )


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the bytes from the first word of each span to its last."""
    in_word = np.frombuffer(text.translate(_TO_WORDS), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(in_word, prepend=False, append=False))
    begins, ends = edges[::2].tolist(), edges[1::2].tolist()
    kept, at = [], 0
    for first, stop in spans:
        kept.append(text[at : begins[first]])
        at = ends[stop - 1]
    return b"".join([*kept, text[at:]])


@F.pandas_udf(T.BinaryType())
def _without(text: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series(
        [None if t is None else _cut(t, list(zip(b.tolist(), e.tolist()))) for t, b, e in zip(text, begins, ends)],
        dtype=object,
    )


def without_spans(found: DataFrame, span_words: int = WINDOW, coverage: int | None = None) -> Column:
    """The text of `row` without spans of benchmark words; a column over what `judged` returns.

    A span is a longest run of hit words. It goes where it has `span_words` words or more and, with
    `coverage`, also where one word in `coverage` or more of its document is hit, however short it is.
    All bytes between its first and last word go; separators around it stay. Texts without such a
    span, null and empty ones stay as they are, and only texts that have one are sent to Python.
    """
    long = F.filter("ranges", lambda r: r["to"] - r["from"] >= span_words)
    if coverage is not None:
        dense = (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))
        long = F.when(dense, F.col("ranges")).otherwise(long)
    any_left = F.size(long) > 0
    mine = lambda c: F.when(any_left, c)
    cut = _without(
        mine(F.col("row.text").cast("binary")),
        mine(F.transform(long, lambda r: r["from"])),
        mine(F.transform(long, lambda r: r["to"])),
    )
    return F.when(any_left, cut.cast("string")).otherwise(F.col("row.text"))


def decontaminated(documents: DataFrame, benchmark: DataFrame, span_words: int | None = WINDOW) -> DataFrame:
    """The documents without contaminated ones, the others without long spans; same columns.

    A document with one hit word in twenty or more goes whole; of the others, spans of `span_words`
    hit words or more are cut from the text (None: nothing is cut). See `without_spans`.
    """
    kept = judged(matches(documents, benchmark)).where(~F.col("contaminated"))
    columns = {c: F.col(f"row.`{c}`") for c in documents.columns}
    if span_words is not None:
        columns["text"] = without_spans(kept, span_words)
    return kept.select(*[value.alias(c) for c, value in columns.items()])


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return judged(matches(documents, benchmark, columns=["doc_id"])).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )

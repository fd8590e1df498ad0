"""Each operator against its rule in plain Python, on the small tables and on odd rows."""

import random
import re
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd_rows import ODD
from packing_rules import packing_faults
from pyspark.sql import functions as F

from station_telemetry.llm import (
    decontamination,
    induced,
    packing,
    quality_classifier,
    quality_rules,
    simhash_pivots,
    suffix_array_dedup,
    suffix_tree_dedup,
    toxicity,
    token_counts,
    warc,
)
from station_telemetry.llm.components import components
from station_telemetry.llm.queries import QUERIES


def by_id(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def empty(df):
    return df.where("false")


@pytest.mark.parametrize("small", [1 << 13, 0])
def test_suffix_arrays_and_common_prefixes(monkeypatch, small):
    monkeypatch.setattr(induced, "_SMALL_ALPHABET", small)
    rng = random.Random(1)
    for _ in range(300):
        k = rng.choice([1, 2, 3, 200])
        text = [rng.randint(1, k) for _ in range(rng.randint(0, 50))] + [0]
        order = induced.suffix_array(np.array(text, np.uint16))
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        before, common = induced.permuted_common_prefixes(np.array(text, np.uint16), order)
        for a, b in zip(want, want[1:]):
            same = next(n for n in range(99) if text[a + n : a + n + 1] != text[b + n : b + n + 1])
            assert (before[b], common[b]) == (a, same)


def test_byte_repeats(spark, sf, docs):
    assert by_id(QUERIES["op6_suffix_array_dedup"](spark, sf)) == brute.byte_repeats(docs)


@pytest.mark.parametrize("group", [4_000_000, 300])
def test_byte_repeats_of_odd_rows(odd, group):
    """A small group limit makes crowded groups split."""
    found = suffix_array_dedup.removed(odd, group_units=group)
    got = by_id(found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))
    assert got == brute.byte_repeats(ODD)


def test_repeated_rows_are_copies(spark, sf):
    rows = spark.createDataFrame([(1, "abc " * 100), (1, "abc " * 100), (None, "q" * 250)], "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix_array_dedup.removed(rows).select("n_bytes", "n_removed").collect())
    assert got == [(250, 250), (400, 400), (400, 400)]
    assert suffix_array_dedup.removed(empty(rows)).count() == 0


def test_cut_texts_are_valid(odd):
    texts = {r.doc_id: r.text for r in suffix_array_dedup.deduplicated(odd).collect()}
    assert texts[9] == dict(ODD)[9] and texts[5] == "" and texts[1] == ""
    assert suffix_array_dedup.deduplicated(odd).columns == odd.columns


def test_word_repeats(spark, sf, docs):
    assert by_id(QUERIES["op9_substring_dedup"](spark, sf)) == brute.word_repeats(docs)


@pytest.mark.parametrize("group", [4_000_000, 100])
def test_word_repeats_of_odd_rows(odd, group):
    found = suffix_tree_dedup.removed(odd, group_units=group)
    assert by_id(found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute.word_repeats(ODD)
    assert suffix_tree_dedup.removed(empty(odd)).count() == 0


def test_copies_count_in_array_and_tree():
    """A context that occurs again has twins and later places by its count alone."""
    one = np.array([1]), np.array([7]), np.array([0])
    for copies, want in ((1, 0), (2, 2)):
        assert suffix_array_dedup.twins(5)([b"abcde"], *one, np.array([copies])).tolist() == [want]
    for copies, want in ((1, 0), (3, 1)):
        assert suffix_tree_dedup.later_ones(3)([b"a b c"], *one, np.array([copies])).tolist() == [want]
    texts, places = [b"a b c d", b"x b c d"], (np.array([2, 2]), np.array([5, 4]), np.array([0, 0]))
    got = suffix_tree_dedup.later_ones(3)(texts, *places, np.array([2, 1]))
    assert got.tolist() == [1, 2, 0, 0]


def test_nothing_goes_but_by_the_search(spark, sf, monkeypatch):
    """With an array and a tree that find nothing, exact copies stay whole too."""
    blind = lambda width: lambda texts, windows, docs, starts, copies: np.zeros(int(windows.sum()), np.int8)
    monkeypatch.setattr(suffix_array_dedup, "twins", blind)
    monkeypatch.setattr(suffix_tree_dedup, "later_ones", blind)
    for name in ("op6_suffix_array_dedup", "op9_substring_dedup"):
        assert QUERIES[name](spark, sf).agg(F.sum("n_removed")).first()[0] == 0


def test_groups_of_very_many_words():
    """More distinct words than 2**21, and numbers of which three don't fit into 63 bits."""
    n = (1 << 21) + 5
    text = b" ".join(b"%x" % i for i in range(n))
    texts = [text, b"0 1 2 3 4"]
    hit = suffix_tree_dedup.later_ones(4)(texts, np.array([n - 3, 2]), np.array([1, 2]), np.array([0, 0]))
    assert np.flatnonzero(hit).tolist() == [n - 3, n - 2]
    words = np.array([0, 0, 1 << 21, 0, 1, 0, 0, 0, 1 << 21])
    assert sorted(suffix_tree_dedup.deep_nodes(words, np.array([0, 3, 6]), 3)[0].tolist()) == [0, 2]


def test_no_group_of_words_is_above_the_limit(spark, sf, monkeypatch):
    """One passage among other words everywhere: no anchor parts the windows inside it."""
    from station_telemetry.llm import repeats

    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(d, " ".join(f"a{d}x{k}" for k in range(25)) + f" {passage} " + " ".join(f"b{d}x{k}" for k in range(25))) for d in range(60)]
    rows += [(60, rows[3][1]), (61, passage), (62, None)]
    search, limit = suffix_tree_dedup.later_ones(20), 400

    def bounded(texts, windows, docs, starts, copies):
        assert (windows + 19).sum() <= limit
        return search(texts, windows, docs, starts, copies)

    monkeypatch.setattr(repeats, "SHARD_BYTES", 1)
    monkeypatch.setattr(suffix_tree_dedup, "later_ones", lambda width: bounded)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_tree_dedup.removed(frame, group_units=limit)
    assert by_id(found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute.word_repeats(rows)


def test_contamination(spark, sf, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert by_id(QUERIES["op3_benchmark_decontamination"](spark, sf)) == brute.contamination(docs, items)


@pytest.mark.parametrize("block", [400_000, 3])
def test_contamination_of_odd_rows(spark, odd, block):
    """A small block makes several automata and passes."""
    items = [(1, "Plain TEXT with a"), (2, "again, and: again"), (3, None), (4, ""), (5, "one"), (6, "ä ö ü " * 9), (1, "nothing")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.judged(decontamination.matches(odd, benchmark, block_words=block))
    got = by_id(found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    assert got == brute.contamination(ODD, items)
    assert decontamination.matches(empty(odd), benchmark).count() == 0
    kept = decontamination.decontaminated(odd, empty(benchmark))
    assert kept.columns == odd.columns and kept.count() == len(ODD)


@pytest.mark.parametrize("span, coverage", [(3, None), (13, None), (3, 4), (1, None)])
def test_spans_of_the_benchmark_are_cut(spark, span, coverage):
    rng = random.Random(5)
    pool = ["ab", "Cd", "é", "9", "zz"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([2, 4, 15])))) for i in range(6)]
    rows = [(0, None), (1, ""), (2, " .. "), (3, items[0][1]), (4, items[0][1])]
    for d in range(5, 60):
        words = [rng.choice([*pool, "other", "words"]) for _ in range(rng.randint(1, 25))]
        words.insert(rng.randint(0, len(words)), rng.choice(items)[1])
        rows.append((d, rng.choice(["", "¡", "; "]) + "".join(w + rng.choice([" ", ", ", "\n", " - "]) for w in words)))
    want = {}
    for d, text in rows:
        data = (text or "").encode()
        found = list(re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", data))
        words, hit = [m.group().lower() for m in found], set()
        for _, item in items:
            other = [w.encode().lower() for w in item.split()]
            size = min(13, len(other))
            for k in range(len(other) - size + 1):
                for i in range(len(words) - size + 1):
                    if words[i : i + size] == other[k : k + size]:
                        hit.update(range(i, i + size))
        dense = coverage is not None and hit and len(hit) * coverage >= len(words)
        for begin in sorted((i for i in hit if i - 1 not in hit), reverse=True):
            end = next(i for i in range(begin, len(words) + 1) if i not in hit)
            if end - begin >= span or dense:
                data = data[: found[begin].start()] + data[found[end - 1].end() :]
        want[d] = None if text is None else data.decode()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.judged(decontamination.matches(frame, spark.createDataFrame(items, "item_id long, text string")))
    got = found.select("row.doc_id", decontamination.without_spans(found, span, coverage).alias("text"))
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert sum(want[d] != t for d, t in rows) > 10


def test_long_spans_go_from_documents_that_stay(spark, odd):
    item = " ".join(f"w{i}" for i in range(20))
    text = "clean words here " * 300
    rows = [(1, f"{text}{item} end", "a"), (1, f"{text}{item} end", "a"), (2, f"{item} only", "b"), (3, None, "c"), (4, text, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ranges string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontamination.decontaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(1, f"{text} end", "a"), (1, f"{text} end", "a"), (3, None, "c"), (4, text, "d")], key=str
    )
    whole = decontamination.decontaminated(frame, benchmark, span_words=None)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted([r for r in rows if r[0] != 2], key=str)
    assert decontamination.decontaminated(odd, benchmark).columns == odd.columns


def test_fingerprints_and_components(spark, sf, docs):
    assert by_id(QUERIES["op10_simhash_near_dedup"](spark, sf)) == brute.near_duplicates(docs)


def test_near_duplicates_of_odd_rows(odd):
    found = simhash_pivots.near_duplicates(odd)
    got = by_id(found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"))
    assert got == brute.near_duplicates(ODD)
    kept = simhash_pivots.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got.values()})
    assert simhash_pivots.near_duplicates(empty(odd)).count() == 0


@pytest.mark.parametrize("crowded", [4_096, 16])
def test_links_in_crowded_buckets(spark, sf, crowded):
    """Fingerprints around a few centres: pairs in small buckets, spanning links in large ones."""
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 3))) for c in centres for _ in range(200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    assert simhash_pivots.buckets(frame, crowded=crowded).groupBy("bucket").count().agg(F.max("count")).first()[0] <= max(crowded, 400)
    edges = simhash_pivots.links(frame, crowded=crowded)
    got = {r.node: r.root for r in components(edges).collect()}
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    sets = Counter(find(f) for f in fps)
    assert sorted(Counter(got.values()).values()) == sorted(n for n in sets.values() if n > 1)


def test_components_of_a_chain(spark, sf):
    edges = spark.range(1, 60).selectExpr("id a", "id - 1 b")
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.where("false")).count() == 0


def test_rule_counts(spark, sf, docs):
    got = by_id(QUERIES["op7_quality_rules"](spark, sf))
    assert {d: v[:6] for d, v in got.items()} == {d: brute.rule_counts(t) for d, t in docs}
    assert all(not v[6] for v in got.values() if v[5])


def test_rules_of_odd_rows(odd, labels):
    got = by_id(quality_rules.judged(odd, labels).select("row.doc_id", *quality_rules.COUNTS, "base_failed", "kept"))
    assert {d: v[:6] for d, v in got.items()} == {d: brute.rule_counts(t) for d, t in ODD}
    assert quality_rules.judged(empty(odd), labels).count() == 0
    alone = quality_rules.judged(odd, empty(labels)).select("base_failed", "kept").collect()
    assert all(r.kept != r.base_failed for r in alone)


def test_forest_finds_what_sticks_out():
    rng = np.random.default_rng(1)
    words = rng.integers(100, 900, 500)
    clean = np.stack([words, words * 5, words * 0, words * 0, words // 20], axis=1)
    odd = clean[:40].copy()
    odd[:, 2] = odd[:, 0] * 2
    trees = quality_rules.forest(np.concatenate([clean, odd]))
    assert quality_rules.mean_paths(odd, trees).max() < quality_rules.mean_paths(clean, trees).min()


@pytest.mark.parametrize("column, per_word", [(1, 9.9), (2, 0.09), (3, 0.05)])
def test_forest_finds_what_is_odd_only_beside_good_text(column, per_word):
    """Less than any hand-set limit allows, but far from every good document."""
    rng = np.random.default_rng(1)
    words = rng.integers(60, 3_000, 2_000)
    rows = np.stack([words, words * rng.normal(5, 0.2, 2_000), words * 0, words * 0, words * rng.uniform(0, 0.05, 2_000)], axis=1)
    bad = np.arange(2_000) < 100
    rows[bad, column] = rows[bad, 0] * per_word
    rows = np.ceil(rows).astype(np.int64)
    paths = quality_rules.mean_paths(rows, fitted := quality_rules.forest(rows, rows[~bad]))
    gone = paths < quality_rules.calibrated(paths, ~bad)
    assert gone[bad].mean() > 0.9 and gone[~bad].mean() <= quality_rules.MOST_LOST
    twice = np.diff(quality_rules.mean_paths(np.array([[100, 500, 0, 0, 0], [2_900, 14_500, 0, 0, 0]]), fitted))
    assert twice != 0  # unlike counts per word, lengths differ


def test_training_rows_are_kept_small():
    """Below eight bytes for each feature of a text, and what all else takes."""
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(97, 123, 8_000))) + f" {k}" for k in range(400)]
    sizes = [len(np.unique(np.concatenate([f for f, _ in quality_classifier.features(d, np.array([0, len(d)]))])))
             for d in (np.frombuffer(t.encode(), np.uint8) for t in texts)]
    tracemalloc.start()
    quality_classifier.fit(texts, np.arange(400) % 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    vectors = 4 * (quality_classifier.BUCKETS + 1) * quality_classifier.DIMENSIONS
    assert peak < 8 * sum(sizes) + 3 * vectors


def test_forest_and_limit_come_from_every_row(spark):
    """Spread over tasks they are those of the rows in memory, and one row in 25,000 counts."""
    rng = np.random.default_rng(2)
    words = rng.integers(60, 3_000, 25_000)
    rows = np.stack([words, words * 5, words // 50, words * 0, words // 20], axis=1)
    good = np.arange(25_000) % 50 != 7
    rows[~good, 2] = rows[~good, 0]
    rows[24_999, 3] = rows[24_999, 0]
    table = spark.createDataFrame(
        [(k, bool(g), *map(int, r)) for k, (g, r) in enumerate(zip(good, rows))],
        "deal long, good boolean, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS),
    ).repartition(3)
    unfitted = quality_rules.usual_of(table.where("good"), 0.01)
    fitted = quality_rules.forest_of(table, unfitted)
    alone = quality_rules.forest(rows, rows[good])
    assert all(np.array_equal(getattr(fitted, n), getattr(alone, n)) for n in alone.__dataclass_fields__)
    assert 3 in fitted.column  # only the last row splits repeated lines
    limit = quality_rules.limit_of(table.select("good", *quality_rules.COUNTS), fitted)
    assert limit == quality_rules.calibrated(quality_rules.mean_paths(rows, alone), good)
    kept = quality_rules.mean_paths(rows, fitted) >= limit
    assert not kept[~good].any() and kept[good].mean() >= 1 - quality_rules.MOST_LOST


def accuracy(spark, name, label):
    """(recall of 1, recall of 0) on labelled rows that training didn't see, at sf0.1."""
    sf = "/root/testdata/sf0.1"
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, sf).collect() if r.held_out and r.doc_id in known]
    share = lambda k: np.mean([r.predicted == k for r in rows if known[r.doc_id] == k])
    assert all(0 <= r.score <= 1 for r in rows)
    return share(1), share(0)


def test_toxicity_on_held_out_rows(spark, sf):
    hit, clean = accuracy(spark, "op2_toxicity", "toxic")
    assert hit > 0.6 and clean > 0.98  # a fifth of the labels are noise


def test_quality_on_held_out_rows(spark, sf):
    good, bad = accuracy(spark, "op5_quality_classifier", "quality")
    assert good > 0.98 and bad > 0.65


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality_classifier.quality_scores])
def test_scores_of_odd_rows(odd, labels, scores):
    got = by_id(scores(odd, labels).select("row.doc_id", "score", "predicted"))
    assert set(got) == {d for d, _ in ODD} and got[1] == got[2]
    assert {v[0] for v in by_id(scores(odd, empty(labels)).select("row.doc_id", "score")).values()} == {0.5}
    assert scores(empty(odd), labels).count() == 0


def test_training_reads_documents_in_many_tasks(spark, sf):
    """The sample comes to one task, the scan before it stays spread."""
    import pyarrow as pa
    from pyspark import TaskContext

    from station_telemetry.llm import labelled

    def where(batches):
        for batch in batches:
            part, n = TaskContext.get().partitionId(), batch.num_rows
            columns = [pa.array([str(part)] * n), pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["text", "label", "place"])

    sample = spark.range(0, 400, 1, 4).mapInArrow(where, "text string, label int, place long")
    seen = labelled.trained(sample, lambda texts, labels: ",".join(sorted(set(texts))).encode())
    assert seen == b"0,1,2,3"


def test_packing(spark, sf, docs):
    rows = [tuple(r) for r in QUERIES["op1_best_fit_packing"](spark, sf).collect()]
    used, least = packing_faults(rows, docs)
    assert used <= 1.03 * least + 1


def test_packing_of_odd_rows(odd):
    found = packing.packed_pieces(odd, columns=["doc_id"])
    packing_faults([(r.row.doc_id, *tuple(r)[1:]) for r in found.collect()], ODD)
    assert packing.packed_pieces(empty(odd)).count() == 0


def test_packing_of_equal_lengths(spark, sf):
    items = spark.range(200).selectExpr("id uid", "1000L length")
    places = packing.packed(items).collect()
    assert len(places) == 200 and len({p.bin for p in places}) == 50


def test_word_by_word_ids_are_the_tokenizers(sf):
    from station_telemetry.llm.tokens import WordTokens, tokenizer_path

    texts = ["don't STOP <|startoftext|> x<|endoftext|>y <|STARTOFTEXT|>", "İstanbul ß ﬁ Ǆ", "a,b., c!, d.. e.", ", .",
             "", " nbsp　wide x", "é café, É.", "12,345. a1, 1a.", "日本語, テスト。", "x" * 300 + ", " + "y" * 5000,
             "Σας ΣΑΣ, ς.", "à́ ,", "²³, ½.", "!?., ,."]
    got = WordTokens(tokenizer_path(packing.TOKENIZER)).encode([t.encode() for t in texts * 2])
    want = [np.array(i, "<u4").tobytes() for i in brute.token_ids(texts)]
    assert got == want * 2
    column = pa.array([*texts, None, "  two  ", *texts])
    ids, stops = WordTokens(tokenizer_path(packing.TOKENIZER)).encode_column(column.slice(1))
    whole = brute.token_ids([t or "" for t in column.to_pylist()[1:]])
    assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == whole


def test_bytes_that_are_not_text_count_as_replaced(spark, sf):
    rows = spark.sql("SELECT 1L AS doc_id, cast(X'6162FF20C3' AS string) AS text UNION ALL SELECT 2L, 'ab\ufffd \ufffd'")
    found = packing.packed_pieces(rows, columns=["doc_id"]).collect()
    assert len({r.ids_crc32 for r in found}) == 1 and len(found) == 2


def test_packing_of_repeated_rows(spark, sf):
    rows = spark.createDataFrame([(1, "same row"), (1, "same row"), (None, None), (None, None)], "doc_id long, text string")
    found = packing.packed_pieces(rows, capacity=8).collect()
    assert len(found) == 4 and len({(r.sequence_id, r.offset) for r in found}) == 4


def test_archives(spark, sf, tmp_path):
    pages = [(1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "v\n", ""), (5, "w", "WARC/1.1\r\n\r\n"),
             (None, "x", "same"), (6, "y", "long " * 100_000), (2, "z", "other")]
    rows = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, uid int")
    path = str(tmp_path / "archives")
    warc.write_archives(rows, path)
    records = warc.read_archives(spark, path)
    payloads = {r.page_id: r.payload for r in records.where("page_id in (5, 6)").collect()}
    assert payloads == {5: b"WARC/1.1\r\n\r\n", 6: b"long " * 100_000}
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.originals(records).collect())
    assert got == sorted([
        ("1", 4, "revisit", 2), ("2", 4, "response", None), ("3", 0, "revisit", 4), ("4", 0, "response", None),
        ("5", 12, "response", None), ("None", 4, "revisit", 2), ("6", 500_000, "response", None), ("2", 5, "response", None),
    ])
    warc.write_archives(rows.where("false"), str(tmp_path / "none"))


def test_pages(spark, sf):
    got = by_id(QUERIES["op4_warc"](spark, sf))
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    newest = {}
    for p in pages:
        newest[p.html or ""] = max(newest.get(p.html or "", -1), p.page_id)
    for p in pages:
        data, first = (p.html or "").encode(), newest[p.html or ""]
        kind = ("response", None) if first == p.page_id else ("revisit", first)
        assert got[p.page_id] == (len(data), warc.payload_digest(data), *kind)


def test_token_totals(spark, sf, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "rollup"))
    names = "op string, doc_id long, text string, source string, lang string"

    def commit(batch, *rows):
        rollup.commit(batch, spark.createDataFrame(rows, names))

    def totals():
        return {(r.source, r.lang): (r.tokens, r.documents) for r in rollup.totals().collect()}

    def n(text):
        return len(brute.token_ids([text])[0])

    first = [("insert", 1, "a b c", "s", "en"), ("insert", 2, None, "s", None), ("insert", 3, "words here", "t", "en"),
             ("insert", 3, "words here", "t", "en")]
    commit(0, *first)
    want = {("s", "en"): (n("a b c"), 1), ("s", None): (0, 1), ("t", "en"): (2 * n("words here"), 2)}
    assert totals() == want
    commit(0, *first)
    assert totals() == want
    second = [("revise", 1, "a longer text now", "t", "en"), ("delete", 3, None, None, None), ("delete", 77, None, None, None)]
    commit(1, *second)
    commit(1, *second)
    assert totals() == {("s", None): (0, 1), ("t", "en"): (n("a longer text now"), 1)}
    commit(2, ("delete", 1, None, None, None), ("delete", 2, None, None, None))
    assert totals() == {}


def test_a_new_version_takes_counts_over(spark, tmp_path):
    """A change under a new version ends what an older one counted; an empty batch changes nothing."""
    names = "op string, doc_id long, text string, source string, lang string"
    old, new = (token_counts.TokenRollup(spark, str(tmp_path / "rollup"), version=v) for v in ("v1", "v2"))

    def totals():
        return {r.version: (r.tokens, r.documents) for r in new.totals().collect()}

    one, two = (len(ids) for ids in brute.token_ids(["a b c", "another text"]))
    rows = [("insert", d, "a b c", "s", "en") for d in (1, 2, 3)]
    old.commit(0, spark.createDataFrame(rows, names))
    second = spark.createDataFrame([("revise", 1, "another text", "s", "en"), ("delete", 2, None, None, None)], names)
    for _ in range(2):
        new.commit(1, second)
        assert totals() == {"v1": (one, 1), "v2": (two, 1)}
    new.commit(2, spark.createDataFrame([], names))
    assert totals() == {"v1": (one, 1), "v2": (two, 1)}
    new.commit(3, spark.createDataFrame([("delete", 3, None, None, None), ("delete", 1, None, None, None)], names))
    assert totals() == {}


def test_counts_of_the_history(spark, sf):
    import re

    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    first = {}
    for r in rows:
        first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    live = [r for r in rows if first[r.text or ""] == r.doc_id]
    tokens = brute.token_ids([re.sub("[ \t]+\n", "\n", (r.text or "").strip(" ")) for r in live])
    want = {}
    for r, ids in zip(live, tokens):
        had = want.get((r.source, r.lang), (0, 0))
        want[(r.source, r.lang)] = (had[0] + len(ids), had[1] + 1)
    got = QUERIES["op8_token_counts"](spark, sf).collect()
    assert {(r.source, r.lang): (r.tokens, r.documents) for r in got} == want

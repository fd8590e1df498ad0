"""Hard negatives, SuperMinHash near-duplicates and the Merkle manifest, against plain Python."""

import random

import brute
import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from station_telemetry.llm import hard_negatives, merkle_manifest, super_minhash
from station_telemetry.llm.common import stored
from station_telemetry.llm.queries import QUERIES


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def vectors_of(spark, rows):
    extra = [(*r, "q", 1, 0.5) for r in rows]
    frame = spark.createDataFrame(extra, "vec_id long, embedding array<float>, label int, q string, uid int, norm double")
    label, v = F.col("label"), F.col("vec_id")
    whole = hard_negatives.whole_vectors(frame)
    return stored(whole.withColumn("label", F.when(v % 7 == 0, (label + 1) % 10).otherwise(label)), "vectors")


def random_vectors(n, dimension, seed):
    rng = random.Random(seed)
    return [(v, [rng.choice([-1.0, 0.25, 0.5, 1.0]) * rng.random() for _ in range(dimension)], rng.randrange(3)) for v in range(n)]


def test_hard_negatives(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(QUERIES["op11_hard_negative_mining"](spark, sf)) == brute.hard_negatives(rows)


@pytest.mark.parametrize("block", [1, 2, 16_384])
def test_hard_negatives_of_odd_rows(spark, sf, block):
    """Ties, zero, short and large vectors, copies of an anchor, nulls and what isn't finite."""
    rows = random_vectors(350, 6, 1)
    rows += [(400, [0.0] * 6, 1), (500, rows[100][1], rows[100][2]), (501, rows[100][1], rows[100][2]), (502, rows[100][1], 9)]
    rows += [(600, [], 1), (601, [1.0], 1), (700, [1e5] * 6, 2), (701, [-1e5] * 6, 2), (702, [9e4] * 6, 1)]
    rows += [(None, [1.0] * 6, 1), (800, None, 1), (801, [1.0] * 6, None), (900, [1.0, None] * 3, 1), (901, [float("nan")] * 6, 1)]
    rows += [(902, [float("inf")] * 6, 1), (1000, [-0.5] * 6, 5)]
    table = vectors_of(spark, rows)
    got = hard_negatives.hard_negatives(table, table.where("vec_id % 100 = 0"), block=block)
    assert rows_of(got) == brute.hard_negatives(rows)


def test_hard_negatives_of_repeated_rows_and_none(spark, sf):
    rows = random_vectors(40, 4, 2)
    table = vectors_of(spark, rows + rows)
    got = hard_negatives.hard_negatives(table, table.where("vec_id = 0"))
    copies = [r for r in brute.hard_negatives(rows + rows) if r[0] == 0]
    assert rows_of(got) == copies
    assert hard_negatives.hard_negatives(table, table.where("false")).count() == 0
    nothing = stored(table.where("false"), "none")
    assert hard_negatives.hard_negatives(nothing, nothing).count() == 0


def test_components_beyond_a_long_stop_the_job(spark, sf):
    table = vectors_of(spark, [(0, [1e30], 1), (1, [1.0], 1)])
    with pytest.raises(Exception, match="beyond 31 bits"):
        hard_negatives.hard_negatives(table, table.where("vec_id = 0")).count()


def test_angles_bound_every_score(spark, sf):
    table = vectors_of(spark, random_vectors(300, 8, 3) + [(999, [0.0] * 8, 1)])
    around = hard_negatives.reference_directions(table, 8)
    rows = hard_negatives.Rows(hard_negatives.with_angles(table, around).toArrow(), 8, len(around))
    low, high = hard_negatives.bounds(rows, rows)
    exact = rows.q @ rows.q.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high < np.multiply.outer(rows.norm, rows.norm) * 0.9).any()


def test_near_duplicates(spark, sf, docs):
    assert rows_of(QUERIES["op12_minhash_near_dedup"](spark, sf)) == brute.shingle_duplicates(docs)


def test_near_duplicates_of_odd_rows(odd):
    assert rows_of(super_minhash.near_duplicates(odd)) == brute.shingle_duplicates(ODD)
    assert super_minhash.near_duplicates(odd.where("false")).count() == 0


def test_near_duplicates_of_repeated_rows_and_null_ids(spark, sf):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(3, text), (3, text), (2, text + " end"), (None, text.upper()), (None, "alone"), (5, None), (5, " ")]
    got = super_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(3, 37, 2, False), (3, 37, 2, False), (2, 38, 2, True), (None, 37, 2, False), (None, 1, None, False)]
    want += [(5, 0, 5, True), (5, 0, 5, True)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def family(n, seed):
    """Texts of two templates with edits, around the limit, so that some pairs link only through others."""
    rng = random.Random(seed)
    bases = [[f"t{b}w{k}" for k in range(60)] for b in range(2)]
    bases[1][:40] = bases[0][:40]
    texts = []
    for d in range(n):
        words = list(bases[d % 2])
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"e{rng.randrange(30)}"
        texts.append((d, " ".join(words)))
    return texts


def test_edited_families(spark, sf):
    rows = family(80, 4)
    got = super_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == brute.shingle_duplicates(rows)


@pytest.mark.parametrize("tile", [7, 512])
def test_a_crowded_bucket_is_resolved(spark, sf, monkeypatch, tile):
    """Everything in one bucket, in tiles: every link between components is found."""
    rows = family(60, 5) + [(100 + d, f"other {d} " + " ".join(f"o{d}x{k}" for k in range(9))) for d in range(12)]
    monkeypatch.setattr(super_minhash, "banded", lambda sets: sets.select(F.lit(1).cast("long").alias("band"), "uid"))
    monkeypatch.setattr(super_minhash, "LEAST_AGREEMENT", 0.0)
    monkeypatch.setattr(super_minhash.similar_sets, "__defaults__", (80, tile))
    got = super_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == brute.shingle_duplicates(rows)


@pytest.mark.parametrize("n", [1, 30, 400])
def test_signatures_are_the_plain_ones(n):
    """Each register against the least rank over shingles, by a shuffle per shingle, without early stops."""
    rng = np.random.default_rng(n)
    hashes, size = rng.integers(0, 1 << 63, n, dtype=np.uint64), 16
    want = [None] * size
    for h in hashes.tolist():
        perm = list(range(size))
        for rank in range(size):
            x = int(super_minhash.mixed(np.array([(h + 0x9E3779B97F4A7C15 * (rank + 1)) & ((1 << 64) - 1)], np.uint64))[0])
            k = rank + ((x & 0xFFFFFFFF) * (size - rank) >> 32)
            perm[rank], perm[k] = perm[k], perm[rank]
            value = rank << 40 | x >> 24
            if want[perm[rank]] is None or value < want[perm[rank]]:
                want[perm[rank]] = value
    assert super_minhash.signatures(hashes, np.array([n]), size)[0].tolist() == want


def test_signatures_vary_less_than_independent_hashes():
    rng = np.random.default_rng(7)
    shares = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 220, dtype=np.uint64)
        both = super_minhash.signatures(np.concatenate([x[:200], x[20:]]), np.array([200, 200]))
        shares.append((both[0] == both[1]).mean())
    expected = 180 / 220
    assert abs(np.mean(shares) - expected) < 0.01
    assert np.std(shares) < (expected * (1 - expected) / super_minhash.REGISTERS) ** 0.5


def checked(df):
    siblings = F.flatten(F.transform("proof", lambda step: F.array(step["left"], step["right"])))
    return sorted(
        (tuple(r) for r in merkle_manifest.verified(df).select(
            "doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", siblings), 256), "folded_root", "verified"
        ).collect()),
        key=str,
    )


def test_manifest(spark, sf):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, sf).collect()), key=str)
    assert got == brute.merkle(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("arity, levels", [(2, 1), (2, 8), (3, 2), (5, 1)])
def test_manifest_of_odd_rows(spark, sf, arity, levels):
    """Null values, a null language, lone leaves, repeated rows and ids, other columns' names."""
    rows = [(k, f"text {k}" if k % 5 else None, ("en", "de", None, "é")[k % 4 if k < 40 else 0], "s" if k % 3 else None, k if k % 4 else None) for k in range(70)]
    rows += [rows[8], rows[8], (9, "same id", "de", "s", 1), (None, "no id", "en", "s", 1), (71, "", "alone", "", 0)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, names).selectExpr("*", "1 as tree", "'x' as hash", "2 as rank", "'p' as proof", "0 as size")
    want = brute.merkle([dict(zip([n.split()[0] for n in names.split(", ")], r)) for r in rows], arity)
    assert checked(merkle_manifest.manifest(frame, arity, levels)) == want
    assert merkle_manifest.manifest(frame.where("false"), arity, levels).count() == 0


def test_manifest_of_one_row(spark, sf):
    one = spark.createDataFrame([(1, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    row = merkle_manifest.manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.proof == []

"""Near-duplicates by SuperMinHash signatures.

A document is the set of its shingles. Every shingle ranks the registers of a signature by a random
permutation of its own, and a register keeps the least rank (and a random fraction below it) that
any shingle gives it. As one shingle's ranks are all different, registers are correlated and the
share of equal registers varies less about the similarity than with independent hashes. Ranks are
given one after the other to all shingles of a batch; a document stops as soon as its registers are
full, as later ranks can only be greater.

Bands of registers deal the distinct sets to buckets, so that sets of the asked similarity meet
in a bucket (a pair at the limit is missed with a chance of 2e-9). Every bucket's first member is
compared with the others: first by signatures, far below the limit, then survivors exactly, on full
sets. A bucket whose members then all belong to one component is resolved. In the others, members of
different components are compared where they lie, in tiles of bounded size, and joined by
union-find, so that a tile hands on the links that join components and no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import mixed, pieces, picked, stored, word_bounds, word_hashes
from station_telemetry.llm.components import components

SHINGLE = 4
SIMILARITY = 80
BANDS, ROWS = 51, 5
REGISTERS = BANDS * ROWS
#: Signatures agreeing in a smaller share are let go: more than six deviations below the limit.
LEAST_AGREEMENT = 0.68
#: Members of an unresolved bucket that are compared in one task; larger buckets are cut into tiles.
TILE = 512
_EMPTY = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and how many each text has.

    A text of fewer words has one shingle, all of them; one without words has none.
    """
    starts, stops, before = word_bounds(data, offsets)
    words = word_hashes(_LOWER[data], starts, stops)
    count = np.diff(before)
    size = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + before[row]
    width = np.minimum(count, shingle)[row]
    found = width.astype(np.uint64)
    for k in range(shingle):
        inside = k < width
        found[inside] = mixed(found[inside] * _STEP + words[at[inside] + k])
    order = np.lexsort((found, row))
    found = found[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[fresh], np.bincount(row[fresh], minlength=len(count))


def signatures(hashes: np.ndarray, count: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash of each set of hashes: least rank above, random fraction below, a row for each set.

    Up to 256 registers. Registers of an empty set stay empty.
    """
    n = len(count)
    kept = np.full(n * registers, _EMPTY, np.uint64)
    of = np.repeat(np.arange(n), count)
    perm = None
    for rank in range(registers):
        random = mixed(hashes + np.uint64((rank + 1) * int(_STEP) & int(_EMPTY)))
        chosen = rank + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(registers - rank) >> np.uint64(32)).astype(np.int64)
        value = (np.uint64(rank) << np.uint64(40)) | (random >> np.uint64(24))
        if perm is None:
            register = chosen
        else:
            here = np.arange(len(of))
            register = perm[here, chosen].astype(np.int64)
            perm[here, chosen] = perm[:, rank]
        place = of * registers + register
        np.minimum.at(kept, place, value)
        full = (kept.reshape(n, registers) != _EMPTY).all(axis=1)
        going = ~full[of]
        if rank == 0 or 4 * going.sum() < 3 * len(going):
            of, hashes = of[going], hashes[going]
            if not len(of):
                break
            if rank == 0:
                # The permutations, from here on in the order of a lazy shuffle.
                perm = np.tile(np.arange(registers, dtype=np.uint8), (len(of), 1))
                perm[np.arange(len(of)), chosen[going]] = 0
            else:
                perm = perm[going]
    return kept.reshape(n, registers)


def _set_keys(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """128 bits for each set, equal for equal sets whatever the order."""
    before = np.concatenate(([0], np.cumsum(count)))
    out = np.empty((len(count), 2), np.uint64)
    for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed(hashes * np.uint64(salt) + np.uint64(k + 1)), out=total[1:])
        out[:, k] = total[before[1:]] - total[before[:-1]] + count.astype(np.uint64)
    return out


def _signed(batches):
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        for first, last, data, offsets in pieces(texts):
            hashes, count = shingle_sets(data, offsets)
            keys = _set_keys(hashes, count)
            registers = mixed(signatures(hashes, count))
            # Upper bytes of all registers, then lower ones: the first half alone tells most apart.
            low, high = (registers & np.uint64(0xFF)).astype(np.uint8), (registers >> np.uint64(8)).astype(np.uint8)
            flat = np.concatenate([high, low], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array(keys[:, 0].view(np.int64)),
                    pa.array(keys[:, 1].view(np.int64)),
                    pa.array(count.astype(np.int64)),
                    pa.array([r.tobytes() for r in flat], pa.binary()),
                    pa.array([squeeze.compress(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
                ],
                names=["doc_id", "k1", "k2", "n", "sig", "text"],
            )


def signed(documents: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n, sig, text): key and size of the set, signature, squeezed text; a row for each row."""
    rows = picked(documents, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_signed, f"doc_id {kind}, k1 long, k2 long, n long, sig binary, text binary")


def _banded(batches):
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, 2, BANDS, ROWS)
        parts = flat.transpose(2, 0, 1, 3).reshape(BANDS, len(flat), 2 * ROWS).astype(np.uint64)
        for k in range(BANDS):
            band = np.full(len(flat), k + 1, np.uint64)
            for part in (parts[k][:, :5], parts[k][:, 5:]):
                word = np.zeros(len(flat), np.uint64)
                for c in part.T:
                    word = (word << np.uint64(8)) | c
                band = mixed(band * _STEP + word)
            yield pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), batch.column("uid")], names=["band", "uid"])


def banded(sets: DataFrame) -> DataFrame:
    """(band, uid) for sets (uid, sig): a row for each band of registers."""
    return sets.select("uid", "sig").mapInArrow(_banded, "band long, uid long")


def _agreeing(least: float):
    def scan(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for n in ("sig_a", "sig_b")
            )
            near = pa.array((a == b).mean(axis=1) >= least) if batch.num_rows else pa.array([], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return scan


def _linked(similarity: int):
    def scan(batches):
        expand = zstandard.ZstdDecompressor()
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            column = lambda n: batch.column(n).to_pylist()
            a, b = column("a"), column("b")
            here = {u: None for u in [*a, *b]}
            known = {u: known[u] for u in here if u in known}
            fresh = {u: t for u, t in zip([*a, *b], [*column("text_a"), *column("text_b")]) if u not in known}
            texts = [expand.decompress(t) for t in fresh.values()]
            stops = np.cumsum([0, *map(len, texts)])
            hashes, count = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), stops)
            known.update(zip(fresh, np.split(hashes, np.cumsum(count)[:-1]) if len(count) else []))
            keep = []
            for x, y in zip(a, b):
                s, t = known[x], known[y]
                both = int(np.isin(s, t, assume_unique=True).sum())
                keep.append(100 * both >= similarity * (len(s) + len(t) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return scan


def links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar.

    Sizes first, then signatures, then the sets, from their texts. Joins are by one id at a time, and a
    leader that many pairs name is split by Spark as a skewed key.
    """
    half = sets.select("uid", "n", F.substring("sig", 1, REGISTERS).alias("sig"))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(name if c == "uid" else f"{c}_{name}") for c in df.columns])

    sized = pairs.join(side(half, "a"), "a").join(side(half, "b"), "b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    likely = sized.where(fits).select("a", "b", "sig_a", "sig_b")
    likely = stored(likely.mapInArrow(_agreeing(LEAST_AGREEMENT), "a long, b long"), "likely")
    full = likely.join(side(texts, "b"), "b").join(side(texts, "a"), "a").select("a", "b", "text_a", "text_b")
    return stored(full.mapInArrow(_linked(similarity), "a long, b long"), "linked")


def _joined(similarity: int):
    """Links between components among the members of each tile, by union-find."""
    names = ("band", "i", "j", "uid", "part", "root", "n", "sig", "text")

    def scan(batches):
        failed: set[tuple[int, int]] = set()
        tile, key = [], None
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if row[:3] != key:
                    yield from resolve(tile, failed)
                    tile, key = [], row[:3]
                tile.append(row[3:])
        yield from resolve(tile, failed)

    def resolve(tile, failed):
        if len(tile) < 2:
            return
        uid, part, root, n = (np.array([r[k] for r in tile]) for k in range(4))
        sig = np.frombuffer(b"".join(r[4] for r in tile), np.uint8).reshape(len(tile), -1)
        parent = np.unique(root, return_inverse=True)[1]
        sets: dict[int, np.ndarray] = {}
        two_parts = (part != part[0]).any()
        expand = zstandard.ZstdDecompressor()

        def shingles(k: int) -> np.ndarray:
            if k not in sets:
                data = np.frombuffer(expand.decompress(tile[k][5]), np.uint8)
                sets[k] = shingle_sets(data, np.array([0, len(data)]))[0]
            return sets[k]

        out = []
        for a in range(len(tile) - 1):
            others = np.arange(a + 1, len(tile))
            apart = (parent[others] != parent[a]) & (np.minimum(n[others], n[a]) * 100 >= np.maximum(n[others], n[a]) * similarity)
            if two_parts:
                apart &= part[others] != part[a]
            others = others[apart]
            others = others[(sig[others] == sig[a]).mean(axis=1) >= LEAST_AGREEMENT]
            for b in others.tolist():
                pair = (int(uid[a]), int(uid[b]))
                if parent[a] == parent[b] or pair in failed:
                    continue
                s, t = shingles(a), shingles(b)
                both = int(np.isin(s, t, assume_unique=True).sum())
                if 100 * both >= similarity * (len(s) + len(t) - both):
                    out.append(pair)
                    parent[parent == parent[b]] = parent[a]
                else:
                    failed.add(pair)
        if len(failed) > 1_000_000:
            failed.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return scan


def _tiles(rows: DataFrame, size: int) -> DataFrame:
    """(band, i, j, uid, part, root): members of a bucket in parts, each pair of parts a tile."""
    parts = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("parts"))
    dealt = rows.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    spread = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    i, j = F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j")
    return spread.select("band", i, j, "uid", "part", "root")


def similar_sets(sets: DataFrame, texts: DataFrame, similarity: int = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(node, root): components of the sets (uid, n, sig) under links of `similarity` percent or more.

    Sets without a link have no row. `texts` has the squeezed text of each uid.
    """
    bands = banded(sets)
    buckets = bands.groupBy("band").agg(F.min("uid").alias("leader"), F.max("uid").alias("last")).where("leader < last")
    members = stored(bands.join(stored(buckets.select("band", "leader"), "buckets"), "band"), "members")
    pairs = members.where("uid > leader").select(F.col("leader").alias("a"), F.col("uid").alias("b")).distinct()
    found = links(stored(pairs, "pairs"), sets, texts, similarity)
    roots = stored(components(found), "roots")
    rooted = members.join(roots, members["uid"] == roots["node"], "left").select(
        "band", "uid", F.coalesce("root", "uid").alias("root"), F.col("uid") == F.col("leader")
    )
    # Pairs of the leader are compared, so only components among the others are in question.
    rooted = rooted.toDF("band", "uid", "root", "leads").where("not leads").drop("leads")
    open_ = rooted.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    rows = stored(rooted.join(stored(open_.select("band"), "open"), "band"), "unresolved")
    needed = stored(rows.select("uid").distinct(), "needed")
    half = sets.select("uid", "n", F.substring("sig", 1, REGISTERS).alias("sig")).join(needed, "uid", "left_semi")
    known = stored(half.join(texts, "uid"), "contents")
    tiled = _tiles(rows, tile).join(known, "uid").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "uid")
    tiled = tiled.select("band", "i", "j", "uid", "part", "root", "n", "sig", "text")
    more = tiled.mapInArrow(_joined(similarity), "a long, b long")
    return stored(components(stored(found.unionByName(more), "linked")), "roots")


def near_duplicates(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of documents.

    Words are bytes other than space and the controls from tab to carriage return, A-Z lower-cased.
    Null, empty and blank texts have no shingle and are linked with nothing, not even each other.
    component_id is the smallest doc_id reachable over links of at least `similarity` percent, null
    where all are null; repeated rows are copies. Equal texts collapse first, so a pair is compared
    once however many rows have it. An empty table gives an empty table.
    """
    rows = stored(signed(documents).withColumn("rid", F.monotonically_increasing_id()), "signed")
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.min("rid").alias("uid"))
    classes = stored(classes, "classes")
    sets = stored(
        rows.select(F.col("rid").alias("uid"), "n", "sig").join(classes.select("uid"), "uid", "left_semi"), "sets"
    )
    roots = similar_sets(sets, rows.select(F.col("rid").alias("uid"), "text"), similarity)
    named = classes.join(roots, classes["uid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "uid"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    answer = stored(named.join(smallest, "root").select("k1", "k2", "component"), "answer")
    return (
        rows.join(answer, ["k1", "k2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def op12_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

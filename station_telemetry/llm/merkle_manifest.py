"""A Merkle manifest of a table: a tree of hashes per language, a tree over these, and proofs.

Rows are hashed where they are read, so texts are never shuffled. The leaves of a language are
ranked in distributed order. The digits of a rank, in base `arity`, are the turns on the path to
its leaf; a block is the leaves that share all but the lowest `levels` digits, and is bounded. One
shuffle brings a block together; then the digits are grouped away one after the other, lowest
first, and each group nests its children's structs in their parent's. The roots of blocks are the
leaves of the next tier, until a tree has one root. Going down again, nested transforms hand every
child its siblings and those above, and an explode gives a row for each leaf: inside a block no
proof needs a join. Between tiers, the blocks' own proofs are joined to the blocks.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import stored
from station_telemetry.operators.ordered import running_sum

ARITY = 2
#: Digits of a block: 2**8 leaves are nested in one row at most.
LEVELS = 8
#: Where this divides the checksum of an id, the self-test tampers with the row.
TAMPERED = 7
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


def _part(value: Column) -> Column:
    """A value with its length, `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**fields: Column) -> Column:
    """Hash of a row: its fields in fixed order, each with its length."""
    return F.sha2(F.concat(*[_part(fields[n]) for n in _FIELDS]), 256)


def leaves(documents: DataFrame, tampered: int = TAMPERED) -> DataFrame:
    """(doc_id, lang, leaf, claimed): hash of each row, and of the row as a tamperer leaves it.

    Where `tampered` divides the CRC-32 of the decimal doc_id, one is added to n_chars; a null
    n_chars stays, and rows without doc_id are left alone.
    """
    own = {n: documents[n] for n in _FIELDS}
    chosen = F.crc32(own["doc_id"].cast("string").cast("binary")) % tampered == 0
    changed = own | {"n_chars": own["n_chars"].cast("long") + 1}
    return documents.select(
        own["doc_id"].alias("doc_id"),
        own["lang"].alias("lang"),
        leaf_hash(**own).alias("leaf"),
        F.when(F.coalesce(chosen, F.lit(False)), leaf_hash(**changed)).alias("changed"),
    ).select("doc_id", "lang", "leaf", F.coalesce("changed", "leaf").alias("claimed"))


def _height(size: Column, arity: int) -> Column:
    """Levels above the leaves of a tree: how often `size` must be divided, rounding up, to be one."""
    powers = [arity**k for k in range(63) if arity**k < 1 << 63]
    return reduce(add, [(size > F.lit(p).cast("long")).cast("int") for p in powers])


def _rolled(rows: DataFrame, payload: list[str], arity: int, levels: int) -> DataFrame:
    """(tree, height, _block, node): a block's nested nodes, from (tree, rank, height, hash, *payload).

    `rank` counts from 0 within a tree and `height` is the number of levels still above its leaves.
    """
    block = F.floor(F.col("rank") / F.lit(arity**levels)).cast("long")
    place = F.col("rank") % F.lit(arity**levels)
    digits = [f"_d{k}" for k in range(levels)]
    node = F.struct(F.col("hash"), *[F.col(p) for p in payload])
    nested = rows.withColumn("_block", block).repartition("tree", "_block").select(
        "tree",
        "height",
        "_block",
        *[(F.floor(place / F.lit(arity**k)) % arity).cast("int").alias(d) for k, d in enumerate(digits)],
        node.alias("node"),
    )
    for k, digit in enumerate(digits):
        keys = ["tree", "height", "_block", *digits[k + 1 :]]
        nested = nested.groupBy(*keys).agg(F.collect_list(F.struct(F.col(digit).alias("digit"), "node")).alias("kids"))
        kids = F.transform(
            F.array_sort("kids", lambda x, y: x["digit"] - y["digit"]), lambda kid: kid["node"]
        )
        nested = nested.select(*keys, kids.alias("kids"))
        one = F.sha2(F.concat_ws("", F.transform("kids", lambda kid: kid["hash"])), 256)
        # Above the top of a tree a node has one child and stays what it is.
        value = F.when(F.col("height") > k, one).otherwise(F.col("kids")[0]["hash"])
        nested = nested.select(*keys, F.struct(value.alias("hash"), "kids").alias("node"))
    return nested


def _unrolled(blocks: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """(tree, proof, ends, hash, *payload): a row for each leaf of (tree, height, node, proof, ends).

    `proof` has a struct for each level from the leaf to the top: the siblings on the left and on
    the right, joined.
    """
    none = F.array().cast(f"array<{_STEP}>")
    found = F.array(F.struct(F.col("node"), none.alias("proof")))

    def down(k: int):
        def one(parent: Column) -> Column:
            kids = parent["node"]["kids"]
            hashes = F.transform(kids, lambda kid: kid["hash"])

            def child(kid: Column, i: Column) -> Column:
                step = F.struct(
                    F.concat_ws("", F.slice(hashes, F.lit(1), i)).alias("left"),
                    F.concat_ws("", F.slice(hashes, i + 2, F.size(hashes))).alias("right"),
                )
                own = F.when(F.col("height") > k, F.concat(F.array(step), parent["proof"])).otherwise(parent["proof"])
                return F.struct(kid.alias("node"), own.alias("proof"))

            return F.transform(kids, child)

        return one

    for k in reversed(range(levels)):
        found = F.flatten(F.transform(found, down(k)))
    rows = blocks.select("tree", "ends", "proof", F.explode(found).alias("_leaf"))
    return rows.select(
        "tree",
        F.concat(F.col("_leaf.proof"), F.col("proof")).alias("proof"),
        "ends",
        F.col("_leaf.node.hash").alias("hash"),
        *[F.col(f"_leaf.node.{p}").alias(p) for p in payload],
    )


def tiers_of(rows: DataFrame, payload: list[str], arity: int = ARITY, levels: int = LEVELS) -> list:
    """Tiers of blocks over rows (tree, rank from 0, height, hash, *payload), with what each carries.

    The roots of a tier's blocks are the next tier's rows, so tiers shrink by `arity**levels`; the
    last has one block for each tree.
    """
    if arity < 2 or levels < 1:
        raise ValueError("blocks need an arity of at least two and at least one level")
    tiers = []
    while True:
        blocks = stored(_rolled(rows, payload, arity, levels), "blocks")
        tiers.append((blocks, payload))
        if blocks.where(F.col("height") > levels).isEmpty():
            return tiers
        height = (F.col("height") - levels).alias("height")
        rows = blocks.select("tree", F.col("_block").alias("rank"), height, F.col("node.hash").alias("hash"))
        payload = ["rank"]


def roots_of(tiers: list) -> DataFrame:
    """(tree, root)."""
    return tiers[-1][0].select("tree", F.col("node.hash").alias("root"))


def proofs_of(tiers: list, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, proof, ends, hash, *payload): a row for each leaf.

    `proof` is the siblings on the way up, from the leaf on, followed by the tree's own in `above`
    (tree, proof, ends), of which `ends` is handed to every leaf.
    """
    last, payload = tiers[-1]
    found = _unrolled(_with_paths(last, above, F.col("tree").eqNullSafe(F.col("_tree"))), payload, levels)
    for blocks, payload in reversed(tiers[:-1]):
        paths = stored(found.select("tree", "proof", "ends", "rank"), "paths")
        same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_block") == F.col("rank"))
        found = _unrolled(_with_paths(blocks, paths, same), payload, levels)
    return found


def _with_paths(blocks: DataFrame, paths: DataFrame, same: Column) -> DataFrame:
    joined = blocks.join(paths.withColumnRenamed("tree", "_tree"), same)
    return joined.select("tree", "height", "node", "proof", "ends")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf's hash and a proof lead to."""
    return F.aggregate(proof, start, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def manifest(documents: DataFrame, arity: int = ARITY, levels: int = LEVELS, tampered: int = TAMPERED) -> DataFrame:
    """(doc_id, lang, leaf, claimed, subroot, root, proof): a row for each row of documents.

    Null values count as `-`; a null lang is a tree of its own, the first. Within a lang, leaves
    ascend by doc_id, null first; rows that share a doc_id ascend by their hash, and equal rows have
    equal hashes, so their order changes no node. A lone leaf is its own subroot. An empty table
    gives an empty table.
    """
    hashed = stored(leaves(documents, tampered).withColumn("one", F.lit(1).cast("long")), "leaves")
    ranked = running_sum(
        hashed,
        ["lang"], ["doc_id", "leaf", "claimed"], "one", into="after", total="size",
    )
    inner = tiers_of(
        ranked.select(
            F.col("lang").alias("tree"),
            (F.col("after") - 1).alias("rank"),
            _height(F.col("size"), arity).alias("height"),
            F.col("leaf").alias("hash"),
            "doc_id",
            "claimed",
        ),
        ["doc_id", "claimed"],
        arity,
        levels,
    )
    # Spark orders strings by their UTF-8 bytes, null first.
    places = running_sum(
        roots_of(inner).withColumn("one", F.lit(1).cast("long")), [], ["tree"], "one", into="after", total="size"
    )
    outer = tiers_of(
        places.select(
            F.lit(0).alias("tree"),
            (F.col("after") - 1).alias("rank"),
            _height(F.col("size"), arity).alias("height"),
            F.col("root").alias("hash"),
            F.col("tree").alias("of"),
        ),
        ["of"],
        arity,
        levels,
    )
    top = roots_of(outer).select("tree", F.array().cast(f"array<{_STEP}>").alias("proof"), F.col("root").alias("ends"))
    above = proofs_of(outer, top, levels).select(
        F.col("of").alias("tree"), "proof", F.struct(F.col("hash").alias("subroot"), F.col("ends").alias("root")).alias("ends")
    )
    return proofs_of(inner, stored(above, "above"), levels).select(
        "doc_id", F.col("tree").alias("lang"), F.col("hash").alias("leaf"), "claimed", "ends.subroot", "ends.root", "proof"
    )


def verified(manifest_rows: DataFrame) -> DataFrame:
    """Adds folded_root, from the claimed leaf and the proof, and verified: whether it is the root."""
    return manifest_rows.withColumn("folded_root", folded(F.col("claimed"), F.col("proof"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    siblings = F.flatten(F.transform("proof", lambda step: F.array(step["left"], step["right"])))
    return verified(manifest(documents)).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"), "folded_root", "verified",
    )

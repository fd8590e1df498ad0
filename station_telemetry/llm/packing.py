"""Best-fit packing of token sequences, in bulk-synchronous rounds.

A round sorts the pieces still unplaced and the gaps of open sequences by size over range
partitions and sweeps them together: each gap, from the smallest, gets the largest piece that fits
and isn't taken. A running count over the sorted rows, up for a piece and down for a gap, turns
that into a match of neighbours: the rows at one height of the count alternate, and a gap that
follows a piece there takes it. That resolves all conflicts by rank in one sweep. A gap much larger
than the largest piece is offered in several slots. Then gaps are updated and the next round
begins; new sequences are opened, as many as the unplaced tokens need, when no gap fits any piece.

A height has at most two rows for each size (all pieces of a size come before its gaps), so a task
gets a bounded number of rows for any one height however many pieces share a length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from station_telemetry.llm.common import stored, with_row
from station_telemetry.llm.tokens import MEMORY_WORDS, WordTokens, tokenizer_path
from station_telemetry.operators.ordered import running_sum
from station_telemetry.session import scratch

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def _cut(path: str, capacity: int, end_id: int, with_ids: bool, memory_words: int):
    def scan(batches):
        for batch in batches:
            tokens = WordTokens.of(path, memory_words)
            rows, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            ids, stops = tokens.encode_column(batch.column("text"))
            ids = np.insert(ids, stops[1:], end_id).astype("<u4")
            stops = (stops + np.arange(len(stops))).tolist()
            for row, (first, last) in enumerate(zip(stops, stops[1:])):
                for k, at in enumerate(range(first, last, capacity)):
                    own = ids[at : min(at + capacity, last)]
                    rows.append(row)
                    out["piece"].append(k)
                    out["start"].append(at - first)
                    out["length"].append(len(own))
                    out["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        out["ids"].append(own.tobytes())
            columns = [batch.column("row").take(pa.array(rows, pa.int32())), pa.array(out["piece"], pa.int32())]
            columns += [pa.array(out[n], pa.int64()) for n in ("start", "length", "ids_crc32")]
            names = ["row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


def token_pieces(
    documents: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    columns: list[str] | None = None,
    memory_words: int = MEMORY_WORDS,
) -> DataFrame:
    """Pieces of at most `capacity` ids: row (the document's columns), piece, start, length, ids_crc32.

    `columns` are those of the document that row carries; `memory_words`
    bounds what a Python worker remembers. A document's ids end with `end_id`, so null and empty texts have one. `with_ids` adds the ids
    as little-endian unsigned 32-bit numbers. Repeated rows give their pieces each. Bytes that are not
    UTF-8 count as the replacement character.
    """
    rows = with_row(documents, columns)
    row = rows.schema["row"].dataType.simpleString()
    schema = f"row {row}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(_cut(path, capacity, end_id, with_ids, memory_words), schema + (", ids binary" if with_ids else ""))


def _matched(items: DataFrame, slots: DataFrame) -> DataFrame:
    """(uid, length, bin): each slot, from the smallest, takes the largest free item that fits."""
    rows = items.select(
        F.col("length").alias("size"), F.lit(0).alias("kind"), F.col("uid").alias("id"), F.lit(0).alias("slot"),
        F.lit(1).alias("step"),
    ).unionByName(
        slots.select(
            "size", F.lit(1).alias("kind"), F.col("bin").alias("id"), "slot", F.lit(-1).alias("step")
        )
    )
    order = ["size", "kind", "id", "slot"]
    swept = running_sum(rows, [], order, "step", into="after", total="all")
    height = F.when(F.col("kind") == 0, F.col("after")).otherwise(F.col("after") + 1)
    level = Window.partitionBy("height").orderBy(*order)
    before = F.lag(F.struct("kind", "id", "size")).over(level)
    return (
        swept.withColumn("height", height)
        .withColumn("before", before)
        .where("kind = 1 and before.kind = 0")
        .select(F.col("before.id").alias("uid"), F.col("before.size").alias("length"), F.col("id").alias("bin"))
    )


def packed(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, bin, offset) for items (uid long, unique; length long, 1 to capacity).

    Items of full capacity get a negative bin of their own. An empty table gives an empty table.
    """
    spark = items.sparkSession
    full = items.where(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    left = stored(items.where(F.col("length") < capacity).select("uid", "length"), "unplaced")
    bins = None
    opened = 0
    rounds: list[DataFrame] = []
    while True:
        n, tokens, least, most = left.agg(
            F.count(F.lit(1)), F.sum("length"), F.min("length"), F.max("length")
        ).first()
        if not n:
            break
        if bins is None or bins.where(F.col("gap") >= least).isEmpty():
            need = -(-tokens // capacity)
            fresh = spark.range(opened, opened + need).select(
                F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap")
            )
            bins, opened = fresh, opened + need
        count = F.greatest(F.lit(1), F.floor(F.col("gap") / F.lit(most))).cast("int")
        slots = (
            bins.where(F.col("gap") >= least)
            .withColumn("count", count)
            .select(
                "bin",
                F.floor(F.col("gap") / F.col("count")).cast("long").alias("size"),
                F.explode(F.sequence(F.lit(1), F.col("count"))).alias("slot"),
            )
        )
        with scratch(spark):
            placed = stored(_matched(left, slots).withColumn("round", F.lit(len(rounds))), "placed")
        rounds.append(placed)
        left = stored(left.join(placed.select("uid"), "uid", "left_anti"), "unplaced")
        taken = placed.groupBy("bin").agg(F.sum("length").alias("taken"))
        bins = stored(
            bins.join(taken, "bin", "left")
            .select("bin", (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap"))
            .where("gap > 0"),
            "gaps",
        )
    if not rounds:
        return full
    placed = rounds[0]
    for more in rounds[1:]:
        placed = placed.unionByName(more)
    inside = Window.partitionBy("bin").orderBy("round", F.desc("length"), "uid")
    offset = F.sum("length").over(inside) - F.col("length")
    return placed.select("uid", "bin", offset.alias("offset")).unionByName(full)


def packed_pieces(
    documents: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    columns: list[str] | None = None,
    memory_words: int = MEMORY_WORDS,
) -> DataFrame:
    """`token_pieces` with sequence_id and offset: their place in sequences of at most `capacity` ids."""
    pieces = token_pieces(documents, path or tokenizer_path(TOKENIZER), capacity, columns=columns, memory_words=memory_words)
    pieces = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    places = packed(pieces.select("uid", "length"), capacity)
    return pieces.join(places, "uid").select(
        "row", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packed_pieces(documents, columns=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), *[F.col(c) for c in found.columns[1:]])

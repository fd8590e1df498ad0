"""Helpers the operators share: stored tables, Arrow batches in bounded pieces, words as numbers."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from station_telemetry.session import new_folder

PIECE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
#: An odd multiplier of 64 bits and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a Parquet table in the shared folder, which goes when the driver ends.

    Cuts the lineage at a durable copy, so a lost executor can't change rows between two readings.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """What the operators expect of a session.

    Arrow batches of few rows, as texts are long and a batch is held whole in a Python worker; and
    Python workers that find this package where the driver runs from a checkout.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def picked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones can't clash with an operator's own names."""
    return df.select(*[df[n] for n in names])


def with_row(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns row (those named, or all) and text: whatever the columns are called, none clashes."""
    kept = [df[c] for c in (df.columns if columns is None else columns)]
    return df.select(F.struct(*kept).alias("row"), df["text"].alias("text"))


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `limit` bytes: first row, row after the last, bytes, row offsets.

    Null counts as empty. A single longer text is a piece of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = bounds[first : last + 1].astype(np.int64)
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.empty(size, np.uint64)
            table[0], have = 1, 1
            while have < size:
                table[have : 2 * have] = table[:have] * np.uint64(pow(base, have, 1 << 64))
                have *= 2
            _POWERS[name] = table
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def sums_before(values: np.ndarray) -> np.ndarray:
    """For `range_hash`: entry i sums the weighted values before i."""
    up, _ = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return total


def range_hash(before: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Equal for equal ranges, wherever they start; of 64 bits."""
    _, down = _powers(len(before))
    return mixed((before[stop] - before[start]) * down[start] + (stop - start).astype(np.uint64))


#: Bytes that end a word: space and the five controls from tab to carriage return.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words, and for every row the number of words before it."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    fresh = np.ones(n + 1, bool)
    fresh[1:n] = ~inside[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh[:n])
    fresh[:n] = ~inside
    fresh[offsets] = True
    stops = np.flatnonzero(inside & fresh[1:]) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return range_hash(sums_before(data), starts, stops)


def text_key() -> "F.Column":
    """Tells texts of rows that share a doc_id apart; null counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.storage import dropped, shared_dir, stored
from foliomill.workers import ship

__all__ = ["dropped", "shared_dir", "stored"]

#: Rows and bytes handed to a Python worker at once; a longer text comes alone.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

#: White space between words, for Java and DuckDB patterns.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep what a Python worker holds at once small, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join with a right side that was aggregated by key, so that Spark can split a hot key's rows.

    The aggregate's partitions would serve the join as they are, and a partition that
    has been aggregated can't be split. A second key, always 0, has both sides dealt anew.
    """
    zero = F.pmod(F.xxhash64(key), F.lit(1)).alias("_zero")
    return left.select("*", zero).join(right.select("*", zero), [key, "_zero"], how).drop("_zero")


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """df, stored, with a number of the row in a column whose name df doesn't have; and that name."""
    at = "_row"
    while at in map(str.lower, df.columns):
        at = f"_{at}"
    return stored(df.withColumn(at, F.monotonically_increasing_id()), "numbered"), at


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


class Interned(dict):
    """Number distinct keys in the order they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Remembered(dict):
    """Cache of fn(key) that holds at most ``most`` keys of at most ``longest`` characters."""

    def __init__(self, fn, most: int = 120_000, longest: int = 48):
        super().__init__()
        self.fn, self.most, self.longest = fn, most, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Offsets of consecutive groups of these sizes, with the end of the last."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def sums(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the flags of each group; starts has the end of the last group too."""
    out = np.zeros(len(starts) - 1, np.int64)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        out[full] = np.add.reduceat(flags, starts[:-1][full], dtype=np.int64)
    return out


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words ``[^\\x20\\x09-\\x0D]+`` of some texts, for each place in the texts which of them is there, and the texts' first places. Null: no words."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat = parts.flatten().dictionary_encode()
    at = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = parts.offsets.to_numpy().astype(np.int64)
    there = np.asarray(pc.binary_length(flat.dictionary), np.int64)[at] > 0  # blanks at a text's ends leave empty strings
    return flat.dictionary, at[there], starts_of(sums(there, starts - starts[0]))


def bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings, and where each starts."""
    at = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = strings.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


def hashes(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit polynomial hash of each string, finalised."""
    data, at = bytes_of(strings)
    size = np.diff(at)
    powers = np.full(int(size.max(initial=0)), 0x9E3779B97F4A7C15, np.uint64)
    powers[:1] = 1
    terms = (data.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers, dtype=np.uint64)[np.arange(len(data)) - np.repeat(at[:-1], size)]
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=upto[1:])
    return mixed(upto[at[1:]] - upto[at[:-1]] + size.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed * 2 + 1))


def pieces(texts: pa.Array, together: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of a batch's texts of about so many bytes, with the number of the first; a longer text comes alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    low = 0
    while low < len(texts):
        high = max(low + 1, low + int(np.searchsorted(np.cumsum(sizes[low : low + 4096]), together, "right")))
        yield low, texts.slice(low, high - low)
        low = high


def word_list(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() cuts at just these six characters."""
    return utf8(text).split()


def word_count(column: Column) -> Column:
    """Number of words of a text column, as a column; null or blank: 0."""
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def word_windows(hashes: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """64-bit hash of each window of ``width`` word hashes."""
    n = len(hashes) - width + 1
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= base
        out += hashes[k : n + k]
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


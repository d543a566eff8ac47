"""Helpers of the training-data operators: tables, staging, size-checked broadcast, fingerprints of byte runs."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import shared_folder

# A side is broadcast only when it was counted and has no more rows than this (some 16 to 32 bytes each).
BROADCAST_ROWS = 500_000
# The same for tables with a text column: the most bytes of all its values together.
BROADCAST_BYTES = 16 << 20
# Bytes of text that one numpy step works on at a time: bounds a worker's memory whatever the batch holds.
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that `store` writes within are removed at the end, but for those stored with `outlive`.

    What is returned from such a block must not read the others any more: store it with `outlive` first.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for folder in _SCOPES.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write `df` as Parquet to the folder all executors share and read it again: cuts lineage, keeps columns prunable."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    level = len(_SCOPES) - 1 - outlive
    if level >= 0:
        _SCOPES[level].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it is counted to be small, else as it is (a shuffled join)."""
    return F.broadcast(stored) if stored.count() <= rows else stored


def looked_up(big: DataFrame, stored: DataFrame, key: str, spread: str, salts: int = 32, wide: str | None = None) -> DataFrame:
    """`big` left-joined with a stored table of unique keys. A key may hold any share of `big`: the table is broadcast
    if it is counted to be small (in bytes of its text column `wide`, if given), else its rows are repeated over `salts`
    and `big` is dealt by key and a hash of `spread`."""
    size = stored.count() if wide is None else stored.agg(F.sum(F.octet_length(wide))).first()[0] or 0
    if size <= (BROADCAST_ROWS if wide is None else BROADCAST_BYTES):
        return big.join(F.broadcast(stored), key, "left")
    dealt = stored.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(dealt, [key, "__salt"], "left").drop("__salt")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo `modulus` (null: crc32 of no bytes)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


# ---------------------------------------------------------------- bytes inside tasks


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in smaller ones, so that what a task holds besides its input stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its values (null: no bytes), without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    size = np.dtype(np.int64 if wide else np.int32)
    bounds = np.frombuffer(offsets, size, len(column) + 1, column.offset * size.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` bytes each; one long text is a range of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial fingerprints (mod 2^64, random byte table) of any run of bytes of a buffer, by differences of prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(0, 2**61)) << 3) | 5
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, CHUNK_BYTES + 1)
            steps = np.full(n, self.base, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.inverses = np.multiply.accumulate(steps)

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.bytes[buf] * self.powers[: len(buf)], out=out[1:])
        return out

    def prefix_of(self, values: np.ndarray) -> np.ndarray:
        """As `prefix`, of 64-bit values (such as fingerprints of words) instead of bytes."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the runs [start, end)."""
        self._grow(len(prefix))
        return mix((prefix[end] - prefix[start]) * self.inverses[start])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Fingerprints of all runs of `width` bytes."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        self._grow(len(prefix))
        return mix((prefix[width:] - prefix[:n]) * self.inverses[:n])


# Bytes of white space that end a word: space and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, bounds: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the words (runs without `blank` bytes) of the rows that `bounds` cuts from `buf` (bounds[0] is 0)."""
    inside = ~blank[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(buf)]
    before[cuts] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(bounds, start, "right") - 1
    return start, end, row

"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into 2^16 cells. Every shard has `virtual` nodes on it, at cells that hash the shard's
number; a row's cell hashes its id, size and checksum. A row goes to the shard of the next node
clockwise; if that shard is full, on to the next node of a shard that is not. Shards hold at most their
share: n / shards rows, rounded up for as many shards as the remainder says, so counts differ by one at
most, and a change moves only the rows of cells whose walk meets the change.

Which rows overflow depends on counts only: rows of a cell are ranked by (ring position, key), the
walk over the cells' counts (2^16 numbers, whatever the size of the table) says how many of a cell's
rows each shard takes. Equal rows share a position; they are counted before they are dealt out and
expanded at the end, so a row that occurs very often is one row in the shuffle.

Defined results: a null text has size 1 and checksum 0; null ids are hashed as null; repeated rows are
placed as often as they occur; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import mix, small_side, store, text_or_empty

CELLS = 1 << 16


def ring(shards: int, virtual: int) -> np.ndarray:
    """The shard of the next virtual node clockwise, for every cell."""
    nodes = np.arange(shards * virtual, dtype=np.uint64)
    at = (mix(nodes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(17)) >> np.uint64(48)).astype(np.int64)
    owner = np.full(CELLS, -1, np.int64)
    owner[at[::-1]] = (np.arange(shards * virtual) // virtual)[::-1]  # two nodes in a cell: the lower shard
    taken = np.flatnonzero(owner >= 0)
    return owner[taken[np.searchsorted(taken, np.arange(CELLS)) % len(taken)]]


def walk(counts: np.ndarray, owners: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, shard, first rank, last rank + 1, first slot): which shard takes which ranks of each cell's rows.

    Once round the ring, and once more for what is left at its end: a cell's rows go to its shard as far as that has
    room, after the rows still waiting from the cells before it; what is left over goes on clockwise.
    """
    total = int(counts.sum())
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    filled = np.zeros(shards, np.int64)
    out, waiting = [], []

    def take(cell: int, first: int, last: int, shard: int) -> int:
        n = min(last - first, int(room[shard] - filled[shard]))
        if n > 0:
            out.append((cell, shard, first, first + n, int(filled[shard])))
            filled[shard] += n
        return first + n

    for lap in range(2):
        for cell in range(len(counts) if total else 0):
            shard = int(owners[cell])
            if filled[shard] < room[shard]:
                while waiting and filled[shard] < room[shard]:
                    c, first, last = waiting.pop(0)
                    first = take(c, first, last, shard)
                    if first < last:
                        waiting.insert(0, (c, first, last))
            if lap == 0 and counts[cell]:
                first = take(cell, 0, int(counts[cell]), shard)
                if first < counts[cell]:
                    waiting.append((cell, first, int(counts[cell])))
        if not waiting:
            break
    return out


def shard_rows(docs: DataFrame, shards: int = 16, virtual: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: a row for every row of `docs`; law `rows`."""
    keyed = docs.select(
        "doc_id", (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"), F.crc32(text_or_empty()).alias("text_crc32")
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    position = F.xxhash64("doc_id", "size", "text_crc32")
    rows = store(keyed.withColumn("at", position).withColumn("cell", F.shiftrightunsigned("at", 48).cast("int")))
    counts = np.zeros(CELLS, np.int64)
    for cell, n in rows.groupBy("cell").agg(F.sum("n")).collect():  # at most 2^16 numbers
        counts[cell] = n
    spark = docs.sparkSession
    taken = spark.createDataFrame(walk(counts, ring(shards, virtual), shards), "cell int, shard int, first long, last long, slot long")
    before = W.partitionBy("cell").orderBy("at", "doc_id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = rows.withColumn("upto", F.sum("n").over(before)).withColumn("from", F.col("upto") - F.col("n"))
    meets = (ranked["cell"] == taken["cell"]) & (F.col("first") < F.col("upto")) & (F.col("last") > F.col("from"))
    placed = ranked.join(small_side(taken), meets).withColumn(
        "rank", F.explode(F.sequence(F.greatest("from", "first"), F.least("upto", "last") - 1))
    )
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"))

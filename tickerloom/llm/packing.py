"""Best-fit packing of documents into bins of `capacity` tokens, with conflicts.

A bin carries two bitmaps: the duplicate clusters it holds (a document of a cluster that is already in
the bin may not enter) and the sources that have used up their share of the bin. Open bins are kept in
the order of their residual; for each piece, largest first, the search starts at the smallest residual
that is large enough and goes on to the next larger one until a bin is compatible: the tightest
compatible bin. Bitmaps are hashed to `bits` bits, so a clash can only forbid, never allow.

A document longer than a bin is cut into pieces of `capacity` tokens (none is dropped); pieces of one
document are of one cluster and so never share a bin. Documents are dealt to packing groups of about
`group_rows` rows by a hash of their place in a stored table, never by source or cluster: a source or a group of
copies with a third of all rows is spread evenly, and the number of groups grows with the table. A task
packs one group; each group leaves at most a few bins part empty.

Defined results: a null or empty text has no tokens and gets one piece of 0 tokens; null sources share
one bit; repeated rows are packed as often as they occur (never into one bin); an empty table gives none.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import store, text_or_empty

# A source may fill this share of a bin; a single piece may fill more.
SOURCE_SHARE = 0.5


def best_fit(
    tokens: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int, source_share: float = SOURCE_SHARE, bits: int = 256,
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place within the bin) of pieces in the given order; `source` and `cluster` are hashes."""
    free: list[tuple[int, int]] = []  # (residual, bin), ascending
    clusters: list[int] = []
    closed: list[int] = []
    used: list[dict[int, int]] = []
    filled: list[int] = []
    quota = max(1, int(capacity * source_share))
    where, place = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    for i, (need, s, c) in enumerate(zip(tokens.tolist(), (source % bits).tolist(), (cluster % bits).tolist())):
        c_bit, s_bit = 1 << c, 1 << s
        at = bisect.bisect_left(free, (need, -1))
        while at < len(free):
            b = free[at][1]
            if not clusters[b] & c_bit and not closed[b] & s_bit:
                break
            at += 1
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b = capacity, len(clusters)
            clusters.append(0)
            closed.append(0)
            used.append({})
            filled.append(0)
        clusters[b] |= c_bit
        used[b][s] = used[b].get(s, 0) + need
        if used[b][s] >= quota:
            closed[b] |= s_bit
        where[i], place[i] = b, filled[b]
        filled[b] += 1
        if left > need:
            bisect.insort(free, (left - need, b))
    return where, place


def pack(docs: DataFrame, capacity: int = 4096, group_rows: int = 20_000, cluster: str | None = None) -> DataFrame:
    """doc_id, piece, n_tokens, source, bin_id (string), place: a row for each piece of each row of `docs`.

    `cluster` names a column with the duplicate cluster; by default rows with the same words are one cluster.
    Only ids, counts and hashes are shuffled.
    """
    words = F.regexp_count(text_or_empty(), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    same = F.xxhash64(F.col(cluster)) if cluster else F.xxhash64(F.regexp_replace(F.trim(F.lower(text_or_empty())), "[\\x20\\x09-\\x0D]+", " "))
    items = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("words"),
            same.alias("cluster"), F.xxhash64("source").alias("source_key"), F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = max(1, math.ceil(items.count() / group_rows))
    full = F.ceil(F.col("words") / capacity)
    pieces = (
        items.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(full.cast("int") - 1, F.lit(0)))))
        .withColumn("n_tokens", F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity))
        .withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "doc_id", "piece", "cluster"], ascending=[False, True, True, True], kind="stable")
        unsigned = lambda c: group[c].to_numpy().view(np.uint64)
        where, place = best_fit(group["n_tokens"].to_numpy(), unsigned("source_key"), unsigned("cluster"), capacity)
        out = group[["doc_id", "piece", "n_tokens", "source"]].copy()
        out["bin_id"] = [f"{group['grp'].iloc[0]}-{b}" for b in where]
        out["place"] = place
        return out

    return pieces.drop("words", "row").groupBy("grp").applyInPandas(
        run, "doc_id long, piece int, n_tokens long, source string, bin_id string, place long"
    )

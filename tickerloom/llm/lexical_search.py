"""Ranked lexical search over bit-sliced Bloom signatures, with exact rescoring of all documents not excluded.

1. **Index.** A document's signature holds, for each of its terms, one entry per tier that its frequency
   reaches (tiers start at 1, 2, 3, 4, 6, 8, 12, 16, ...). Documents with signatures of one width form a block,
   stored as slices: row b is a bitmap of the block's documents whose bit b is set. The signature has 8 to 16 bits
   an entry and 4 hashes. Beside the blocks each task leaves the document frequencies it has seen.
2. **Bounds.** The slices of a term's bits, combined by AND, mark every document that has it at that tier (and a few that
   have not). Weighted sums of these bitmaps, scaled by the most a tier can give in a document of that length, bound
   the score from above. They are sums of integers below 2^24 (else of doubles below 2^53), hence exact.
3. **Threshold.** Each task names the documents with the highest bounds of every item; the best of all are scored
   from their texts. The k-th best exact score is a proven floor.
4. **Answer.** Every document whose bound is at least the floor is scored from its whole text. What is left out has a
   bound below the floor, so nothing is lost. Of exact copies within a block only the k smallest ids are named: copies
   score alike, and others cannot be among the first k.

Items are taken in chunks of about `CHUNK_TERMS` terms, whose arrays are the only thing sent to all tasks;
documents, blocks and candidates stay distributed. A block's arrays are bounded by its number of entries.

Defined results: documents without a term (null, empty, only punctuation) count nowhere; an item without a
known term has no rows; every row of `docs` is a document of its own, also with a repeated or null doc_id (null last
among equal scores); repeated items are answered each; empty tables give none; further columns are not read.
Terms are compared by 64-bit fingerprints.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import LOWER, Rolling, chunks, mix, small_batches, small_side, store, utf8, word_spans

ROLL = Rolling(12)
STEP = np.uint64(0x9E3779B97F4A7C15)
HASHES = 4
BITS = 8  # at least, per entry
BLOCK_ENTRIES = 1 << 17
BLOCK_DOCS = 1024
SEEN_TERMS = 1 << 20  # document frequencies a task holds before it writes them out
CHUNK_TERMS = 1 << 14  # terms of the items that are searched in one go
GROUP_CELLS = 1 << 22  # items times terms of one matrix
SLAB = 4096  # terms whose bitmaps are unpacked at a time
# Bytes outside the terms.
GAP = np.zeros(256, bool)
GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
# The frequency at which each tier starts: 1, 2, 3, 4, 6, 8, 12, 16, ...
TIERS = np.array(sorted({1, *(1 << i for i in range(1, 41)), *(3 << i for i in range(0, 40))}), np.int64)


class Index(NamedTuple):
    blocks: DataFrame  # width, slices, tiers, ids, tkeys, lengths
    seen: DataFrame  # terms, counts: document frequencies, in parts
    documents: int
    terms: int


def term_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct terms (sorted fingerprints) of every value of a string column, and how often each occurs."""
    data, bounds = utf8(column)
    for first, last in chunks(bounds):
        cut = bounds[first : last + 1]
        buf = LOWER[data[cut[0] : cut[-1]]]
        start, end, row = word_spans(buf, cut - cut[0], GAP)
        found = ROLL.runs(ROLL.prefix(buf), start, end)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=last - first))])
        for i in range(last - first):
            yield np.unique(found[ends[i] : ends[i + 1]], return_counts=True)


def tier_entries(terms: np.ndarray, tier: int) -> np.ndarray:
    return mix(terms + np.full(1, tier, np.uint64) * STEP)


def slots(entries: np.ndarray, width: int) -> list[np.ndarray]:
    """The bits of the entries in signatures of `width` bits."""
    low, high = entries & np.uint64(0xFFFFFFFF), entries >> np.uint64(32) | np.uint64(1)
    return [((low + np.uint64(i) * high) & np.uint64(width - 1)).astype(np.int64) for i in range(HASHES)]


class _Block:
    """Documents of one signature width, on their way into slices."""

    def __init__(self, width: int, most: int):
        self.width, self.most, self.size, self.entries, self.rows, self.tiers = width, most, 0, [], [], 0

    def add(self, entries: np.ndarray, tiers: int, row: tuple) -> None:
        self.entries.append(entries)
        self.rows.append(row)
        self.size += len(entries)
        self.tiers = max(self.tiers, tiers)

    def full(self) -> bool:
        return self.size >= self.most or len(self.rows) >= BLOCK_DOCS

    def record(self) -> dict:
        n = len(self.rows)
        wide = (n + 7) // 8
        slices = np.zeros(self.width * wide, np.uint8)
        doc = np.repeat(np.arange(n), [len(e) for e in self.entries])
        entries = np.concatenate(self.entries)
        for at in slots(entries, self.width):
            np.bitwise_or.at(slices, at * wide + doc // 8, (1 << (doc % 8)).astype(np.uint8))
        ids, tkeys, lengths = zip(*self.rows)
        return {"width": self.width, "slices": slices.tobytes(), "tiers": self.tiers, "ids": ids, "tkeys": tkeys, "lengths": lengths}


BLOCK_SCHEMA = "width long, slices binary, tiers int, ids array<long>, tkeys array<long>, lengths array<long>, terms array<long>, counts array<long>"


def _rows_of(records: list[dict]) -> pa.RecordBatch:
    long = pa.int64()
    types = [
        ("width", long), ("slices", pa.binary()), ("tiers", pa.int32()), ("ids", pa.list_(long)), ("tkeys", pa.list_(long)),
        ("lengths", pa.list_(long)), ("terms", pa.list_(long)), ("counts", pa.list_(long)),
    ]
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in records], kind) for name, kind in types], [name for name, _ in types])


class _Seen:
    """Document frequencies of the terms of a task."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, terms: np.ndarray) -> None:
        self.parts.append((terms, np.ones(len(terms), np.int64)))
        self.size += len(terms)

    def shrink(self) -> int:
        terms, at = np.unique(np.concatenate([t for t, _ in self.parts]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([c for _, c in self.parts]), minlength=len(terms)).astype(np.int64)
        self.parts, self.size = [(terms, counts)], len(terms)
        return self.size

    def record(self) -> dict:
        self.shrink()
        terms, counts = self.parts[0]
        return {"terms": terms.view(np.int64), "counts": counts}


def build(docs: DataFrame, block_entries: int = BLOCK_ENTRIES, seen_terms: int = SEEN_TERMS) -> Index:
    """The index of all rows of `docs` (doc_id, text), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, _Block] = {}
        seen = _Seen()
        for batch in small_batches(batches):
            ids, tkeys = batch.column("doc_id").to_pylist(), batch.column("tkey").to_pylist()
            for i, (terms, tf) in enumerate(term_counts(batch.column("text"))):
                if not len(terms):
                    continue
                seen.add(terms)
                top = int(np.searchsorted(TIERS, tf.max(), "right"))
                entries = np.concatenate([tier_entries(terms[tf >= TIERS[j]], j) for j in range(top)])
                width = 1 << max(8, math.ceil(math.log2(BITS * len(entries))))
                block = open_.setdefault(width, _Block(width, block_entries))
                block.add(entries, top, (ids[i], tkeys[i], int(tf.sum())))
                if block.full():
                    yield _rows_of([open_.pop(width).record()])
            if seen.size >= 2 * seen_terms and seen.shrink() >= seen_terms:
                yield _rows_of([seen.record()])
                seen = _Seen()
        for block in open_.values():
            yield _rows_of([block.record()])
        if seen.size:
            yield _rows_of([seen.record()])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
    made = store(source.mapInArrow(run, BLOCK_SCHEMA))
    blocks = made.where("width is not null").drop("terms", "counts")
    total = blocks.select(F.size("ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("l")).agg(F.sum("n"), F.sum("l")).first()
    return Index(blocks, made.where("width is null").select("terms", "counts"), total[0] or 0, total[1] or 0)


class _Group(NamedTuple):
    """Some items of a chunk: their numbers, distinct terms and, as a matrix, weight times repeats."""

    items: np.ndarray
    terms: np.ndarray
    matrix: np.ndarray


class _Chunk:
    """The items that are searched in one go."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], frequency: dict[int, int], documents: int, total: int, cells: int, slab: int):
        self.documents, self.total, self.cells, self.slab = documents, total, cells, slab
        weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for t, df in frequency.items()}
        self.terms = np.sort(np.array(list(weight), np.int64).view(np.uint64))
        weights = np.array([weight[t] for t in self.terms.view(np.int64).tolist()], np.int64)
        self.items: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for number, terms, repeats in items:
            at = np.searchsorted(self.terms, terms)
            known = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == terms) if len(self.terms) else np.zeros(0, np.int64)
            if len(known):
                self.items[number] = (at[known], weights[at[known]] * repeats[known])
        self.groups = self._groups()

    def _groups(self) -> list[_Group]:
        out, some, used = [], [], set()

        def close() -> None:
            at = np.array(sorted(used), np.int64)
            exact = sum(int(self.items[n][1].sum()) for n in some) < 1 << 24
            matrix = np.zeros((len(some), len(at)), np.float32 if exact else np.float64)
            for i, number in enumerate(some):
                places, values = self.items[number]
                matrix[i, np.searchsorted(at, places)] = values
            out.append(_Group(np.array(some, np.int64), self.terms[at], matrix))

        for number, (places, _) in self.items.items():
            more = used | set(places.tolist())
            if some and (len(some) + 1) * len(more) > self.cells:
                close()
                some, more = [], set(places.tolist())
            some, used = [*some, number], more
        if some:
            close()
        return out

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 75 + (75 * lengths * self.documents) // self.total

    def bounds(self, block: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per group: the numbers of its items, and upper bounds (items by documents) of their scores."""
        n = len(block["lengths"])
        slices = np.frombuffer(block["slices"], np.uint8).reshape(block["width"], -1)
        m = self.damping(block["lengths"])
        caps = TIERS[1 : block["tiers"] + 1] - 1
        most = np.array([(1_000_000_000 * c) // (1000 * c + 8 * m) for c in caps])
        gain = np.diff(most, axis=0, prepend=0)
        for group in self.groups:
            out = np.zeros((len(group.items), n), np.int64)
            for a in range(0, len(group.terms), self.slab):
                at = np.arange(a, min(a + self.slab, len(group.terms)))
                held = None
                for tier in range(block["tiers"]):
                    bits = np.bitwise_and.reduce([slices[s] for s in slots(tier_entries(group.terms[at], tier), block["width"])])
                    if held is not None:  # who lacks a lower tier cannot have this one
                        bits &= held
                    some = bits.any(axis=1)
                    if not some.any():
                        break
                    at, held = at[some], bits[some]
                    marks = np.unpackbits(held, axis=1, count=n, bitorder="little").astype(group.matrix.dtype)
                    out += (group.matrix[:, at] @ marks).astype(np.int64) * gain[tier]
            yield group.items, out

    def score(self, number: int, places: np.ndarray, part: np.ndarray) -> int:
        """The score of an item in a document that has the chunk's terms at `places`, worth `part` each."""
        at, weight = self.items[number]
        where = np.minimum(np.searchsorted(places, at), len(places) - 1)
        both = places[where] == at
        return int((weight[both] * part[where[both]]).sum())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in small_batches(batches, 1):
        row = {c: batch.column(c)[0] for c in ("width", "tiers", "slices", "ids", "tkeys", "lengths")}
        yield {
            "width": row["width"].as_py(), "tiers": row["tiers"].as_py(), "slices": row["slices"].as_buffer(), "ids": row["ids"].values,
            "tkeys": row["tkeys"].values.to_numpy(), "lengths": row["lengths"].values.to_numpy(),
        }


def _named(item: np.ndarray, bound: np.ndarray, place: np.ndarray, block: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int64()), pa.array(bound, pa.int64()), block["ids"].take(pa.array(place)), pa.array(block["tkeys"][place], pa.int64())],
        ["item", "bound", "doc_id", "tkey"],
    )


NAMED = "item long, bound long, doc_id long, tkey long"


def highest_bounds(blocks: DataFrame, shared, most: int) -> DataFrame:
    """item, bound, doc_id, tkey: the documents with the `most` highest bounds of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: _Chunk = shared.value
        best: dict[int, list[tuple[int, int | None, int]]] = defaultdict(list)
        for block in _blocks(batches):
            ids = None
            for items, bounds in chunk.bounds(block):
                for i, number in enumerate(items.tolist()):
                    mine = best[number]
                    least = mine[-1][0] if len(mine) == most else 0
                    place = np.flatnonzero(bounds[i] > least)
                    if not len(place):
                        continue
                    if len(place) > most:
                        place = place[np.argpartition(-bounds[i][place], most)[:most]]
                    ids = block["ids"].to_pylist() if ids is None else ids
                    mine += [(int(bounds[i][p]), ids[p], int(block["tkeys"][p])) for p in place]
                    mine.sort(key=lambda r: -r[0])
                    del mine[most:]
        flat = [(number, *r) for number, mine in best.items() for r in mine]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(4)], ["item", "bound", "doc_id", "tkey"])

    named = blocks.mapInArrow(run, NAMED)
    order = Window.partitionBy("item").orderBy(F.desc("bound"))
    return named.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")


def not_excluded(blocks: DataFrame, shared, floors, k: int) -> DataFrame:
    """item, bound, doc_id, tkey: every document whose bound is at least the item's floor (of copies in a block the k smallest ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: _Chunk = shared.value
        floor = floors.value
        for block in _blocks(batches):
            order = None
            for items, bounds in chunk.bounds(block):
                least = np.array([max(1, floor.get(n, 1)) for n in items.tolist()], np.int64)
                i, place = np.nonzero(bounds >= least[:, None])
                if not len(i):
                    continue
                if order is None:
                    ids = block["ids"].fill_null(np.iinfo(np.int64).max).to_numpy()
                    by = np.lexsort((block["ids"].is_null().to_numpy(zero_copy_only=False), ids, block["tkeys"]))
                    order = np.empty(len(by), np.int64)
                    order[by] = np.arange(len(by))
                inner = np.lexsort((order[place], i))
                i, place = i[inner], place[inner]
                new = np.ones(len(i), bool)
                new[1:] = (i[1:] != i[:-1]) | (block["tkeys"][place[1:]] != block["tkeys"][place[:-1]])
                nth = np.arange(len(i)) - np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))
                i, place = i[nth < k], place[nth < k]
                yield _named(items[i], bounds[i, place], place, block)

    return blocks.mapInArrow(run, NAMED)


def exact_scores(docs: DataFrame, named: DataFrame, shared) -> DataFrame:
    """item, doc_id, score of the named documents, from their whole texts; a row for every row of `docs` that is meant."""
    wanted = store(named.groupBy(F.col("doc_id").alias("want_id"), F.col("tkey").alias("want_key")).agg(F.collect_set("item").alias("items")))
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
        .join(small_side(wanted), F.col("tkey").eqNullSafe(F.col("want_key")) & F.col("doc_id").eqNullSafe(F.col("want_id"))).select("doc_id", "items", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: _Chunk = shared.value
        for batch in small_batches(batches):
            ids, items = batch.column("doc_id").to_pylist(), batch.column("items").to_pylist()
            out = []
            for i, (terms, tf) in enumerate(term_counts(batch.column("text"))):
                at = np.searchsorted(chunk.terms, terms)
                known = chunk.terms[np.minimum(at, len(chunk.terms) - 1)] == terms
                if not known.any():
                    continue
                m = int(chunk.damping(np.array([tf.sum()], np.int64))[0])
                part = (1_000_000_000 * tf[known]) // (1000 * tf[known] + 8 * m)
                out += [(n, ids[i], chunk.score(n, at[known], part)) for n in items[i]]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], ["item", "doc_id", "score"])

    return texts.mapInArrow(run, "item long, doc_id long, score long").where("score > 0")


def items_of(items: DataFrame) -> DataFrame:
    """item, item_id, terms, repeats: the items with a number each, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = list(term_counts(batch.column("text")))
            lists = [pa.array([f[i].view(np.int64) for f in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), *lists], ["item", "item_id", "terms", "repeats"])

    kind = items.schema["item_id"].dataType.simpleString()
    source = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return store(source.mapInArrow(run, f"item long, item_id {kind}, terms array<long>, repeats array<long>"))


def ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_chunk(docs: DataFrame, index: Index, items: DataFrame, k: int, most: int, cells: int, slab: int) -> DataFrame:
    """item, rank, doc_id, score for the items of one chunk (item, terms, repeats), which are few enough to be sent to all tasks."""
    context = docs.sparkSession.sparkContext
    asked = items.select(F.explode("terms").alias("term")).distinct()
    counted = (
        index.seen.select(F.explode(F.arrays_zip("terms", "counts")).alias("s")).select(F.col("s.terms").alias("term"), F.col("s.counts").alias("n"))
        .join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("n").alias("df"))
    )
    frequency = {r["term"]: r["df"] for r in counted.collect()}
    own = [(r["item"], np.array(r["terms"], np.int64).view(np.uint64), np.array(r["repeats"], np.int64)) for r in items.select("item", "terms", "repeats").collect()]
    shared = context.broadcast(_Chunk(own, frequency, index.documents, index.terms, cells, slab))
    first = exact_scores(docs, highest_bounds(index.blocks, shared, most), shared)
    floors = context.broadcast({r["item"]: r["score"] for r in ranked(first, k).where(F.col("rank") == k).collect()})
    return ranked(exact_scores(docs, not_excluded(index.blocks, shared, floors, k), shared), k)


def search(
    docs: DataFrame, index: Index, items: DataFrame, k: int = 10, most: int = 20, chunk_terms: int = CHUNK_TERMS, cells: int = GROUP_CELLS, slab: int = SLAB
) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item."""
    numbered = items_of(items)
    total = numbered.agg(F.sum(F.size("terms"))).first()[0] or 0
    chunks_ = max(1, -(-total // chunk_terms))
    of_chunk = F.pmod(F.xxhash64("item"), F.lit(chunks_))
    found = None
    for c in range(chunks_ if index.documents else 0):
        part = search_chunk(docs, index, numbered.where(of_chunk == c), k, most, cells, slab)
        part = store(part) if chunks_ > 1 else part
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long, rank int")
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as ts from documents),
q as (select row_number() over () as i, item_id, {_TERMS} as ts from benchmark),
tf as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d) group by all),
s as (select count(*) as n_docs, sum(len(ts)) as n_terms from d where len(ts) > 0),
df as (select term, count(*) as df from tf group by term),
m as (select r, doc_id, 25 + ((75 * len(ts) * n_docs) // n_terms)::bigint as m from d, s where len(ts) > 0),
w as (
  select i, item_id, term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)))::bigint * count(*) as w
  from (select i, item_id, unnest(ts) as term from q) join df using (term), s group by i, item_id, term, df, n_docs
),
p as (
  select i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from w join tf using (term) join m using (r) group by all having score > 0
),
o as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from p)
select item_id, rank::int as rank, doc_id, score from o where rank <= 10
"""

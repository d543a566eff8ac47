"""Suffix-array dedup: repeated strings of `width` bytes, by cover samples and one bucket of suffixes at a time.

Two suffixes count as tied when their first `width` bytes agree, so only that much of the suffix
order is built, and only where a tie is possible. The difference cover is content-synchronised: the
cover sample of the suffix at i is the position of the smallest gram fingerprint among the next
`spread` + 1 positions. As with a fixed difference cover, two tied suffixes have their samples at the
same distance, so a tie between suffixes is decided by a tie between samples plus the few bytes
around; unlike with a fixed one, only 2 / (spread + 2) of all positions are samples, and an insertion
does not shift them.

1. **Prefilter.** Sparse samples (one in some 170 bytes) of every text; a suffix can be tied only if
   its sparse sample's gram occurs twice. Counts are pre-aggregated minima and maxima.
2. **Cover ranks.** For the suffixes left over, dense samples. A sample's rank is the class of the
   `width - spread` bytes after it (contained in every suffix that it stands for); its block is the
   union of those suffixes. Ranks and blocks are counted over the corpus. Rank unique: no tie. Block
   as frequent as the rank: all its suffixes are tied in all places, nothing is left to sort.
3. **Buckets.** The other suffixes (ends of repeats, some tens a repeat; repeats of equal blocks send
   one witness) are put into the bucket of their key and compared by fingerprints of `width` bytes.
   A task holds one bucket of keys at a time, never a whole text's suffixes.

A passage that a third of all texts share is a hot key in none of the shuffles: counts are combined
before they are dealt out, and joins back have one row for each key on the other side.

The unit is the byte, or with `words` the word (a run without white space, by its fingerprint): then `width`,
samples and runs count words, a repeat is `width` equal words in a row whatever their lengths and the white
space between them, and what is cut out are whole words.

Defined results: null is an empty text; texts shorter than `width` lose nothing; of repeated rows each
is another place of all its strings, so both go; an empty table gives none. Equality is that of 64-bit
fingerprints. `dedup_texts` decodes what is kept and drops bytes of characters that were cut through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import Rolling, chunks, mix, scratch, small_batches, small_side, store, text_or_empty, utf8, word_spans

ROLL = Rolling(4)
POSITION = np.uint64((1 << 24) - 1)


class Rule(NamedTuple):
    """Length of a repeat and of the samples' grams, in units (bytes or words)."""

    width: int
    spread: int
    gram: int
    sparse_gram: int
    words: bool


def rule_of(width: int, words: bool) -> Rule:
    found = Rule(width, 11, 5, 16, True) if words else Rule(width, 47, 24, 64, False)
    if width < max(found.sparse_gram, found.spread + found.gram):
        raise ValueError(f"width {width} is shorter than the samples' grams")
    return found


def unit_prefix(data: np.ndarray, cut: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the units of the rows that `cut` cuts from `data`, and the rows' bounds in units."""
    raw, base = data[cut[0] : cut[-1]], cut - cut[0]
    prefix = ROLL.prefix(raw)
    if not words:
        return prefix, base
    start, end, row = word_spans(raw, base)
    counts = np.bincount(row, minlength=len(base) - 1)
    return ROLL.prefix_of(ROLL.runs(prefix, start, end)), np.concatenate([[0], np.cumsum(counts)])


def cover(prefix: np.ndarray, gram: int, span: int, most: int = 1 << 24) -> np.ndarray:
    """For every i the position of the leftmost smallest gram fingerprint in [i, i + span); `most` positions at a time."""
    h = ROLL.windows(prefix, gram)
    if len(h) < span:
        return np.zeros(0, np.int64)
    if len(h) >= most:  # one very long text: in overlapping parts
        step, parts = most - span, []
        for a in range(0, len(h) - span + 1, step):
            parts.append(_smallest(h[a : a + most - 1], span)[:step] + a)
        return np.concatenate(parts)[: len(h) - span + 1]
    return _smallest(h, span)


def _smallest(h: np.ndarray, span: int) -> np.ndarray:
    low = (h & ~POSITION) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = span - reach
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    return (low & POSITION).astype(np.int64)


def valid_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes with `width` bytes left in their text, and the row of each."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][row]
    return start, row


def _lists(row: np.ndarray, rows: int, *values: np.ndarray) -> list[pa.Array]:
    """Values sorted by row as one list per row."""
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, pa.array(v.view(np.int64) if v.dtype == np.uint64 else v)) for v in values]


def _joined(parts: list[list[np.ndarray]], n: int) -> list[np.ndarray]:
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(n)]


def sparse_samples(texts: DataFrame, rule: Rule) -> DataFrame:
    """tid, at, gram: the sparse samples of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            parts = []
            for first, last in chunks(bounds):
                cut = bounds[first : last + 1]
                prefix, base = unit_prefix(data, cut, rule.words)
                start, row = valid_starts(base, rule.width)
                if not len(start):
                    continue
                at = cover(prefix, rule.sparse_gram, rule.width - rule.sparse_gram + 1)[start]
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
                at, row = at[new], row[new]
                parts.append([row + first, at - base[row], ROLL.runs(prefix, at, at + rule.sparse_gram)])
            row, at, gram = _joined(parts, 3)
            yield pa.RecordBatch.from_arrays([batch.column("tid"), *_lists(row, batch.num_rows, at.astype(np.int64), gram)], ["tid", "at", "gram"])

    return texts.mapInArrow(run, "tid long, at array<long>, gram array<long>")


def cover_blocks(texts: DataFrame, rule: Rule) -> DataFrame:
    """tid, text and, for every run of possible suffixes with one cover sample: lo, hi (first and last suffix), rank, block.

    `texts` has tid, text and `known`: the sparse samples whose gram is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            known = batch.column("known")
            known_at, known_row = known.flatten().to_numpy(), np.repeat(np.arange(len(known)), known.value_lengths().to_numpy())
            parts = []
            for first, last in chunks(bounds):
                cut = bounds[first : last + 1]
                prefix, base = unit_prefix(data, cut, rule.words)
                start, row = valid_starts(base, rule.width)
                if not len(start):
                    continue
                mine = (known_row >= first) & (known_row < last)
                repeated = np.zeros(len(prefix), bool)
                repeated[base[known_row[mine] - first] + known_at[mine]] = True
                open_ = repeated[cover(prefix, rule.sparse_gram, rule.width - rule.sparse_gram + 1)[start]]
                start, row = start[open_], row[open_]
                if not len(start):
                    continue
                at = cover(prefix, rule.gram, rule.spread + 1)[start]
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1) | (row[1:] != row[:-1])
                lo, at, row = start[new], at[new], row[new]
                hi = start[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]
                rank = ROLL.runs(prefix, at, at + rule.width - rule.spread)
                shape = ((at - lo) * 4096 + (hi - lo)).astype(np.uint64)
                block = mix(ROLL.runs(prefix, lo, hi + rule.width) ^ mix(shape + np.uint64(1)))
                parts.append([row + first, lo - base[row], hi - base[row], rank, block])
            row, lo, hi, rank, block = _joined(parts, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), batch.column("text"), *_lists(row, batch.num_rows, lo.astype(np.int64), hi.astype(np.int64), rank, block)],
                ["tid", "text", "lo", "hi", "rank", "block"],
            )

    return texts.mapInArrow(run, "tid long, text string, lo array<long>, hi array<long>, rank array<long>, block array<long>")


def open_suffixes(blocks: DataFrame, rule: Rule) -> DataFrame:
    """tid, from, to (runs of units that are known to be repeated), at, key (suffixes still to be compared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            lo, hi = (batch.column(c).flatten().to_numpy() for c in ("lo", "hi"))
            of = np.repeat(np.arange(batch.num_rows), batch.column("lo").value_lengths().to_numpy())
            ends = np.concatenate([[0], np.cumsum(batch.column("lo").value_lengths().to_numpy())])
            said = batch.column("said")
            row = np.repeat(np.arange(len(said)), said.value_lengths().to_numpy())
            code, count, lead = (x.to_numpy(zero_copy_only=False) for x in said.flatten().flatten())
            place = ends[row] + code // 2
            ranks, same, leads = np.ones(len(lo), np.int64), np.ones(len(lo), np.int64), np.ones(len(lo), bool)
            ranks[place[code % 2 == 0]] = count[code % 2 == 0]
            same[place[code % 2 == 1]] = count[code % 2 == 1]
            leads[place[code % 2 == 1]] = lead[code % 2 == 1]
            done, todo = same >= 2, (same < ranks) & leads
            parts = []
            for first, last in chunks(bounds):
                pick = np.flatnonzero(todo[ends[first] : ends[last]]) + ends[first]
                if not len(pick):
                    continue
                cut = bounds[first : last + 1]
                prefix, base = unit_prefix(data, cut, rule.words)
                sizes = hi[pick] - lo[pick] + 1
                which = np.repeat(pick, sizes)
                at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[which]
                begin = at + base[of[which] - first]
                parts.append([of[which], at, ROLL.runs(prefix, begin, begin + rule.width)])
            row, at, key = _joined(parts, 3)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), *_lists(of[done], n, lo[done], hi[done] + rule.width), *_lists(row, n, at.astype(np.int64), key)],
                ["tid", "from", "to", "at", "key"],
            )

    return blocks.mapInArrow(run, "tid long, from array<long>, to array<long>, at array<long>, key array<long>")


def _runs(n: int, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of the bytes that the runs [start, end) cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    inside = np.concatenate([[False], np.cumsum(edge)[:n] > 0, [False]])
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])


def cut_out(found: DataFrame, rule: Rule, with_text: bool) -> DataFrame:
    """tid, n_removed, n_spans, kept_sha256 and, on request, the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            of = {c: batch.column(c) for c in ("from", "to", "tied")}
            ends = {c: np.concatenate([[0], np.cumsum(x.value_lengths().fill_null(0).to_numpy())]) for c, x in of.items()}
            flat = {c: x.flatten().to_numpy() for c, x in of.items()}
            removed, spans, shas, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = data[bounds[i] : bounds[i + 1]]
                one = {c: flat[c][ends[c][i] : ends[c][i + 1]] for c in of}
                start, end, _ = word_spans(raw, np.array([0, len(raw)])) if rule.words else (raw, raw, None)
                a, b = _runs(len(start), np.concatenate([one["from"], one["tied"]]), np.concatenate([one["to"], one["tied"] + rule.width]))
                if rule.words:
                    # From a run's first word to the next word that stays; at an end of the text the white space goes as well.
                    last = b == len(start)
                    a = np.where(a == 0, 0, np.where(last, end[np.maximum(a - 1, 0)], start[a]))
                    b = np.where(last, len(raw), start[np.where(last, 0, b)])
                left, edges = [], np.concatenate([[0], np.column_stack([a, b]).ravel(), [len(raw)]])
                for x, y in edges.reshape(-1, 2):
                    left.append(raw[x:y].tobytes())
                rest = b"".join(left)
                removed.append(len(raw) - len(rest))
                spans.append(len(a))
                shas.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())],
                ["tid", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return found.mapInArrow(run, "tid long, n_removed long, n_spans long, kept_sha256 string, kept string")


def text_id() -> Column:
    return F.xxhash64(text_or_empty(), F.length(text_or_empty()), F.crc32(text_or_empty()))


def long_enough(rule: Rule) -> Column:
    size = F.octet_length("text")
    return (size >= 2 * rule.width - 1) & (F.regexp_count("text", F.lit(r"[^ \t\n\x0B\f\r]+")) >= rule.width) if rule.words else size >= rule.width


def removals(docs: DataFrame, rule: Rule, with_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows of texts that lose units, by tid; tids of texts of `width` units or more that occur more than once)."""
    with scratch(docs.sparkSession):
        return _removals(docs, rule, with_text)


def _removals(docs: DataFrame, rule: Rule, with_text: bool) -> tuple[DataFrame, DataFrame]:
    texts = docs.select(text_id().alias("tid"), text_or_empty().alias("text"))
    sparse = store(sparse_samples(texts.where(long_enough(rule)), rule))
    grams = sparse.select("tid", F.explode(F.arrays_zip("at", "gram")).alias("s")).select("tid", "s.at", "s.gram")
    place = F.xxhash64("tid", "at")
    twice = store(grams.groupBy("gram").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select("gram"))
    known = store(grams.join(twice, "gram").groupBy("tid").agg(F.collect_set("at").alias("known")))
    # Texts with a repeated sample are picked before any of them is shuffled, as long as their counted ids are few.
    once = (
        texts.join(small_side(known.select("tid")), "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
        .join(known, "tid")
    )
    blocks = store(cover_blocks(once, rule))

    made = blocks.select(
        "tid", F.posexplode(F.arrays_zip("rank", "block")).alias("i", "s")
    ).select("tid", F.explode(F.array(F.struct((2 * F.col("i")).alias("code"), F.col("s.rank").alias("name")), F.struct((2 * F.col("i") + 1).alias("code"), F.col("s.block").alias("name")))).alias("s"))
    names = made.select("tid", "s.code", "s.name", F.xxhash64("tid", "s.code").alias("place"))
    ranked = store(names.groupBy("name").agg(F.count("*").alias("count"), F.min("place").alias("lead")).where("count > 1"))
    said = names.join(ranked, "name").groupBy("tid").agg(
        F.collect_list(F.struct(F.col("code").cast("long").alias("code"), "count", (F.col("place") == F.col("lead")).alias("lead"))).alias("said")
    )
    suffixes = store(open_suffixes(blocks.select("tid", "text", "lo", "hi").join(said, "tid"), rule))

    keys = suffixes.select("tid", F.explode(F.arrays_zip("at", "key")).alias("s")).select("tid", "s.at", "s.key")
    tied = store(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    at = keys.join(tied, "key").groupBy("tid").agg(F.collect_list("at").alias("tied"))
    none = F.array().cast("array<long>")
    found = (
        suffixes.select("tid", "from", "to").join(at, "tid", "left").withColumn("tied", F.coalesce("tied", none))
        .where("size(`from`) > 0 or size(tied) > 0").join(blocks.select("tid", "text"), "tid")
    )
    gone = store(cut_out(found, rule, with_text), outlive=True)
    copies = store(texts.where(long_enough(rule)).groupBy("tid").agg(F.count("*").alias("n")).where("n > 1").select("tid"), outlive=True)
    return gone, copies


def dedup_digest(docs: DataFrame, width: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is kept): a row for every row of `docs`."""
    gone, copies = removals(docs, rule_of(width, words=False), with_text=True)
    ids, twice = small_side(gone.select("tid")), small_side(copies)
    rows = docs.select("doc_id", text_id().alias("tid"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), text_or_empty().alias("text"))
    single = rows.join(twice, "tid", "left_anti")
    as_digest = lambda df, removed, spans, sha, text: df.select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"), spans.cast("long").alias("n_spans"), sha.alias("kept_sha256"), text.alias("text")
    )
    whole = as_digest(rows.join(twice, "tid", "left_semi"), F.col("n_bytes"), F.lit(1), F.sha2(F.lit(""), 256), F.lit(""))
    same = as_digest(single.join(ids, "tid", "left_anti"), F.lit(0), F.lit(0), F.sha2("text", 256), F.col("text"))
    cut = single.join(ids, "tid", "left_semi").drop("text").join(gone, "tid")
    return whole.unionByName(same).unionByName(as_digest(cut, F.col("n_removed"), F.col("n_spans"), F.col("kept_sha256"), F.col("kept")))


def dedup_texts(docs: DataFrame, width: int = 400, words: bool = False) -> DataFrame:
    """`docs` with repeated strings cut out of `text` (and n_chars set anew, if there); a text with nothing left goes. Other columns stay."""
    gone, copies = removals(docs, rule_of(width, words), with_text=True)
    twice = small_side(copies.withColumnRenamed("tid", "__tid"))
    plain = docs.withColumn("__tid", text_id()).join(twice, "__tid", "left_anti")
    changed = small_side(gone.select(F.col("tid").alias("__tid")))
    kept = plain.join(changed, "__tid", "left_anti")
    cut = (
        plain.join(changed, "__tid", "left_semi").join(gone.select(F.col("tid").alias("__tid"), F.col("kept").alias("__kept")), "__tid")
        .where("__kept <> ''").withColumn("text", F.col("__kept"))
    )
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns).unionByName(cut.select(*docs.columns))

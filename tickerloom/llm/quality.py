"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source.

One pass over whole texts counts words, symbols, repeated lines and repeated word windows. For every
(language, source) group a KLL sketch of each measure is built from the rows that pass the base rules:
partial sketches per salt first, merged per group, so a group with a third of all rows is no hot task.
The fences are joined back and decide. What is usual in a group passes there, whatever is usual elsewhere.

Measures: mean word length is fenced by quartiles on both sides: q75 + `reach` * (q75 - q25), the lower fence
likewise. Symbols per word, repeated lines per line and repeated words per word are zero in most rows, so their
quartiles say nothing: their upper fence is the group's q99. Only where a group has no spread
at all (q75 = q25, or q99 = q50) a least spread stands in, so that the first row that differs a little is not
rejected; groups with fewer than `least_rows` rows use the fences of all rows. `decisions` counts per measure
whose fence decided.

Defined results: a null, empty or blank text has no words and fails the base rule; null language or
source form groups of their own; repeated rows count as often as they occur; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import BLANK, Rolling, chunks, mix, small_batches, store, utf8, word_spans

ROLL = Rolling(5)
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
# measure, least spread (where a group has none), fences that apply: by quartiles on both sides, or the upper tail
MEASURES = (("word_length", 0.5, "both"), ("symbol_ratio", 0.02, "tail"), ("line_ratio", 0.1, "tail"), ("repeat_ratio", 0.1, "tail"))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeats(key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many earlier or later entries of the same group have the same key: True where there is one."""
    if not len(key):
        return np.zeros(0, bool)
    both = mix(key + mix(group.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def count_text(buf: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The COUNTS of the rows that `bounds` cuts from `buf`."""
    n = len(bounds) - 1
    per_row = lambda row, keep=None: np.bincount(row if keep is None else row[keep], minlength=n).astype(np.int64)
    prefix = ROLL.prefix(buf)
    start, end, row = word_spans(buf, bounds)
    of_byte = np.repeat(np.arange(n), np.diff(bounds))
    chars = per_row(of_byte, ~BLANK[buf] & ((buf & 0xC0) != 0x80))
    symbols = per_row(of_byte, SYMBOL[buf])
    words = ROLL.runs(prefix, start, end)
    if len(words) >= 3:
        window = mix(mix(words[:-2] * np.uint64(3) + words[1:-1]) * np.uint64(5) + words[2:])
        inside = row[2:] == row[:-2]
        first = np.flatnonzero(inside)
        twice = first[_repeats(window[inside], row[:-2][inside])]
        marked = np.zeros(len(words), bool)
        for j in range(3):
            marked[twice + j] = True
        repeat = per_row(row, marked)
    else:
        repeat = np.zeros(n, np.int64)
    breaks = np.flatnonzero(buf == 10)
    filled = np.diff(bounds) > 0
    line_start = np.sort(np.concatenate([bounds[:-1][filled], breaks + 1]))
    line_row = np.searchsorted(bounds, line_start, "right") - 1
    # A break at a row's end opens an empty last line, which begins where the next row does: it has no word.
    line_start, keep = np.unique(line_start, return_index=True)
    line_row = line_row[keep]
    ok = (line_start < len(buf)) & (line_row < n)
    line_start, line_row = line_start[ok], line_row[ok]
    line_end = np.minimum(np.concatenate([line_start[1:], [len(buf)]]), bounds[line_row + 1])
    has_break = (line_end > line_start) & (buf[np.maximum(line_end - 1, 0)] == 10)
    line_end = line_end - has_break
    word_at = np.concatenate([[0], np.cumsum(~BLANK[buf])])
    worded = word_at[line_end] > word_at[line_start]
    line_start, line_end, line_row = line_start[worded], line_end[worded], line_row[worded]
    key = mix(ROLL.runs(prefix, line_start, line_end) + (line_end - line_start).astype(np.uint64))
    both = mix(key + mix(line_row.astype(np.uint64) + np.uint64(1)))
    _, firsts = np.unique(both, return_index=True)
    again = np.ones(len(both), bool)
    again[firsts] = False
    return [per_row(row), chars, symbols, per_row(line_row), per_row(line_row, again), repeat]


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the COUNTS of the whole text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            parts = [
                count_text(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in chunks(bounds)
            ]
            columns = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "lang", "source")] + columns, ["doc_id", "lang", "source", *COUNTS])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    return source.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def _fenced(docs: DataFrame, reach: float, least_rows: int, salts: int) -> DataFrame:
    """Rows of `counted` with the measures and for each m of them low_m, high_m, from_m (whose fence: group, all or floor)."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    rows = store(
        counted(docs).withColumns({
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "word_length": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "n_words"),
            "line_ratio": ratio("n_dup_lines", "n_lines"), "repeat_ratio": ratio("n_repeat_words", "n_words"),
        })
    )
    names = [m for m, _, _ in MEASURES]
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts))
    partial = rows.where("not base_failed").groupBy("lang", "source", salt.alias("salt")).agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(m).alias(m) for m in names]
    )
    parts = store(partial)
    merged = lambda keys: parts.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m).alias(m) for m in names])

    def fences(of: str) -> list[Column]:
        out = []
        for m, least, sides in MEASURES:
            at = lambda q: F.kll_sketch_get_quantile_double(m, F.lit(q))  # noqa: E731, B023
            q1, q3 = (at(0.5), at(0.99)) if sides == "tail" else (at(0.25), at(0.75))
            flat = q3 <= q1
            spread = F.when(flat, F.lit(least)).otherwise(q3 - q1)
            high = F.when(flat, q3 + reach * F.lit(least)).otherwise(q3) if sides == "tail" else q3 + reach * spread
            low = F.lit(float("-inf")) if sides == "tail" else q1 - reach * spread
            out += [low.alias(f"low_{m}"), high.alias(f"high_{m}"), F.when(flat, F.lit("floor")).otherwise(F.lit(of)).alias(f"from_{m}")]
        return out

    own = merged(["lang", "source"]).where(F.col("n") >= least_rows).select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *fences("group"))
    shared = merged([]).where("n > 0").select(*fences("all")).first()  # one row
    found = rows.join(own, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
    return found.withColumns({
        c: F.coalesce(F.col(c), F.lit(shared[c] if shared else "all" if c.startswith("from_") else 0.0))
        for m in names for c in (f"low_{m}", f"high_{m}", f"from_{m}")
    })


def _passes(m: str) -> Column:
    return (F.col(m) <= F.col(f"high_{m}")) & (F.col(m) >= F.col(f"low_{m}"))


def judged(docs: DataFrame, reach: float = 4.0, least_rows: int = 50, salts: int = 16) -> DataFrame:
    """doc_id, the COUNTS, base_failed, kept and the measures: a row for every row of `docs`."""
    names = [m for m, _, _ in MEASURES]
    kept = ~F.col("base_failed")
    for m in names:
        kept = kept & _passes(m)
    return _fenced(docs, reach, least_rows, salts).select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), *names)


def decisions(docs: DataFrame, reach: float = 4.0, least_rows: int = 50, salts: int = 16) -> DataFrame:
    """measure, fence (group, all or floor), n_rows, n_rejected: whose fence decided the rows that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"from_{m}").alias("fence"), _passes(m).alias("ok")) for m, _, _ in MEASURES]))
    rows = _fenced(docs, reach, least_rows, salts).where("not base_failed").select(each.alias("d"))
    return rows.groupBy("d.measure", "d.fence").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("d.ok")).alias("n_rejected"))

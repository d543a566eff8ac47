"""Filter interaction audit by wide packed counters: what each filter does at each step of every order.

1. One pass over whole texts says which filters a document fails (a mask of five bits); a copy is found
   by (hashes, length) of the text, its smallest doc_id by partial minima, so a text that a third of all
   rows share is one row before anything is dealt out.
2. Documents are counted by (part, mask, labels): at most 128 rows a part, with partial aggregation.
3. Every mask has one big integer per outcome (kept, removed, redundant, failing alone), with a field of 64 bits
   for each of the 120 * 5 steps. A part's integers are summed, each as often as its documents were counted,
   and unpacked. A field never exceeds the number of the part's documents, which is below 2^63: no carry.

Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 * [A-Z] > 5 * code points; D any of
#$%&*|; E the text of a smaller doc_id.

Defined results: a null text is empty (fails A); null and empty source are one part; a document without
labels, or with null ones, is neither good nor toxic, and of several label rows any 1 counts; rows with a null
doc_id neither fail E nor make others fail it; rows of one doc_id are no copies of each other; columns beyond
doc_id, text and source are not read; an empty table gives no row. Words are compared by 64-bit
fingerprints within a text, texts by 96 bits of hashes and their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import Rolling, chunks, mix, small_batches, store, text_or_empty, utf8, word_spans

ROLL = Rolling(11)
LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
FIELDS = len(ORDERS) * len(LETTERS)
FIELD_BITS = 64
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#$%&*|"]] = True
KEY = ("hash", "crc", "size")
CASE = ("part", "mask", "good", "toxic")


def text_masks(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that the rows cut from `buf` by `bounds` (bounds[0] is 0) fail."""
    n = len(bounds) - 1
    of_byte = np.repeat(np.arange(n), np.diff(bounds))
    per_row = lambda keep: np.bincount(of_byte[keep], minlength=n)
    start, end, row = word_spans(buf, bounds)
    words = np.bincount(row, minlength=n)
    both = mix(mix(ROLL.runs(ROLL.prefix(buf), start, end)) + mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both)
    first = np.ones(len(order), bool)
    first[1:] = both[order][1:] != both[order][:-1]
    distinct = np.bincount(row[order[first]], minlength=n)
    points = per_row((buf & 0xC0) != 0x80)
    capitals = per_row((buf >= 65) & (buf <= 90))
    fails = [words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, per_row(SYMBOL[buf]) > 0]
    return sum(f.astype(np.int64) << i for i, f in enumerate(fails))


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, the key of the text and its mask: a row for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, bounds = utf8(batch.column("text"))
            found = [text_masks(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in chunks(bounds)]
            mask = pa.array(np.concatenate(found) if found else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], mask], [*batch.schema.names[:-1], "mask"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text_or_empty()).alias("hash"), F.crc32(text_or_empty()).alias("crc"), F.octet_length(text_or_empty()).cast("long").alias("size"),
        "text",
    )
    return source.mapInArrow(run, "doc_id long, part string, hash long, crc long, size long, mask long")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` with good and toxic, from all label rows of the document."""
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    known = (
        labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality"), is_one("toxic"))
        .withColumnRenamed("quality", "good").where("good or toxic")
    )
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.join(known, "doc_id", "left").select("doc_id", "part", *KEY, "mask", flag("good"), flag("toxic"))


def case_counts(rows: DataFrame) -> DataFrame:
    """part, mask (with the bit of E), good, toxic, n: documents of each case.

    The rows of a copied text are counted per case first and joined with the text's smallest doc_id then, so no join
    meets them one by one; the rows that hold this doc_id do not fail E and are taken off again.
    """
    groups = store(
        rows.groupBy(*KEY, *CASE).agg(F.count("*").alias("n"), F.count("doc_id").alias("named"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    )
    copied = store(groups.groupBy(*KEY).agg(F.min("lo").alias("first"), F.max("hi").alias("hi")).where("first < hi").select(*KEY, "first"))
    added = lambda df, n: df.select(*CASE, n.cast("long").alias("n"))
    in_copies = groups.join(copied, [*KEY])
    leading = rows.join(copied.withColumnRenamed("first", "doc_id"), [*KEY, "doc_id"])
    copy_bit = 1 << (len(LETTERS) - 1)
    moved = added(in_copies, F.col("named")).unionByName(added(leading, F.lit(-1)))
    signed = (
        added(groups, F.col("n")).unionByName(added(moved, -F.col("n")))
        .unionByName(added(moved.withColumn("mask", F.col("mask").bitwiseOR(F.lit(copy_bit))), F.col("n")))
    )
    return signed.groupBy(*CASE).agg(F.sum("n").alias("n")).where("n > 0")


def packed_outcomes() -> dict[str, list[int]]:
    """For every outcome the big integer of each mask: a 1 in the field of each (order, step) where it has that outcome."""
    out = {name: [0] * (1 << len(LETTERS)) for name in ("kept", "removed", "redundant", "unique_fails")}
    for mask in range(1 << len(LETTERS)):
        field = 0
        for order in ORDERS:
            gone = False
            for letter in order:
                bit, one = 1 << LETTERS.index(letter), 1 << (FIELD_BITS * field)
                fails = bool(mask & bit)
                if fails:
                    out["redundant" if gone else "removed"][mask] |= one
                gone = gone or fails
                if not gone:
                    out["kept"][mask] |= one
                if mask == bit:
                    out["unique_fails"][mask] |= one
                field += 1
    return out


def unpacked(total: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(FIELDS * FIELD_BITS // 8, "little"), "<i8")


STEP_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def step_outcomes(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the STEP_COLUMNS, of the counts of `case_counts`."""
    filters = np.array([LETTERS.index(letter) for order in ORDERS for letter in order])
    orders = pa.array([order for order in ORDERS for _ in LETTERS])
    steps = pa.array(list(range(1, len(LETTERS) + 1)) * len(ORDERS), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = packed_outcomes()
        for batch in batches:
            for part, cases in zip(batch.column("part").to_pylist(), batch.column("cases").to_pylist()):
                totals = dict.fromkeys(STEP_COLUMNS[:-1], 0)
                for case in cases:  # at most 32 masks times 4 labels
                    n, mask = case["n"], case["mask"]
                    for name, of in packed.items():
                        totals[name] += n * of[mask]
                    totals["good_lost"] += n * case["good"] * packed["removed"][mask]
                    totals["toxic_lost"] += n * case["toxic"] * packed["removed"][mask]
                columns = {name: unpacked(total) for name, total in totals.items()}
                columns["shapley"] = np.array([columns["removed"][filters == f].sum() for f in range(len(LETTERS))])[filters]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * FIELDS, pa.string()), orders, steps, *[pa.array(columns[c], pa.int64()) for c in STEP_COLUMNS]],
                    ["part", "filter_order", "step", *STEP_COLUMNS],
                )

    cases = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cases"))
    return cases.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in STEP_COLUMNS))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for every part, order of the five filters and step."""
    return step_outcomes(case_counts(store(with_labels(masked(docs), labels))))


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
f as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
    (len(ws) < 50)::int + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * (coalesce(d.doc_id > least_id, false))::int as mask
  from (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as least_id from d) d
  left join l on d.doc_id = l.doc_id
),
c as (select part, mask, good, toxic, count(*) as n from f group by all),
x as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
o as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from x a join x b on b.f <> a.f join x c on c.f not in (a.f, b.f) join x d on d.f not in (a.f, b.f, c.f) join x e on e.f not in (a.f, b.f, c.f, d.f)
),
s as (
  select filter_order, step::int as step, bits[step] as bit, list_sum(list_concat([0], bits[1:step - 1]))::int as earlier
  from o, unnest(range(1, 6)) u(step)
),
r as (
  select part, filter_order, step, bit,
    sum(case when mask & (earlier + bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & earlier = 0 and mask & bit <> 0 then n else 0 end)::bigint as removed,
    sum(case when mask & earlier <> 0 and mask & bit <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & earlier = 0 and mask & bit <> 0 and good = 1 then n else 0 end)::bigint as good_lost,
    sum(case when mask & earlier = 0 and mask & bit <> 0 and toxic = 1 then n else 0 end)::bigint as toxic_lost
  from c, s group by part, filter_order, step, bit
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) over (partition by part, bit)::bigint as shapley
from r
"""

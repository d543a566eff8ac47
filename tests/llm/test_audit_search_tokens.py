"""Filter audit, ranked lexical search and token counts against brute force and the library."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of, odd_docs, rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerloom.llm import filter_audit, lexical_search, token_counts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- filter audit ------------------------------------------------------
def audit_by_force(docs, labels):
    """docs: (doc_id, text, source) rows; labels: (doc_id, quality, toxic) rows."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    fails = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc_id is not None and any(t is not None and t < doc_id and (x or "") == text for t, x, _ in docs)
        mask = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)}
        fails.append((doc_id, source or "", mask | {"D": bool(re.search("[#$%&*|]", text)), "E": earlier}))
    out = []
    for part in {f[1] for f in fails}:
        mine = [f for f in fails if f[1] == part]
        removed_by, lines = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                hit = [f for f in left if f[2][letter]]
                redundant = sum(f[2][letter] for f in mine) - len(hit)
                left = [f for f in left if not f[2][letter]]
                removed_by[letter] += len(hit)
                unique = sum(f[2][letter] and sum(f[2].values()) == 1 for f in mine)
                lines.append((part, order, step, len(left), len(hit), redundant, unique, sum(f[0] in good for f in hit), sum(f[0] in toxic for f in hit)))
        out += [(*line, removed_by[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id long, quality int, toxic int"


def test_audit_matches_brute_force(spark):
    rng = random.Random(5)
    docs = []
    for i in range(150):
        words = [rng.choice(["aa", "bb", "Ab", "été", "x"]) + str(rng.randrange(rng.choice([3, 900]))) for _ in range(rng.randrange(20, 120))]
        words += rng.choice([[], [], ["#1"], ["a|b"], ["THE"] * 30])
        docs.append((i, rng.choice([" ", "\n", "\x0b "]).join(words), rng.choice(["s0", "s0", "s1", None, ""])))
    docs += [(200 + i, docs[i % 4][1], rng.choice(["s0", "s2"])) for i in range(40)] + [docs[0], docs[50], (None, docs[0][1], "s0"), (None, docs[1][1], None)]
    docs += [(300, None, "s0"), (301, "", "s0"), (302, "\x1c \xa0 　", "s3")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 310, 2)] + [(0, 1, 0), (0, 0, 1), (None, 1, 1), (999, 1, 1)]
    rng.shuffle(docs)
    got = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, LABELS))
    assert rows(got, *AUDIT) == audit_by_force(docs, labels)


def test_audit_odd_rows(spark, odd_docs):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1)], LABELS)
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert rows(filter_audit.audit(odd_docs, labels), *AUDIT) == audit_by_force(docs, [(1, 1, 0), (6, 0, 1)])
    assert filter_audit.audit(odd_docs.limit(0), labels).count() == 0
    assert filter_audit.audit(odd_docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_packed_fields_do_not_carry():
    packed = filter_audit.packed_outcomes()
    most = (1 << 63) - 1
    assert (filter_audit.unpacked(most * packed["removed"][31]) == [most, 0, 0, 0, 0] * 120).all()
    assert (filter_audit.unpacked(most * packed["kept"][0]) == most).all()


# ---- ranked lexical search ----------------------------------------------
def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked_by_force(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms_of(text) if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def found_by(spark, docs, items, build={}, **options):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, terms string, rank int").repartition(3)
    asked = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")
    got = lexical_search.search(frame, lexical_search.build(frame, **build), asked, **options)
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("build, limits", [({}, {}), ({"block_entries": 500, "seen_terms": 50}, {"chunk_terms": 1500, "cells": 300, "slab": 16})])
def test_search_matches_brute_force(spark, build, limits):
    rng = random.Random(8)
    words = lambda n: [f"{rng.choice(['Wort', 'été', 'x_', 'naïve-'])}{int(rng.paretovariate(0.7)) % 600}" for _ in range(n)]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(words(rng.randrange(1, 200)))) for i in range(220)]
    docs += [(1000 - i, docs[7][1]) for i in range(40)] + [(300, " ".join(words(9000))), (301, "the " * 4000 + docs[3][1])]
    items = [(i, " ".join(words(rng.randrange(1, 60)))) for i in range(25)] + [(100, docs[7][1][:200]), (100, docs[7][1][:200]), (101, " ".join(words(700)))]
    assert found_by(spark, docs, items, build, k=10, **limits) == ranked_by_force(docs, items, 10)


def test_search_odd_rows(spark, odd_docs):  # noqa: F811
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    some = docs[0][1]
    items = [(1, some), (2, None), (3, ""), (4, "unheard words"), (None, "w1 w2 W3 w3"), (5, "é 34"), (6, "--")]
    assert found_by(spark, docs, items, k=10) == ranked_by_force(docs, items, 10)
    assert not found_by(spark, docs, [], k=10) and not found_by(spark, [], items, k=10) and not found_by(spark, [(1, None), (2, "--")], items, k=10)


def test_bounds_are_never_too_low(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(rng.randrange(1, 400)))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = lexical_search.build(frame)
    items = lexical_search.items_of(spark.createDataFrame([(i, t) for i, t in docs[:9]], "item_id long, text string")).collect()
    as_array = lambda x: lexical_search.np.array(x, "int64")
    df = Counter(t for r in lexical_search.items_of(frame.withColumnRenamed("doc_id", "item_id")).collect() for t in r["terms"])
    chunk = lexical_search._Chunk([(r["item_id"], as_array(r["terms"]).view("uint64"), as_array(r["repeats"])) for r in items], dict(df), index.documents, index.terms, 1 << 20, 4096)
    exact = {(i, d): s for (i, _, d, s) in ranked_by_force(docs, docs[:9], 120)}
    tight = 0
    for batch in index.blocks.toArrow().to_batches():
        for block in lexical_search._blocks([batch]):
            for numbers, bounds in chunk.bounds(block):
                for i, number in enumerate(numbers.tolist()):
                    for place, doc in enumerate(block["ids"].to_pylist()):
                        assert bounds[i][place] >= exact.get((number, doc), 0)
                        tight += bounds[i][place] <= 1.1 * exact.get((number, doc), 0)
    assert tight > 500


# ---- token counts -------------------------------------------------------
LIBRARY = Tokenizer.from_file(VOCABULARY)
COUNTER = token_counts.WordCounter(VOCABULARY)
PIECES = [
    "a", "A", "the", "ing", "é", "é", "Σ", "ς", "İ", "ß", "ﬁ", "\x1c", "\x1f", "\x85", "\xa0", "　", "​", "\n", "\t", " ", "'s", "'S", "'", "1", "２", "½", "²",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "!", "!!!", "日本", "한", "🙂", "\x00", "aaaaaaa", "abab", "K", "ǅ", "̀", "﻿", "_", "-", "ŉ", "ª",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=12)), max_size=30).map("".join))
def test_token_counts_equal_the_library(text):
    assert COUNTER.tokens([text]) == [len(LIBRARY.encode(text, add_special_tokens=False).ids)]


def test_one_place_at_a_time_where_a_merge_makes_an_older_pair():
    """abc is made late by (a, bc), but (abc, a) is an older pair: it merges before the next (a, bc)."""
    chars = list(token_counts.byte_symbols().values())
    merges = [("b", "c"), ("ab", "c"), ("abc", "a"), ("abca", "bc"), ("a", "bc")]
    names = chars + [c + "/" for c in chars] + ["bc", "abc", "abca", "abcabc", "ab"]
    merger = token_counts.Merger({n: i for i, n in enumerate(names)}, merges, "/")
    assert merger.one_by_one.tolist() == [False, False, False, False, True]
    # abcabcx: bc, bc merge; then the first (a, bc), then (abc, a), then (abca, bc); x/ stays.
    assert merger.counts(["abcabcx", "x", "aax"]).tolist() == [2, 1, 3]


def test_tokens_of_rows(spark, sf, odd_docs):  # noqa: F811
    docs = odd_docs.select("doc_id", "text", F.lit(1).alias("n_tokens"), F.lit("x").alias("n_bytes"))
    got = token_counts.token_counts(docs, VOCABULARY, known_pieces=40)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    expected = Counter((i, len(t.encode()), len(LIBRARY.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert token_counts.token_counts(docs.limit(0), VOCABULARY).count() == 0
    given_docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r["text"] for r in given_docs.orderBy("doc_id").collect()]
    expected = [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [r["n_tokens"] for r in token_counts.token_counts(given_docs, VOCABULARY).orderBy("doc_id").collect()] == expected

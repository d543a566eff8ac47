"""Brute-force comparisons and defined results of the operators on texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import docs_of, odd_docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tickerloom.llm import language, mixing, ngram_join, packing, quality, sharding, suffix_dedup, toxicity
from tickerloom.llm.graph import components


def text_of(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# ---- repeated strings --------------------------------------------------
def removed_by_force(texts, width):
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        hit = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                hit[i : i + width] = [True] * width
        kept = bytes(b for b, h in zip(t, hit) if not h)
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_strings_match_brute_force(docs_of, seed):
    rng = random.Random(seed)
    passages = [text_of(rng, n) for n in (60, 90, 150, 400)]
    texts = []
    for i in range(40):
        parts = [text_of(rng, rng.randrange(5, 200))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p)), 2))
            parts += [p if rng.random() < 0.5 else p[a:b], text_of(rng, rng.randrange(40))]
        texts.append(" ".join(parts))
    texts += [texts[0], texts[1] + " end", "a" * 1500, "ab" * 900, passages[3] + "x" + passages[3], "é" * 300]
    got = suffix_dedup.dedup_digest(docs_of(list(enumerate(texts)))).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got}
    assert [got[i] for i in range(len(texts))] == removed_by_force([t.encode() for t in texts], 400)


def test_cover_of_a_long_text_in_parts():
    raw = np.frombuffer(text_of(random.Random(7), 3000).encode(), np.uint8)
    prefix = suffix_dedup.ROLL.prefix(raw)
    # The low 24 bits of a fingerprint give way to the position, so ties within a part fall alike.
    assert (suffix_dedup.cover(prefix, 24, 48, most=500) == suffix_dedup.cover(prefix, 24, 48)).all()


def test_digest_carries_the_kept_text(docs_of):
    passage = text_of(random.Random(3), 150, 9000)
    got = suffix_dedup.dedup_digest(docs_of([(1, "one " + passage), (2, passage + " two"), (3, "three"), (4, passage * 2), (5, passage * 2), (6, None)]))
    found = {r["doc_id"]: (r["text"], r["kept_sha256"]) for r in got.collect()}
    assert {i: t for i, (t, _) in found.items()} == {1: "one ", 2: " two", 3: "three", 4: "", 5: "", 6: ""}
    assert all(h == hashlib.sha256(t.encode()).hexdigest() for t, h in found.values())


def test_repeated_strings_odd_rows(spark, odd_docs):
    got = suffix_dedup.dedup_digest(odd_docs)
    assert got.count() == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[3]["n_bytes"] == by_id[3]["n_removed"] == 0 and by_id[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[8]["n_removed"] == 1400 and by_id[2]["n_removed"] == by_id[2]["n_bytes"] > 400
    kept = suffix_dedup.dedup_texts(odd_docs)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 8, None}
    assert kept.where("doc_id = 8").first()["text"] == " naïve 　 text" and kept.where("doc_id = 8").first()["n_chars"] == 13
    assert suffix_dedup.dedup_digest(odd_docs.limit(0)).count() == suffix_dedup.dedup_texts(odd_docs.limit(0)).count() == 0


# ---- n-gram join -------------------------------------------------------
def components_by_force(texts, k, percent):
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("k", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_near_duplicates_match_brute_force(docs_of, k, percent, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        base = text_of(rng, rng.choice([2, 5, 12, 30, 90, 400]), 2000).split()
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(copy) // 25 + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(copy[: rng.randrange(len(copy) * 9 // 10, len(copy)) + 1]))
    texts += [texts[3].upper(), "", "one", "ONE", "one two"]
    got = {r["doc_id"]: (r["n"], r["component_id"]) for r in ngram_join.near_duplicates(docs_of(list(enumerate(texts))), k, percent).collect()}
    assert [got[i] for i in range(len(texts))] == components_by_force(texts, k, percent)


def test_large_group_of_near_copies_is_one_component(docs_of):
    rng = random.Random(5)
    base = text_of(rng, 300, 5000).split()
    pairs = []
    for i in range(400):
        copy = list(base)
        for _ in range(4):
            copy[rng.randrange(300)] = f"x{i}"
        pairs.append((i + 10, " ".join(copy)))
    kept = ngram_join.keep_one(docs_of(pairs))
    expected = {10 + c for _, c in components_by_force([t for _, t in pairs], 5, 80)}
    assert {r["doc_id"] for r in kept.collect()} == expected and len(expected) < 40


def test_near_duplicates_odd_rows(odd_docs):
    found = ngram_join.near_duplicates(odd_docs)
    assert found.count() == odd_docs.count()
    assert rows(found.where("n = 0 and doc_id is not null"), "doc_id", "component_id") == [(3, 3), (4, 4), (5, 5)]
    assert {r["component_id"] for r in found.where("doc_id = 2").collect()} == {1}
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 3, 4, 5, 6, 7, 8]
    assert ngram_join.near_duplicates(odd_docs.limit(0)).count() == ngram_join.keep_one(odd_docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5, 5)]
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "label"))
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(40))


# ---- toxicity ----------------------------------------------------------
def test_machine_learns_a_pair_that_no_word_shows(spark, docs_of):
    rng = random.Random(1)
    pairs, labels = [], []
    for i in range(900):
        kind = i % 4  # the insult or the group alone is harmless, both together are not
        extra = [[], ["rotten"], ["folks"], ["rotten", "folks"]][kind]
        words = text_of(rng, 12, 60).split() + extra
        rng.shuffle(words)
        pairs.append((i, " ".join(words)))
        labels.append((i, int(kind == 3)))
    docs = docs_of(pairs)
    model = toxicity.fit(docs, spark.createDataFrame(labels[:600], "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] >= 0.7 for r in toxicity.score(docs, model).collect()}
    right = sum(got[i] == bool(y) for i, y in labels[600:])
    assert right >= 290


def test_toxicity_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    for docs, known in ((odd_docs, labels), (odd_docs, labels.limit(0)), (odd_docs.limit(0), labels)):
        scored = toxicity.score(docs, toxicity.fit(docs, known), "kept")
        assert scored.count() == docs.count() and scored.columns == docs.columns
        assert scored.where("kept is null or kept < 0 or kept > 1").count() == 0


# ---- languages ---------------------------------------------------------
def test_languages_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    got = language.identify(docs, language.fit_languages(docs.where(seen))).where(~seen)
    assert got.where("language.lang = lang").count() >= 0.9 * got.count()


def test_languages_odd_rows(spark, odd_docs):
    model = language.fit_languages(odd_docs)
    got = language.identify(odd_docs, model)
    und = {(r["doc_id"], r["text"]) for r in got.where("language.lang = 'und'").collect()}
    assert und == {(3, None), (4, ""), (5, " \n\t "), (7, "12 !? 34"), (None, None)}
    assert got.where("language.score < 0 or language.score > 1").count() == 0
    empty = language.fit_languages(odd_docs.limit(0))
    assert {r["l"] for r in language.identify(odd_docs, empty).select("language.lang").toDF("l").collect()} == {"und"}
    assert language.identify(odd_docs.limit(0), model).count() == 0


# ---- quality -----------------------------------------------------------
def test_quality_counts_match_brute_force(spark, docs_of, odd_docs):
    rng = random.Random(2)
    texts = ["a b c a b c d\n\n a b\n a b\nx", "# | <b> $5 %%", "é é é é\né é é é\n", "\n\n", "one\ntwo\none\ntwo\n"]
    texts += ["\n".join(text_of(rng, rng.randrange(9), 6) for _ in range(rng.randrange(12))) for _ in range(60)]
    got = {r["doc_id"]: r for r in quality.judged(docs_of(list(enumerate(texts)))).collect()}
    blank = set(" \t\n\v\f\r")
    for i, t in enumerate(texts):
        w = t.encode().split()
        windows, marked, seen, again = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
        for j in range(len(w) - 2):
            if windows[tuple(w[j : j + 3])] > 1:
                marked |= {j, j + 1, j + 2}
        for line in t.split("\n"):
            if set(line) - blank:
                again += line in seen
                seen.add(line)
        r = got[i]
        expected = (len(w), sum(c not in blank for c in t), sum(c in "#*$%&|<>" for c in t), again, len(marked))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected, t
        assert r["base_failed"] == (len(w) < 50 or 100 * len(marked) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    odd = quality.judged(odd_docs)
    assert odd.count() == odd_docs.count() and odd.where("kept is null").count() == 0 and quality.judged(odd_docs.limit(0)).count() == 0


def test_quality_fences_follow_the_group(spark):
    rng = random.Random(4)
    data = []
    for i in range(400):
        w = text_of(rng, 80, 5000).split()
        if i % 2:  # code-like source: a symbol after every word is usual there
            w = [x + "$" for x in w]
        data.append((i, " ".join(w), "en", "code" if i % 2 else "prose", 0))
    data.append((1000, " ".join(x + "$$" for x in text_of(rng, 80).split()), "en", "prose", 0))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert not got[1000] and all(got[i] for i in range(400))


def test_quality_fences_come_from_the_sketch(spark):
    rng = random.Random(5)
    data = []
    for i in range(300):
        lines = [" ".join(text_of(rng, 8, 5000).split()) for _ in range(20)]
        if i % 15 == 0:  # some repeat one line of twenty
            lines[1] = lines[0]
        if i == 7:  # one repeats six of them: far more than any other here, less than any fixed limit
            lines[:6] = [lines[0]] * 6
        data.append((i, "\n".join(lines), "en", "a", 0))
    long = "\n".join(" ".join(f"word{rng.randrange(1000)}" for _ in range(8)) for _ in range(20))
    data.append((1000, " ".join(w + "x" for w in long.split()), "en", "a", 0))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert not got[7] and not got[1000] and all(got[i] for i in range(300) if i != 7)
    said = {(r["measure"], r["fence"]): r["n_rows"] for r in quality.decisions(docs).collect()}
    assert said == {("word_length", "group"): 301, ("symbol_ratio", "floor"): 301, ("line_ratio", "group"): 301, ("repeat_ratio", "group"): 301}


def test_quality_fence_of_symbols_is_the_groups_own(spark):
    rng = random.Random(6)
    data = []
    for i in range(400):  # every twentieth of source a holds some symbols, every second of source b
        words = text_of(rng, 100, 5000).split()
        for j in range(8 if (i % 20 == 0 if i < 200 else i % 2) else 0):
            words[j] += "#"
        data.append((i, " ".join(words), "en", "a" if i < 200 else "b", 0))
    data.append((1000, " ".join([w + "#" for w in text_of(rng, 20, 5000).split()] + text_of(rng, 80, 5000).split()), "en", "a", 0))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert not got[1000] and all(got[i] for i in range(400))
    said = {(r["measure"], r["fence"]): (r["n_rows"], r["n_rejected"]) for r in quality.decisions(docs).collect()}
    assert said[("symbol_ratio", "group")] == (401, 1)


# ---- mixing ------------------------------------------------------------
def test_rates_are_the_least_squares_optimum(spark):
    """Overlapping posteriors: the totals meet a target that can be met; else the deviation that is left is said."""
    rng = random.Random(7)
    data = [(i, rng.randrange(10, 90), *sorted([rng.random(), rng.random()])) for i in range(300)]
    members = spark.createDataFrame([(n, [a, b - a, 1 - b]) for _, n, a, b in data], "n_tokens long, p array<double>").coalesce(1).cache()
    p, tokens = np.array([[a, b - a, 1 - b] for _, _, a, b in data]), np.array([n for _, n, _, _ in data], float)
    for target, most, reachable in (([0.45, 0.3, 0.25], 100, True), ([0.97, 0.02, 0.01], 6, False)):
        steps, deviation = mixing.fit_rates(members, target, most_steps=most)
        rate, goal = np.ones(len(p)), np.array(target) * tokens.sum()
        for g in steps:
            rate = np.maximum(0, rate - p @ np.array(g))
        assert abs(np.abs((rate * tokens) @ p / goal - 1).max() - deviation) < 1e-9 and (deviation < 1e-4) == reachable


def test_targets_that_cannot_be_met_are_refused(spark):
    docs = spark.createDataFrame([(i, f"{'ab'[i % 2]}{i % 7} same words here") for i in range(60)], "doc_id long, text string")
    known = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(60)], "doc_id long, domain string")
    with pytest.raises(ValueError, match="no labelled row has the domains"):
        mixing.mix_members(docs, known, {"a": 0.5, "c": 0.5})
    with pytest.raises(ValueError, match="deviate by"):
        mixing.mix_members(docs, known, {"a": 1.0})


def test_rare_domain_has_a_column(spark):
    docs = spark.createDataFrame([(i, ("rare" if i == 7 else "often") + f" w{i}") for i in range(400)], "doc_id long, text string")
    known = spark.createDataFrame([(i, "r" if i == 7 else "o") for i in range(400)], "doc_id long, domain string")
    _, domains, _ = mixing.mix_members(docs, known, labelled_rows=20)
    assert domains == ["o", "r"]


def test_rates_meet_the_targets(spark):
    rng = random.Random(6)
    data, labels = [], []
    for i in range(600):
        d = "abc"[(i % 10 > 5) + (i % 10 > 8)]
        data.append((i, " ".join(f"{d}{rng.randrange(40)}" for _ in range(rng.randrange(20, 80)))))
        labels.append((i, d))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    target = {"a": 0.3, "b": 0.3, "c": 0.4}
    known = spark.createDataFrame(labels[:200], "doc_id long, domain string")
    rated, domains, _ = mixing.mix_members(docs, known, target, least_rate=False)
    total = rated.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col("p")[i]) for i in range(3)]).first()
    assert domains == ["a", "b", "c"] and all(abs(x / sum(total) - target[d]) < 0.01 for x, d in zip(total, domains))
    assert rated.where("rate < 0").count() == 0
    kept, _, _ = mixing.mix_members(docs, known, target)
    assert abs(kept.agg(F.min("rate")).first()[0] - 1.0) < 1e-9 and kept.where("copies < 1").count() == 0
    expected, made = kept.agg(F.sum("rate"), F.sum("copies")).first()
    assert abs(made / expected - 1) < 0.05


def test_mixing_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, "x"), (6, "y"), (8, "z"), (None, "x"), (2, None)], "doc_id long, domain string")
    for known in (labels, labels.limit(0), labels.limit(1)):
        out = mixing.mixed(odd_docs, known)
        assert out.columns == odd_docs.columns and out.count() >= odd_docs.count()
        assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in odd_docs.collect()}
    assert mixing.mixed(odd_docs.limit(0), labels).count() == 0


# ---- sharding and packing ----------------------------------------------
def test_shards_are_even_and_slots_gapless(docs_of, odd_docs):
    pairs = [(i, f"text {i % 50}") for i in range(1003)] + [(7, "same")] * 400
    got = sharding.shard_rows(docs_of(pairs)).collect()
    sizes, slots = Counter(r["shard"] for r in got), defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 1403 and len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len(t) + 1, zlib.crc32(t.encode())) for i, t in pairs)
    odd = sharding.shard_rows(odd_docs)
    assert odd.count() == odd_docs.count() and odd.where("doc_id = 3").first()["size"] == 1 and odd.where("doc_id = 3").first()["text_crc32"] == 0
    assert sharding.shard_rows(odd_docs.limit(0)).count() == 0


def test_a_new_shard_moves_few_rows(docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(3000)])
    before = dict(rows(sharding.shard_rows(docs, 16), "doc_id", "shard"))
    after = dict(rows(sharding.shard_rows(docs, 17), "doc_id", "shard"))
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 0.5 * len(before)  # hashing modulo the number of shards would move 16 of 17


def test_packing_keeps_the_rules(spark, odd_docs):
    rng = random.Random(8)
    data = [(i, text_of(rng, rng.choice([3, 40, 90, 130, 450])), "hot" if i % 3 else f"s{i % 7}") for i in range(700)]
    data += [(1000 + i, data[0][1].upper(), "s1") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = packing.pack(docs, capacity=200, group_rows=400).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r["bin_id"]].append(r)
    total, copies = Counter(), {0, *range(1000, 1060)}
    for r in got:
        total[r["doc_id"]] += r["n_tokens"]
    assert total == Counter({i: len(t.split()) for i, t, _ in data})
    for b in bins.values():
        assert sum(r["n_tokens"] for r in b) <= 200 and sorted(r["place"] for r in b) == list(range(len(b)))
        assert sum(r["doc_id"] in copies for r in b) <= 1 and len({r["doc_id"] for r in b}) == len(b)
        for s in {r["source"] for r in b}:  # the piece that fills the share may pass it, none comes after it
            held = [r["n_tokens"] for r in sorted(b, key=lambda r: r["place"]) if r["source"] == s]
            assert sum(held[:-1]) < 100
    assert packing.pack(odd_docs).agg(F.countDistinct("doc_id")).first()[0] == 8 and packing.pack(odd_docs.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    import numpy as np

    tokens = np.array([70, 60, 30, 30, 10])
    where, place = packing.best_fit(tokens, np.array([1, 2, 3, 4, 5]), np.array([1, 2, 1, 3, 4]), 100)
    # 30 of cluster 1 may not join the 70 of cluster 1; the next 30 may; the last 10 ends in the residual of ten.
    assert where.tolist() == [0, 1, 1, 0, 1] and place.tolist() == [0, 0, 1, 1, 2]


def packed_by_force(tokens, source, cluster, capacity, share, bits):
    """Every piece in turn looks at every bin."""
    bins, out = [], []
    for need, s, c in zip(tokens, source, cluster):
        fits = [
            (capacity - b["filled"], i) for i, b in enumerate(bins)
            if b["filled"] < capacity and capacity - b["filled"] >= need and c % bits not in b["clusters"] and b["by"][s % bits] < max(1, int(capacity * share))
        ]
        if not fits:
            bins.append({"filled": 0, "clusters": set(), "by": Counter(), "n": 0})
        b = bins[min(fits)[1] if fits else -1]
        out.append((bins.index(b) if fits else len(bins) - 1, b["n"]))
        b["filled"] += need
        b["clusters"].add(c % bits)
        b["by"][s % bits] += need
        b["n"] += 1
    return out


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_matches_a_search_of_all_bins(seed):
    rng = random.Random(seed)
    n, bits = 300, rng.choice([8, 256])
    tokens = sorted((rng.choice([0, 1, 5, 20, 33, 50, 90, 100]) for _ in range(n)), reverse=True)
    source, cluster = [rng.choice([1, 1, 1, rng.randrange(50)]) for _ in range(n)], [rng.choice([7, rng.randrange(90)]) for _ in range(n)]
    where, place = packing.best_fit(np.array(tokens), np.array(source), np.array(cluster), 100, 0.5, bits)
    expected = packed_by_force(tokens, source, cluster, 100, 0.5, bits)
    # A source may close a bin only with its own pieces, so bins are compared as they were opened.
    assert list(zip(where.tolist(), place.tolist())) == expected


@pytest.mark.parametrize("seed", range(5))
def test_ring_walk_matches_one_row_at_a_time(seed):
    rng = random.Random(seed)
    shards, cells = rng.randrange(2, 7), 40
    owners = [rng.randrange(shards) for _ in range(cells)]
    owners[:shards] = range(shards)
    counts = [rng.choice([0, 0, 1, 3, 40 * (rng.random() < 0.1)]) for _ in range(cells)]
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    queue, filled, expected = [], Counter(), {}
    for lap in range(2):
        for cell, shard in enumerate(owners):
            queue += [(cell, i) for i in range(counts[cell])] if lap == 0 else []
            while queue and filled[shard] < room[shard]:
                expected[queue.pop(0)] = (shard, filled[shard])
                filled[shard] += 1
    got = {}
    for cell, shard, first, last, slot in sharding.walk(np.array(counts), np.array(owners), shards):
        got |= {(cell, rank): (shard, slot + rank - first) for rank in range(first, last)}
    assert got == expected and len(got) == total and [filled[s] for s in range(shards)] == room

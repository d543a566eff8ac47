"""Each stage of the pipeline on planted rows, and the whole on the given documents."""

import random

import corpus_pipeline
from llm_fixtures import docs_of, odd_docs  # noqa: F401
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_act_on_planted_rows(spark, sf, tmp_path, docs_of):  # noqa: F811
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    near = text(200).split()
    passage = text(120)
    pairs = [(i, text(100)) for i in range(200)]
    pairs += [(200 + i, text(60) + (" awful" if i % 2 else "") + " scumbag " + text(30)) for i in range(100)]
    pairs += [(300, " ".join(near)), (301, " ".join([*near[:100], "changed", *near[101:]])), (302, " ".join(near))]
    pairs += [(310 + i, f"{text(50)} {passage} {text(50)}") for i in range(4)]
    spark.createDataFrame([(i, 1, int(200 <= i < 300)) for i, _ in pairs if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = docs_of(pairs).select("doc_id", "text", "lang", "source", "n_chars")
    ids = lambda df: {r["doc_id"] for r in df.collect()}

    clean = STAGES["toxicity"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and ids(clean) == {i for i, _ in pairs if not 200 <= i < 300}
    single = STAGES["ngram_join"](spark, clean, str(tmp_path))
    assert single.columns == docs.columns and ids(single) == ids(clean) - {301, 302}
    cut = STAGES["suffix_dedup"](spark, single, str(tmp_path))
    assert cut.columns == docs.columns and ids(cut) == ids(single)
    assert cut.where(F.col("text").contains(passage[50:200])).count() == 0
    assert cut.where("n_chars <> length(text)").count() == 0
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    assert all(r["text"] == before[r["doc_id"]] for r in cut.where("doc_id < 301").collect())
    mixed = STAGES["mixing"](spark, cut, str(tmp_path))
    assert mixed.columns == docs.columns and ids(mixed) == ids(cut)
    packed = STAGES["packing"](spark, mixed, str(tmp_path))
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert packed.agg(F.sum("n_tokens")).first()[0] == words
    assert packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("n")).where("n > 4096").count() == 0


def test_every_repeat_of_over_50_words_is_cut(spark, docs_of):  # noqa: F811
    rng = random.Random(12)
    new = lambda n, size=9_000_000: [f"{rng.randrange(size)}" for _ in range(n)]
    short = lambda n: [chr(97 + rng.randrange(26)) for _ in range(n)]
    long = [[*new(51)], [*new(55)], [*new(60)], short(51), short(60), new(51, 10**12), new(120)]
    less = [new(50), short(50), new(50, 10**12), new(30), new(30)]
    pairs = {}
    for i, passage in enumerate(long):  # in the middle, at the start, at the end, with other white space
        for j, (a, b, gap) in enumerate([(20, 20, " "), (0, 30, " "), (30, 0, "\n"), (15, 15, "  ")]):
            before, after = new(a), new(b)
            pairs[10 * i + j] = (gap.join([*before, *passage, *after]), [*before, *after])
    for i, passage in enumerate(less[:3]):
        for j in range(3):
            words = [*new(20), *passage, *new(20)]
            pairs[100 + 10 * i + j] = (" ".join(words), words)
    for i, words in enumerate([[*new(9), *less[3], *less[4], *new(9)], [*new(9), *less[3], *new(30)], [*new(30), *less[4], *new(9)]]):
        pairs[200 + i] = (" ".join(words), words)  # two repeats of 30 words side by side are none of 60
    whole = " ".join(new(51))
    pairs |= {300: (whole, None), 301: (whole, None), 302: (whole.replace(" ", "\t"), None)}
    got = {r["doc_id"]: r for r in STAGES["suffix_dedup"](spark, docs_of([(i, t) for i, (t, _) in pairs.items()]), "").collect()}
    for i, (_, words) in pairs.items():
        assert (got[i]["text"].split() if i in got else None) == words, i
        assert i not in got or got[i]["n_chars"] == len(got[i]["text"])


def test_stages_take_odd_rows_and_empty_tables(spark, sf, odd_docs):  # noqa: F811
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        assert stage(spark, docs, sf).count() > 0, name


def test_whole_pipeline_on_the_given_documents(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.columns == ["doc_id", "piece", "n_tokens", "source", "bin_id", "place"]
    assert out.join(docs, "doc_id", "left_anti").count() == 0
    copies = docs.groupBy("text").agg(F.collect_set("doc_id").alias("ids")).where("size(ids) > 1").select(F.explode(F.slice("ids", 2, 1000)).alias("x"), "ids")
    kept = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert all(len(kept & set(r["ids"])) <= 1 for r in copies.collect())


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()

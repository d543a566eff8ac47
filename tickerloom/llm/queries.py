"""The queries of the operators: each applies one to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    ann, filter_audit, html, language, lexical_search, mixing, ngram_join, packing, quality, sharding, suffix_dedup, token_counts, toxicity,
)
from tickerloom.llm.common import id_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(id_bucket("doc_id", 3) != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", (id_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ngram_join.near_duplicates(docs, k=4, percent=85)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents").select("doc_id", "text"), width=400)


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents; the labelled table gives the languages of its documents as domains."""
    docs = table(spark, sf_dir, "documents")
    rated, domains, _ = mixing.mix_members(
        docs.select("doc_id", "text"), language_domains(docs, table(spark, sf_dir, "labels")), keep=["doc_id"]
    )
    return rated.select(
        "doc_id", "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], "rate", "copies"
    )


def language_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the documents that the label table covers."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[m for m, _, _ in quality.MEASURES]
    )


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_languages(docs.where(id_bucket("doc_id", 4) != 2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        F.col("language.accepted").alias("accepted"),
    )


@query("op8_ann")
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op11_filter_audit", filter_audit.ORACLE)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "labels"))


@query("op12_lexical_search", lexical_search.ORACLE)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, lexical_search.build(docs), table(spark, sf_dir, "benchmark"), k=10)


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))

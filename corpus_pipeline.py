"""A training corpus from `documents`: each stage is one operator on all that the stage before it kept.

Which rows a stage may drop: `toxicity` those with a score of 0.7 or more; `ngram_join` all but one of a group of near
copies, and all but one of rows that repeat id and text; `suffix_dedup` texts with nothing left; `mixing` none (documents are
repeated by their rate); `packing` none (long documents come in pieces).

Odd rows: a null doc_id is an id like others (unlabelled, last when one of a group is kept); null, empty and blank texts are
not toxic, are near copies of nothing, lose nothing, have rate and bin like others with 0 tokens; null language or source
is a value of its own; columns beyond those of `documents` pass through all stages but the last; an empty table
gives an empty result. Missing or one-sided labels: every text gets the same score, or there is one domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from tickerloom.llm.common import id_bucket, store, table
from tickerloom.llm.queries import language_domains


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(id_bucket("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, "__toxicity").where(F.col("__toxicity") < 0.7).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, k=5, percent=80)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_texts(docs, width=51, words=True)  # every repeat of over 50 words


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, language_domains(docs, table(spark, sf_dir, "labels")))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_strings),
    ("mixing", mix_languages),
    ("packing", pack_bins),
]

# The stages learn models, hash and iterate: not expressible in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

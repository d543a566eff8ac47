"""Mixing to target weights: soft membership and projected-gradient least squares, in DataFrame functions only.

1. A table of labelled rows (doc_id, domain) trains a multinomial logistic regression over hashed words
   (Spark ML, in the JVM) on a bounded sample of each domain (`labelled_rows` in all, a documented parameter).
   Its posteriors say how much of each document belongs to each domain; a text in two languages counts for both.
2. Document rates r >= 0 are fitted so that the expected tokens of every domain, sum of r * tokens *
   posterior, match their targets: minimise sum over domains of (total - target)^2 / (2 target) by
   projected gradient steps r <- max(0, r - (p . g)), scaled by a document's tokens. The gradient is preconditioned by
   the curvature of the documents whose rate is above zero; where such a step does not lower the objective, a plain
   one of safe length is taken. An iteration is one aggregate of some numbers per pair of domains. A rate is a
   function of the document's posteriors and of the steps so far, so rates are replayed from a short array of
   steps and never written; a lost executor repeats a scan. Steps go on until the totals are within `tolerance` or no
   step lowers the objective by a thousandth. Targets that the caller sets and that cannot be met then fail, with the deviation.
3. With `least_rate` the fitted rates are scaled so that the smallest is one: documents are repeated,
   none is lost. Rate 2.3 means two copies, and a third for three documents in ten, chosen by a hash.

Defined results: a null or empty text has no tokens, posteriors of the trained prior and rate as fitted;
null ids and repeated rows are documents like others; without labelled rows there is one domain '' (with
labels of one domain only, that one); an empty table gives an empty result. `mix_members` wants no columns
of its own added names in `keep`; `mixed` takes any.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import store, text_or_empty

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def word_vectors(docs: DataFrame, buckets: int) -> DataFrame:
    """`docs` with __words (counts of hashed words by length one): a text's words, each with its share."""
    words = docs.withColumn("__list", F.split(F.lower(text_or_empty()), WORD_BREAK))
    counted = HashingTF(inputCol="__list", outputCol="__tf", numFeatures=buckets).transform(words)
    return Normalizer(inputCol="__tf", outputCol="__words", p=2.0).transform(counted).drop("__list", "__tf")


def train_domains(docs: DataFrame, labelled: DataFrame, labelled_rows: int, buckets: int) -> tuple[LogisticRegressionModel, list[str]]:
    """The classifier and all labelled domains in order; trained on the rows of each with the smallest hash of their id."""
    known = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    domains = sorted(r[0] for r in known.select("domain").distinct().collect())
    order = Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id")
    each = max(1, labelled_rows // max(1, len(domains)))
    picked = store(known.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= each).drop("__n"))
    if len(domains) < 2:  # nothing to tell apart
        return None, domains or [""]
    coded = picked.select("doc_id", (F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1).cast("double").alias("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(coded), "doc_id")
    vectors = store(word_vectors(rows, buckets).select("label", "__words"))
    present = [domains[int(r[0])] for r in vectors.select("label").distinct().collect()]
    if len(present) < 2:
        return None, present or [""]
    model = LogisticRegression(featuresCol="__words", labelCol="label", maxIter=25, regParam=1e-3, family="multinomial", maxBlockSizeInMB=8.0)
    return model.fit(vectors), domains


def posteriors(docs: DataFrame, model: LogisticRegressionModel | None, buckets: int) -> DataFrame:
    """`docs` with n_tokens and p (an array with the probability of each domain)."""
    counted = docs.withColumn("n_tokens", n_words())
    if model is None:
        return counted.withColumn("p", F.array(F.lit(1.0)))
    model.setFeaturesCol("__words").setProbabilityCol("__probability").setRawPredictionCol("").setPredictionCol("")
    scored = model.transform(word_vectors(counted, buckets))
    return scored.withColumn("p", vector_to_array("__probability")).drop("__words", "__probability")


def _dot(p: Column, weights: list[float] | Column) -> Column:
    other = weights if isinstance(weights, Column) else F.array(*map(F.lit, weights))
    return F.aggregate(F.zip_with(p, other, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def rate_of(p: Column, steps: list[list[float]], scale: float) -> Column:
    """The rate after the given projected steps, replayed from one."""
    if not steps:
        return F.lit(scale)
    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    return scale * F.aggregate(moves, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - _dot(p, g)))


def fit_rates(members: DataFrame, targets: list[float], tolerance: float = 1e-4, most_steps: int = 100) -> tuple[list[list[float]], float]:
    """The steps after which expected totals match `targets` (shares of all tokens), and the largest relative deviation left."""
    size = len(targets)
    mass = members.select("n_tokens", "p").where("n_tokens > 0")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]

    def state(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, curvature of the documents with a rate above zero, and all tokens."""
        now = mass.select("n_tokens", rate_of(F.col("p"), steps, 1.0).alias("r"), "p")
        live = F.when(F.col("r") > 0, F.col("n_tokens")).otherwise(F.lit(0))
        row = now.agg(
            F.sum("n_tokens").alias("t"), *[F.sum(F.col("n_tokens") * F.col("r") * F.col("p")[i]).alias(f"s{i}") for i in range(size)],
            *[F.sum(live * F.col("p")[i] * F.col("p")[j]).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        curvature = np.zeros((size, size))
        for i, j in pairs:
            curvature[i, j] = curvature[j, i] = row[f"h{i}_{j}"] or 0.0
        return np.array([float(row[f"s{i}"] or 0.0) for i in range(size)]), curvature, float(row["t"] or 0)

    totals, curvature, tokens = state([])
    if not tokens:
        return [], 0.0
    goal = np.array(targets) * tokens
    scale = np.where(goal > 0, goal, 0.01 * tokens)  # deviations count in parts of the target, of an unwanted domain in parts of all tokens
    # The largest eigenvalue of the scaled curvature is at most its largest row sum: steps under its inverse fall.
    bound = float((curvature / np.sqrt(np.outer(scale, scale))).sum(axis=1).max())
    worth = lambda s: float((((s - goal) ** 2) / (2 * scale)).sum())
    steps: list[list[float]] = []
    for _ in range(most_steps):
        off = (totals - goal) / scale
        if np.abs(off).max() < tolerance:
            break
        moves = [np.linalg.lstsq(curvature + 1e-12 * tokens * np.eye(size), totals - goal, rcond=None)[0], off / bound]
        for move in moves:
            tried = [*steps, [float(x) for x in move]]
            found, curved, _ = state(tried)
            if worth(found) < worth(totals) * (1 - 1e-3):
                break
        else:
            break  # the least squares are reached
        steps, totals, curvature = tried, found, curved
    return steps, float(np.abs((totals - goal) / scale).max())


def tempered(members: DataFrame, size: int, power: float) -> list[float]:
    """Target shares: the domains' own token shares to a power under one, which lifts small domains."""
    row = members.agg(*[F.sum(F.col("n_tokens") * F.col("p")[i]).alias(f"s{i}") for i in range(size)]).first()
    lifted = [max(float(x or 0.0), 1e-9) ** power for x in row]
    return [x / sum(lifted) for x in lifted]


def mix_members(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, power: float = 0.7, least_rate: bool = True,
    labelled_rows: int = 6000, buckets: int = 2048, keep: list[str] | None = None, tolerance: float = 1e-4,
) -> tuple[DataFrame, list[str], list[float]]:
    """(docs with n_tokens, p, rate and copies; the domains; the target shares), with the columns `keep` of `docs` (default: all).

    `targets` maps domains to shares of all tokens (missing domains: none); unknown domains and shares that the
    documents cannot give are refused. Left out, they are the tempered shares of the corpus. Copies are rounded by a hash of id and text, so expected totals are kept.
    """
    model, domains = train_domains(docs, labelled, labelled_rows, buckets)
    draw = F.pmod(F.xxhash64(F.lit(2), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    members = store(posteriors(docs.withColumn("__draw", draw), model, buckets).select(*(keep or docs.columns), "__draw", "n_tokens", "p"))
    known = members.select("n_tokens", "p")
    if targets is None:
        shares = tempered(known, len(domains), power)
    else:
        if unknown := sorted(set(targets) - set(domains)):
            raise ValueError(f"no labelled row has the domains {unknown}")
        asked = [max(0.0, targets.get(d, 0.0)) for d in domains]
        shares = [x / (sum(asked) or 1.0) for x in asked]
    steps, deviation = fit_rates(known, shares, tolerance)
    if targets is not None and deviation > tolerance:
        raise ValueError(f"the documents cannot give the target shares: the totals deviate by {deviation:.2%}")
    low = known.where("n_tokens > 0").agg(F.min(rate_of(F.col("p"), steps, 1.0))).first()[0] if least_rate else None
    # Rounded, so that the smallest rate is one and not a hair below it.
    rate = F.round(rate_of(F.col("p"), steps, 1.0 / low if low else 1.0), 9)
    rated = members.withColumn("rate", F.greatest(rate, F.lit(1.0)) if low else rate)
    return rated.withColumn("copies", F.floor(F.col("rate") + F.col("__draw")).cast("int")).drop("__draw"), domains, shares


def mixed(docs: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """`docs`, every row as often as its copies say. Columns of any name are carried through."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    rated, _, _ = mix_members(whole, labelled, keep=["__row"], **options)
    copies = rated.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])

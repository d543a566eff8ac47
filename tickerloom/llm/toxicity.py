"""Toxicity: a factorization machine over hashed terms.

A text is the set of its hashed terms: lower-cased words and the first 4 and 5 letters of longer
words (so that inflected forms share a term). The machine scores a text by a bias, a weight per
term and a low-rank weight per pair of terms, so that a pair (an insult next to a group's name)
can weigh more than its parts. It is trained in numpy on the driver on a bounded sample of
labelled rows (`positives`, `negatives`: documented parameters, 7,500 term sets of 4 bytes a term); the terms that enter it are those whose counts in the sample differ most between
the classes, so the model has a fixed size and neutral words of a long text add nothing.
Scoring is one pass over whole texts without a shuffle.

Defined results: a null or empty text, or one without a known term, gets the bias's score; a null
doc_id is never a training row; repeated rows get equal scores; with no labelled row of one class
the score is the share of the other class.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import store, text_or_empty

WORD = re.compile(r"[^\W_]+")
BITS = 20
PREFIXES = (4, 5)


def terms(text: str, cache: dict[str, tuple[int, ...]]) -> set[int]:
    """The hashed terms of a text. `cache` maps words to their terms and is emptied when it grows."""
    out: set[int] = set()
    for word in set(WORD.findall(text.lower())):
        ids = cache.get(word)
        if ids is None:
            if len(cache) > 50_000:
                cache.clear()
            short = [word[:n] + "_" * (n - 2) for n in PREFIXES if len(word) >= n]
            ids = tuple(zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in [word, *short])
            cache[word] = ids
        out.update(ids)
    return out


@dataclass
class FactorizationMachine:
    """Sorted term ids, bias, weights (n) and factors (n x rank)."""

    ids: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, sets: list[np.ndarray]) -> np.ndarray:
        """Scores of term sets, given as positions in `ids`."""
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        cols = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
        z = self.bias + np.bincount(rows, self.weights[cols], len(sets))
        for k in range(self.factors.shape[1]):
            v = self.factors[cols, k]
            z += 0.5 * (np.bincount(rows, v, len(sets)) ** 2 - np.bincount(rows, v * v, len(sets)))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def positions(self, found: set[int] | np.ndarray) -> np.ndarray:
        x = found if isinstance(found, np.ndarray) else np.fromiter(found, np.int64, len(found))
        at = np.minimum(np.searchsorted(self.ids, x), max(len(self.ids) - 1, 0))
        return np.sort(at[self.ids[at] == x]) if len(self.ids) else np.zeros(0, np.int64)


def select_terms(sets: list[np.ndarray], y: np.ndarray, most: int, least: int = 3) -> np.ndarray:
    """The `most` terms whose document counts differ most between the classes (log-likelihood ratio)."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    in_pos, in_neg = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for found, positive in zip(sets, y):
        (in_pos if positive else in_neg)[found] += 1
    seen = np.flatnonzero(in_pos + in_neg >= least)
    a, b = in_pos[seen].astype(float), in_neg[seen].astype(float)
    share = (a + b) / (n1 + n0)
    gain = a * np.log(np.maximum(a, 1e-9) / (share * n1)) + b * np.log(np.maximum(b, 1e-9) / (share * n0))
    best = np.lexsort((seen, -gain))[:most]
    return np.sort(seen[best[gain[best] > 6.0]])


def train(
    sets: list[np.ndarray], y: np.ndarray, rank: int = 4, most: int = 4096, epochs: int = 80,
    rate: float = 0.15, decay: float = 3e-5, batch: int = 256, heaviest: float = 8.0, seed: int = 7,
) -> FactorizationMachine:
    """Logistic loss, AdaGrad over shuffled batches; rows of the rarer class weigh up to `heaviest` times as much."""
    share = float(y.mean()) if len(y) else 0.0
    prior = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    if len(y) == 0 or share in (0.0, 1.0):
        return FactorizationMachine(np.zeros(0, np.int64), prior, np.zeros(0), np.zeros((0, rank)))
    weight = np.where(y > 0, min(heaviest, (1 - share) / share), 1.0)
    rng = np.random.default_rng(seed)
    ids = select_terms(sets, y, most)
    model = FactorizationMachine(ids, prior, np.zeros(len(ids)), rng.normal(0, 0.01, (len(ids), rank)))
    at = [model.positions(s) for s in sets]
    g_w, g_v, g_b = np.full(len(ids), 1e-2), np.full((len(ids), rank), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(y), batch):
            pick = order[first : first + batch]
            rows = np.repeat(np.arange(len(pick)), [len(at[i]) for i in pick])
            cols = np.concatenate([at[i] for i in pick])
            error = (model.score([at[i] for i in pick]) - y[pick]) * weight[pick]
            model.bias -= rate * error.mean() / np.sqrt(g_b := g_b + error.mean() ** 2)
            if not len(cols):
                continue
            used, where = np.unique(cols, return_inverse=True)
            grad = np.bincount(where, error[rows], len(used)) / len(pick) + decay * model.weights[used]
            g_w[used] += grad**2
            model.weights[used] -= rate * grad / np.sqrt(g_w[used])
            for k in range(rank):
                v = model.factors[cols, k]
                total = np.bincount(rows, v, len(pick))[rows]
                grad = np.bincount(where, error[rows] * (total - v), len(used)) / len(pick) + 10 * decay * model.factors[used, k]
                g_v[used, k] += grad**2
                model.factors[used, k] -= 0.2 * rate * grad / np.sqrt(g_v[used, k])
    return model


def calibrated(sets: list[np.ndarray], y: np.ndarray, cut: float = 0.7, most_shift: float = 2.0) -> FactorizationMachine:
    """Train on all rows; then move the bias so that `cut` lies between the classes of a held-back fifth.

    The shift is the middle of the highest negatives and the lowest positives of that fifth, if they are
    apart, and at most `most_shift` either way; a sample too small or mixed is left as trained.
    """
    model = train(sets, y)
    held = np.arange(len(y)) % 5 == 0
    if min(y[held].sum(), (1 - y[held]).sum()) >= 40:
        part = train([s for s, h in zip(sets, held) if not h], y[~held])
        p = part.score([part.positions(s) for s, h in zip(sets, held) if h])
        z = np.log(p / (1 - p))
        high, low = np.quantile(z[y[held] == 0], 0.999), np.quantile(z[y[held] == 1], 0.01)
        if low > high:
            model.bias += float(np.clip(np.log(cut / (1 - cut)) - (low + high) / 2, -most_shift, most_shift))
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = 2500, negatives: int = 5000,
) -> FactorizationMachine:
    """Train on at most `positives` + `negatives` labelled documents, taken in the order of a hash of their ids.

    `labels` has doc_id and the 0/1 column `label`; where rows of an id differ, 1 wins. The picked ids are
    bounded by the parameters and are broadcast, so no text is shuffled but those of the sample.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = store(
        known.where("y = 1").orderBy(*order).limit(positives).union(known.where("y = 0").orderBy(*order).limit(negatives))
    )
    chosen = (
        docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    )

    def as_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found = [np.fromiter(s, np.int32, len(s)) for s in (terms(t, cache) for t in batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "terms": found})

    sample = chosen.mapInPandas(as_terms, "doc_id long, y int, terms array<int>").toArrow().sort_by("doc_id").combine_chunks()
    flat, ends = sample["terms"].combine_chunks().flatten().to_numpy(), np.cumsum([0, *(sample["terms"].combine_chunks().value_lengths().to_pylist())])
    return calibrated([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], sample["y"].to_numpy().astype(float))


def score(docs: DataFrame, model: FactorizationMachine, column: str = "score") -> DataFrame:
    """Every row of `docs` with `column` (double, 0 to 1): one map over whole texts, no shuffle.

    Other columns of the input are kept; one that is called `column` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = shared.value
        cache: dict[str, tuple[int, ...]] = {}
        for batch in texts:
            yield pd.Series(machine.score([machine.positions(terms(t, cache)) for t in batch]))

    return docs.withColumn(column, of(text_or_empty()))

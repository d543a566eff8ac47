"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text is the mean of the embeddings of its subwords: the runs of 1 to 4 letters within its words, words
marked at both ends, lower-cased, hashed to 2^15 buckets. A softmax over the mean gives the languages.
Embeddings and softmax are trained together by stochastic gradient descent on the driver on a bounded
sample of labelled rows (`labelled_rows`, a documented parameter). The sampled texts are read whole, in the executors:
what comes to the driver of each is its distinct buckets (2^15 at most) and how often each occurs. A held-back part
of the sample sets the temperature (calibration) and the score below which a prediction is rejected. For scoring, embedding times softmax is folded into one number per
bucket and language, so a whole text of any length costs a lookup per subword, in one map without a shuffle.

Defined results: `und` with score 0 for a null text or one without a letter; repeated rows get equal
results; with one known language that language has score 1; without labelled rows all is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import mix, small_batches, store

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
STRETCH = 1 << 18


def _letters() -> np.ndarray:
    """Which code points are letters (planes 0 to 3)."""
    return np.fromiter((chr(c).isalpha() for c in range(0x40000)), bool, 0x40000)


_TABLE: list[np.ndarray] = []


def subwords(text: str) -> np.ndarray:
    """The buckets of all subwords of a text, in no order; none if it has no letter."""
    if not _TABLE:
        _TABLE.append(_letters())
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _TABLE[0][np.minimum(codes, 0x3FFFF)]
    if not letter.any():
        return np.zeros(0, np.int64)
    # Every run of other characters is one boundary mark, and one stands at either end.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    marked = np.concatenate([[0], np.where(letter, codes, 0)[keep], [0]]).astype(np.uint64)
    inside = marked != 0
    out = []
    rolled = np.zeros(len(marked), np.uint64)
    whole = np.ones(len(marked), bool)  # no mark strictly inside the run
    for n in range(1, max(GRAMS) + 1):
        size = len(marked) - n + 1
        if size <= 0:
            break
        rolled = rolled[:size] * np.uint64(0x9E3779B97F4A7C15) + marked[n - 1 :] + np.uint64(1)
        if n > 2:
            whole = whole[:size] & inside[n - 2 : n - 2 + size]
        whole = whole[:size]
        if n in GRAMS:
            pick = whole & (inside[:size] | inside[n - 1 :]) if n > 1 else inside[:size]
            out.append((mix(rolled[pick] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(out)


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and how often each occurs, taken in stretches so that memory stays bounded."""
    if len(text) <= STRETCH:
        return np.unique(subwords(text), return_counts=True)
    total = np.zeros(BUCKETS, np.int64)
    for first in range(0, len(text), STRETCH):
        total += np.bincount(subwords(text[first : first + STRETCH]), minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class LanguageModel:
    """Languages, logits per bucket (BUCKETS x languages), bias, temperature and the least score of an accepted prediction."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def mean_logits(self, text: str) -> np.ndarray | None:
        """Logits of a whole text, taken in stretches so that memory stays bounded."""
        total, n = np.zeros(len(self.languages)), 0
        for first in range(0, len(text), STRETCH):
            found = subwords(text[first : first + STRETCH])
            if len(found):
                total += np.bincount(found, minlength=BUCKETS) @ self.logits if len(found) > BUCKETS else self.logits[found].sum(0)
                n += len(found)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float]:
        z = self.mean_logits(text) if text and self.languages else None
        if z is None:
            return "und", 0.0
        p = np.exp((z - z.max()) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def train(
    found: list[tuple[np.ndarray, np.ndarray]], names: list[str], size: int = 16, epochs: int = 8, least_steps: int = 1000, rate: float = 2.0,
    batch: int = 32, seed: int = 3,
) -> LanguageModel:
    """Stochastic gradient descent on cross-entropy, falling rate, on `bucket_counts` of texts; every fifth text is held back for calibration."""
    languages = sorted(set(names))
    known = [i for i in range(len(found)) if len(found[i][0])]
    if len(languages) < 2 or not known:
        return LanguageModel(languages, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)))
    shares = [n / max(1, n.sum()) for _, n in found]
    y = np.array([languages.index(n) for n in names])
    held = np.array([i for k, i in enumerate(known) if k % 5 == 4], np.int64)
    fit = np.array([i for k, i in enumerate(known) if k % 5 != 4], np.int64)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.3, (BUCKETS, size)).astype(np.float64)
    soft, bias = rng.normal(0, 0.3, (size, len(languages))), np.zeros(len(languages))
    per_epoch = max(1, -(-len(fit) // batch))
    epochs = max(epochs, -(-least_steps // per_epoch))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for first in range(0, len(order), batch):
            pick = order[first : first + batch]
            counts = np.array([len(found[i][0]) for i in pick])
            cols = np.concatenate([found[i][0] for i in pick])
            used, where = np.unique(cols, return_inverse=True)
            share = np.zeros((len(pick), len(used)))
            share[np.repeat(np.arange(len(pick)), counts), where] = np.concatenate([shares[i] for i in pick])
            mean = share @ embed[used]
            error = _softmax(mean @ soft + bias)
            error[np.arange(len(pick)), y[pick]] -= 1.0
            lr = rate * (1 - step / steps)
            grad = share.T @ (error @ soft.T)
            soft -= lr * (mean.T @ error) / len(pick)
            bias -= lr * error.sum(0) / len(pick)
            embed[used] -= lr * grad
            step += 1
    model = LanguageModel(languages, embed @ soft, bias)
    if len(held):
        z = np.stack([shares[i] @ model.logits[found[i][0]] + bias for i in held])
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.2, 5, 33), key=loss))
        p = _softmax(z / model.temperature)
        right = p.argmax(1) == y[held]
        # The smallest score from which on at least 99 of 100 held-back predictions are right.
        score = np.sort(p.max(1))
        model.least = next((float(s) for s in score if right[p.max(1) >= s].mean() >= 0.99), 1.0)
    return model


def fit_languages(docs: DataFrame, labelled_rows: int = 4000) -> LanguageModel:
    """Train on the `labelled_rows` rows of `docs` (doc_id, text, lang) with the smallest hash of id and text, whole."""
    known = docs.where("lang is not null and text is not null and text <> ''")
    order = F.xxhash64("doc_id", F.octet_length("text"), F.crc32("text"))
    # The hashes are picked first, so that no task gathers texts but those of the sample; equal rows count once.
    picked = store(known.select(order.alias("o")).distinct().orderBy("o").limit(labelled_rows))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [bucket_counts(t) for t in batch.column("text").to_pylist()]
            lists = [pa.array([f[i].astype(np.int32) for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("lang"), *lists], ["o", "lang", "buckets", "counts"])

    sample = known.select(order.alias("o"), "lang", "text").join(F.broadcast(picked), "o")
    made = sample.mapInArrow(counted, "o long, lang string, buckets array<int>, counts array<int>").toArrow().combine_chunks()
    ids, names = made["o"].to_pylist(), made["lang"].to_pylist()
    ends = np.concatenate([[0], np.cumsum([len(x) for x in made["buckets"]])]).astype(np.int64)
    flat = [np.concatenate([c.flatten().to_numpy() for c in made[k].chunks] or [np.zeros(0, np.int32)]) for k in ("buckets", "counts")]
    first = {ids[i]: i for i in sorted(range(len(ids)), key=lambda i: (ids[i], names[i]), reverse=True)}
    picks = [first[o] for o in sorted(first)]
    return train([tuple(x[ends[i] : ends[i + 1]] for x in flat) for i in picks], [names[i] for i in picks])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with language (struct: lang, score, accepted) of every whole text; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, accepted boolean")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in texts:
            found = [m.predict(t) for t in batch]
            yield pd.DataFrame({
                "lang": [x[0] for x in found], "score": [x[1] for x in found],
                "accepted": [x[0] != "und" and x[1] >= m.least for x in found],
            })

    return docs.withColumn("language", of("text"))

"""Approximate nearest neighbours by cosine: learned partitions of a neighbour graph, exact rerank.

1. A bounded sample (`sample_rows`, a documented parameter) is cut into equal parts that keep graph
   neighbours together: halving along main directions, then moves of vectors to the part most of their
   neighbours are in, as long as no part grows over its limit.
2. A small classifier (one hidden layer, numpy) learns the parts of a vector's neighbours and routes: every
   vector of the table is filed under its most probable part, a query goes to the `probes` most probable
   ones. `probes` is the smallest number that finds `aim` of the sample's own neighbours.
3. Within a part, exact cosines in double precision. Parts are split into chunks of members and of queries,
   so a part with a third of all rows is many tasks; equal vectors count once: of one vector only the
   `k` + 1 smallest ids can be among the `k` nearest of any query, so no others are filed (exact).

Defined results: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components, and rows without an id, take no part; rows that repeat id and vector are one;
candidates with the query's id are its own; ties go to the smaller id; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import store


@dataclass
class Router:
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row of unit vectors, in blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1024] = np.argsort(-near, axis=1, kind="stable")[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.15, rounds: int = 12) -> np.ndarray:
    """A part for each row: equal halves along main directions, then moves towards the neighbours' part."""
    part = np.zeros(len(x), np.int64)
    todo, made = [(np.arange(len(x)), parts)], 0
    while todo:
        rows, n = todo.pop()
        if n == 1:
            part[rows] = made
            made += 1
            continue
        y = x[rows] - x[rows].mean(0)
        direction = np.linalg.eigh(y.T @ y)[1][:, -1]
        order = rows[np.argsort(y @ direction, kind="stable")]
        cut = len(rows) * (n // 2) // n
        todo += [(order[cut:], n - n // 2), (order[:cut], n // 2)]
    limit = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        gain = votes.max(1) - votes[np.arange(len(x)), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if sizes[to] < limit:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i] = to
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def fit_router(x: np.ndarray, parts: int, k: int, aim: float, width: int = 128, epochs: int = 40, seed: int = 5) -> Router:
    """Learn to route unit vectors to the parts of their neighbours."""
    if len(x) <= k + 1 or parts <= 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, 10)
    part = balanced_parts(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    wanted[np.arange(len(x)), part] += 0.5
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    theta = [rng.normal(0, (2 / d) ** 0.5 * 3, (d, width)), np.zeros(width), rng.normal(0, width**-0.5, (width, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            pick = order[a : a + 256]
            h = np.maximum(x[pick] @ theta[0] + theta[1], 0)
            z = h @ theta[2] + theta[3]
            p = np.exp(z - z.max(1, keepdims=True))
            error = (p / p.sum(1, keepdims=True) - wanted[pick]) / len(pick)
            back = (error @ theta[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x[pick].T @ back, back.sum(0), h.T @ error, error.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                theta[i] -= 3e-3 * (1 - epoch / epochs) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    router = Router(*theta)
    # The sample's own neighbours are filed where the router files them: how many parts must a query see?
    z = router.logits(x)
    rank_of = np.argsort(np.argsort(-z, axis=1, kind="stable"), axis=1)
    seen = rank_of[np.repeat(np.arange(len(x)), min(k, graph.shape[1])), z.argmax(1)[graph[:, :k]].ravel()]
    router.probes = next(n for n in range(1, parts + 1) if (seen < n).mean() >= aim or n == parts)
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.coalesce(ok, F.lit(False)))
    length = sound.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return store(sound.where(F.size("v") == (length["n"] if length else 0)))


def _best(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The k best candidates of each query; cosines by products and sums in one fixed order."""
    xn, qn = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
    near = (q / qn[:, None]) @ (x / xn[:, None]).T
    near[qids[:, None] == ids[None, :]] = -np.inf
    most = min(k, len(ids)) - 1
    floor = -np.partition(-near, most, axis=1)[:, most] - 1e-9
    rows, cols = np.nonzero((near >= np.maximum(floor, -2)[:, None]))
    score = (q[rows] * x[cols]).sum(1) / (qn[rows] * xn[cols])
    order = np.lexsort((ids[cols], -score, rows))
    rows, cols, score = rows[order], cols[order], score[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return pd.DataFrame({"query_id": qids[rows[keep]], "vec_id": ids[cols[keep]], "score": score[keep]})


def search(
    vectors: DataFrame, is_query, k: int = 5, rows_per_part: int = 2048, sample_rows: int = 4096, aim: float = 0.97,
    chunk: int = 4096, max_parts: int = 128,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of the rows of `vectors` (vec_id, embedding) for which `is_query` holds."""
    table = usable(vectors)
    # Ids are picked first, so that no task gathers vectors but those of the sample.
    picked = store(table.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows))
    sample = table.join(F.broadcast(picked), "vec_id").groupBy("vec_id").agg(F.min("v").alias("v")).toPandas().sort_values("vec_id")
    if not len(sample):
        return table.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    x = np.stack(sample["v"].to_numpy())
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    x = np.unique(x, axis=0)
    parts = int(max(1, min(max_parts, len(x) // 32, -(-table.count() // rows_per_part))))
    shared = table.sparkSession.sparkContext.broadcast(fit_router(x, parts, k, aim))

    @F.pandas_udf("array<int>")
    def routes(v: pd.Series, n: pd.Series) -> pd.Series:
        router = shared.value
        order = np.argsort(-router.logits(np.stack(v.to_numpy())), axis=1, kind="stable")
        return pd.Series([o[: (router.probes if many else 1)].tolist() for o, many in zip(order, n)])

    routed = store(
        table.where(is_query).select("vec_id", "v", F.lit(True).alias("q")).distinct()
        .unionByName(
            table.distinct().withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
            .select("vec_id", "v", F.lit(False).alias("q"))
        ).withColumn("parts", routes("v", "q"))
    )
    placed = routed.withColumn("part", F.explode("parts")).drop("parts")
    sizes = {r["part"]: (r["m"] or 0, r["n"] or 0) for r in placed.groupBy("part").agg(F.sum((~F.col("q")).cast("int")).alias("m"), F.sum(F.col("q").cast("int")).alias("n")).collect()}
    split = lambda i: F.create_map(*[F.lit(y) for p, s in sizes.items() for y in (p, max(1, -(-s[i] // chunk)))])[F.col("part")]
    own = F.pmod(F.xxhash64("vec_id"), F.when(F.col("q"), F.col("nq")).otherwise(F.col("nm"))).cast("int")
    laid = (
        placed.withColumn("nm", split(0)).withColumn("nq", split(1)).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("q"), F.col("nm")).otherwise(F.col("nq")) - 1)))
        .select("vec_id", "v", "q", "part", F.when(F.col("q"), F.col("other")).otherwise(F.col("own")).alias("mc"), F.when(F.col("q"), F.col("own")).otherwise(F.col("other")).alias("qc"))
    )

    def rerank(group: pd.DataFrame) -> pd.DataFrame:
        asks, has = group[group["q"]], group[~group["q"]]
        if not len(asks) or not len(has):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        out = []
        members, ids = np.stack(has["v"].to_numpy()), has["vec_id"].to_numpy()
        for a in range(0, len(asks), 512):
            some = asks.iloc[a : a + 512]
            out.append(_best(ids, members, some["vec_id"].to_numpy(), np.stack(some["v"].to_numpy()), k))
        return pd.concat(out)

    found = laid.groupBy("part", "mc", "qc").applyInPandas(rerank, "query_id long, vec_id long, score double").distinct()
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.where(F.col("query_id") != F.col("vec_id")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )

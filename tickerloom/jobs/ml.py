"""Models on cohorts (rows A27-A29, A33, C28-C31): walk-forward regression, intervals, ranking ensembles.

Spark ML fits on the cluster; a walk-forward run is a short list of fits, one per
fold and seed. Trees take no missing values, so each feature is split into an
imputed value and a missing flag.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.jobs import cohort
from tickerloom.operators import ranks
from tickerloom.session import stage

MIN_HALF_WIDTH = 1e-6


# ---- winsorizing ------------------------------------------------------
def winsor_bounds(train: DataFrame, columns: Sequence[str], q: float) -> DataFrame:
    """(feature, low, high): quantile bounds of each column on the training rows."""
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in columns)
    long = train.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, x)")
    return ranks.exact_percentiles(long, ["feature"], "x", {"low": q, "high": 1 - q})


def winsorize(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clip by fitted bounds. The bounds are one row per feature, turned into one row and read as scalars."""
    wide = bounds.groupBy().pivot("feature", list(columns)).agg(F.max(F.struct("low", "high")))
    one = wide.select(F.struct(*columns)).scalar()
    row = df.withColumn("_b", one)

    def clipped(c: str) -> Column:
        low, high = F.col(f"_b.{c}.low"), F.col(f"_b.{c}.high")
        return F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), low), high))

    return row.withColumns({c: clipped(c) for c in columns}).drop("_b")


# ---- errors and intervals --------------------------------------------
def error_metrics(df: DataFrame, group: Sequence[str], y: str, pred: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """Mean and 90th percentile absolute error; with bounds also coverage and mean width."""
    err = df.withColumn("_ae", F.abs(F.col(y) - F.col(pred))).where("_ae IS NOT NULL")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("_ae").alias("mae")]
    if low and high:
        inside = (F.col(y) >= F.col(low)) & (F.col(y) <= F.col(high))
        aggs += [F.avg(inside.cast("double")).alias("interval_coverage"), F.avg(F.col(high) - F.col(low)).alias("interval_avg_width")]
    p90 = ranks.exact_percentiles(err, group, "_ae", {"p90_ae": 0.9})
    return ranks.join_on_keys(err.groupBy(*group).agg(*aggs), p90, group)


def _normalized(df: DataFrame, y: str, mid: str, low: str, high: str) -> DataFrame:
    half = F.greatest((F.col(high) - F.col(low)) / 2, F.lit(MIN_HALF_WIDTH))
    return df.withColumn("_ne", F.abs(F.col(y) - F.col(mid)) / half).where("_ne IS NOT NULL")


def interval_scales(
    train: DataFrame, group: Sequence[str], y: str, mid: str, low: str, high: str, coverage: float,
    min_samples: int, min_scale: float = 0.5, max_scale: float = 3.0,
) -> DataFrame:
    """(group, n, scale): factor on interval half-widths that reaches the coverage on training rows.

    Groups under min_samples are left out. An empty group list calibrates globally.
    """
    err = _normalized(train, y, mid, low, high)
    g = list(group)
    if not g:
        err, g = err.withColumn("_all", F.lit(0)), ["_all"]
    p = ranks.exact_percentiles(err, g, "_ne", {"scale": coverage})
    n = err.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_samples)
    out = ranks.join_on_keys(n, p, g, "inner")
    return out.select(*group, "n", N.clip("scale", min_scale, max_scale).alias("scale"))


def uncertainty_bucket(spread: str, q33: Column, q66: Column) -> Column:
    return F.when(F.col(spread) <= q33, "low").when(F.col(spread) <= q66, "mid").otherwise("high")


def regime_scales(
    train: DataFrame, test: DataFrame, industry: str, spread: str, y: str, mid: str, low: str, high: str,
    coverage: float, min_samples: int,
) -> DataFrame:
    """Test rows with the scale of their industry and uncertainty bucket, else the global one."""
    cuts = ranks.exact_percentiles(train.withColumn("_k", F.lit(0)), ["_k"], spread, {"a": 0.33, "b": 0.66})
    a, b = cuts.select("a").scalar(), cuts.select("b").scalar()

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("regime", F.concat_ws("__", F.coalesce(F.col(industry).cast("string"), F.lit("unknown")), uncertainty_bucket(spread, a, b)))

    per = stage(interval_scales(keyed(train), ["regime"], y, mid, low, high, coverage, min_samples))
    if per.limit(1).count() == 0:
        raise ValueError(f"no regime has {min_samples} training rows")
    everywhere = interval_scales(train, [], y, mid, low, high, coverage, min_samples).select("scale").scalar()
    joined = keyed(test).join(per.select("regime", F.col("scale").alias("_s")), "regime", "left")
    return joined.withColumn("scale", F.coalesce("_s", everywhere, F.lit(1.0))).drop("_s")


def monotone_scales(
    train: DataFrame, spread: str, y: str, mid: str, low: str, high: str, coverage: float, bins: int,
    min_bin_samples: int, min_scale: float = 0.5, max_scale: float = 3.0,
) -> DataFrame:
    """(bin, low_edge, high_edge, scale) over uncertainty bins, made non-decreasing by a running maximum."""
    err = _normalized(train, y, mid, low, high).where(F.col(spread).isNotNull()).withColumn("_k", F.lit(0))
    edges = ranks.quantile_edges(err, ["_k"], spread, bins).select("edges").scalar()
    df = err.withColumn("_e", edges)
    last = F.size("_e") - 1
    at = F.least(F.size(F.filter("_e", lambda e: F.col(spread) >= e)), last)
    df = df.withColumn("bin", at)
    p = ranks.exact_percentiles(df, ["bin"], "_ne", {"scale": coverage})
    n = df.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.max("_e").alias("_e")).where(F.col("n") >= min_bin_samples)
    w = Window.partitionBy(F.lit(0)).orderBy("bin")
    clipped = ranks.join_on_keys(n, p, ["bin"], "inner").withColumn("scale", N.clip("scale", min_scale, max_scale))
    running = F.max("scale").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return clipped.select(
        "bin", F.element_at("_e", F.col("bin")).alias("low_edge"), F.element_at("_e", F.col("bin") + 1).alias("high_edge"), "n", running.alias("scale")
    )


def scale_by_bins(test: DataFrame, bins: DataFrame, spread: str, everywhere: float | Column = 1.0) -> DataFrame:
    """Test rows with the scale of their uncertainty bin.

    Bins are closed below and open above, the last one closed on both sides. Below the first and above
    the last the nearest bin holds; in a gap between bins, and without a spread, the global scale does.
    Fewer than two bins cannot be monotone: the job fails.
    """
    listed = stage(bins.groupBy().agg(F.sort_array(F.collect_list(F.struct("low_edge", "high_edge", "scale"))).alias("b")))
    if listed.where("size(b) >= 2").count() == 0:
        raise ValueError("fewer than two bins have enough rows")
    df = test.withColumn("_b", listed.select("b").scalar())
    x, first, last = F.col(spread), F.get("_b", F.lit(0)), F.element_at("_b", -1)
    inside = F.filter("_b", lambda b: (x >= b["low_edge"]) & ((x < b["high_edge"]) | ((b["high_edge"] == last["high_edge"]) & (x == last["high_edge"]))))
    glob = everywhere if isinstance(everywhere, Column) else F.lit(everywhere)
    scale = (
        F.when(x.isNull() | F.isnan(x), glob).when(F.size(inside) > 0, F.get(inside, F.lit(0))["scale"])
        .when(x < first["low_edge"], first["scale"]).when(x > last["high_edge"], last["scale"]).otherwise(glob)
    )
    return df.withColumn("scale", scale).drop("_b")


# ---- regression -------------------------------------------------------
def model_pipeline(features: Sequence[str], label: str, seed: int, rounds: int = 30, depth: int = 4) -> Pipeline:
    """Median imputation, missing flags and gradient-boosted trees on the absolute error."""
    filled = [f"{c}_filled" for c in features]
    flags = [f"{c}_missing" for c in features]
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=[*filled, *flags], outputCol="features"),
        GBTRegressor(labelCol=label, lossType="absolute", maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=0.8, predictionCol="prediction"),
    ])


def with_missing_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features}).withColumns(
        {f"{c}_missing": F.col(c).isNull().cast("double") for c in features}
    )


def fit(train: DataFrame, features: Sequence[str], label: str, seed: int = 42, **settings: int) -> PipelineModel:
    return model_pipeline(features, label, seed, **settings).fit(with_missing_flags(train, features))


def fit_seeds(train: DataFrame, features: Sequence[str], label: str, seeds: Sequence[int], at_once: int = 4, **settings: int) -> tuple[PipelineModel, dict[int, Model]]:
    """What `fit` does for several seeds, a few at a time: rows are imputed and assembled once, and held while the trees are grown."""
    flagged = with_missing_flags(train, features)
    *before, _ = model_pipeline(features, label, seeds[0], **settings).getStages()
    shared = Pipeline(stages=before).fit(flagged)
    ready = shared.transform(flagged).select("features", label).persist()
    try:
        with ThreadPoolExecutor(at_once) as pool:
            trees = pool.map(lambda s: model_pipeline(features, label, s, **settings).getStages()[-1].fit(ready), seeds)
            return shared, dict(zip(seeds, trees))
    finally:
        ready.unpersist()


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    scored = model.transform(with_missing_flags(df, features))
    return scored.select(*df.columns, F.col("prediction").alias(out))


def each_fit(fits: Sequence[Callable[[], DataFrame]], at_once: int = 4) -> DataFrame:
    """The union of the results of independent fits, a few of which run at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        parts = list(pool.map(lambda f: f(), fits))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def walk_forward(
    df: DataFrame, features: Sequence[str], label: str, fold: str, folds: Sequence, seed: int = 42, public: str | None = None,
    winsor: float | None = None, **settings: int,
) -> DataFrame:
    """Each fold predicted by a model fitted on all earlier folds only, next to the training median.

    `public` names the day a label became public: a fold trains on labels public before its first
    cohort (`playbook_date`) only. With `winsor`, features are clipped at that share and its
    complement of the training rows.
    """
    starts = {r[fold]: r["d"] for r in df.where(F.col(fold).isin(list(folds))).groupBy(fold).agg(F.min("playbook_date").alias("d")).collect()} if public else {}

    def one(value) -> DataFrame:
        train = df.where((F.col(fold) < value) & F.col(label).isNotNull())
        if public:
            train = train.where(F.col(public) < starts[value])
        test = df.where(F.col(fold) == value)
        median = ranks.exact_percentiles(train.withColumn("_k", F.lit(0)), ["_k"], label, {"m": 0.5}).select("m").scalar()
        if winsor is not None:
            bounds = winsor_bounds(train, list(features), winsor)
            train, test = winsorize(train, bounds, list(features)), winsorize(test, bounds, list(features))
        model = fit(train, features, label, seed, **settings)
        return predict(model, test, features).withColumn("train_median", median)

    return each_fit([lambda v=v: one(v) for v in folds])


# ---- ranking ensemble -------------------------------------------------
def rank_labels(panel: DataFrame, ret: str = "fwd_return_pct", bins: int = 5) -> DataFrame:
    """Return quintile within the cohort as a relevance label; a cohort that cannot be cut fails the job."""
    df = ranks.with_quantile_bucket(panel, ["playbook_date"], ret, bins, "label")
    label = F.when(F.col("label").isNotNull() | F.col(ret).isNull(), F.col("label").cast("double")).otherwise(
        F.raise_error(F.concat(F.lit("returns too concentrated to bin in cohort "), F.col("playbook_date"))).cast("double")
    )
    return df.withColumn("label", label)


def member_scores(
    panel: DataFrame, candidates: DataFrame, features: Sequence[str], targets: Sequence[str | tuple[str, str]], seeds: Sequence[int], **settings: int,
) -> DataFrame:
    """(playbook_date, symbol, model, score): candidates of each target cohort scored by a model per seed, fitted on strictly earlier cohorts.

    Targets that follow one another in a list of `targets` given as (fit date, target) pairs share a model. The seeds of
    a fit date share its training rows and one reading of its candidates.
    """
    pairs = [t if isinstance(t, tuple) else (t, t) for t in targets]
    served: dict[str, list[str]] = {}
    for fitted, target in pairs:
        if fitted > target:
            raise ValueError(f"cohort {target} would be scored by a later model")
        served.setdefault(fitted, []).append(target)

    def one(fitted: str) -> DataFrame:
        train = panel.where((F.col("playbook_date") < fitted) & F.col("label").isNotNull())
        shared, trees = fit_seeds(train, features, "label", seeds, **settings)
        scored = shared.transform(with_missing_flags(candidates.where(F.col("playbook_date").isin(served[fitted])), features))
        scored = scored.select("playbook_date", "symbol", "features")
        for seed, model in trees.items():
            scored = model.setPredictionCol(f"_score_{seed}").transform(scored)
        members = [F.struct(F.lit(seed).alias("model"), F.col(f"_score_{seed}").alias("score")) for seed in trees]
        return scored.select("playbook_date", "symbol", F.inline(F.array(*members)))

    return each_fit([lambda f=f: one(f) for f in served], at_once=1)


def combined_members(members: DataFrame, seeds: Sequence[int], agg: str = "score") -> DataFrame:
    """The ensemble of these seeds' members."""
    combined = cohort.combine_scores(members.where(F.col("model").isin(list(seeds))), agg)
    return combined.withColumn("scored_by_ensemble_seeds", F.lit(",".join(str(s) for s in seeds)))


def ensemble_scores(
    panel: DataFrame, candidates: DataFrame, features: Sequence[str], targets: Sequence[str | tuple[str, str]], seeds: Sequence[int],
    agg: str = "score", **settings: int,
) -> DataFrame:
    """Candidates of each target cohort scored by a K-seed ensemble of `member_scores`."""
    return combined_members(member_scores(panel, candidates, features, targets, seeds, **settings), seeds, agg)


def importance_table(spark: SparkSession, models: dict[str, PipelineModel], features: Sequence[str]) -> DataFrame:
    """(model, feature, gain_pct): tree importances, the missing flag counted with its feature.

    One row per model and feature: the size is that of the feature list.
    """
    rows = []
    for name, model in models.items():
        gains = model.stages[-1].featureImportances.toArray()
        k = len(features)
        rows += [(name, f, float(gains[i] + gains[i + k]) * 100) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "model string, feature string, gain_pct double")


def importance_drift(table: DataFrame, models: Sequence[str]) -> DataFrame:
    """Importances across models side by side, with the change from first to last."""
    wide = table.groupBy("feature").pivot("model", list(models)).agg(F.max("gain_pct"))
    return wide.withColumn("drift", F.col(f"`{models[-1]}`") - F.col(f"`{models[0]}`"))


def ensemble_verdict(cells: DataFrame, keys: Sequence[str], metric: str, baseline: float, spread_target: float = 0.10, fail_below: float = 0.05) -> DataFrame:
    """Centre and spread of disjoint seed groups: pass when tight and not below the baseline."""
    agg = cells.groupBy(*keys).agg(F.avg(metric).alias("center"), (F.max(metric) - F.min(metric)).alias("spread"), F.count(metric).alias("groups"))
    ok = (F.col("spread") < spread_target) & (F.col("center") >= baseline - fail_below)
    return agg.withColumn("verdict", F.when(ok, "pass").otherwise("fail"))

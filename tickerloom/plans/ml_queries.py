"""Queries over model evaluation, intervals and walk-forward fits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.jobs import cohort, ml, performance as perf
from tickerloom.plans import views as V
from tickerloom.plans.cohort_queries import _EPS, _members
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.performance_queries import FEATURES
from tickerloom.plans.registry import query
from tickerloom.plans.series_queries import _round_all
from tickerloom.session import stage

R = N.rnd

# predictions: last year's quarter; the interval widens with the recent change of EPS
_PRED = f"""WITH {_EPS}, pred AS (SELECT e.playbook_date, substr(e.playbook_date, 1, 4) AS year, e.symbol, i.industry, rnd(target_eps, 6) AS y, rnd(ly_target_eps, 6) AS mid, rnd(abs(anchor_eps - pre_anchor_eps), 6) AS spread,
   rnd(ly_target_eps - abs(anchor_eps - pre_anchor_eps), 6) AS low, rnd(ly_target_eps + abs(anchor_eps - pre_anchor_eps), 6) AS high
  FROM eps e JOIN issued i ON i.symbol = e.symbol WHERE target_eps IS NOT NULL AND ly_target_eps IS NOT NULL AND anchor_eps IS NOT NULL AND pre_anchor_eps IS NOT NULL),
 err AS (SELECT *, abs(y - mid) / greatest((high - low) / 2, 1e-6) AS ne FROM pred)"""


def _predictions(spark, sf):
    e = cohort.eps_history(V.quarterly(spark, sf), V.playbook(spark, sf)).join(V.issued(spark, sf).select("symbol", "industry"), "symbol")
    e = e.where("target_eps IS NOT NULL AND ly_target_eps IS NOT NULL AND anchor_eps IS NOT NULL AND pre_anchor_eps IS NOT NULL")
    move = F.abs(F.col("anchor_eps") - F.col("pre_anchor_eps"))
    return stage(e.select(
        "playbook_date", F.substring("playbook_date", 1, 4).alias("year"), "symbol", "industry", R("target_eps", 6).alias("y"), R("ly_target_eps", 6).alias("mid"),
        R(move, 6).alias("spread"), R(F.col("ly_target_eps") - move, 6).alias("low"), R(F.col("ly_target_eps") + move, 6).alias("high"),
    ))


@query("error_metrics", "A27", with_views(_PRED + """ SELECT year, count(*) AS n, rnd(avg(abs(y - mid)), 6) AS mae, rnd(avg((y >= low AND y <= high)::INT), 6) AS interval_coverage, rnd(avg(high - low), 6) AS interval_avg_width,
 rnd(quantile_cont(abs(y - mid), 0.9), 6) AS p90_ae FROM pred GROUP BY 1"""))
def error_metrics(spark, sf):
    return _round_all(ml.error_metrics(_predictions(spark, sf), ["year"], "y", "mid", "low", "high"), 6)


@query("interval_scale_by_year", "A28", with_views(_PRED + " SELECT year, count(*) AS n, rnd(least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0), 6) AS scale FROM err GROUP BY 1 HAVING count(*) >= 30"))
def interval_scale_by_year(spark, sf):
    return _round_all(ml.interval_scales(_predictions(spark, sf), ["year"], "y", "mid", "low", "high", 0.8, 30), 6)


@query("interval_scale_global", "A28", with_views(_PRED + " SELECT count(*) AS n, rnd(least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0), 6) AS scale FROM err"))
def interval_scale_global(spark, sf):
    return _round_all(ml.interval_scales(_predictions(spark, sf), [], "y", "mid", "low", "high", 0.8, 30), 6)


_TRAIN = "tr AS (SELECT * FROM err WHERE year < '2000'), te AS (SELECT * FROM err WHERE year >= '2000')"


@query("interval_scale_regimes", "A28", with_views(_PRED + f""", {_TRAIN}, c AS (SELECT quantile_cont(spread, 0.33) AS a, quantile_cont(spread, 0.66) AS b FROM tr),
 k AS (SELECT industry || '__' || CASE WHEN spread <= a THEN 'low' WHEN spread <= b THEN 'mid' ELSE 'high' END AS regime, ne FROM tr, c), g AS (SELECT regime, least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0) AS s FROM k GROUP BY 1 HAVING count(*) >= 60)
SELECT te.playbook_date, te.symbol, industry || '__' || CASE WHEN spread <= a THEN 'low' WHEN spread <= b THEN 'mid' ELSE 'high' END AS regime, rnd(coalesce(g.s, (SELECT least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0) FROM tr)), 6) AS scale
FROM te CROSS JOIN c LEFT JOIN g ON g.regime = industry || '__' || CASE WHEN spread <= a THEN 'low' WHEN spread <= b THEN 'mid' ELSE 'high' END"""))
def interval_scale_regimes(spark, sf):
    p = _predictions(spark, sf)
    df = ml.regime_scales(p.where("year < '2000'"), p.where("year >= '2000'"), "industry", "spread", "y", "mid", "low", "high", 0.8, 60)
    return df.select("playbook_date", "symbol", "regime", R("scale", 6).alias("scale"))


@query("interval_scale_monotone", "A28", with_views(_PRED + """, e AS (SELECT list_sort(list_distinct(quantile_cont(spread, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS ed FROM err),
 b AS (SELECT least(len(list_filter(ed, lambda x: spread >= x)), len(ed) - 1) AS bin, ne, ed FROM err, e), g AS (SELECT bin, any_value(ed) AS ed, count(*) AS n, least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0) AS s FROM b GROUP BY 1 HAVING count(*) >= 20)
SELECT bin, rnd(ed[bin], 6) AS low_edge, rnd(ed[bin + 1], 6) AS high_edge, n, rnd(max(s) OVER (ORDER BY bin), 6) AS scale FROM g"""))
def interval_scale_monotone(spark, sf):
    return _round_all(ml.monotone_scales(_predictions(spark, sf), "spread", "y", "mid", "low", "high", 0.8, 5, 20), 6)


_BINS = _PRED + f""", {_TRAIN}, e AS (SELECT list_sort(list_distinct(quantile_cont(spread, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS ed FROM tr),
 b AS (SELECT least(len(list_filter(ed, lambda x: spread >= x)), len(ed) - 1) AS bin, ne, ed FROM tr, e), g AS (SELECT bin, any_value(ed) AS ed, least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0) AS s FROM b GROUP BY 1 HAVING count(*) >= 20),
 m AS (SELECT ed[bin] AS lo, ed[bin + 1] AS hi, max(s) OVER (ORDER BY bin) AS s FROM g), o AS (SELECT min(lo) AS lo, max(hi) AS hi, min(s) AS s0, max(s) AS s1 FROM m), gl AS (SELECT least(greatest(quantile_cont(ne, 0.8), 0.5), 3.0) AS s FROM tr)"""


@query("interval_scale_rows", "A28", with_views(_BINS + """
SELECT te.playbook_date, te.symbol, rnd(CASE WHEN spread < o.lo THEN o.s0 WHEN spread > o.hi THEN o.s1 ELSE coalesce(m.s, gl.s) END, 6) AS scale
FROM te CROSS JOIN o CROSS JOIN gl LEFT JOIN m ON te.spread >= m.lo AND (te.spread < m.hi OR (m.hi = o.hi AND te.spread = o.hi))"""))
def interval_scale_rows(spark, sf):
    """Scales fitted on earlier years, applied to each later row."""
    p = _predictions(spark, sf)
    train, test = p.where("year < '2000'"), p.where("year >= '2000'")
    bins = ml.monotone_scales(train, "spread", "y", "mid", "low", "high", 0.8, 5, 20)
    everywhere = ml.interval_scales(train, [], "y", "mid", "low", "high", 0.8, 1).select("scale").scalar()
    return ml.scale_by_bins(test, bins, "spread", everywhere).select("playbook_date", "symbol", R("scale", 6).alias("scale"))


@query("winsorized_features", "A29 P14", with_views("""
WITH b AS (SELECT quantile_cont(ml_score, 0.05) AS sl, quantile_cont(ml_score, 0.95) AS sh, quantile_cont(qty, 0.05) AS ql, quantile_cont(qty, 0.95) AS qh FROM scored_base WHERE playbook_date < '2000-01-01')
SELECT playbook_date, symbol, rnd(least(greatest(ml_score, sl), sh), 6) AS ml_score, rnd(least(greatest(qty, ql), qh), 6) AS qty FROM scored_base, b WHERE playbook_date >= '2000-01-01'"""))
def winsorized_features(spark, sf):
    base = V.scored_base(spark, sf).select("playbook_date", "symbol", "ml_score", "qty")
    bounds = ml.winsor_bounds(base.where("playbook_date < '2000-01-01'"), ["ml_score", "qty"], 0.05)
    return _round_all(ml.winsorize(base.where("playbook_date >= '2000-01-01'"), bounds, ["ml_score", "qty"]), 6)


@query("ensemble_verdict", "A33 C31", with_views("""
WITH m AS (SELECT substr(playbook_date, 1, 4) AS year, unnest(['a', 'b', 'c']) AS model, unnest([ml_score, qty, disc * 1000]) AS score FROM scored_base), c AS (SELECT year, model, avg(score) / stddev_samp(score) AS sharpe FROM m GROUP BY 1, 2)
SELECT year, rnd(avg(sharpe), 6) AS center, rnd(max(sharpe) - min(sharpe), 6) AS spread, count(*) AS groups, CASE WHEN max(sharpe) - min(sharpe) < 0.9 AND avg(sharpe) >= 1.65 THEN 'pass' ELSE 'fail' END AS verdict FROM c GROUP BY 1"""))
def ensemble_verdict(spark, sf):
    cells = _members(spark, sf).groupBy(F.substring("playbook_date", 1, 4).alias("year"), "model").agg((F.avg("score") / F.stddev_samp("score")).alias("sharpe"))
    return _round_all(ml.ensemble_verdict(cells, ["year"], "sharpe", 1.7, 0.9, 0.05), 6)


# ---- fits (rows only) -------------------------------------------------
EPS_FEATURES = ["ly_target_eps", "anchor_eps", "pre_anchor_eps", "ly_anchor_eps"]


def _years(df):
    """The years of a table's cohorts, of which there are a few, without the first two (features look back a year, models one more)."""
    return sorted(r[0] for r in df.select(F.substring("playbook_date", 1, 4)).distinct().collect())[2:]


@query("eps_walk_forward", "C28 A27 A29")
def eps_walk_forward(spark, sf):
    """EPS change regressed on earlier years, every year, on labels public by then, against two baselines."""
    cal = V.playbook(spark, sf)
    e = cohort.eps_history(V.quarterly(spark, sf), cal).join(cal.select("playbook_date", P.statutory_publish_date("target_q").alias("public")), "playbook_date")
    df = stage(e.withColumn("year", F.substring("playbook_date", 1, 4)).withColumn("delta_eps", F.col("target_eps") - F.col("anchor_eps")).where("delta_eps IS NOT NULL"))
    out = stage(ml.walk_forward(df, EPS_FEATURES, "delta_eps", "year", _years(df), public="public", winsor=0.01, rounds=20, depth=4).withColumn("zero", F.lit(0.0)))
    parts = [ml.error_metrics(out, ["year"], "delta_eps", c).withColumn("model", F.lit(n)) for n, c in (("gbt", "prediction"), ("anchor_eps", "zero"), ("train_median", "train_median"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _rank_panel(spark, sf):
    return stage(ml.rank_labels(stage(perf.forward_returns(V.scores(spark, sf), V.quotes(spark, sf), V.calendar(spark, sf)))))


def _targets(panel):
    """(fit date, target) of all cohorts but those of the first year: a model serves the cohorts of its year."""
    dates = sorted(r[0] for r in panel.select("playbook_date").distinct().collect())
    first = {d[:4]: d for d in reversed(dates)}
    return [(first[d[:4]], d) for d in dates if d[:4] != dates[0][:4]]


@query("ranking_ensemble", "C29 C11 C12 J19")
def ranking_ensemble(spark, sf):
    """All cohorts from the second year on, scored by a three-seed ensemble fitted on the years before."""
    panel = _rank_panel(spark, sf)
    return ml.ensemble_scores(panel, panel.select("playbook_date", "symbol", *FEATURES), FEATURES, _targets(panel), [1, 2, 3], "rank", rounds=5, depth=3)


@query("importance_drift", "C30")
def importance_drift(spark, sf):
    panel = _rank_panel(spark, sf)
    models = {d: ml.fit(panel.where((F.col("playbook_date") < d) & F.col("label").isNotNull()), FEATURES, "label", 42, rounds=5, depth=3) for d in dict.fromkeys(f for f, _ in _targets(panel))}
    return ml.importance_drift(ml.importance_table(spark, models, FEATURES), list(models))


@query("ensemble_validation", "C31 A33 C29")
def ensemble_validation(spark, sf):
    """Three disjoint seed groups, each run through the rotation of all cohorts and judged on its monthly Sharpe."""
    panel, days = _rank_panel(spark, sf), stage(V.calendar(spark, sf))
    rows = panel.select("playbook_date", "symbol", *FEATURES)
    entries = panel.select("playbook_date", "entry_date").distinct()
    groups = {"g1": [1, 2], "g2": [3, 4], "g3": [5, 6]}
    members = stage(ml.member_scores(panel, rows, FEATURES, _targets(panel), [s for seeds in groups.values() for s in seeds], rounds=5, depth=3))
    scored = {name: stage(ml.combined_members(members, seeds).select("playbook_date", "symbol", "ml_score").join(entries, "playbook_date")) for name, seeds in groups.items()}
    picked = stage(reduce(DataFrame.union, [perf.rotation_picks(s, [25]).select("symbol") for s in scored.values()]).distinct())
    quotes = stage(V.quotes(spark, sf, symbols=picked).select("date", "symbol", "open"))
    cells = []
    for name, seeds in groups.items():
        trades = stage(perf.rotation_trades(scored[name], quotes, [25], calendar=days))
        stats = perf.monthly_stats(perf.rotation_months(scored[name], quotes, trades, [25], calendar=days), "1996-01-11", "2001-11-16")
        cells.append(stats.select("monthly_sharpe", F.lit(name).alias("group"), F.lit(len(seeds)).alias("k")))
    return ml.ensemble_verdict(cells[0].unionByName(cells[1]).unionByName(cells[2]), ["k"], "monthly_sharpe", 0.0)

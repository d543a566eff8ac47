"""Queries that measure ranked cohorts: rotation, sweep, gate, regimes, buckets, correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.jobs import performance as perf
from tickerloom.operators import asof, ranks
from tickerloom.plans import views as V
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.registry import query
from tickerloom.plans.series_queries import _round_all
from tickerloom.session import stage

R = N.rnd
TOPS = (5, 10, 15, 20, 25, 30)

# ---- shared oracle text ----------------------------------------------
_SCHEDULE = """coh AS (SELECT playbook_date, min(entry_date) AS entry_date, count(*) AS size FROM scores GROUP BY 1),
 sched AS (SELECT *, lead(playbook_date) OVER (ORDER BY playbook_date) AS next_cohort, lead(close_date) OVER (ORDER BY playbook_date) AS exit_date,
    substr(playbook_date, 6, 2) NOT IN ('02', '03') AS opens
  FROM (SELECT *, (SELECT max(c.date) FROM calendar c WHERE c.date < coh.entry_date) AS close_date FROM coh))"""


def _first_open(points, day, days, where="true"):
    """SQL: first quote row per (symbol, day) up to `days` later."""
    return f"""(SELECT symbol, d, open FROM (SELECT p.symbol, p.d, q.open, row_number() OVER (PARTITION BY p.symbol, p.d ORDER BY q.date) AS rn
     FROM (SELECT DISTINCT symbol, {day} AS d FROM {points} WHERE {day} IS NOT NULL) p JOIN quotes q ON q.symbol = p.symbol AND q.date >= p.d
       AND CAST(q.date AS DATE) <= CAST(p.d AS DATE) + {days} AND {where}) WHERE rn = 1)"""


def _rotation(tops):
    tops = ", ".join(str(n) for n in tops)
    return f"""{_SCHEDULE},
 picks AS (SELECT s.playbook_date, s.symbol, s.ml_rank AS pick, h.entry_date, h.exit_date, h.next_cohort FROM scores s JOIN sched h ON s.playbook_date = h.playbook_date WHERE h.opens AND s.ml_rank <= 30),
 ins AS (SELECT * FROM {_first_open('picks', 'entry_date', 5)}),
 outs AS (SELECT * FROM {_first_open('picks', 'exit_date', 5)}),
 held AS (SELECT p.*, i.open AS ep, o.open AS xp, greatest(CAST(floor(100000 / i.open) AS BIGINT), 1) AS shares
   FROM picks p JOIN ins i ON i.symbol = p.symbol AND i.d = p.entry_date LEFT JOIN outs o ON o.symbol = p.symbol AND o.d = p.exit_date WHERE i.open IS NOT NULL),
 calc AS (SELECT *, rnd(ep * shares, 2) AS capital_used, (xp - ep) * shares AS gross,
    (ep * shares + xp * shares) * 0.001425::DOUBLE + xp * shares * 0.003::DOUBLE AS cost_raw FROM held),
 trades AS (SELECT t.n AS top_n, playbook_date, next_cohort, symbol, pick, entry_date, exit_date, ep AS entry_price, xp AS exit_price, shares, capital_used,
    rnd(gross, 2) AS gross_pnl, rnd(cost_raw, 2) AS cost, rnd(gross - cost_raw, 2) AS net_pnl, gross - cost_raw AS net_raw,
    rnd((gross - cost_raw) / capital_used * 100, 4) AS return_pct,
    CASE WHEN next_cohort IS NULL THEN 'still_open' WHEN xp IS NULL THEN 'no_quote_on_exit' ELSE 'monthly_rotation' END AS exit_reason
   FROM calc JOIN (SELECT unnest([{tops}]) AS n) t ON pick <= t.n)"""


_MONTHS = """months AS (SELECT b.top_n, b.playbook_date, b.exit_date, b.entry_date, b.entries, coalesce(o.c, 0) AS holdings_count, coalesce(o.cap, 0) AS portfolio_capital_deployed,
    coalesce(x.c, 0) AS exits, x.cp AS cohort_playbook_date, x.ce AS cohort_entry_date, coalesce(x.pnl, 0) AS realized_net_pnl, b.entries - coalesce(o.c, 0) AS entries_failed_no_quote
  FROM (SELECT n AS top_n, playbook_date, close_date AS exit_date, entry_date, CASE WHEN opens THEN least(size, n) ELSE 0 END AS entries FROM sched CROSS JOIN (SELECT unnest([{tops}]) AS n)) b
  LEFT JOIN (SELECT top_n, playbook_date, count(*) AS c, rnd(sum(capital_used), 2) AS cap FROM trades GROUP BY 1, 2) o ON o.top_n = b.top_n AND o.playbook_date = b.playbook_date
  LEFT JOIN (SELECT top_n, next_cohort, count(*) AS c, min(playbook_date) AS cp, min(entry_date) AS ce, rnd(sum(coalesce(net_raw, 0)), 2) AS pnl FROM trades WHERE next_cohort IS NOT NULL GROUP BY 1, 2) x
    ON x.top_n = b.top_n AND x.next_cohort = b.playbook_date)"""
_REGIME = """ix AS (SELECT date, avg(index_close) AS c FROM index_daily GROUP BY 1),
 reg AS (SELECT date, CASE WHEN m20 IS NULL OR m60 IS NULL THEN 'Sideways' WHEN m20 > m60 THEN 'Bull' WHEN m20 < m60 AND c < m20 THEN 'Bear' ELSE 'Sideways' END AS regime
   FROM (SELECT date, c, CASE WHEN count(*) OVER a >= 10 THEN avg(c) OVER a END AS m20, CASE WHEN count(*) OVER b >= 20 THEN avg(c) OVER b END AS m60
     FROM ix WINDOW a AS (ORDER BY date ROWS 19 PRECEDING), b AS (ORDER BY date ROWS 59 PRECEDING)))"""


def _trades(spark, sf, tops):
    scores, quotes = V.scores(spark, sf), V.quotes(spark, sf)
    return scores, quotes, stage(perf.rotation_trades(scores, quotes, tops, calendar=V.calendar(spark, sf)))


# ---- lookups ----------------------------------------------------------
@query("entry_days", "J8 X11", with_views("SELECT playbook_date, entry_date, (SELECT max(c.date) FROM calendar c WHERE c.date < entry_date) AS previous_day FROM entries"))
def entry_days(spark, sf):
    return asof.previous_trading_day(V.entries(spark, sf), V.calendar(spark, sf), "entry_date", "previous_day")


@query("asof_forward_valid_open", "J6", with_views(f"""
SELECT s.playbook_date, s.symbol, rnd(f.open, 6) AS open FROM scores s LEFT JOIN {_first_open('scores', 'entry_date', 7, 'q.open > 0')} f ON f.symbol = s.symbol AND f.d = s.entry_date"""))
def asof_forward_valid_open(spark, sf):
    valid = V.quotes(spark, sf).where("open > 0").select("symbol", "date", "open")
    df = asof.asof_forward(V.scores(spark, sf).select("playbook_date", "symbol", "entry_date"), valid, ["symbol"], "entry_date", "date", ["open"], 7)
    return df.select("playbook_date", "symbol", R("open", 6).alias("open"))


@query("asof_forward_first_row", "J7", with_views(f"""
SELECT s.playbook_date, s.symbol, rnd(f.open, 6) AS open FROM scores s LEFT JOIN {_first_open('scores', 'entry_date', 5)} f ON f.symbol = s.symbol AND f.d = s.entry_date"""))
def asof_forward_first_row(spark, sf):
    rows = V.quotes(spark, sf).select("symbol", "date", "open")
    df = asof.asof_forward(V.scores(spark, sf).select("playbook_date", "symbol", "entry_date"), rows, ["symbol"], "entry_date", "date", ["open"], 5)
    return df.select("playbook_date", "symbol", R("open", 6).alias("open"))


@query("latest_quote_as_of_cohort", "J5 W12 F4", with_views("""
WITH z AS (SELECT s.playbook_date, s.symbol, q.date, q.close, q.volume, row_number() OVER (PARTITION BY s.playbook_date, s.symbol ORDER BY q.date DESC) AS rn
  FROM scores s JOIN quotes q ON q.symbol = s.symbol AND q.date < s.playbook_date)
SELECT playbook_date, symbol, max(CASE WHEN rn = 1 THEN date END) AS quote_date, rnd(max(CASE WHEN rn = 1 THEN close END), 4) AS close,
  max(CASE WHEN rn = 1 THEN volume END) AS quote_volume, rnd(avg(volume), 4) AS avg_volume_20d, avg(volume) >= 25 AS liquid
FROM z WHERE rn <= 20 GROUP BY 1, 2"""))
def latest_quote_as_of_cohort(spark, sf):
    from tickerloom.jobs import cohort

    keys = V.scores(spark, sf).select("playbook_date", "symbol").withColumn("cutoff_date", F.date_format(F.date_sub(F.to_date("playbook_date"), 1), "yyyy-MM-dd"))
    df = cohort.latest_quotes(keys, V.quotes(spark, sf)).where("quote_date IS NOT NULL")
    liquid = F.coalesce(F.col("avg_volume_20d") >= 25, F.lit(False))
    return df.select(
        "playbook_date", "symbol", "quote_date", R("close", 4).alias("close"), "quote_volume", R("avg_volume_20d", 4).alias("avg_volume_20d"), liquid.alias("liquid")
    )


# ---- ranks ------------------------------------------------------------
@query("cohort_ranks", "W14 W15 W16", with_views("""
SELECT playbook_date, symbol, ml_rank, rank() OVER (PARTITION BY playbook_date ORDER BY qty) + (count(*) OVER (PARTITION BY playbook_date, qty) - 1) / 2.0::DOUBLE AS qty_rank,
  ceil(least(greatest(ceil(10 * (rank() OVER (PARTITION BY playbook_date ORDER BY qty) + (count(*) OVER (PARTITION BY playbook_date, qty) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY playbook_date)), 1), 10)) / 10.0::DOUBLE AS qty_decile
FROM scores"""))
def cohort_ranks(spark, sf):
    df = V.scores(spark, sf).select("playbook_date", "symbol", "ml_rank", "qty")
    df = ranks.with_average_rank(df, ["playbook_date"], "qty", "qty_rank")
    return ranks.with_decile(df, ["playbook_date"], "qty", "qty_decile").drop("qty")


_QCUT = """e AS (SELECT playbook_date, list_sort(list_distinct(quantile_cont({v}::DOUBLE, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM {t} GROUP BY 1),
 b AS (SELECT t.*, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: t.{v} > x)) AS bucket FROM {t} t JOIN e ON e.playbook_date = t.playbook_date WHERE len(e.edges) >= 2)"""


@query("quantile_buckets", "W19 C11", with_views(f"""
WITH {_QCUT.format(v='qty', t='scores')} SELECT playbook_date, symbol, bucket, count(*) OVER (PARTITION BY playbook_date) AS group_size FROM b"""))
def quantile_buckets(spark, sf):
    df = V.scores(spark, sf).select("playbook_date", "symbol", "qty")
    df = ranks.with_quantile_bucket(df, ["playbook_date"], "qty", 5, "bucket").where("bucket IS NOT NULL")
    sizes = df.groupBy("playbook_date").agg(F.count(F.lit(1)).alias("group_size"))
    return df.drop("qty").join(sizes, "playbook_date")


@query("cross_section_zscore", "W13 A20", with_views("""
SELECT s.playbook_date, s.symbol, rnd((ml_score - avg(ml_score) OVER w) / nullif(stddev_samp(ml_score) OVER w, 0), 4) AS z
FROM scores s JOIN issued i ON i.symbol = s.symbol WINDOW w AS (PARTITION BY s.playbook_date, i.industry)"""))
def cross_section_zscore(spark, sf):
    df = V.scores(spark, sf).join(V.issued(spark, sf), "symbol")
    return ranks.with_zscore(df, ["playbook_date", "industry"], "ml_score", "z").select("playbook_date", "symbol", R("z", 4).alias("z"))


@query("walk_forward_percentile", "W17 X18", with_views("""
WITH p AS (SELECT playbook_date, quantile_cont(ml_score, 0.9) AS p90 FROM scores GROUP BY 1)
SELECT a.playbook_date, rnd(a.p90, 6) AS p90, rnd((SELECT avg(CASE WHEN b.p90 <= a.p90 THEN 1.0 ELSE 0 END) FROM p b WHERE b.playbook_date < a.playbook_date), 6) AS wf_pct FROM p a"""))
def walk_forward_percentile(spark, sf):
    from pyspark.sql import Window

    from tickerloom.operators import windows as W

    p = ranks.exact_percentiles(V.scores(spark, sf), ["playbook_date"], "ml_score", {"p90": 0.9})
    w = Window.partitionBy(F.lit(0)).orderBy("playbook_date")
    return p.select("playbook_date", R("p90", 6).alias("p90"), R(W.prior_share_at_most("p90", w), 6).alias("wf_pct"))


@query("score_distribution", "A7 T1 W24", with_views("""
SELECT playbook_date, count(*) AS n_candidates, rnd(min(ml_score), 6) AS min, rnd(quantile_cont(ml_score, 0.1), 6) AS p10, rnd(quantile_cont(ml_score, 0.25), 6) AS p25,
 rnd(median(ml_score), 6) AS median, rnd(quantile_cont(ml_score, 0.75), 6) AS p75, rnd(quantile_cont(ml_score, 0.9), 6) AS p90, rnd(max(ml_score), 6) AS max,
 rnd(avg(ml_score), 6) AS mean, rnd(stddev_samp(ml_score), 6) AS std, rnd(avg(CASE WHEN ml_rank <= 10 THEN ml_score END), 6) AS top10_mean
FROM scores GROUP BY 1"""))
def score_distribution(spark, sf):
    return _round_all(perf.score_distribution(V.scores(spark, sf)), 6)


@query("score_drift", "A8", with_views("""
WITH d AS (SELECT playbook_date, median(ml_score) AS median, quantile_cont(ml_score, 0.9) AS p90, max(ml_score) AS max FROM scores GROUP BY 1),
 l AS (SELECT row_number() OVER (PARTITION BY metric ORDER BY playbook_date) AS rn, count(*) OVER (PARTITION BY metric) AS n, metric, v FROM (UNPIVOT d ON median, p90, max INTO NAME metric VALUE v))
SELECT metric, rnd(avg(CASE WHEN rn <= n // 3 THEN v END), 4) AS early_mean, rnd(avg(CASE WHEN rn > n - n // 3 THEN v END), 4) AS recent_mean,
 rnd(avg(CASE WHEN rn > n - n // 3 THEN v END) - avg(CASE WHEN rn <= n // 3 THEN v END), 4) AS delta,
 rnd((avg(CASE WHEN rn > n - n // 3 THEN v END) - avg(CASE WHEN rn <= n // 3 THEN v END)) / stddev_samp(v), 4) AS delta_in_std FROM l GROUP BY 1"""))
def score_drift(spark, sf):
    dist = perf.score_distribution(V.scores(spark, sf))
    return _round_all(perf.score_drift(dist, ["median", "p90", "max"]), 4)


# ---- rotation ---------------------------------------------------------
@query("rotation_trades", "C13 W24 J7 J8 P22 F9", with_views(f"""
WITH {_rotation((10, 30))} SELECT top_n, playbook_date, next_cohort, symbol, pick, entry_date, exit_date, rnd(entry_price, 6) AS entry_price, rnd(exit_price, 6) AS exit_price, shares,
 capital_used, gross_pnl, cost, net_pnl, return_pct, exit_reason FROM trades"""))
def rotation_trades(spark, sf):
    _, _, trades = _trades(spark, sf, (10, 30))
    return trades.drop("_net").withColumns({"entry_price": R("entry_price", 6), "exit_price": R("exit_price", 6)})


@query("rotation_months", "C13 C15 A6 W20", with_views(f"""
WITH {_rotation((10,))}, {_MONTHS.format(tops=10)}, {_REGIME}
SELECT m.*, coalesce(r.regime, 'Sideways') AS regime FROM months m ASOF LEFT JOIN reg r ON m.entry_date >= r.date"""))
def rotation_months(spark, sf):
    scores, quotes, trades = _trades(spark, sf, (10,))
    return perf.rotation_months(scores, quotes, trades, (10,), V.index_daily(spark, sf), V.calendar(spark, sf))


_STATS = """stats AS (SELECT top_n, sum((exit_reason = 'monthly_rotation')::INT) AS total_closed_trades, sum((exit_reason = 'monthly_rotation' AND net_pnl > 0)::INT) AS win_count,
 sum((exit_reason = 'monthly_rotation' AND net_pnl < 0)::INT) AS loss_count, sum((exit_reason = 'still_open')::INT) AS still_open_count, sum((exit_reason = 'no_quote_on_exit')::INT) AS no_quote_count,
 rnd(sum(net_pnl) FILTER (exit_reason = 'monthly_rotation'), 2) AS total_net_pnl, rnd(sum(gross_pnl) FILTER (exit_reason = 'monthly_rotation'), 2) AS total_gross_pnl,
 rnd(sum(cost) FILTER (exit_reason = 'monthly_rotation'), 2) AS total_cost, rnd(avg(return_pct) FILTER (exit_reason = 'monthly_rotation'), 4) AS avg_return_pct,
 rnd(median(return_pct) FILTER (exit_reason = 'monthly_rotation'), 4) AS median_return_pct FROM trades GROUP BY 1)"""


@query("trade_stats", "A14 C14", with_views(f"""
WITH {_rotation(TOPS)}, {_STATS} SELECT *, rnd(win_count / total_closed_trades, 4) AS win_rate FROM stats"""))
def trade_stats(spark, sf):
    return perf.trade_stats(_trades(spark, sf, TOPS)[2])


_RET_STATS = """count(*) AS n_cohorts, rnd(sum({p}), 2) AS total_pnl, rnd(avg({r}), 4) AS mean_monthly_return_pct, rnd(stddev_samp({r}), 4) AS std_monthly_return_pct,
 rnd(CASE WHEN stddev_samp({r}) > 0 THEN avg({r}) / stddev_samp({r}) * sqrt(12) END, 4) AS sharpe_annual, rnd(avg(({r} > 0)::INT), 4) AS positive_months_pct,
 rnd(min({r}), 4) AS worst_month_return_pct, rnd(min(dd), 2) AS max_drawdown_pnl"""


@query("monthly_performance", "A15 C14 K16", with_views(f"""
WITH {_rotation((10, 20))}, {_MONTHS.format(tops='10, 20')},
 r AS (SELECT top_n, realized_net_pnl / (top_n * 100000) AS r FROM months WHERE cohort_playbook_date IS NOT NULL),
 a AS (SELECT top_n, count(*) AS n, avg(r) AS m, stddev_samp(r) AS sd, min(r) AS lo, max(r) AS hi, sum((r > 0)::INT) AS win FROM r GROUP BY 1),
 y AS (SELECT date_diff('day', DATE '1995-01-11', DATE '2001-11-16') / 365.25::DOUBLE AS years)
SELECT top_n, n AS cohort_count, rnd(m * 100, 4) AS mean_monthly_return_pct, rnd(sd * 100, 4) AS std_monthly_return_pct, rnd(lo * 100, 4) AS worst_month_return_pct,
 rnd(hi * 100, 4) AS best_month_return_pct, win AS win_months, rnd(m / sd, 4) AS monthly_sharpe, rnd(sqrt(n / years), 4) AS annualization_factor,
 rnd(m / sd * sqrt(n / years), 4) AS monthly_sharpe_annualized FROM a CROSS JOIN y"""))
def monthly_performance(spark, sf):
    scores, quotes, trades = _trades(spark, sf, (10, 20))
    months = perf.rotation_months(scores, quotes, trades, (10, 20), calendar=V.calendar(spark, sf))
    return perf.monthly_stats(months, "1995-01-11", "2001-11-16")


@query("top_n_sweep", "C16 A16 W18", with_views(f"""
WITH {_rotation(TOPS)}, {_MONTHS.format(tops=', '.join(map(str, TOPS)))}, {_STATS},
 c AS (SELECT *, realized_net_pnl / (top_n * 100000) * 100 AS r, sum(realized_net_pnl) OVER (PARTITION BY top_n ORDER BY playbook_date) AS cum FROM months),
 d AS (SELECT *, cum - max(cum) OVER (PARTITION BY top_n ORDER BY playbook_date) AS dd FROM c),
 s AS (SELECT top_n, {_RET_STATS.format(r='r', p='realized_net_pnl')} FROM d GROUP BY 1)
SELECT s.*, total_closed_trades AS trades, rnd(win_count / total_closed_trades, 4) AS win_rate, total_net_pnl AS closed_pnl, still_open_count AS still_open FROM s JOIN stats USING (top_n)"""))
def top_n_sweep(spark, sf):
    scores, quotes, trades = _trades(spark, sf, TOPS)
    months = perf.rotation_months(scores, quotes, trades, TOPS, calendar=V.calendar(spark, sf))
    return perf.top_n_sweep(months, trades)


@query("walk_forward_gate", "C17 W17 J22 A16", with_views(f"""
WITH {_rotation((10,))},
 known AS (SELECT t.*, substr(t.entry_date, 1, 7) AS ym, s.ml_rank FROM trades t JOIN scores s ON substr(s.playbook_date, 1, 7) = substr(t.entry_date, 1, 7) AND s.symbol = t.symbol WHERE t.net_pnl IS NOT NULL),
 sums AS (SELECT ym, count(*) AS n_all, sum(net_pnl) AS pnl_all, sum((ml_rank <= 5)::INT) AS n_few, coalesce(sum(net_pnl) FILTER (ml_rank <= 5), 0) AS pnl_few FROM known GROUP BY 1),
 p AS (SELECT playbook_date, quantile_cont(ml_score, 0.9) AS p90 FROM scores GROUP BY 1),
 wf AS (SELECT *, (SELECT avg((b.p90 <= a.p90)::INT) FROM p b WHERE b.playbook_date < a.playbook_date) AS wf_pct FROM p a),
 c AS (SELECT *, row_number() OVER (ORDER BY playbook_date) - 1 AS idx FROM wf JOIN sums ON sums.ym = substr(wf.playbook_date, 1, 7)),
 opt AS (SELECT * FROM (VALUES ('baseline_top10', 'pass', 2.0), ('sanity_all_reduce_to_top5', 'reduce', 2.0), ('skip_p90<10p', 'skip', 0.1), ('reduce_p90<10p', 'reduce', 0.1),
   ('skip_p90<20p', 'skip', 0.2), ('reduce_p90<20p', 'reduce', 0.2), ('skip_p90<30p', 'skip', 0.3), ('reduce_p90<30p', 'reduce', 0.3)) v(scenario, act, thr)),
 x AS (SELECT *, CASE WHEN thr > 1 OR (idx >= 6 AND coalesce(wf_pct < thr::DOUBLE, false)) THEN act ELSE 'pass' END AS action FROM c CROSS JOIN opt),
 y AS (SELECT *, CASE action WHEN 'skip' THEN 0 WHEN 'reduce' THEN n_few ELSE n_all END AS npos, CASE action WHEN 'skip' THEN 0 WHEN 'reduce' THEN pnl_few ELSE pnl_all END AS net FROM x),
 z AS (SELECT *, coalesce(net / nullif(npos * 100000, 0) * 100, 0) AS r, sum(net) OVER (PARTITION BY scenario ORDER BY playbook_date) AS cum FROM y),
 d AS (SELECT *, cum - max(cum) OVER (PARTITION BY scenario ORDER BY playbook_date) AS dd FROM z)
SELECT scenario, {_RET_STATS.format(r='r', p='net')}, sum((action = 'skip')::INT) AS skipped, sum((action = 'reduce')::INT) AS reduced FROM d GROUP BY 1"""))
def walk_forward_gate(spark, sf):
    scores, _, trades = _trades(spark, sf, (10,))
    return perf.gate_scenarios(trades, scores, perf.score_distribution(scores))


# ---- forward returns and features -------------------------------------
_PANEL = f"""{_SCHEDULE}, cand AS (SELECT s.*, h.exit_date FROM scores s JOIN sched h ON h.playbook_date = s.playbook_date WHERE h.exit_date IS NOT NULL),
 panel AS (SELECT c.*, rnd(i.open, 2) AS entry_open, rnd(o.open, 2) AS exit_open, rnd((o.open - i.open) / i.open * 100, 4) AS fwd_return_pct
  FROM cand c JOIN {_first_open('cand', 'entry_date', 7, 'q.open > 0')} i ON i.symbol = c.symbol AND i.d = c.entry_date
  JOIN {_first_open('cand', 'exit_date', 7, 'q.open > 0')} o ON o.symbol = c.symbol AND o.d = c.exit_date)"""
FEATURES = ["ml_score", "disc", "tax", "qty", "line_count"]
_LONG = "long AS (SELECT playbook_date, feature, x, y FROM (UNPIVOT (SELECT playbook_date, fwd_return_pct AS y, ml_score, disc, tax, qty::DOUBLE AS qty, line_count::DOUBLE AS line_count FROM panel) ON ml_score, disc, tax, qty, line_count INTO NAME feature VALUE x))"


def _panel(spark, sf):
    return stage(perf.forward_returns(V.scores(spark, sf), V.quotes(spark, sf), V.calendar(spark, sf)))


@query("forward_return_panel", "C10 J18 J6", with_views(f"WITH {_PANEL} SELECT playbook_date, symbol, entry_date, exit_date, entry_open, exit_open, fwd_return_pct, ml_rank FROM panel"))
def forward_return_panel(spark, sf):
    return _panel(spark, sf).select("playbook_date", "symbol", "entry_date", "exit_date", "entry_open", "exit_open", "fwd_return_pct", "ml_rank")


_CORR = "SELECT feature, {extra}count(*) AS n, rnd(corr(x, y), 4) AS pearson, rnd(corr(rx, ry), 4) AS spearman FROM (SELECT *, rank() OVER (PARTITION BY {g} ORDER BY x) + (count(*) OVER (PARTITION BY {g}, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY {g} ORDER BY y) + (count(*) OVER (PARTITION BY {g}, y) - 1) / 2.0::DOUBLE AS ry FROM long) GROUP BY ALL HAVING stddev_samp(x) > 0"


@query("feature_correlations", "A12 C10", with_views(f"WITH {_PANEL}, {_LONG} " + _CORR.format(g="feature", extra="")))
def feature_correlations(spark, sf):
    return _round_all(perf.feature_correlations(_panel(spark, sf), FEATURES), 4)


@query("monthly_rank_ic", "A13", with_views(f"WITH {_PANEL}, long AS (SELECT 'ml_score' AS feature, playbook_date, ml_score AS x, fwd_return_pct AS y FROM panel) " + _CORR.format(g="playbook_date", extra="playbook_date, ")))
def monthly_rank_ic(spark, sf):
    df = ranks.correlations(_panel(spark, sf), ["playbook_date"], "ml_score", "fwd_return_pct")
    return _round_all(df.withColumn("feature", F.lit("ml_score")), 4)


@query("correlation_direction", "P23 A12", with_views(f"WITH {_PANEL}, {_LONG}, c AS (" + _CORR.format(g="feature", extra="") + """)
SELECT feature, CASE WHEN s IS NULL THEN 'flat' WHEN s > 0.5 THEN 'strong_up' WHEN s > 0.2 THEN 'up' WHEN s < -0.5 THEN 'strong_down' WHEN s < -0.2 THEN 'down' ELSE 'non_monotonic' END AS direction
FROM (SELECT feature, spearman AS s FROM c)"""))
def correlation_direction(spark, sf):
    df = _round_all(perf.feature_correlations(_panel(spark, sf), FEATURES), 4)
    return df.select("feature", N.correlation_label(F.col("spearman")).alias("direction"))


@query("feature_quintiles", "A11 W19", with_views(f"""
WITH {_PANEL}, {_LONG}, e AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM long GROUP BY 1)
SELECT feature, 'Q' || (1 + len(list_filter(e.edges[2:len(e.edges) - 1], lambda v: l.x > v))) AS quintile, rnd(avg(y), 4) AS mean, rnd(median(y), 4) AS median, count(*) AS count
FROM long l JOIN e USING (feature) GROUP BY 1, 2"""))
def feature_quintiles(spark, sf):
    return _round_all(perf.feature_quintiles(_panel(spark, sf), FEATURES), 4)


# ---- buckets ----------------------------------------------------------
_BIG = f"""{_PANEL}, big AS (SELECT * FROM panel WHERE substr(playbook_date, 6, 2) NOT IN ('02', '03') QUALIFY count(*) OVER (PARTITION BY playbook_date) >= 20)"""


def _big(spark, sf):
    return perf.ranked_panel(_panel(spark, sf), min_rows=20)


@query("fixed_rank_tiers", "A9 S19 F9 J24", with_views(f"""
WITH {_BIG}, c AS (SELECT playbook_date, avg(fwd_return_pct) FILTER (ml_rank BETWEEN 1 AND 10) AS a, avg(fwd_return_pct) FILTER (ml_rank BETWEEN 11 AND 20) AS b, avg(fwd_return_pct) FILTER (ml_rank BETWEEN 21 AND 30) AS d FROM big GROUP BY 1)
SELECT rnd(avg(a), 4) AS tier_1_10, rnd(avg(b), 4) AS tier_11_20, rnd(avg(d), 4) AS tier_21_30, sum((a > b)::INT) AS hits, sum((a IS NOT NULL AND b IS NOT NULL)::INT) AS compared FROM c"""))
def fixed_rank_tiers(spark, sf):
    return _round_all(perf.fixed_tiers(_big(spark, sf)), 4)


@query("rank_bucket_means", "A10 C19", with_views(f"""
WITH {_BIG}, {_QCUT.format(v='ml_rank', t='big')}, g AS (SELECT playbook_date, bucket + 1 AS bucket, avg(fwd_return_pct) AS r FROM b GROUP BY 1, 2)
SELECT bucket, rnd(avg(r), 4) AS mean_return, count(*) AS cohorts FROM g GROUP BY 1"""))
def rank_bucket_means(spark, sf):
    return _round_all(perf.rank_buckets(_big(spark, sf), 5), 4)


@query("rank_bucket_spread", "A10 A12 C19 J24", with_views(f"""
WITH {_BIG}, {_QCUT.format(v='ml_rank', t='big')}, g AS (SELECT playbook_date, bucket + 1 AS bucket, avg(fwd_return_pct) AS r FROM b GROUP BY 1, 2),
 m AS (SELECT bucket, avg(r) AS r FROM g GROUP BY 1), h AS (SELECT playbook_date, max(r) FILTER (bucket = 1) AS a, max(r) FILTER (bucket = 5) AS z FROM g GROUP BY 1)
SELECT (SELECT rnd(max(r) FILTER (bucket = 1) - max(r) FILTER (bucket = 5), 4) FROM m) AS spread,
 (SELECT rnd(corr(bucket, rk), 4) FROM (SELECT bucket, rank() OVER (ORDER BY r) AS rk FROM m)) AS monotonicity,
 (SELECT sum((a > z)::INT) FROM h) AS hits, (SELECT sum((a IS NOT NULL AND z IS NOT NULL)::INT) FROM h) AS compared, 5 AS buckets"""))
def rank_bucket_spread(spark, sf):
    return _round_all(perf.bucket_spread(_big(spark, sf), 5), 4)


# ---- regimes ----------------------------------------------------------
_DIAG = f"""WITH {_rotation((10,))}, {_MONTHS.format(tops=10)}, {_REGIME},
 one AS (SELECT date, index_close AS c, ln(index_close) - ln(lag(index_close) OVER (ORDER BY date)) AS lr FROM index_daily WHERE index_name = 'IDX0'),
 sig AS (SELECT date, (m20 / m60 - 1) * 100 AS ma20_vs_ma60_pct, (c / m20 - 1) * 100 AS close_vs_ma20_pct, r20 * 100 AS ret_20d_pct, r60 * 100 AS ret_60d_pct, vol * 100 AS vol_20d_ann_pct FROM (
   SELECT date, c, CASE WHEN count(*) OVER a >= 10 THEN avg(c) OVER a END AS m20, CASE WHEN count(*) OVER b >= 20 THEN avg(c) OVER b END AS m60,
    c / lag(c, 20) OVER (ORDER BY date) - 1 AS r20, c / lag(c, 60) OVER (ORDER BY date) - 1 AS r60, CASE WHEN count(lr) OVER a >= 10 THEN stddev_samp(lr) OVER a * sqrt(252) END AS vol
   FROM one WINDOW a AS (ORDER BY date ROWS 19 PRECEDING), b AS (ORDER BY date ROWS 59 PRECEDING))),
 settled AS (SELECT m.cohort_entry_date, m.playbook_date AS settle_playbook_date, coalesce(r.regime, 'Sideways') AS regime_label, m.realized_net_pnl AS realized_pnl, m.realized_net_pnl / 1000000 * 100 AS realized_ret_pct
   FROM (SELECT * FROM months WHERE cohort_entry_date IS NOT NULL) m ASOF LEFT JOIN reg r ON m.entry_date >= r.date),
 dist AS (SELECT substr(playbook_date, 1, 7) AS ym, median(ml_score) AS score_median, quantile_cont(ml_score, 0.9) AS score_p90, max(ml_score) AS score_max, avg(ml_score) FILTER (ml_rank <= 10) AS score_topn_mean FROM scores GROUP BY 1),
 diag AS (SELECT s.*, g.* EXCLUDE (date), d.* EXCLUDE (ym) FROM settled s ASOF LEFT JOIN sig g ON s.cohort_entry_date >= g.date LEFT JOIN dist d ON d.ym = substr(s.cohort_entry_date, 1, 7))"""


def _diag(spark, sf):
    scores, quotes, trades = _trades(spark, sf, (10,))
    indices = stage(V.index_daily(spark, sf))
    months = perf.rotation_months(scores, quotes, trades, (10,), indices, V.calendar(spark, sf))
    index = perf.market_mean(indices, "IDX0")
    return perf.regime_panel(months, index, perf.score_distribution(scores), 10)


@query("regime_diagnostic", "C18 W21 J5", with_views(_DIAG + """ SELECT cohort_entry_date, settle_playbook_date, regime_label, rnd(realized_pnl, 2) AS realized_pnl, rnd(realized_ret_pct, 4) AS realized_ret_pct,
 rnd(ma20_vs_ma60_pct, 4) AS ma20_vs_ma60_pct, rnd(close_vs_ma20_pct, 4) AS close_vs_ma20_pct, rnd(ret_20d_pct, 4) AS ret_20d_pct, rnd(ret_60d_pct, 4) AS ret_60d_pct, rnd(vol_20d_ann_pct, 4) AS vol_20d_ann_pct,
 rnd(score_topn_mean, 4) AS score_topn_mean, rnd(score_median, 4) AS score_median, rnd(score_p90, 4) AS score_p90, rnd(score_max, 4) AS score_max FROM diag"""))
def regime_diagnostic(spark, sf):
    return _round_all(_diag(spark, sf), 4)


_SIGNALS = [*perf.SIGNALS, "score_topn_mean", "score_median", "score_p90", "score_max"]
_SIGNAL_ROWS = _DIAG + ", long AS (" + " UNION ALL ".join(f"SELECT '{s}' AS feature, {s} AS x, realized_ret_pct AS y FROM diag WHERE {s} IS NOT NULL AND realized_ret_pct IS NOT NULL" for s in _SIGNALS) + ")"


@query("signal_correlations", "C18 A12", with_views(_SIGNAL_ROWS + " " + _CORR.format(g="feature", extra="") + " AND count(*) >= 5"))
def signal_correlations(spark, sf):
    """Signals at entry against realised cohort returns."""
    df = perf.feature_correlations(stage(_diag(spark, sf)), _SIGNALS, "realized_ret_pct")
    return _round_all(df.where("n >= 5"), 4)


@query("signal_quintiles", "C18 A11", with_views(_SIGNAL_ROWS + """, e AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM long GROUP BY 1 HAVING count(*) >= 10)
SELECT feature, 'Q' || (1 + len(list_filter(e.edges[2:len(e.edges) - 1], lambda v: l.x > v))) AS quintile, rnd(avg(y), 4) AS mean, rnd(median(y), 4) AS median, count(*) AS count FROM long l JOIN e USING (feature) GROUP BY 1, 2"""))
def signal_quintiles(spark, sf):
    return _round_all(perf.feature_quintiles(stage(_diag(spark, sf)).where("realized_ret_pct IS NOT NULL"), _SIGNALS, "realized_ret_pct", min_rows=10), 4)


@query("regime_label_returns", "A32 C18", with_views(_DIAG + """ SELECT regime_label, count(*) AS count, rnd(avg(realized_ret_pct), 4) AS mean, rnd(stddev_samp(realized_ret_pct), 4) AS std, rnd(min(realized_ret_pct), 4) AS min, rnd(max(realized_ret_pct), 4) AS max FROM diag GROUP BY 1"""))
def regime_label_returns(spark, sf):
    return _round_all(perf.stats_by_label(_diag(spark, sf), "regime_label", "realized_ret_pct"), 4)


@query("csv_outputs", "K15 C13", with_views(f"""
WITH {_rotation((10,))} SELECT symbol, entry_date, exit_date, shares, net_pnl, exit_reason FROM trades"""))
def csv_outputs(spark, sf):
    """Trades written as CSV to the shared folder and read back."""
    import uuid

    from tickerloom.session import shared_folder
    from tickerloom.sinks import load

    path = f"{shared_folder(spark)}/trades-{uuid.uuid4().hex}"
    columns = ["symbol", "entry_date", "exit_date", "shares", "net_pnl", "exit_reason"]
    load.write_csv(_trades(spark, sf, (10,))[2].select(*columns), path)
    schema = "symbol string, entry_date string, exit_date string, shares bigint, net_pnl double, exit_reason string"
    return spark.read.schema(schema).option("header", "true").csv(path)

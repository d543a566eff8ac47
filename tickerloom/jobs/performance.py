"""Ranked selections measured: rotation P&L, summaries, sweeps, gates, regimes, rank buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.operators import asof, ranks, windows as W

POSITION_AMOUNT = 100_000.0
WARMUP_COHORTS = 6
SKIP_MONTHS = ("02", "03")


# ---- index and regime -------------------------------------------------
def index_signals(index: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Averages, returns and volatility per index day; `index` has one row per key and day."""
    w = W.series(list(keys) or [F.lit(0)], "date")
    df = index.withColumn("log_ret", F.log("index_close") - F.log(F.lag("index_close").over(w)))
    vol = W.rolling_std("log_ret", w, 20, 10)
    return (
        df.withColumn("ma20", W.rolling_mean("index_close", w, 20, 10))
        .withColumn("ma60", W.rolling_mean("index_close", w, 60, 20))
        .withColumn("ret_20d", W.pct_change("index_close", w, 20))
        .withColumn("ret_60d", W.pct_change("index_close", w, 60))
        .withColumn("vol_20d_ann", vol * F.sqrt(F.lit(252.0)))
    )


def market_mean(indices: DataFrame, index_name: str | None = None) -> DataFrame:
    """Daily mean over all indices, or one index by name."""
    if index_name:
        indices = indices.where(F.col("index_name") == index_name)
    return indices.groupBy("date").agg(F.avg("index_close").alias("index_close"))


def regime_label() -> Column:
    ma20, ma60, close = F.col("ma20"), F.col("ma60"), F.col("index_close")
    return (
        F.when(ma20.isNull() | ma60.isNull(), "Sideways")
        .when(ma20 > ma60, "Bull")
        .when((ma20 < ma60) & (close < ma20), "Bear")
        .otherwise("Sideways")
    )


def regime_as_of(dates: DataFrame, on: str, indices: DataFrame) -> DataFrame:
    """Regime of each date from the index days up to it; Sideways without history."""
    daily = index_signals(market_mean(indices)).withColumn("regime", regime_label())
    found = asof.asof_backward(dates, daily, [], on, "date", ["regime"])
    return found.withColumn("regime", F.coalesce("regime", F.lit("Sideways")))


# ---- cohort rotation --------------------------------------------------
def cohort_schedule(cohorts: DataFrame, calendar: DataFrame) -> DataFrame:
    """(playbook_date, entry_date) rows with the day positions are closed.

    Every processed cohort closes the one before it on the trading day before
    its own entry; February and March open nothing. A cohort without such a day
    fails the job: a calendar that begins too late would leave positions open.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("playbook_date")
    prev = asof.previous_trading_day(cohorts, calendar, "entry_date", "close_date")
    month = F.substring("playbook_date", 6, 2)
    return (
        prev.withColumn("next_cohort", F.lead("playbook_date").over(w))
        .withColumn("exit_date", F.lead("close_date").over(w))
        .withColumn("exit_date", F.when(
            F.col("next_cohort").isNull() | F.col("exit_date").isNotNull(), F.col("exit_date")
        ).otherwise(F.raise_error(F.concat(F.lit("no trading day before the entry of cohort "), "next_cohort")).cast("string")))
        .withColumn("opens", ~month.isin(*SKIP_MONTHS))
    )


def _with_opens(df: DataFrame, quotes: DataFrame, within: int, entry: str, exit_: str) -> DataFrame:
    """Opens at entry_date and exit_date; both days are looked up in one pass over the quotes."""
    points = df.select("symbol", F.col("entry_date").alias("_d")).union(df.select("symbol", "exit_date"))
    opens = asof.forward_lookup(points, quotes, ["symbol"], "_d", "date", ["open"], within)

    def at(day: str, out: str) -> DataFrame:
        return opens.select("symbol", F.col("_d").alias(day), F.col("open").alias(out))

    joined = df.join(at("entry_date", entry), ["symbol", "entry_date"], "left")
    return joined.join(at("exit_date", exit_), ["symbol", "exit_date"], "left")


def rotation_picks(scores: DataFrame, top_ns: Sequence[int]) -> DataFrame:
    """The first symbols of each cohort, as many as the largest N: all that a rotation ever looks up quotes of."""
    order = [F.desc("ml_score"), F.col("symbol")]
    return ranks.top_n(scores.select("playbook_date", "symbol", "ml_score"), ["playbook_date"], order, max(top_ns), "pick")


def rotation_trades(
    scores: DataFrame, quotes: DataFrame, top_ns: Sequence[int], amount: float = POSITION_AMOUNT, calendar: DataFrame | None = None
) -> DataFrame:
    """All trades of a monthly full rotation, for every N of a sweep in one job.

    A cohort's trades depend on its own entry and the next cohort's exit day
    only, so months are joined, not looped. Opens are the first row within five
    days; a missing entry open opens nothing, a missing exit open books no P&L.
    """
    calendar = asof.trading_days(quotes) if calendar is None else calendar
    cohorts = scores.groupBy("playbook_date").agg(F.min("entry_date").alias("entry_date"))
    schedule = cohort_schedule(cohorts, calendar)
    picks = rotation_picks(scores, top_ns).join(schedule.where("opens"), "playbook_date")
    held = _with_opens(picks, quotes, 5, "entry_price", "exit_price").where("entry_price IS NOT NULL")
    shares = F.greatest(F.floor(F.lit(amount) / F.col("entry_price")), F.lit(1))
    df = held.withColumn("shares", shares.cast("bigint"))
    entry_value, exit_value = F.col("entry_price") * F.col("shares"), F.col("exit_price") * F.col("shares")
    cost = N.trade_cost(entry_value, exit_value)
    df = (
        df.withColumn("capital_used", N.rnd(entry_value, 2))
        .withColumn("_gross", (F.col("exit_price") - F.col("entry_price")) * F.col("shares"))
        .withColumn("_cost", cost)
        .withColumn("_net", F.col("_gross") - F.col("_cost"))
    )
    reason = (
        F.when(F.col("next_cohort").isNull(), "still_open")
        .when(F.col("exit_price").isNull(), "no_quote_on_exit")
        .otherwise("monthly_rotation")
    )
    df = df.withColumn("exit_reason", reason).withColumn("top_n", F.explode(F.array(*[F.lit(n) for n in top_ns])))
    return df.where(F.col("pick") <= F.col("top_n")).select(
        "top_n", "playbook_date", "next_cohort", "symbol", "pick", "entry_date", "exit_date", "entry_price", "exit_price",
        "shares", "capital_used", N.rnd("_gross", 2).alias("gross_pnl"), N.rnd("_cost", 2).alias("cost"),
        N.rnd("_net", 2).alias("net_pnl"), N.rnd(F.col("_net") / F.col("capital_used") * 100, 4).alias("return_pct"),
        "_net", "exit_reason",
    )


def rotation_months(
    scores: DataFrame, quotes: DataFrame, trades: DataFrame, top_ns: Sequence[int], indices: DataFrame | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """One row per cohort and N: exits of the cohort before, entries, realized P&L, capital."""
    calendar = asof.trading_days(quotes) if calendar is None else calendar
    cohorts = scores.groupBy("playbook_date").agg(
        F.min("entry_date").alias("entry_date"), F.count(F.lit(1)).alias("_size")
    )
    months = cohort_schedule(cohorts, calendar).withColumn("top_n", F.explode(F.array(*[F.lit(n) for n in top_ns])))
    entries = F.when(F.col("opens"), F.least(F.col("_size"), F.col("top_n"))).otherwise(F.lit(0))
    months = months.select(
        "top_n", "playbook_date", F.col("close_date").alias("exit_date"), "entry_date", entries.cast("bigint").alias("entries")
    )
    opened = trades.groupBy("top_n", "playbook_date").agg(
        F.count(F.lit(1)).alias("holdings_count"), N.rnd(F.sum("capital_used"), 2).alias("portfolio_capital_deployed")
    )
    closed = trades.where("next_cohort IS NOT NULL").groupBy("top_n", F.col("next_cohort").alias("playbook_date")).agg(
        F.count(F.lit(1)).alias("exits"), F.min("playbook_date").alias("cohort_playbook_date"),
        F.min("entry_date").alias("cohort_entry_date"), N.rnd(F.sum(F.coalesce("_net", F.lit(0.0))), 2).alias("realized_net_pnl"),
    )
    df = months.join(opened, ["top_n", "playbook_date"], "left").join(closed, ["top_n", "playbook_date"], "left")
    df = df.withColumns({
        "holdings_count": F.coalesce("holdings_count", F.lit(0)),
        "portfolio_capital_deployed": F.coalesce("portfolio_capital_deployed", F.lit(0.0)),
        "exits": F.coalesce("exits", F.lit(0)),
        "realized_net_pnl": F.coalesce("realized_net_pnl", F.lit(0.0)),
    }).withColumn("entries_failed_no_quote", F.col("entries") - F.col("holdings_count"))
    if indices is not None:
        df = regime_as_of(df, "entry_date", indices)
    return df


def trade_stats(trades: DataFrame, keys: Sequence[str] = ("top_n",)) -> DataFrame:
    """Counts, win rate, sums, mean and median return of the closed trades."""
    closed = F.col("exit_reason") == "monthly_rotation"
    agg = trades.groupBy(*keys).agg(
        F.sum(closed.cast("int")).alias("total_closed_trades"),
        F.sum((closed & (F.col("net_pnl") > 0)).cast("int")).alias("win_count"),
        F.sum((closed & (F.col("net_pnl") < 0)).cast("int")).alias("loss_count"),
        F.sum((F.col("exit_reason") == "still_open").cast("int")).alias("still_open_count"),
        F.sum((F.col("exit_reason") == "no_quote_on_exit").cast("int")).alias("no_quote_count"),
        N.rnd(F.sum(F.when(closed, F.col("net_pnl"))), 2).alias("total_net_pnl"),
        N.rnd(F.sum(F.when(closed, F.col("gross_pnl"))), 2).alias("total_gross_pnl"),
        N.rnd(F.sum(F.when(closed, F.col("cost"))), 2).alias("total_cost"),
        N.rnd(F.avg(F.when(closed, F.col("return_pct"))), 4).alias("avg_return_pct"),
    )
    rate = N.rnd(F.try_divide(F.col("win_count"), F.col("total_closed_trades")), 4)
    median = ranks.exact_percentiles(trades.where(closed), list(keys), "return_pct", {"median_return_pct": 0.5})
    median = median.withColumn("median_return_pct", N.rnd("median_return_pct", 4))
    return ranks.join_on_keys(agg.withColumn("win_rate", rate), median, list(keys))


def monthly_stats(months: DataFrame, start: str, end: str, amount: float = POSITION_AMOUNT) -> DataFrame:
    """Monthly return statistics over months that settled a cohort; Sharpe by cohorts per year."""
    real = months.where("cohort_playbook_date IS NOT NULL")
    ret = F.col("realized_net_pnl") / (F.col("top_n") * amount)
    agg = real.withColumn("_r", ret).groupBy("top_n").agg(
        F.count(F.lit(1)).alias("cohort_count"), F.avg("_r").alias("_mean"), F.stddev_samp("_r").alias("_sd"),
        F.min("_r").alias("_min"), F.max("_r").alias("_max"), F.sum((F.col("_r") > 0).cast("int")).alias("win_months"),
    )
    years = F.datediff(F.lit(end), F.lit(start)) / 365.25
    factor = F.sqrt(F.when(years > 0, F.col("cohort_count") / years).otherwise(12.0))
    sharpe = F.when((F.col("cohort_count") > 1) & (F.col("_sd") > 0), F.col("_mean") / F.col("_sd"))
    return agg.select(
        "top_n", "cohort_count", N.rnd(F.col("_mean") * 100, 4).alias("mean_monthly_return_pct"),
        N.rnd(F.col("_sd") * 100, 4).alias("std_monthly_return_pct"), N.rnd(F.col("_min") * 100, 4).alias("worst_month_return_pct"),
        N.rnd(F.col("_max") * 100, 4).alias("best_month_return_pct"), "win_months", N.rnd(sharpe, 4).alias("monthly_sharpe"),
        N.rnd(factor, 4).alias("annualization_factor"), N.rnd(sharpe * factor, 4).alias("monthly_sharpe_annualized"),
    )


def return_stats(months: DataFrame, keys: Sequence[str], order: str, ret: str, pnl: str) -> DataFrame:
    """Mean, sd, Sharpe by root 12, share of positive months, worst month, drawdown of the P&L."""
    w = W.series(list(keys), order)
    df = months.withColumn("_cum", W.cumulative(pnl, w)).withColumn("_dd", W.drawdown("_cum", w))
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cohorts"), F.sum(pnl).alias("_pnl"), F.avg(ret).alias("_m"), F.stddev_samp(ret).alias("_sd"),
        F.avg((F.col(ret) > 0).cast("double")).alias("_pos"), F.min(ret).alias("_worst"), F.min("_dd").alias("_dd"),
    )
    sharpe = F.when(F.col("_sd") > 0, F.col("_m") / F.col("_sd") * F.sqrt(F.lit(12.0)))
    return agg.select(
        *keys, "n_cohorts", N.rnd("_pnl", 2).alias("total_pnl"), N.rnd("_m", 4).alias("mean_monthly_return_pct"),
        N.rnd("_sd", 4).alias("std_monthly_return_pct"), N.rnd(sharpe, 4).alias("sharpe_annual"),
        N.rnd("_pos", 4).alias("positive_months_pct"), N.rnd("_worst", 4).alias("worst_month_return_pct"),
        N.rnd("_dd", 2).alias("max_drawdown_pnl"),
    )


def top_n_sweep(months: DataFrame, trades: DataFrame, amount: float = POSITION_AMOUNT) -> DataFrame:
    """Metrics per N. Every month counts here, also those that settled nothing."""
    df = months.withColumn("ret_pct", F.col("realized_net_pnl") / (F.col("top_n") * amount) * 100)
    stats = return_stats(df, ["top_n"], "playbook_date", "ret_pct", "realized_net_pnl")
    counts = trade_stats(trades).select(
        "top_n", F.col("total_closed_trades").alias("trades"), "win_rate", F.col("total_net_pnl").alias("closed_pnl"),
        F.col("still_open_count").alias("still_open"),
    )
    return stats.join(counts, "top_n", "left")


# ---- score distribution and gate --------------------------------------
PERCENTS = {"p10": 0.10, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.90}


def score_distribution(scores: DataFrame, top: int = 10) -> DataFrame:
    """Distribution of the scores of each cohort, with the mean of its best `top`."""
    dist = ranks.value_distribution(scores, ["playbook_date"], "ml_score")
    cuts = ranks.exact_percentiles(scores, ["playbook_date"], "ml_score", PERCENTS, dist)
    agg = scores.groupBy("playbook_date").agg(
        F.count("ml_score").alias("n_candidates"), F.min("ml_score").alias("min"), F.max("ml_score").alias("max"),
        F.avg("ml_score").alias("mean"), F.stddev_samp("ml_score").alias("std"),
    )
    best = ranks.top_n(scores, ["playbook_date"], [F.desc("ml_score"), F.col("symbol")], top)
    best = best.groupBy("playbook_date").agg(F.avg("ml_score").alias(f"top{top}_mean"))
    return agg.join(cuts, "playbook_date").join(best, "playbook_date")


def score_drift(dist: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric in the first and last third of the cohorts, apart in standard deviations."""
    w = Window.partitionBy(F.lit(0))
    df = dist.withColumn("_rn", F.row_number().over(w.orderBy("playbook_date"))).withColumn("_n", F.count(F.lit(1)).over(w))
    third = F.floor(F.col("_n") / 3)
    pairs = ", ".join(f"'{m}', {m}" for m in metrics)
    long = df.withColumn("_third", third).selectExpr("_rn", "_n", "_third", f"stack({len(metrics)}, {pairs}) AS (metric, value)")
    agg = long.groupBy("metric").agg(
        F.avg(F.when(F.col("_rn") <= F.col("_third"), F.col("value"))).alias("early_mean"),
        F.avg(F.when(F.col("_rn") > F.col("_n") - F.col("_third"), F.col("value"))).alias("recent_mean"),
        F.stddev_samp("value").alias("_sd"), F.max("_third").alias("_third"),
    )
    delta = F.col("recent_mean") - F.col("early_mean")
    return agg.where("_third >= 2").select(
        "metric", "early_mean", "recent_mean", delta.alias("delta"), F.try_divide(delta, F.col("_sd")).alias("delta_in_std")
    )


def gate_scenarios(
    trades: DataFrame, scores: DataFrame, dist: DataFrame, thresholds: Sequence[float] = (0.10, 0.20, 0.30),
    amount: float = POSITION_AMOUNT, reduced_to: int = 5, warmup: int = WARMUP_COHORTS,
) -> DataFrame:
    """Skip or shrink a cohort whose score p90 ranks low among all earlier cohorts.

    All scenarios are one table: closed trades per cohort are summed once in
    full and once for the best `reduced_to`, then the scenarios pick.
    """
    closed = trades.where("net_pnl IS NOT NULL").withColumn("ym", F.substring("entry_date", 1, 7))
    rank = scores.select(F.substring("playbook_date", 1, 7).alias("ym"), "symbol", "ml_rank")
    known = closed.join(rank, ["ym", "symbol"])
    small = F.col("ml_rank") <= reduced_to
    sums = known.groupBy("ym").agg(
        F.count(F.lit(1)).alias("n_all"), F.sum("net_pnl").alias("pnl_all"),
        F.sum(small.cast("int")).alias("n_few"), F.sum(F.when(small, F.col("net_pnl")).otherwise(0.0)).alias("pnl_few"),
    )
    one = Window.partitionBy(F.lit(0)).orderBy("playbook_date")
    cohorts = dist.withColumn("wf_pct", W.prior_share_at_most("p90", one)).withColumn("ym", F.substring("playbook_date", 1, 7))
    cohorts = cohorts.join(sums, "ym").withColumn("_idx", F.row_number().over(one) - 1)
    options = [("baseline_top10", "pass", 2.0), ("sanity_all_reduce_to_top5", "reduce", 2.0)]
    options += [(f"{a}_p90<{int(t * 100)}p", a, t) for t in thresholds for a in ("skip", "reduce")]
    listed = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(a).alias("act"), F.lit(t).alias("thr")) for s, a, t in options])
    df = cohorts.withColumn("_o", F.explode(listed)).select("*", "_o.*")
    gated = (F.col("thr") > 1) | ((F.col("_idx") >= warmup) & F.coalesce(F.col("wf_pct") < F.col("thr"), F.lit(False)))
    df = df.withColumn("action", F.when(gated, F.col("act")).otherwise("pass"))

    def pick(skip, few, full):
        return F.when(F.col("action") == "skip", F.lit(skip)).when(F.col("action") == "reduce", F.col(few)).otherwise(F.col(full))

    df = df.withColumn("n_positions", pick(0, "n_few", "n_all")).withColumn("net", pick(0.0, "pnl_few", "pnl_all"))
    ret = F.coalesce(F.try_divide("net", F.col("n_positions") * amount) * 100, F.lit(0.0))
    df = df.withColumn("ret_pct", ret)
    stats = return_stats(df, ["scenario"], "playbook_date", "ret_pct", "net")
    counts = df.groupBy("scenario").agg(
        F.sum((F.col("action") == "skip").cast("int")).alias("skipped"), F.sum((F.col("action") == "reduce").cast("int")).alias("reduced")
    )
    return stats.join(counts, "scenario")


# ---- forward returns --------------------------------------------------
def forward_returns(cohort: DataFrame, quotes: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Entry to exit return per candidate: exit is the trading day before the next cohort's entry.

    Opens must be positive, found within a week. Cohorts without a successor drop out.
    """
    days = cohort.groupBy("playbook_date").agg(F.min("entry_date").alias("entry_date"))
    w = Window.partitionBy(F.lit(0)).orderBy("playbook_date")
    calendar = asof.trading_days(quotes) if calendar is None else calendar
    close = asof.previous_trading_day(days, calendar, "entry_date", "_close")
    span = close.withColumn("exit_date", F.lead("_close").over(w)).where("exit_date IS NOT NULL").select("playbook_date", "exit_date")
    df = _with_opens(cohort.join(span, "playbook_date"), quotes.where("open > 0"), 7, "_in", "_out")
    ret = (F.col("_out") - F.col("_in")) / F.col("_in") * 100
    return (
        df.where("_in IS NOT NULL AND _out IS NOT NULL")
        .withColumn("entry_open", N.rnd("_in", 2)).withColumn("exit_open", N.rnd("_out", 2))
        .withColumn("fwd_return_pct", N.rnd(ret, 4)).drop("_in", "_out")
    )


def long_features(panel: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in features)
    return panel.selectExpr(*keep, f"stack({len(features)}, {pairs}) AS (feature, x)")


def feature_correlations(panel: DataFrame, features: Sequence[str], ret: str = "fwd_return_pct") -> DataFrame:
    long = long_features(panel, features, [ret])
    return ranks.correlations(long, ["feature"], "x", ret)


def feature_quintiles(panel: DataFrame, features: Sequence[str], ret: str = "fwd_return_pct", min_rows: int = 20) -> DataFrame:
    """Mean, median and count of returns per quintile of each feature."""
    long = long_features(panel, features, [ret]).where("x IS NOT NULL")
    bucketed = ranks.with_quantile_bucket(long, ["feature"], "x", 5, "_b").where("_b IS NOT NULL")
    bucketed = bucketed.withColumn("quintile", F.concat(F.lit("Q"), (F.col("_b") + 1).cast("string")))
    agg = bucketed.groupBy("feature", "quintile").agg(F.avg(ret).alias("mean"), F.count(F.lit(1)).alias("count"))
    median = ranks.exact_percentiles(bucketed, ["feature", "quintile"], ret, {"median": 0.5})
    total = F.sum("count").over(Window.partitionBy("feature"))
    return agg.join(median, ["feature", "quintile"]).withColumn("_t", total).where(F.col("_t") >= min_rows).drop("_t")


# ---- rank buckets -----------------------------------------------------
def ranked_panel(panel: DataFrame, min_rows: int = 50, skip_months: bool = True) -> DataFrame:
    """Cohorts with enough ranked and realised rows. Sizes are counted, then joined back."""
    df = panel.where("fwd_return_pct IS NOT NULL AND ml_rank IS NOT NULL")
    if skip_months:
        df = df.where(~F.substring("playbook_date", 6, 2).isin(*SKIP_MONTHS))
    big = df.groupBy("playbook_date").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    return df.join(big.select("playbook_date"), "playbook_date", "left_semi")


def fixed_tiers(panel: DataFrame, tiers: Sequence[tuple[int, int]] = ((1, 10), (11, 20), (21, 30))) -> DataFrame:
    """Mean return per rank tier, cohorts weighted equally, and how often the first beat the second."""
    aggs = [
        F.avg(F.when(F.col("ml_rank").between(lo, hi), F.col("fwd_return_pct"))).alias(f"t{i}") for i, (lo, hi) in enumerate(tiers)
    ]
    per_cohort = panel.groupBy("playbook_date").agg(*aggs)
    both = F.col("t0").isNotNull() & F.col("t1").isNotNull()
    return per_cohort.agg(
        *[F.avg(f"t{i}").alias(f"tier_{lo}_{hi}") for i, (lo, hi) in enumerate(tiers)],
        F.sum((F.col("t0") > F.col("t1")).cast("int")).alias("hits"), F.sum(both.cast("int")).alias("compared"),
    )


def rank_buckets(panel: DataFrame, q: int) -> DataFrame:
    """Per bucket (1 = best) the return averaged over cohorts."""
    b = ranks.with_quantile_bucket(panel, ["playbook_date"], "ml_rank", q, "_b").where("_b IS NOT NULL")
    per = b.groupBy("playbook_date", (F.col("_b") + 1).alias("bucket")).agg(F.avg("fwd_return_pct").alias("ret"))
    return per.groupBy("bucket").agg(F.avg("ret").alias("mean_return"), F.count(F.lit(1)).alias("cohorts"))


def bucket_spread(panel: DataFrame, q: int) -> DataFrame:
    """Top minus bottom bucket, hit rate, and Spearman of bucket number and mean return."""
    b = ranks.with_quantile_bucket(panel, ["playbook_date"], "ml_rank", q, "_b").where("_b IS NOT NULL")
    per = b.groupBy("playbook_date", (F.col("_b") + 1).alias("bucket")).agg(F.avg("fwd_return_pct").alias("ret"))
    wide = per.groupBy("playbook_date").agg(
        F.max(F.when(F.col("bucket") == 1, F.col("ret"))).alias("best"), F.max(F.when(F.col("bucket") == q, F.col("ret"))).alias("worst")
    )
    both = F.col("best").isNotNull() & F.col("worst").isNotNull()
    hits = wide.agg(F.sum((F.col("best") > F.col("worst")).cast("int")).alias("hits"), F.sum(both.cast("int")).alias("compared"))
    means = per.groupBy("bucket").agg(F.avg("ret").alias("ret"))
    # q rows at most: a plain window is enough
    rk = F.rank().over(Window.partitionBy(F.lit(0)).orderBy("ret"))
    mono = means.withColumn("_r", rk.cast("double")).agg(
        (F.max(F.when(F.col("bucket") == 1, F.col("ret"))) - F.max(F.when(F.col("bucket") == q, F.col("ret")))).alias("spread"),
        ranks.pearson(F.col("bucket").cast("double"), F.col("_r")).alias("monotonicity"),
    )
    one = F.lit(1).alias("_k")
    return mono.select("*", one).join(hits.select("*", one), "_k").drop("_k").withColumn("buckets", F.lit(q))


def stats_by_label(df: DataFrame, label: str, value: str) -> DataFrame:
    return df.groupBy(label).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )


# ---- regime diagnostic ------------------------------------------------
SIGNALS = ["ma20_vs_ma60_pct", "close_vs_ma20_pct", "ret_20d_pct", "ret_60d_pct", "vol_20d_ann_pct"]


def regime_panel(months: DataFrame, index: DataFrame, dist: DataFrame, top_n: int, amount: float = POSITION_AMOUNT) -> DataFrame:
    """Settled cohorts with the index signals and score spread known at their entry."""
    c = F.col
    sig = index_signals(index).select(
        "date",
        ((F.try_divide("ma20", "ma60") - 1) * 100).alias("ma20_vs_ma60_pct"),
        ((F.try_divide("index_close", "ma20") - 1) * 100).alias("close_vs_ma20_pct"),
        (c("ret_20d") * 100).alias("ret_20d_pct"), (c("ret_60d") * 100).alias("ret_60d_pct"),
        (c("vol_20d_ann") * 100).alias("vol_20d_ann_pct"),
    )
    settled = months.where("cohort_entry_date IS NOT NULL").select(
        "cohort_entry_date", F.col("playbook_date").alias("settle_playbook_date"), F.col("regime").alias("regime_label"),
        F.col("realized_net_pnl").alias("realized_pnl"), (c("realized_net_pnl") / (top_n * amount) * 100).alias("realized_ret_pct"),
    )
    df = asof.asof_backward(settled, sig, [], "cohort_entry_date", "date", SIGNALS)
    spread = dist.select(
        F.substring("playbook_date", 1, 7).alias("_ym"), F.col(f"top{top_n}_mean").alias("score_topn_mean"),
        F.col("median").alias("score_median"), F.col("p90").alias("score_p90"), F.col("max").alias("score_max"),
    )
    return df.withColumn("_ym", F.substring("cohort_entry_date", 1, 7)).join(spread, "_ym", "left").drop("_ym")

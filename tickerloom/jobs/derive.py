"""Derived daily tables: technical, valuation, holdings, margin, short interest, concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.operators import asof, recursion, windows as W
from tickerloom.session import stage

MA_LENGTHS = (5, 10, 20, 60, 120, 240)
KEYS = ["date", "market", "symbol"]


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def _pct(n: Column, d: str) -> Column:
    return N.safe_div_positive(n, d) * 100


# ---- technical_indicators ---------------------------------------------
def technical_indicators(quotes: DataFrame, flows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Averages, oscillators, bands and net-buying streaks per symbol and day.

    With `start` or `end` only that span is returned; it equals the same days of a full run, since
    recursive averages and streaks see the whole history of a symbol. All windows are taken in two
    steps over one sort, and the recursion reads on in it: one exchange on symbol serves everything.
    """
    if end:
        quotes = quotes.where(F.col("date") <= end)
    net = ["foreign_net", "trust_net", "dealer_net"]
    df = quotes.select("date", "symbol", "high", "low", "close", "volume").join(
        flows.select("date", "symbol", *net), ["date", "symbol"], "left"
    )
    w = W.series("symbol", "date")
    sums, means = W.rolling_means("symbol", "date", {"close": MA_LENGTHS, "volume": MA_LENGTHS}, {"close": "ma", "volume": "vma"})
    first, streaks = W.streaks("symbol", "date", {c: c.replace("_net", "_streak_days") for c in net})
    df = df.withColumns({"rsv": W.stochastic(df, w), "_sd20": W.rolling_std("close", w, 20), **sums, **first})
    df = df.withColumns({**means, **streaks}).select("date", "symbol", "close", "rsv", "_sd20", *means, *streaks)
    df = W.with_ewm_indicators(df, "symbol", "date")
    df = (
        df.withColumn("bb_upper", F.col("ma20") + 2 * F.col("_sd20"))
        .withColumn("bb_middle", F.col("ma20"))
        .withColumn("bb_lower", F.col("ma20") - 2 * F.col("_sd20"))
    )
    if start:
        df = df.where(F.col("date") >= start)
    return df.select(
        "date", "symbol", *[f"ma{n}" for n in MA_LENGTHS], *[f"vma{n}" for n in MA_LENGTHS],
        *W.EWM_FIELDS, "bb_upper", "bb_middle", "bb_lower",
        "foreign_streak_days", "trust_streak_days", "dealer_streak_days",
    )


def technical_run(
    quotes: DataFrame, flows: DataFrame, state: DataFrame | None = None, followed: bool = True, digits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(indicator rows of the given days, state after them): both inputs hold new days only.

    `state` is what the last run returned; without one the given days are the whole history. Rows equal those of
    `technical_indicators` over all days. A symbol without new days keeps its state. Quotes, flows and states are staged
    as they lie side by side, for the rows and the next run's states to read; not for a last run, which is not `followed`.
    `digits` rounds the rows where they are made, as `numbers.rnd` does.
    """
    nets = ["foreign_net", "trust_net", "dealer_net"]
    df = recursion.united(quotes.select("date", "symbol", "high", "low", "close", "volume"), flows.select("date", "symbol", *nets), state)
    df = stage(df) if followed else df
    return recursion.indicators(df, MA_LENGTHS, nets, digits), recursion.next_states(df, MA_LENGTHS, nets)


# ---- valuation_daily --------------------------------------------------
def trailing_eps(reports: DataFrame) -> DataFrame:
    """Sum of the last four reported quarters with its statutory publish date."""
    w = W.series("symbol", "date")
    ttm = reports.withColumn("ttm_eps_official", W.rolling_sum("eps_q", w, 4))
    return ttm.withColumn("publish_date", P.statutory_publish_date("date"))


def valuation(
    quotes: DataFrame, reports: DataFrame, pe_ratio: DataFrame, after: str | None = None, history: DataFrame | None = None
) -> DataFrame:
    """Daily point-in-time valuation: trailing EPS known on the day, PE, ROE and PE percentile.

    Loss-making rows stay (PE NULL, ROE keeps its sign). pe_ratio may repeat a
    key; its `row_order` decides, last wins. With `after`, only later days are
    made and `history` (stored rows) completes the percentile.
    """
    price = quotes.select("date", "symbol", "close")
    if after:
        price = price.where(F.col("date") > after)
    known = trailing_eps(reports).where("ttm_eps_official IS NOT NULL")
    df = asof.asof_backward(
        price, known.select("symbol", "publish_date", "ttm_eps_official", "nav_per_share"),
        ["symbol"], "date", "publish_date", ["ttm_eps_official", "nav_per_share"],
    ).where("ttm_eps_official IS NOT NULL")
    official = W.keep_last(pe_ratio, ["symbol", "date"], [F.desc("row_order")])
    df = df.join(official.select("symbol", "date", F.col("pe_ratio").alias("pe_official")), ["symbol", "date"], "left")
    df = df.withColumn("pe_calculated", _pe("close", "ttm_eps_official"))
    roe = N.rnd(F.try_divide("ttm_eps_official", "nav_per_share") * 100, 2)
    df = df.withColumn("roe_official", roe)
    series = df.where("pe_calculated IS NOT NULL").select("symbol", "date", "pe_calculated")
    if history is not None:
        old = history.where("ttm_eps_official > 0")
        if after:
            old = old.where(F.col("date") <= after)
        series = series.union(old.select("symbol", "date", _pe("close", "ttm_eps_official")))
    ranked = W.with_expanding_percentile(series, "symbol", "date", "pe_calculated", "_rank")
    pct = N.rnd(F.col("_rank") * 100, 4)
    ranked = ranked.select("symbol", "date", pct.alias("pe_percentile_official"))
    return df.join(ranked, ["symbol", "date"], "left").select(
        "date", "symbol", "close", "ttm_eps_official", "pe_official", "pe_percentile_official", "roe_official"
    )


def _pe(close: str, ttm: str) -> Column:
    return F.when(F.col(ttm) > 0, N.rnd(F.col(close) / F.col(ttm), 2))


def reconcile_trailing_eps(stored: DataFrame, reports: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """Each symbol's latest stored trailing EPS against a fresh sum; `drifted` where apart."""
    latest = asof.latest_as_of(stored.select("symbol", "date", "ttm_eps_official"), ["symbol"], "date")
    fresh = trailing_eps(reports).where("ttm_eps_official IS NOT NULL").select(
        "symbol", "publish_date", F.col("ttm_eps_official").alias("expected_ttm")
    )
    joined = asof.asof_backward(latest, fresh, ["symbol"], "date", "publish_date", ["expected_ttm"])
    diff = F.abs(F.col("ttm_eps_official") - F.col("expected_ttm"))
    return joined.where("expected_ttm IS NOT NULL").withColumn("diff", diff).withColumn("drifted", diff > tolerance)


# ---- holdings ---------------------------------------------------------
def cumulative_holding(
    flows: DataFrame, foreign: DataFrame, net: str, prefix: str, state: DataFrame | None = None, after: str | None = None
) -> DataFrame:
    """Running institutional holding per symbol and its share of issued stock.

    `state` is the table written so far; later days continue from its last row.
    """
    if after:
        flows = flows.where(F.col("date") > after)
    daily = _summed(flows, [net], "_name").withColumnRenamed(net, "_net")
    held = f"{prefix}_held_shares"
    total = W.cumulative("_net", W.series(["market", "symbol"], "date"))
    if state is not None:
        last = asof.latest_as_of(state.select("market", "symbol", "date", held), ["market", "symbol"], "date")
        daily = daily.join(last.select("market", "symbol", F.col(held).alias("_base")), ["market", "symbol"], "left")
        total = F.coalesce(F.col("_base"), F.lit(0.0)) + total
    df = daily.withColumn(held, total)
    fh = foreign.select(*KEYS, F.col("name").alias("_fh_name"), "issued_shares")
    df = df.join(fh, KEYS, "left")
    ratio = N.rnd(N.safe_div_positive(held, "issued_shares") * 100, 4)
    return df.select(
        *KEYS, F.coalesce("_fh_name", "_name").alias("name"), "issued_shares", held, ratio.alias(f"{prefix}_held_ratio")
    )


def _summed(df: DataFrame, sums: Sequence[str], name: str) -> DataFrame:
    """Sums per (date, market, symbol), with the last of its names.

    Raw rows are added up by hash with the name as a key; only these few rows per
    key meet the maximum of a string, which sorts.
    """
    label = F.col("name") if "name" in df.columns else F.lit(None).cast("string")
    per_name = df.groupBy(*KEYS, label.alias(name)).agg(*[F.sum(_zero(c)).alias(c) for c in sums])
    return per_name.groupBy(*KEYS).agg(F.max(name).alias(name), *[F.sum(c).alias(c) for c in sums])


# ---- margin and short interest ---------------------------------------
def margin_pressure(margin: DataFrame) -> DataFrame:
    """Usage ratios, day-over-day changes and the pressure score per (date, market, symbol)."""
    sums = [
        "margin_long_prev_balance", "margin_long_balance", "margin_long_limit", "margin_short_prev_balance",
        "margin_short_balance", "margin_short_limit", "margin_short_buy", "margin_short_cash_repay",
    ]
    base = _summed(margin, sums, "name")
    c = F.col
    long_use = _pct(c("margin_long_balance"), "margin_long_limit")
    short_use = _pct(c("margin_short_balance"), "margin_short_limit")
    long_change = c("margin_long_balance") - c("margin_long_prev_balance")
    short_change = c("margin_short_balance") - c("margin_short_prev_balance")
    cover = _pct(c("margin_short_buy") + c("margin_short_cash_repay"), "margin_short_prev_balance")
    zero = F.lit(0.0)
    score = F.coalesce(long_use, zero) * 0.45 + F.coalesce(short_use, zero) * 0.30 + F.coalesce(cover, zero) * 0.25
    return base.select(
        *KEYS, "name", "margin_long_balance", "margin_long_limit",
        N.rnd(long_use, 4).alias("margin_usage_ratio"),
        N.rnd(long_change, 4).alias("margin_long_balance_wow"),
        N.rnd(_pct(long_change, "margin_long_prev_balance"), 4).alias("margin_long_balance_wow_pct"),
        "margin_short_balance", "margin_short_limit",
        N.rnd(short_use, 4).alias("short_usage_ratio"),
        N.rnd(short_change, 4).alias("margin_short_balance_wow"),
        N.rnd(_pct(short_change, "margin_short_prev_balance"), 4).alias("margin_short_balance_wow_pct"),
        N.rnd(cover, 4).alias("short_cover_pressure"),
        N.rnd(score, 4).alias("margin_pressure_score"),
    )


def short_interest(sbl: DataFrame) -> DataFrame:
    """Lending balance changes, sell/repay ratio and the short pressure score."""
    sums = ["sbl_balance", "sbl_prev_balance", "sbl_sell", "sbl_repay", "margin_short_balance", "margin_short_prev_balance"]
    base = _summed(sbl, sums, "name")
    c = F.col
    lent = c("sbl_balance") - c("sbl_prev_balance")
    short = c("margin_short_balance") - c("margin_short_prev_balance")
    lent_pct, short_pct = _pct(lent, "sbl_prev_balance"), _pct(short, "margin_short_prev_balance")
    ratio = N.safe_div_positive("sbl_sell", "sbl_repay")
    score = (
        F.coalesce(lent_pct, F.lit(0.0)) * 0.4
        + F.coalesce(short_pct, F.lit(0.0)) * 0.4
        + (F.coalesce(ratio, F.lit(1.0)) - 1) * 100 * 0.2
    )
    return base.select(
        *KEYS, "name", "sbl_balance", N.rnd(lent, 4).alias("sbl_balance_wow"), N.rnd(lent_pct, 4).alias("sbl_balance_wow_pct"),
        "sbl_sell", "sbl_repay", N.rnd(ratio, 4).alias("sbl_sell_repay_ratio"), "margin_short_balance",
        N.rnd(short, 4).alias("margin_short_balance_wow"), N.rnd(short_pct, 4).alias("margin_short_balance_wow_pct"),
        N.rnd(score, 4).alias("short_pressure_score"),
    )


# ---- shareholding_concentration --------------------------------------
def shareholder_bands(shareholding: DataFrame) -> DataFrame:
    """Small (levels 1-8), mid (9-11) and large (12-15) holders per snapshot and symbol."""

    def band(low: int, high: int, c: str) -> Column:
        return F.sum(F.when(F.col("level").between(low, high), F.coalesce(F.col(c), F.lit(0))).otherwise(0))

    return shareholding.groupBy("date", "symbol").agg(
        band(1, 8, "percentage").alias("small_holder_ratio"),
        band(9, 11, "percentage").alias("mid_holder_ratio"),
        band(12, 15, "percentage").alias("large_holder_ratio"),
        band(1, 8, "holders").alias("small_holder_count"),
        band(12, 15, "holders").alias("large_holder_count"),
    )


def concentration(shareholding: DataFrame, after: str | None = None) -> DataFrame:
    """Holder concentration and its change since the symbol's previous snapshot.

    With `after`, each symbol's last earlier snapshot is kept as the base of its
    first new row, also when it missed the latest snapshot date.
    """
    bands = shareholder_bands(shareholding)
    bands = bands.withColumn("concentration_spread", F.col("large_holder_ratio") - F.col("small_holder_ratio"))
    w = Window.partitionBy("symbol").orderBy("date")
    moved = ["large_holder_ratio", "small_holder_ratio", "mid_holder_ratio", "concentration_spread"]
    for name in moved:
        bands = bands.withColumn(f"{name}_wow", W.change_from_previous(name, w))
    if after:
        bands = bands.where(F.col("date") > after)
    return bands.select(
        "date", "symbol", *[N.rnd(m, 4).alias(m) for m in moved], *[N.rnd(f"{m}_wow", 4).alias(f"{m}_wow") for m in moved],
        "large_holder_count", "small_holder_count",
    )

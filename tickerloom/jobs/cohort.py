"""Point-in-time cohorts: feature sets, finalizing, guards (rows C6-C9, C12, C20).

All cohorts are built in one job. The playbook calendar says which quarters and
months a cohort may look at; facts meet it by equi-joins on the period token,
and as-of lookups are bounded by the cutoff, never by the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import clean
from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.operators import asof, ranks, windows as W
from tickerloom.session import stage

KEY = ["playbook_date", "symbol"]

# fixed values: account codes of the statements
INCOME_CODES = ["4000", "5900", "6300", "6900", "7900", "7950", "8200"]
BALANCE_CODES = ["1100", "11XX", "21XX", "1XXX", "2XXX", "3XXX", "3300"]
CASH_CODES = ["AAAA", "B02700"]


# ---- facts per cohort -------------------------------------------------
def role_quarters(calendar: DataFrame) -> DataFrame:
    """(playbook_date, role, quarter): which quarter plays which part in a cohort."""
    roles = ["target", "ly_target", "ly_anchor", "pre_anchor", "anchor"]
    pairs = [F.struct(F.lit(r).alias("role"), F.col(f"{r}_q").alias("quarter")) for r in roles]
    year = F.substring("target_q", 1, 4).cast("int")
    for q in (1, 2, 3, 4):
        pairs.append(F.struct(F.lit(f"ly_q{q}").alias("role"), P.quarter_token(year - 1, F.lit(q)).alias("quarter")))
    for q in (1, 2):
        pairs.append(F.struct(F.lit(f"ty_q{q}").alias("role"), P.quarter_token(year, F.lit(q)).alias("quarter")))
    return calendar.select("playbook_date", F.inline(F.array(*pairs)))


def eps_history(quarterly: DataFrame, calendar: DataFrame) -> DataFrame:
    """EPS of every quarter a cohort refers to, one column per role."""
    roles = role_quarters(calendar)
    joined = quarterly.select(F.col("date").alias("quarter"), "symbol", "eps_q").join(roles, "quarter")
    names = ["target", "ly_target", "ly_anchor", "pre_anchor", "anchor", "ly_q1", "ly_q2", "ly_q3", "ly_q4", "ty_q1", "ty_q2"]
    wide = joined.groupBy(*KEY).pivot("role", names).agg(F.max("eps_q"))
    return wide.select(*KEY, *[F.col(n).alias(f"{n}_eps") for n in names])


def month_revenue(monthly: DataFrame, calendar: DataFrame, published_only: bool = True) -> DataFrame:
    """Revenue of the cohort's feature months (k = 1..3), each with the month before and a year ago.

    `published_only` keeps rows public at the cutoff.
    """
    first = P.month_index(P.month_token(F.col("year"), F.col("month"))) - F.col("feature_months")
    per_month = calendar.select(
        "playbook_date", F.date_format(F.to_date("cutoff_date"), "yyyyMMdd").alias("_cut"), first.alias("_first"),
        F.explode(F.sequence(F.lit(1), F.col("feature_months"))).alias("_k"),
    )
    index = F.col("_first") + F.col("_k") - 1
    wanted = F.array(*[
        F.struct(F.concat(F.lit(p), F.col("_k").cast("string")).alias("part"), P.month_of_index(index + d).alias("date"))
        for p, d in (("rev_", 0), ("rev_prev_", -1), ("rev_ly_", -12))
    ])
    asked = per_month.select("playbook_date", "_cut", F.inline(wanted))
    rows = monthly.select("date", "symbol", "revenue_current", "publish_time").join(asked, "date")
    if published_only:
        rows = rows.where("publish_time IS NOT NULL AND publish_time <= _cut")
    names = [f"{p}{k}" for k in (1, 2, 3) for p in ("rev_", "rev_prev_", "rev_ly_")]
    return rows.groupBy(*KEY).pivot("part", names).agg(F.max("revenue_current"))


def pivot_codes(facts: DataFrame, period_type: str, codes: Sequence[str], order: str | None = None) -> DataFrame:
    """Statement codes as columns per (date, symbol); with `order` the last value of a code wins."""
    value = F.coalesce(F.col("value_num"), F.col("value_text").try_cast("double")) if "value_text" in facts.columns else F.col("value_num")
    rows = facts.where((F.col("period_type") == period_type) & F.col("account_code").isin(list(codes)))
    agg = F.max_by(value, F.col(order)) if order else F.max(value)
    return rows.groupBy("date", "symbol").pivot("account_code", list(codes)).agg(agg)


def single_quarter_flow(accumulated: DataFrame, codes: Sequence[str], first_as_is: bool) -> DataFrame:
    """Year-to-date flows to single quarters by a self join on the quarter before.

    first_as_is: the first quarter is taken as it is and a missing prior counts
    as zero. Otherwise the prior is always subtracted and a missing one gives NULL.
    """
    prior = accumulated.select(
        P.shift_quarter("date", 1).alias("date"), "symbol", *[F.col(c).alias(f"_p_{c}") for c in codes]
    )
    joined = accumulated.join(prior, ["date", "symbol"], "left")

    def flow(c: str) -> Column:
        if not first_as_is:
            return F.col(c) - F.col(f"_p_{c}")
        return F.when(F.substring("date", 6, 1) == "1", F.col(c)).otherwise(F.col(c) - F.coalesce(f"_p_{c}", F.lit(0.0)))

    return joined.select("date", "symbol", *[flow(c).alias(c) for c in codes])


def statement_ratios(facts: DataFrame) -> DataFrame:
    """Margin, tax, liquidity and cash ratios per (date, symbol) from three statements, any of which may be missing."""
    income = pivot_codes(facts, "quarter", INCOME_CODES)
    balance = pivot_codes(facts, "as_of", BALANCE_CODES)
    cash = single_quarter_flow(pivot_codes(facts, "accumulated", CASH_CODES), CASH_CODES, first_as_is=False)
    x = income.join(balance, ["date", "symbol"], "full_outer").join(cash, ["date", "symbol"], "full_outer")
    div = N.safe_div_positive
    return x.select(
        "date", "symbol",
        div("5900", "4000").alias("xbrl_gross_margin_q"), div("6900", "4000").alias("xbrl_op_margin_q"),
        div("6300", "4000").alias("xbrl_rd_ratio_q"), N.clip(div("7950", "7900"), 0, 1).alias("xbrl_tax_rate_q"),
        N.clip(div("11XX", "21XX"), 0, 20).alias("xbrl_current_ratio"), N.clip(div("1100", "1XXX"), 0, 1).alias("xbrl_cash_to_assets"),
        N.clip(div("AAAA", "8200"), -10, 10).alias("xbrl_cfo_to_ni_q"),
        N.clip(div(F.abs("B02700"), "4000"), 0, 10).alias("xbrl_capex_to_revenue_q"),
    )


def _anchored(df: DataFrame, calendar: DataFrame, quarter: str, names: dict[str, str]) -> DataFrame:
    """Rows of the cohort's `quarter`, columns renamed."""
    cal = calendar.select("playbook_date", F.col(quarter).alias("date"))
    return df.join(cal, "date").select(*KEY, *[F.col(a).alias(b) for a, b in names.items()])


def _month_features(df: DataFrame, group: Sequence[str]) -> DataFrame:
    for k in (1, 2, 3):
        df = df.withColumn(f"rev_yoy_{k}", N.safe_div_positive(f"rev_{k}", f"rev_ly_{k}") - 1)
        df = df.withColumn(f"rev_mom_{k}", N.safe_div_positive(f"rev_{k}", f"rev_prev_{k}") - 1)
    return df


def with_industry_quantiles(df: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Industry z-score deciles of several columns at once.

    The columns are stacked to rows, so one statistics pass and one ranking pass
    serve them all; the deciles are pivoted back.
    """
    pairs = ", ".join(f"'{c}', {c}" for c in columns)
    long = df.selectExpr(*KEY, *[g for g in group if g not in KEY], f"stack({len(columns)}, {pairs}) AS (_f, _x)")
    g = [*group, "_f"]
    scored = stage(ranks.with_zscore(long.where("_x IS NOT NULL"), g, "_x", "_z").where("_z IS NOT NULL"))
    deciles = ranks.with_decile(scored, g, "_z", "_q")
    wide = deciles.groupBy(*KEY).pivot("_f", list(columns)).agg(F.max("_q"))
    wide = wide.select(*KEY, *[F.col(c).alias(f"{c}_quantile") for c in columns])
    return df.join(wide, KEY, "left")


MONTH_COLUMNS = [f"rev_{kind}_{k}" for k in (1, 2, 3) for kind in ("yoy", "mom")]


def eps_dataset(
    calendar: DataFrame, quarterly: DataFrame, facts: DataFrame, monthly: DataFrame, info: DataFrame,
    min_ttm: float = 1.0, label_cutoff: str | None = None,
) -> DataFrame:
    """Training and evaluation rows of the EPS model for every cohort.

    A symbol needs income, balance and cash rows of the anchor quarter. Labels
    whose quarter is public only after `label_cutoff` (default: the newest
    cohort's cutoff) are NULL, so a rerun of an old run sees what that run saw.
    `labeled` and `live` mark what may train and what may be predicted.
    """
    anchor = _anchored(quarterly, calendar, "anchor_q", {
        "market": "market", "revenue_q": "anchor_rev", "net_income_q": "anchor_ni", "non_op_income_q": "non_op_income_q",
        "pretax_income_q": "pretax_income_q", "capital": "capital",
    })
    before = _anchored(quarterly, calendar, "pre_anchor_q", {"revenue_q": "pre_anchor_rev", "net_income_q": "pre_anchor_ni"})
    balance = _anchored(pivot_codes(facts, "as_of", BALANCE_CODES), calendar, "anchor_q", {
        "1XXX": "total_assets", "2XXX": "total_liabilities", "3XXX": "total_equity", "3300": "retained_earnings",
    })
    flow = single_quarter_flow(pivot_codes(facts, "accumulated", CASH_CODES), CASH_CODES, first_as_is=False)
    cash = _anchored(flow, calendar, "anchor_q", {"AAAA": "anchor_ocf"})
    ratios = statement_ratios(facts)
    ratio_names = [c for c in ratios.columns if c.startswith("xbrl_")]
    ratios = _anchored(ratios, calendar, "anchor_q", {c: c for c in ratio_names})
    df = (
        anchor.join(month_revenue(monthly, calendar), KEY).join(balance, KEY).join(cash, KEY)
        .join(before, KEY, "left").join(eps_history(quarterly, calendar), KEY, "left").join(ratios, KEY, "left")
        .join(info.select("symbol", "industry"), "symbol", "left")
        .join(calendar.select("playbook_date", "anchor_q", "target_q"), "playbook_date")
    )
    known_until = F.lit(label_cutoff) if label_cutoff else calendar.agg(F.max("cutoff_date")).scalar()
    public = P.statutory_publish_date("target_q") <= known_until
    df = df.withColumn("target_eps", F.when(public, F.col("target_eps")))
    df = _growth_features(df).withColumn("industry", F.coalesce(F.col("industry").cast("string"), F.lit("unknown")))
    df = df.where(F.coalesce(pseudo_ttm() >= min_ttm, F.lit(False)))
    df = with_industry_quantiles(stage(df), MONTH_COLUMNS, ["playbook_date", "industry"])
    labeled = F.col("target_eps").isNotNull() & F.col("anchor_eps").isNotNull()
    newest = calendar.agg(F.max("playbook_date")).scalar()
    return df.withColumn("labeled", labeled).withColumn("live", labeled | (F.col("playbook_date") == newest))


def pseudo_ttm() -> Column:
    """Last year's target quarter plus the two latest quarters; NULL when one is missing."""
    return F.col("ly_target_eps") + F.col("pre_anchor_eps") + F.col("anchor_eps")


def _growth_features(df: DataFrame) -> DataFrame:
    div = N.safe_div_positive
    df = _month_features(df, [])
    return (
        df.withColumn("pre_anchor_margin", div("pre_anchor_ni", "pre_anchor_rev"))
        .withColumn("anchor_margin", div("anchor_ni", "anchor_rev"))
        .withColumn("anchor_ocf_ratio", N.clip(div("anchor_ocf", "anchor_ni"), -5, 5))
        .withColumn("anchor_re_ratio", div("retained_earnings", "capital"))
        .withColumn("margin_momentum", F.col("anchor_margin") - F.col("pre_anchor_margin"))
        .withColumn("anchor_non_op_ratio", N.div_nonzero("non_op_income_q", "pretax_income_q"))
        .withColumn("anchor_roe", N.div_nonzero("anchor_ni", "total_equity"))
        .withColumn("anchor_debt_ratio", N.div_nonzero("total_liabilities", "total_assets"))
        .withColumn("ly_seasonality", N.clip(div("ly_target_eps", "ly_anchor_eps"), -5, 5))
        .withColumn("anchor_yoy_eps", N.clip(div("anchor_eps", "ly_anchor_eps") - 1, -5, 5))
        .withColumn("delta_eps", F.col("target_eps") - F.col("anchor_eps"))
    )


def ttm_by_month(month: Column) -> Column:
    """Trailing EPS a cohort may know, by playbook month; one missing quarter makes it NULL."""

    def total(*cols: str) -> Column:
        out = F.col(cols[0])
        for c in cols[1:]:
            out = out + F.col(c)
        return out

    return (
        F.when(month.isin(2, 3, 4), total("ly_q1_eps", "ly_q2_eps", "ly_q3_eps", "ly_q4_eps"))
        .when(month.isin(5, 6, 7), total("ly_q2_eps", "ly_q3_eps", "ly_q4_eps", "ty_q1_eps"))
        .when(month.isin(8, 9, 10), total("ly_q3_eps", "ly_q4_eps", "ty_q1_eps", "ty_q2_eps"))
        .otherwise(total("ly_q4_eps", "ty_q1_eps", "ty_q2_eps", "anchor_eps"))
    )


def latest_quotes(cohort: DataFrame, quotes: DataFrame, rows: int = 20) -> DataFrame:
    """Per (cohort, symbol) the last quote up to the cutoff and the mean volume of its last rows.

    The mean over the last rows is a window of the quote series itself, so the
    cohort only has to find one row as of its cutoff. A short history averages
    what there is.
    """
    series = quote_series(quotes, rows)
    return asof.asof_backward(
        cohort, series, ["symbol"], "cutoff_date", "date", ["close", "quote_volume", "avg_volume_20d"], matched_as="quote_date"
    )


def quote_series(quotes: DataFrame, rows: int = 20) -> DataFrame:
    """Close, volume and mean volume of the last rows for every day of a symbol."""
    frame = W.series("symbol", "date").rowsBetween(-(rows - 1), 0)
    return quotes.select("symbol", "date", "close", F.col("volume").alias("quote_volume"), F.avg("volume").over(frame).alias("avg_volume_20d"))


def two_period_flag(series: DataFrame, value: str, out: str) -> DataFrame:
    """1 where this and the previous row are both above zero (else 0, also for NULL)."""
    w = W.series("symbol", "date")
    both = (F.col(value) > 0) & (F.lag(value).over(w) > 0)
    return series.withColumn(out, F.when(F.coalesce(both, F.lit(False)), 1).otherwise(0))


def with_as_of(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of the table's last row per symbol up to the cohort's cutoff."""
    return asof.asof_backward(df, table, ["symbol"], "cutoff_date", "date", list(columns))


def strategy_cohort(
    calendar: DataFrame, quarterly: DataFrame, facts: DataFrame, monthly: DataFrame, info: DataFrame, quotes: DataFrame,
    as_of_tables: Sequence[tuple[DataFrame, Sequence[str]]] = (), min_ttm: float = 2.0, min_lots: float = 400.0,
) -> DataFrame:
    """Candidate rows of every cohort: anchor facts, EPS history, price, volume and as-of features.

    Price and the tables of `as_of_tables` (table with symbol and date, columns; see `feature_families`) are looked
    up as of the cutoff in one merge. Facts and series of symbols without a quarterly report, which no cohort holds, are left out.
    """
    quarterly = stage(quarterly)
    facts, quotes = (asof.with_keys_of(t, quarterly, ["symbol"]) for t in (facts, quotes))
    as_of_tables = [(asof.with_keys_of(t, quarterly, ["symbol"]), columns) for t, columns in as_of_tables]
    anchor = _anchored(quarterly, calendar, "anchor_q", {
        "revenue_q": "anchor_rev", "net_income_q": "anchor_ni", "capital": "capital", "nav_per_share": "nav_per_share",
    })
    balance = _anchored(pivot_codes(facts, "as_of", BALANCE_CODES), calendar, "anchor_q", {"1XXX": "_assets", "2XXX": "_debts"})
    flow = single_quarter_flow(pivot_codes(facts, "accumulated", CASH_CODES), CASH_CODES, first_as_is=True)
    cash = _anchored(flow, calendar, "anchor_q", {"AAAA": "anchor_ocf"})
    df = (
        anchor.join(month_revenue(monthly, calendar).select(*KEY), KEY)
        .join(eps_history(quarterly, calendar), KEY)
        .join(balance, KEY, "left").join(cash, KEY, "left")
        .join(info.select("symbol", "name", "industry"), "symbol", "left")
        .join(calendar.select("playbook_date", "month", "cutoff_date"), "playbook_date")
    )
    df = df.where(F.coalesce(pseudo_ttm() >= min_ttm, F.lit(False)))
    families = [(table, "date", columns, None) for table, columns in as_of_tables]
    quote = (quote_series(quotes), "date", ["close", "quote_volume", "avg_volume_20d"], "quote_date")
    df = asof.asof_families(df, [quote, *families], ["symbol"], "cutoff_date")
    div = N.safe_div_positive
    df = (
        df.withColumn("ttm_eps", ttm_by_month(F.col("month")))
        .withColumn("volume_lots", F.col("quote_volume") / 1000)
        .withColumn("avg_volume_lots_20d", F.col("avg_volume_20d") / 1000)
        .withColumn("pe_current", div("close", "ttm_eps"))
        .withColumn("anchor_debt_ratio", N.div_nonzero("_debts", "_assets"))
        .withColumn("anchor_ocf_ratio", N.clip(div("anchor_ocf", "anchor_ni"), -5, 5))
        .withColumn("pb_ratio", div("close", "nav_per_share"))
    )
    return df.where(F.coalesce(F.col("avg_volume_lots_20d") >= min_lots, F.lit(False))).drop("_assets", "_debts")


CONCENTRATION = ["large_holder_ratio", "mid_holder_ratio", "small_holder_ratio", "concentration_spread"]
HOLDER_FEATURES = [*CONCENTRATION, *[f"{c}_wow" for c in CONCENTRATION], "large_holder_two_week_up"]


def feature_families(
    valuation: DataFrame, margin: DataFrame, short_interest: DataFrame, foreign: DataFrame, trust: DataFrame, dealer: DataFrame, concentration: DataFrame
) -> list[tuple[DataFrame, Sequence[str]]]:
    """The as-of features of a cohort by table: valuation, margin, lending, holdings of three institutions, concentration."""
    return [
        (valuation, ["roe_official", "pe_percentile_official"]), (margin, ["margin_usage_ratio", "short_cover_pressure"]),
        (short_interest, ["sbl_sell_repay_ratio"]), (foreign, ["foreign_held_ratio"]), (trust, ["trust_held_ratio"]), (dealer, ["dealer_held_ratio"]),
        (two_period_flag(concentration, "large_holder_ratio_wow", "large_holder_two_week_up"), HOLDER_FEATURES),
    ]


# ---- finalize ---------------------------------------------------------
def eps_growth_split(df: DataFrame, month: str = "month", delta: str = "pred_delta") -> DataFrame:
    """Expected growth of trailing EPS: the quarter rolling off, the predicted delta, and their sum."""
    m = F.col(month)
    rolloff = (
        F.when(m.isin(5, 6, 7), F.col("ly_q2_eps")).when(m.isin(8, 9, 10), F.col("ly_q3_eps"))
        .when(m.isin(11, 12, 1), F.col("ly_q4_eps")).otherwise(F.col("ly_q1_eps"))
    )
    base = N.div_nonzero((F.col("anchor_eps") - rolloff) * 100, "ttm_eps")
    predicted = N.div_nonzero(F.col(delta) * 100, "ttm_eps")
    return df.withColumns({"base_eps_growth_pct": base, "ml_eps_delta_pct": predicted, "eps_growth_total_pct": base + predicted})


def technical_features(cohort: DataFrame, indicators: DataFrame) -> DataFrame:
    """Price and volume against their averages, band position, as of the cutoff."""
    used = ["ma5", "ma10", "ma20", "ma60", "ma240", "vma5", "vma10", "vma20", "bb_upper", "bb_lower"]
    df = asof.asof_backward(cohort, indicators, ["symbol"], "cutoff_date", "date", used, matched_as="tech_snapshot_date")
    ratio = N.ratio_to_average
    out = {f"close_vs_ma{n}": ratio("close", f"ma{n}") for n in (5, 10, 20, 60, 240)}
    out.update({f"vol_vs_vma{n}": ratio("quote_volume", f"vma{n}") for n in (5, 10, 20)})
    out.update({"ma5_vs_ma20": ratio("ma5", "ma20"), "ma20_vs_ma60": ratio("ma20", "ma60"), "bb_position": N.band_position("close", "bb_lower", "bb_upper")})
    return df.withColumns(out).drop(*used)


def revenue_features(cohort: DataFrame, monthly: DataFrame) -> DataFrame:
    """Growth of the latest months public by the cutoff, per (cohort, symbol).

    Months are filed out of order, so what is public is a state of the revenue series by publish time:
    the six latest months among those published so far. A cohort reads the state of its cutoff, so no
    month filed later enters the mean of three (two needed), the acceleration against the third or the
    audit time. A symbol whose latest public month is older than expected gets NULLs.
    """
    optional = "cumulative_yoy_pct" if "cumulative_yoy_pct" in monthly.columns else None
    row = F.struct(
        F.col("date").alias("month"), clean.finite("yoy_pct").alias("yoy"), clean.finite("mom_pct").alias("mom"),
        (clean.finite(optional) if optional else F.lit(None).cast("double")).alias("cum"), F.col("publish_time").alias("at"),
    )
    so_far = W.series("symbol", "publish_time").rangeBetween(Window.unboundedPreceding, 0)
    states = (
        monthly.where("publish_time IS NOT NULL").withColumn("_top", F.collect_list(row).over(so_far))
        .select("symbol", "publish_time", F.slice(F.sort_array("_top", asc=False), 1, 6).alias("_top"))
        .dropDuplicates(["symbol", "publish_time"])
    )
    df = cohort.withColumn("_cut", F.date_format(F.to_date("cutoff_date"), "yyyyMMdd"))
    df = asof.asof_backward(df, states, ["symbol"], "_cut", "publish_time", ["_top"])
    cut = F.to_date("cutoff_date")
    expected = P.shift_month(P.month_token(F.year(cut), F.month(cut)), -1)
    first, third = F.get("_top", F.lit(0)), F.get("_top", F.lit(2))
    known = F.array_compact(F.transform(F.slice("_top", 1, 3), lambda r: r["yoy"]))
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
    features = {
        "revenue_yoy_1m": first["yoy"], "revenue_mom_1m": first["mom"],
        **({"revenue_cum_yoy": first["cum"]} if optional else {}),
        "revenue_yoy_3m_avg": F.when(F.size(known) >= 2, mean), "revenue_yoy_accel": first["yoy"] - third["yoy"],
    }
    df = df.withColumns({
        "revenue_month": first["month"], "rev_max_publish_time": F.array_max(F.transform("_top", lambda r: r["at"])),
    })
    fresh = F.col("revenue_month") >= expected
    return df.withColumns({c: F.when(fresh, v) for c, v in features.items()}).drop("_cut", "_top")


def trade_candidates(df: DataFrame) -> DataFrame:
    """Rows with both growth parts, a price, and positive total growth."""
    return df.where(
        "base_eps_growth_pct IS NOT NULL AND ml_eps_delta_pct IS NOT NULL AND close > 0 AND eps_growth_total_pct > 0"
    )


def guard_violations(cohort: DataFrame) -> DataFrame:
    """One row per cohort and broken as-of rule. A missing audit value is a violation.

    Expects cutoff_date, tech_snapshot_date, quote_date, rev_max_publish_time.
    """
    agg = cohort.groupBy("playbook_date", "cutoff_date").agg(
        F.max("tech_snapshot_date").alias("tech"), F.max("quote_date").alias("quote"), F.max("rev_max_publish_time").alias("rev")
    )
    cut = F.regexp_replace("cutoff_date", "-", "")
    rules = [
        ("unverifiable_technical", F.col("tech").isNull() | F.col("quote").isNull()),
        ("technical_beyond_cutoff", F.col("tech") > F.col("cutoff_date")),
        ("technical_behind_quotes", F.col("tech") < F.col("quote")),
        ("technical_ahead_of_quotes", F.col("tech") > F.col("quote")),
        ("unverifiable_revenue", F.col("rev").isNull()),
        ("revenue_beyond_cutoff", F.col("rev") > cut),
    ]
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return agg.select("playbook_date", "cutoff_date", "tech", "quote", "rev", F.explode(broken).alias("rule"))


def assert_point_in_time(cohort: DataFrame) -> None:
    """Raise if any cohort breaks a rule."""
    first = guard_violations(cohort).limit(1).collect()
    if first:
        raise ValueError(f"look-ahead guard: {first[0]['rule']} in cohort {first[0]['playbook_date']}")


GROWTH = ["base_eps_growth_pct", "ml_eps_delta_pct", "eps_growth_total_pct"]
AUDIT_DAYS = ["tech_snapshot_date", "rev_max_publish_time", "revenue_month"]


def finalize(
    cohort: DataFrame, predictions: DataFrame, trading_days: DataFrame, indicators: DataFrame, monthly: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The finished rows of every cohort and its trade candidates: growth split, entry day, technical and revenue features.

    `cohort` are the rows of `strategy_cohort`, `predictions` (playbook_date, symbol, pred_delta) at most one a row.
    Features are read as of the cutoff, never of the entry day, and the job fails if any cohort breaks a rule of the
    guard or has no trading day on or after its playbook day. Columns of an earlier run are made anew.
    """
    rest = [c for c in cohort.columns if c not in (*GROWTH, "pred_delta", "entry_date")]
    deltas = predictions.groupBy(*KEY).agg(F.max("pred_delta").alias("pred_delta"))
    df = eps_growth_split(cohort.select(*rest).join(deltas, KEY, "left"))
    days = asof.next_trading_day(df.select("playbook_date").distinct(), trading_days, "playbook_date", "entry_date")
    days = asof.require_found(days, "entry_date", "no trading day on or after a playbook day")
    df = technical_features(df.join(days, "playbook_date"), indicators)
    df = stage(revenue_features(df, monthly))
    assert_point_in_time(df)
    rows = df.drop(*AUDIT_DAYS)
    return rows, trade_candidates(rows).select(*KEY, "close", "entry_date", *GROWTH)


# ---- scoring ----------------------------------------------------------
def combine_scores(scores: DataFrame, agg: str = "score", group: Sequence[str] = ("playbook_date",)) -> DataFrame:
    """Member scores (cohort, symbol, model, score) to one: the mean, or minus the mean rank."""
    g = list(group)
    value = F.avg("score")
    if agg == "rank":
        scores = ranks.with_average_rank(scores, [*g, "model"], "score", "_r", descending=True)
        value = -F.avg("_r")
    elif agg != "score":
        raise ValueError(f"unknown aggregation {agg!r}")
    out = scores.groupBy(*g, "symbol").agg(value.alias("ml_score"), F.countDistinct("model").alias("scored_by_ensemble_k"))
    ranked = ranks.with_ordinal_rank(out, g, -F.col("ml_score"), "symbol", "ml_rank")
    return ranked.withColumn("scored_by_ensemble_agg", F.when(F.col("scored_by_ensemble_k") > 1, agg).otherwise("single"))


def model_for_target(models: DataFrame, targets: DataFrame) -> DataFrame:
    """Latest model version strictly before each target date, with its cutoff day."""
    found = asof.asof_backward(
        targets, models.select(F.col("version").alias("train_through")), [], "playbook_date", "train_through", ["train_through"], strict=True
    )
    return found.withColumn("train_through_cutoff", P.add_days("train_through", -1))


# ---- versions ---------------------------------------------------------
def compare_versions(old: DataFrame, new: DataFrame, score: str, rank: str, numeric: Sequence[str]) -> DataFrame:
    """Per cohort: sizes, symbols added and removed, overlap, top overlap, mean differences, rank agreement."""
    o = old.select(*KEY, F.col(score).alias("_so"), F.col(rank).alias("_ro"), *[F.col(c).alias(f"_o_{c}") for c in numeric])
    n = new.select(*KEY, F.col(score).alias("_sn"), F.col(rank).alias("_rn"), *[F.col(c).alias(f"_n_{c}") for c in numeric])
    both = o.join(n, KEY, "full_outer")
    in_old, in_new = F.col("_ro").isNotNull(), F.col("_rn").isNotNull()

    def count(cond: Column) -> Column:
        return F.sum(cond.cast("int"))

    def overlap(k: int) -> Column:
        return F.sum(F.coalesce((F.col("_ro") <= k) & (F.col("_rn") <= k), F.lit(False)).cast("int")).alias(f"top{k}_overlap")

    agg = both.groupBy("playbook_date").agg(
        count(in_old).alias("rows_old"), count(in_new).alias("rows_new"), count(in_old & in_new).alias("shared"),
        count(~in_old & in_new).alias("added"), count(in_old & ~in_new).alias("removed"), overlap(10), overlap(20),
        *[F.avg(F.abs(F.col(f"_o_{c}") - F.col(f"_n_{c}"))).alias(f"_d_{c}") for c in numeric],
    )
    diffs = F.array_compact(F.array(*[F.col(f"_d_{c}") for c in numeric]))
    mean_diff = F.try_divide(F.aggregate(diffs, F.lit(0.0), lambda a, x: a + x), F.size(diffs))
    agree = ranks.correlations(both, ["playbook_date"], "_so", "_sn").where("n >= 3").select("playbook_date", F.col("spearman").alias("score_spearman"))
    out = agg.withColumn("jaccard", F.try_divide("shared", F.col("shared") + F.col("added") + F.col("removed")))
    out = out.withColumn("mean_abs_diff", mean_diff).withColumn("rows_diff_pct", N.div_nonzero((F.col("rows_new") - F.col("rows_old")) * 100.0, "rows_old"))
    return out.drop(*[f"_d_{c}" for c in numeric]).join(agree, "playbook_date", "left")

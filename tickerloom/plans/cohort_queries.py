"""Queries that build, finalize, guard and compare point-in-time cohorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.jobs import cohort, derive
from tickerloom.operators import asof, ranks, windows as W
from tickerloom.plans import views as V
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.registry import query
from tickerloom.plans.series_queries import _VAL, _round_all, pe_ratio
from tickerloom.session import stage

R = N.rnd


@query("playbook_calendar", "X8 X11 X12 X13", with_views("""
SELECT playbook_date, cutoff_date, target_q, anchor_q, pre_anchor_q, ly_target_q, ly_anchor_q, feature_months,
 ((mi - 1) // 12) || 'M' || printf('%02d', (mi - 1) % 12 + 1) AS expected_revenue_month FROM cohort_calendar"""))
def playbook_calendar(spark, sf):
    return V.playbook(spark, sf).drop("year", "month")


@query("latest_playbook_day", "X11 X7", with_views("""
WITH d AS (SELECT date, CAST(date AS DATE) AS d FROM calendar)
SELECT date, (SELECT max(p.playbook_date) FROM (SELECT strftime(make_date(year(m), month(m), CASE WHEN month(m) IN (5, 8, 11) THEN 16 ELSE 11 END), '%Y-%m-%d') AS playbook_date
   FROM (SELECT unnest([d.d, d.d - INTERVAL 1 MONTH]) AS m)) p WHERE p.playbook_date <= date) AS playbook_date,
 (CASE WHEN month(d) IN (5, 8, 11) THEN 16 ELSE 11 END) = day(d) AS is_playbook_day FROM d"""))
def latest_playbook_day(spark, sf):
    return V.calendar(spark, sf).select("date", P.latest_playbook_day("date").alias("playbook_date"), P.is_playbook_day("date").alias("is_playbook_day"))


# ---- statement pieces -------------------------------------------------
def _pivot(codes, kind, agg="max"):
    cols = ", ".join(f"{agg}(value_num) FILTER (account_code = '{c}') AS \"{c}\"" for c in codes)
    inlist = ", ".join(f"'{c}'" for c in codes)
    return f"(SELECT date, symbol, {cols} FROM statements WHERE period_type = '{kind}' AND account_code IN ({inlist}) GROUP BY 1, 2)"


_PREV = "CASE WHEN substr(a.date, 6, 1) = '1' THEN (CAST(substr(a.date, 1, 4) AS INT) - 1) || 'Q4' ELSE substr(a.date, 1, 5) || (CAST(substr(a.date, 6, 1) AS INT) - 1) END"
_CASH = _pivot(cohort.CASH_CODES, "accumulated")
_FLOW_NULL = f"(SELECT a.date, a.symbol, a.\"AAAA\" - p.\"AAAA\" AS \"AAAA\", a.\"B02700\" - p.\"B02700\" AS \"B02700\" FROM {_CASH} a LEFT JOIN {_CASH} p ON p.symbol = a.symbol AND p.date = {_PREV})"
_FLOW_ZERO = f"(SELECT a.date, a.symbol, CASE WHEN substr(a.date, 6, 1) = '1' THEN a.\"AAAA\" ELSE a.\"AAAA\" - coalesce(p.\"AAAA\", 0) END AS \"AAAA\", CASE WHEN substr(a.date, 6, 1) = '1' THEN a.\"B02700\" ELSE a.\"B02700\" - coalesce(p.\"B02700\", 0) END AS \"B02700\" FROM {_CASH} a LEFT JOIN {_CASH} p ON p.symbol = a.symbol AND p.date = {_PREV})"


def _flow(sql):
    return with_views(f'SELECT date, symbol, rnd("AAAA", 4) AS operating, rnd("B02700", 4) AS capex FROM {sql}')


def _flow_df(spark, sf, first_as_is):
    acc = cohort.pivot_codes(V.statements(spark, sf), "accumulated", cohort.CASH_CODES)
    df = cohort.single_quarter_flow(acc, cohort.CASH_CODES, first_as_is)
    return df.select("date", "symbol", R("AAAA", 4).alias("operating"), R("B02700", 4).alias("capex"))


@query("cash_flow_first_quarter_as_is", "J14 A3", _flow(_FLOW_ZERO))
def cash_flow_first_quarter_as_is(spark, sf):
    return _flow_df(spark, sf, True)


@query("cash_flow_always_subtract", "J15 A3", _flow(_FLOW_NULL))
def cash_flow_always_subtract(spark, sf):
    return _flow_df(spark, sf, False)


@query("pivot_last_code", "A4", with_views("""
SELECT printf('%04d', l_suppkey) AS symbol, arg_max(l_quantity, k) FILTER (c = 'AF') AS af, arg_max(l_quantity, k) FILTER (c = 'NO') AS no, arg_max(l_quantity, k) FILTER (c = 'RF') AS rf
FROM (SELECT *, l_returnflag || l_linestatus AS c, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem) GROUP BY 1"""))
def pivot_last_code(spark, sf):
    li = V.table(spark, sf, "lineitem").select(
        V.symbol_of("l_suppkey").alias("symbol"), F.lit("x").alias("date"), F.lit("quarter").alias("period_type"),
        F.concat("l_returnflag", "l_linestatus").alias("account_code"), F.col("l_quantity").alias("value_num"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("pos"),
    )
    df = cohort.pivot_codes(li, "quarter", ["AF", "NO", "RF"], order="pos")
    return df.select("symbol", F.col("AF").alias("af"), F.col("NO").alias("no"), F.col("RF").alias("rf"))


def _div(n, d):
    return f"CASE WHEN {d} > 0 THEN {n} / {d} END"


def _clip(x, lo, hi):
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"


_RATIOS = f"""(SELECT coalesce(coalesce(i.date, b.date), c.date) AS date, coalesce(coalesce(i.symbol, b.symbol), c.symbol) AS symbol,
  {_div('"5900"', '"4000"')} AS xbrl_gross_margin_q, {_div('"6900"', '"4000"')} AS xbrl_op_margin_q, {_div('"6300"', '"4000"')} AS xbrl_rd_ratio_q,
  {_clip(_div('"7950"', '"7900"'), 0, 1)} AS xbrl_tax_rate_q, {_clip(_div('"11XX"', '"21XX"'), 0, 20)} AS xbrl_current_ratio, {_clip(_div('"1100"', '"1XXX"'), 0, 1)} AS xbrl_cash_to_assets,
  {_clip(_div('"AAAA"', '"8200"'), -10, 10)} AS xbrl_cfo_to_ni_q, {_clip(_div('abs("B02700")', '"4000"'), 0, 10)} AS xbrl_capex_to_revenue_q
 FROM {_pivot(cohort.INCOME_CODES, 'quarter')} i FULL JOIN {_pivot(cohort.BALANCE_CODES, 'as_of')} b ON i.date = b.date AND i.symbol = b.symbol
 FULL JOIN {_FLOW_NULL} c ON coalesce(i.date, b.date) = c.date AND coalesce(i.symbol, b.symbol) = c.symbol)"""
_XB = ["xbrl_gross_margin_q", "xbrl_op_margin_q", "xbrl_rd_ratio_q", "xbrl_tax_rate_q", "xbrl_current_ratio", "xbrl_cash_to_assets", "xbrl_cfo_to_ni_q", "xbrl_capex_to_revenue_q"]


@query("statement_ratios", "P18 P12 P14 J11 A3", with_views(f"SELECT date, symbol, {', '.join(f'rnd({c}, 6) AS {c}' for c in _XB)} FROM {_RATIOS}"))
def statement_ratios(spark, sf):
    return _round_all(cohort.statement_ratios(V.statements(spark, sf)), 6)


# ---- EPS history and months ------------------------------------------
_EPS = """eps AS (SELECT c.playbook_date, q.symbol, max(eps_q) FILTER (q.date = c.target_q) AS target_eps, max(eps_q) FILTER (q.date = c.ly_target_q) AS ly_target_eps,
  max(eps_q) FILTER (q.date = c.ly_anchor_q) AS ly_anchor_eps, max(eps_q) FILTER (q.date = c.pre_anchor_q) AS pre_anchor_eps, max(eps_q) FILTER (q.date = c.anchor_q) AS anchor_eps,
  max(eps_q) FILTER (q.date = (c.ti // 4 - 1) || 'Q1') AS ly_q1_eps, max(eps_q) FILTER (q.date = (c.ti // 4 - 1) || 'Q2') AS ly_q2_eps, max(eps_q) FILTER (q.date = (c.ti // 4 - 1) || 'Q3') AS ly_q3_eps,
  max(eps_q) FILTER (q.date = (c.ti // 4 - 1) || 'Q4') AS ly_q4_eps, max(eps_q) FILTER (q.date = (c.ti // 4) || 'Q1') AS ty_q1_eps, max(eps_q) FILTER (q.date = (c.ti // 4) || 'Q2') AS ty_q2_eps
 FROM cohort_calendar c JOIN quarterly q ON q.date IN (c.target_q, c.ly_target_q, c.ly_anchor_q, c.pre_anchor_q, c.anchor_q, (c.ti // 4 - 1) || 'Q1', (c.ti // 4 - 1) || 'Q2', (c.ti // 4 - 1) || 'Q3', (c.ti // 4 - 1) || 'Q4', (c.ti // 4) || 'Q1', (c.ti // 4) || 'Q2')
 GROUP BY 1, 2)"""
_EPS_COLS = ["target_eps", "ly_target_eps", "ly_anchor_eps", "pre_anchor_eps", "anchor_eps", "ly_q1_eps", "ly_q2_eps", "ly_q3_eps", "ly_q4_eps", "ty_q1_eps", "ty_q2_eps"]


@query("eps_history", "A3 J9", with_views(f"WITH {_EPS} SELECT playbook_date, symbol, {', '.join(f'rnd({c}, 6) AS {c}' for c in _EPS_COLS)} FROM eps"))
def eps_history(spark, sf):
    return _round_all(cohort.eps_history(V.quarterly(spark, sf), V.playbook(spark, sf)), 6)


_MONTH = """mk AS (SELECT playbook_date, replace(cutoff_date, '-', '') AS cut, k, mi - feature_months + k - 1 AS i FROM (SELECT *, unnest(generate_series(1, feature_months)) AS k FROM cohort_calendar)),
 mrow AS (SELECT mk.playbook_date, m.symbol, mk.k, m.date, m.revenue_current AS v, (i // 12) || 'M' || printf('%02d', i % 12 + 1) AS cur, ((i - 1) // 12) || 'M' || printf('%02d', (i - 1) % 12 + 1) AS prv, ((i - 12) // 12) || 'M' || printf('%02d', i % 12 + 1) AS ly
   FROM mk JOIN monthly m ON m.date IN ((i // 12) || 'M' || printf('%02d', i % 12 + 1), ((i - 1) // 12) || 'M' || printf('%02d', (i - 1) % 12 + 1), ((i - 12) // 12) || 'M' || printf('%02d', i % 12 + 1)) AND m.publish_time <= mk.cut),
 mrev AS (SELECT playbook_date, symbol, """ + ", ".join(
    f"max(v) FILTER (k = {k} AND date = {src}) AS {name}{k}" for k in (1, 2, 3) for src, name in (("cur", "rev_"), ("prv", "rev_prev_"), ("ly", "rev_ly_"))
) + " FROM mrow GROUP BY 1, 2)"


@query("month_revenue_pivot", "A3 F3 X13", with_views(f"WITH {_MONTH} SELECT playbook_date, symbol, " + ", ".join(f"rnd({n}{k}, 4) AS {n}{k}" for k in (1, 2, 3) for n in ("rev_", "rev_prev_", "rev_ly_")) + " FROM mrev"))
def month_revenue_pivot(spark, sf):
    return _round_all(cohort.month_revenue(V.monthly(spark, sf), V.playbook(spark, sf)), 4)


# ---- EPS dataset ------------------------------------------------------
_ANCHORED = f"""anchored AS (SELECT c.playbook_date, c.anchor_q, c.target_q, q.symbol, q.market, q.revenue_q AS anchor_rev, q.net_income_q AS anchor_ni, q.non_op_income_q, q.pretax_income_q, q.capital
  FROM cohort_calendar c JOIN quarterly q ON q.date = c.anchor_q)"""
_QCOLS = [f"rev_{kind}_{k}" for k in (1, 2, 3) for kind in ("yoy", "mom")]
_EPSDATA = f"""WITH {_EPS}, {_MONTH}, {_ANCHORED},
 raw AS (SELECT a.*, m.* EXCLUDE (playbook_date, symbol), e.* EXCLUDE (playbook_date, symbol), x.* EXCLUDE (date, symbol), b."1XXX" AS ta, b."2XXX" AS tl, b."3XXX" AS te, b."3300" AS re, f."AAAA" AS ocf,
   p.revenue_q AS pre_rev, p.net_income_q AS pre_ni, coalesce(CAST(i.industry AS VARCHAR), 'unknown') AS industry
  FROM anchored a JOIN mrev m ON m.playbook_date = a.playbook_date AND m.symbol = a.symbol
  JOIN {_pivot(cohort.BALANCE_CODES, 'as_of')} b ON b.date = a.anchor_q AND b.symbol = a.symbol JOIN {_FLOW_NULL} f ON f.date = a.anchor_q AND f.symbol = a.symbol
  LEFT JOIN (SELECT c.playbook_date, q.* FROM cohort_calendar c JOIN quarterly q ON q.date = c.pre_anchor_q) p ON p.playbook_date = a.playbook_date AND p.symbol = a.symbol
  LEFT JOIN eps e ON e.playbook_date = a.playbook_date AND e.symbol = a.symbol LEFT JOIN {_RATIOS} x ON x.date = a.anchor_q AND x.symbol = a.symbol LEFT JOIN issued i ON i.symbol = a.symbol
  WHERE e.ly_target_eps + e.pre_anchor_eps + e.anchor_eps >= 0.02),
 feat AS (SELECT *, {', '.join(f"{_div(f'rev_{k}', f'rev_ly_{k}')} - 1 AS rev_yoy_{k}, {_div(f'rev_{k}', f'rev_prev_{k}')} - 1 AS rev_mom_{k}" for k in (1, 2, 3))},
   {_div('pre_ni', 'pre_rev')} AS pre_anchor_margin, {_div('anchor_ni', 'anchor_rev')} AS anchor_margin FROM raw),
 z AS (SELECT *, {', '.join(f"({c} - avg({c}) OVER g) / nullif(stddev_samp({c}) OVER g, 0) AS z_{c}" for c in _QCOLS)} FROM feat WINDOW g AS (PARTITION BY playbook_date, industry)),
 dec AS (SELECT *, {', '.join(f"CASE WHEN z_{c} IS NOT NULL THEN least(greatest(ceil((rank() OVER (PARTITION BY playbook_date, industry ORDER BY z_{c} NULLS LAST) + (count(*) OVER (PARTITION BY playbook_date, industry, z_{c}) - 1) / 2.0::DOUBLE) / count(z_{c}) OVER (PARTITION BY playbook_date, industry) * 10), 1), 10) / 10.0::DOUBLE END AS {c}_quantile" for c in _QCOLS)} FROM z)"""


def _eps_dataset(spark, sf):
    return cohort.eps_dataset(
        V.playbook(spark, sf), V.quarterly(spark, sf), V.statements(spark, sf), V.monthly(spark, sf),
        V.issued(spark, sf).select("symbol", "industry"), min_ttm=0.02,
    )


_EPS_OUT = ["anchor_margin", "margin_momentum", "anchor_ocf_ratio", "anchor_re_ratio", "anchor_non_op_ratio", "anchor_roe", "anchor_debt_ratio", "ly_seasonality", "anchor_yoy_eps", "delta_eps", *_XB]


_PUBLIC = "(CASE substr(target_q, 6, 1) WHEN '1' THEN substr(target_q, 1, 4) || '-05-15' WHEN '2' THEN substr(target_q, 1, 4) || '-08-14' WHEN '3' THEN substr(target_q, 1, 4) || '-11-14' ELSE (CAST(substr(target_q, 1, 4) AS INT) + 1) || '-03-31' END) <= (SELECT max(cutoff_date) FROM cohort_calendar)"


@query("eps_dataset", "C6 J9 J10 J11 J15 F3 F5 F6 P12 P13 P14 P18 W13 W14", with_views(_EPSDATA + f"""
SELECT playbook_date, symbol, market, industry, anchor_q, target_q, rnd(anchor_margin, 6) AS anchor_margin, rnd(anchor_margin - pre_anchor_margin, 6) AS margin_momentum,
 rnd({_clip(_div('ocf', 'anchor_ni'), -5, 5)}, 6) AS anchor_ocf_ratio, rnd({_div('re', 'capital')}, 6) AS anchor_re_ratio, rnd(non_op_income_q / nullif(pretax_income_q, 0), 6) AS anchor_non_op_ratio,
 rnd(anchor_ni / nullif(te, 0), 6) AS anchor_roe, rnd(tl / nullif(ta, 0), 6) AS anchor_debt_ratio, rnd({_clip(_div('ly_target_eps', 'ly_anchor_eps'), -5, 5)}, 6) AS ly_seasonality,
 rnd({_clip(_div('anchor_eps', 'ly_anchor_eps') + ' - 1', -5, 5)}, 6) AS anchor_yoy_eps, rnd(CASE WHEN {_PUBLIC} THEN target_eps END - anchor_eps, 6) AS delta_eps, {', '.join(f'rnd({c}, 6) AS {c}' for c in _XB)},
 {', '.join(f'{c}_quantile' for c in _QCOLS)}, (target_eps IS NOT NULL AND anchor_eps IS NOT NULL AND {_PUBLIC}) AS labeled,
 (target_eps IS NOT NULL AND anchor_eps IS NOT NULL AND {_PUBLIC}) OR playbook_date = (SELECT max(playbook_date) FROM cohort_calendar) AS live FROM dec"""))
def eps_dataset(spark, sf):
    df = _eps_dataset(spark, sf)
    keep = ["playbook_date", "symbol", "market", "industry", "anchor_q", "target_q", *_EPS_OUT, *[f"{c}_quantile" for c in _QCOLS], "labeled", "live"]
    return _round_all(df.select(*keep), 6)


# ---- strategy cohort --------------------------------------------------
_STRAT = f"""WITH {_EPS}, {_MONTH}, {_ANCHORED}, base AS (
 SELECT a.playbook_date, a.symbol, c.month, c.cutoff_date, i.name, i.industry, a.anchor_ni, q.nav_per_share, e.* EXCLUDE (playbook_date, symbol), b."2XXX" / nullif(b."1XXX", 0) AS anchor_debt_ratio,
   {_clip(_div('f."AAAA"', 'a.anchor_ni'), -5, 5)} AS anchor_ocf_ratio,
   CASE WHEN c.month IN (2, 3, 4) THEN ly_q1_eps + ly_q2_eps + ly_q3_eps + ly_q4_eps WHEN c.month IN (5, 6, 7) THEN ly_q2_eps + ly_q3_eps + ly_q4_eps + ty_q1_eps
     WHEN c.month IN (8, 9, 10) THEN ly_q3_eps + ly_q4_eps + ty_q1_eps + ty_q2_eps ELSE ly_q4_eps + ty_q1_eps + ty_q2_eps + anchor_eps END AS ttm_eps
 FROM anchored a JOIN cohort_calendar c ON c.playbook_date = a.playbook_date JOIN mrev m ON m.playbook_date = a.playbook_date AND m.symbol = a.symbol JOIN eps e ON e.playbook_date = a.playbook_date AND e.symbol = a.symbol
 JOIN quarterly q ON q.date = a.anchor_q AND q.symbol = a.symbol
 LEFT JOIN {_pivot(cohort.BALANCE_CODES, 'as_of')} b ON b.date = a.anchor_q AND b.symbol = a.symbol LEFT JOIN {_FLOW_ZERO} f ON f.date = a.anchor_q AND f.symbol = a.symbol LEFT JOIN issued i ON i.symbol = a.symbol
 WHERE ly_target_eps + pre_anchor_eps + anchor_eps >= 0.02),
 ser AS (SELECT symbol, date, close, volume, avg(volume) OVER (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING) AS av FROM quotes),
 strat AS (SELECT b.*, s.date AS quote_date, s.close, s.volume AS quote_volume, s.av / 1000 AS avg_volume_lots_20d FROM base b ASOF JOIN ser s ON s.symbol = b.symbol AND b.cutoff_date >= s.date WHERE s.av / 1000 >= 0.02)"""


def _strategy(spark, sf, extra=()):
    return cohort.strategy_cohort(
        V.playbook(spark, sf), V.quarterly(spark, sf), V.statements(spark, sf), V.monthly(spark, sf), V.issued(spark, sf),
        V.quotes(spark, sf), extra, min_ttm=0.02, min_lots=0.02,
    )


# The tables that a cohort reads as of its cutoff.
_HELD = ", ".join(
    f"rnd(CASE WHEN issued_shares > 0 THEN sum({c}_net) OVER (PARTITION BY market, symbol ORDER BY date) / issued_shares * 100 END, 4) AS {c}_held_ratio"
    for c in ("foreign", "trust", "dealer")
)
_CONC = ", ".join(
    f"rnd({v}, 4) AS {c}, rnd({v} - lag({v}) OVER (PARTITION BY symbol ORDER BY date), 4) AS {c}_wow"
    for v, c in (("la", "large_holder_ratio"), ("mi", "mid_holder_ratio"), ("sm", "small_holder_ratio"), ("(la - sm)", "concentration_spread"))
)
_FAMILIES = f"""{_VAL},
 fv AS (SELECT v.symbol, v.date, rnd(v.ttm / nullif(v.nav_per_share, 0) * 100, 2) AS roe_official, pct.p AS pe_percentile_official FROM val v LEFT JOIN pct ON v.date = pct.date AND v.symbol = pct.symbol),
 fm AS (SELECT date, symbol, rnd(CASE WHEN ll > 0 THEN lb / ll * 100 END, 4) AS margin_usage_ratio, rnd(CASE WHEN sp > 0 THEN (buy + rep) / sp * 100 END, 4) AS short_cover_pressure, rnd(CASE WHEN r > 0 THEN s / r END, 4) AS sbl_sell_repay_ratio
   FROM (SELECT date, symbol, sum(coalesce(margin_long_balance, 0)) AS lb, sum(coalesce(margin_long_limit, 0)) AS ll, sum(coalesce(margin_short_prev_balance, 0)) AS sp, sum(coalesce(margin_short_buy, 0)) AS buy,
     sum(coalesce(margin_short_cash_repay, 0)) AS rep, sum(coalesce(sbl_sell, 0)) AS s, sum(coalesce(sbl_repay, 0)) AS r FROM margin GROUP BY 1, 2)),
 fi AS (SELECT date, symbol, {_HELD} FROM flows LEFT JOIN foreign_holding USING (date, market, symbol)),
 fb AS (SELECT date, symbol, {_CONC} FROM (SELECT date, symbol, sum(CASE WHEN level BETWEEN 12 AND 15 THEN percentage ELSE 0 END) AS la, sum(CASE WHEN level BETWEEN 9 AND 11 THEN percentage ELSE 0 END) AS mi,
   sum(CASE WHEN level BETWEEN 1 AND 8 THEN percentage ELSE 0 END) AS sm FROM shareholding GROUP BY 1, 2)),
 fc AS (SELECT *, CASE WHEN large_holder_ratio_wow > 0 AND lag(large_holder_ratio_wow) OVER (PARTITION BY symbol ORDER BY date) > 0 THEN 1 ELSE 0 END AS large_holder_two_week_up FROM fb)"""
_FAMILY_COLUMNS = [
    "roe_official", "pe_percentile_official", "margin_usage_ratio", "short_cover_pressure", "sbl_sell_repay_ratio", "foreign_held_ratio", "trust_held_ratio",
    "dealer_held_ratio", *cohort.HOLDER_FEATURES,
]
_FAMILY_JOINS = " ".join(f"ASOF LEFT JOIN {f} ON {f}.symbol = strat.symbol AND strat.cutoff_date >= {f}.date" for f in ("fv", "fm", "fi", "fc"))


def _families(spark, sf):
    reports = stage(V.reports(spark, sf))  # the symbols that a cohort may hold
    margin, flows, foreign, quotes, official = (
        asof.with_keys_of(t, reports, ["symbol"])
        for t in (V.margin(spark, sf), V.flows(spark, sf), V.foreign_holding(spark, sf), V.quotes(spark, sf), pe_ratio(spark, sf))
    )
    flows, foreign = stage(flows), stage(foreign)
    held = [derive.cumulative_holding(flows, foreign, f"{c}_net", c) for c in ("foreign", "trust", "dealer")]
    valuation = derive.valuation(quotes, reports, official)
    return cohort.feature_families(valuation, derive.margin_pressure(margin), derive.short_interest(margin), *held, derive.concentration(V.shareholding(spark, sf)))


@query("strategy_cohort", "C7 J5 J9 J14 W12 P13 P17 F4 F5", with_views(_STRAT + f""", {_FAMILIES}
SELECT strat.playbook_date, strat.symbol, name, industry, rnd(anchor_eps, 6) AS anchor_eps, rnd(ttm_eps, 6) AS ttm_eps, rnd({_div('close', 'ttm_eps')}, 4) AS pe_current, rnd(quote_volume / 1000, 6) AS volume_lots,
 rnd(avg_volume_lots_20d, 6) AS avg_volume_lots_20d, quote_date, rnd(close, 4) AS close, rnd(anchor_debt_ratio, 6) AS anchor_debt_ratio, rnd(anchor_ocf_ratio, 6) AS anchor_ocf_ratio, rnd({_div('close', 'nav_per_share')}, 4) AS pb_ratio,
 {', '.join(_FAMILY_COLUMNS)} FROM strat {_FAMILY_JOINS}"""))
def strategy_cohort(spark, sf):
    df = _strategy(spark, sf, _families(spark, sf))
    digits = {"anchor_eps": 6, "ttm_eps": 6, "pe_current": 4, "volume_lots": 6, "avg_volume_lots_20d": 6, "close": 4, "anchor_debt_ratio": 6, "anchor_ocf_ratio": 6, "pb_ratio": 4}
    return df.select("playbook_date", "symbol", "name", "industry", "quote_date", *[R(c, d).alias(c) for c, d in digits.items()], *_FAMILY_COLUMNS)


@query("cohort_holder_features", "C7 A5 J5", with_views("""
WITH keys AS (SELECT s.playbook_date, s.symbol, c.cutoff_date FROM scored_base s JOIN cohort_calendar c ON c.playbook_date = s.playbook_date), b AS (SELECT date, symbol, sum(CASE WHEN level BETWEEN 12 AND 15 THEN percentage ELSE 0 END) AS la FROM shareholding GROUP BY 1, 2),
 d AS (SELECT *, rnd(la - lag(la) OVER (PARTITION BY symbol ORDER BY date), 4) AS wow FROM b),
 r AS (SELECT c.playbook_date, d.*, row_number() OVER (PARTITION BY c.playbook_date, d.symbol ORDER BY d.date DESC) AS rn FROM keys c JOIN d ON d.symbol = c.symbol AND d.date <= c.cutoff_date)
SELECT playbook_date, symbol, rnd(max(la) FILTER (rn = 1), 4) AS large_holder_ratio, max(wow) FILTER (rn = 1) AS large_holder_ratio_wow,
 CASE WHEN max(wow) FILTER (rn = 1) > 0 AND max(wow) FILTER (rn = 2) > 0 THEN 1 ELSE 0 END AS large_holder_two_week_up FROM r WHERE rn <= 2 GROUP BY 1, 2"""))
def cohort_holder_features(spark, sf):
    series = cohort.two_period_flag(derive.concentration(V.shareholding(spark, sf)), "large_holder_ratio_wow", "large_holder_two_week_up")
    df = cohort.with_as_of(_keys(spark, sf), series, ["large_holder_ratio", "large_holder_ratio_wow", "large_holder_two_week_up"])
    return df.where("large_holder_two_week_up IS NOT NULL").drop("cutoff_date", "month")


# ---- finalize ---------------------------------------------------------
_REV = """rev AS (SELECT k.playbook_date, k.symbol, k.cutoff_date, m.date, m.yoy_pct, m.mom_pct, m.publish_time, row_number() OVER (PARTITION BY k.playbook_date, k.symbol ORDER BY m.date DESC) AS rn
   FROM keys k JOIN monthly m ON m.symbol = k.symbol AND m.publish_time <= replace(k.cutoff_date, '-', '')),
 rf AS (SELECT playbook_date, symbol, max(publish_time) AS rev_max_publish_time, max(date) FILTER (rn = 1) >= strftime(CAST(cutoff_date AS DATE) - INTERVAL 1 MONTH, '%YM%m') AS fresh,
   max(yoy_pct) FILTER (rn = 1) AS y1, max(mom_pct) FILTER (rn = 1) AS m1, CASE WHEN count(yoy_pct) FILTER (rn <= 3) >= 2 THEN avg(yoy_pct) FILTER (rn <= 3) END AS y3, max(yoy_pct) FILTER (rn = 3) AS y3ago FROM rev WHERE rn <= 6 GROUP BY playbook_date, symbol, cutoff_date)"""


def _keys(spark, sf):
    cal = V.playbook(spark, sf).select("playbook_date", "cutoff_date", "month")
    return V.scored_base(spark, sf).select("playbook_date", "symbol").join(cal, "playbook_date")


_KEYS = "keys AS (SELECT s.playbook_date, s.symbol, c.cutoff_date, c.month FROM scored_base s JOIN cohort_calendar c ON c.playbook_date = s.playbook_date)"


@query("revenue_features", "W23 F3 F8 M3 J5 X13", with_views(f"""
WITH {_KEYS}, {_REV} SELECT k.playbook_date, k.symbol, rev_max_publish_time, rnd(CASE WHEN fresh THEN y1 END, 4) AS revenue_yoy_1m, rnd(CASE WHEN fresh THEN m1 END, 4) AS revenue_mom_1m,
 rnd(CASE WHEN fresh THEN y3 END, 4) AS revenue_yoy_3m_avg, rnd(CASE WHEN fresh THEN y1 - y3ago END, 4) AS revenue_yoy_accel FROM keys k LEFT JOIN rf ON rf.playbook_date = k.playbook_date AND rf.symbol = k.symbol"""))
def revenue_features(spark, sf):
    df = cohort.revenue_features(_keys(spark, sf), V.monthly(spark, sf))
    return _round_all(df.drop("cutoff_date", "month", "revenue_month"), 4)


def _indicators(spark, sf):
    """The part of technical_indicators that the features read: averages and bands."""
    q = V.quotes(spark, sf).select("symbol", "date", "close", "volume")
    df = W.with_rolling_means(q, "symbol", "date", {"close": (5, 10, 20, 60, 240), "volume": (5, 10, 20)}, {"close": "ma", "volume": "vma"})
    df = df.withColumn("_sd", W.rolling_std("close", W.series("symbol", "date"), 20))
    return df.withColumn("bb_upper", F.col("ma20") + 2 * F.col("_sd")).withColumn("bb_lower", F.col("ma20") - 2 * F.col("_sd"))


_IND = "ind AS (SELECT symbol, date, close, volume, " + ", ".join(
    f"CASE WHEN count(*) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) = {n} THEN avg({c}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END AS {p}{n}"
    for p, c, ns in (("ma", "close", (5, 10, 20, 60, 240)), ("vma", "volume", (5, 10, 20))) for n in ns
) + ", CASE WHEN count(*) OVER (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING) = 20 THEN stddev_samp(close) OVER (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING) END AS sd FROM quotes)"


def _vs(x, m):
    return f"rnd(CASE WHEN {m} > 0 THEN {x} / {m} - 1 END, 6)"


@query("technical_features", "P15 J5 C8", with_views(f"""
WITH {_KEYS}, {_IND} SELECT k.playbook_date, k.symbol, i.date AS tech_snapshot_date, {', '.join(f"{_vs('close', f'ma{n}')} AS close_vs_ma{n}" for n in (5, 10, 20, 60, 240))},
 {', '.join(f"{_vs('volume', f'vma{n}')} AS vol_vs_vma{n}" for n in (5, 10, 20))}, {_vs('ma5', 'ma20')} AS ma5_vs_ma20, {_vs('ma20', 'ma60')} AS ma20_vs_ma60,
 rnd(CASE WHEN 4 * sd > 0 THEN (close - (ma20 - 2 * sd)) / ((ma20 + 2 * sd) - (ma20 - 2 * sd)) END, 6) AS bb_position
FROM keys k ASOF LEFT JOIN ind i ON i.symbol = k.symbol AND k.cutoff_date >= i.date"""))
def technical_features(spark, sf):
    keys = cohort.latest_quotes(_keys(spark, sf), V.quotes(spark, sf)).drop("avg_volume_20d", "quote_date")
    df = cohort.technical_features(keys, _indicators(spark, sf))
    return _round_all(df.drop("cutoff_date", "month", "close", "quote_volume"), 6)


_GROWTH = _STRAT + """, fin AS (SELECT *, 100 * (anchor_eps - CASE WHEN month IN (5, 6, 7) THEN ly_q2_eps WHEN month IN (8, 9, 10) THEN ly_q3_eps WHEN month IN (11, 12, 1) THEN ly_q4_eps ELSE ly_q1_eps END) / nullif(ttm_eps, 0) AS base_pct,
  100 * (ly_target_eps - pre_anchor_eps) / nullif(ttm_eps, 0) AS ml_pct FROM strat)"""


def _growth(spark, sf):
    df = _strategy(spark, sf).withColumn("pred_delta", F.col("ly_target_eps") - F.col("pre_anchor_eps"))
    return cohort.eps_growth_split(df)


@query("eps_growth_split", "P16 P17 C8", with_views(_GROWTH + " SELECT playbook_date, symbol, rnd(base_pct, 4) AS base_eps_growth_pct, rnd(ml_pct, 4) AS ml_eps_delta_pct, rnd(base_pct + ml_pct, 4) AS eps_growth_total_pct FROM fin"))
def eps_growth_split(spark, sf):
    return _round_all(_growth(spark, sf).select("playbook_date", "symbol", "base_eps_growth_pct", "ml_eps_delta_pct", "eps_growth_total_pct"), 4)


@query("trade_candidates", "C8 F7 J8 T5", with_views(_GROWTH + """ SELECT f.playbook_date, f.symbol, rnd(f.close, 4) AS close, rnd(base_pct + ml_pct, 4) AS eps_growth_total_pct, e.entry_date
FROM fin f JOIN entries e ON e.playbook_date = f.playbook_date WHERE base_pct IS NOT NULL AND ml_pct IS NOT NULL AND close > 0 AND base_pct + ml_pct > 0 AND e.entry_date IS NOT NULL"""))
def trade_candidates(spark, sf):
    good = cohort.trade_candidates(_growth(spark, sf))
    entries = V.entries(spark, sf).where("entry_date IS NOT NULL")
    df = good.join(entries, "playbook_date").select("playbook_date", "symbol", "close", "eps_growth_total_pct", "entry_date")
    return _round_all(df, 4).orderBy("playbook_date", F.desc("eps_growth_total_pct"), "symbol")


_FINAL_FEATURES = [
    *[f"close_vs_ma{n}" for n in (5, 10, 20, 60, 240)], *[f"vol_vs_vma{n}" for n in (5, 10, 20)], "ma5_vs_ma20", "ma20_vs_ma60", "bb_position",
    "revenue_yoy_1m", "revenue_mom_1m", "revenue_yoy_3m_avg", "revenue_yoy_accel",
]


@query("finalized_cohort", "C8 C9 J8 P15 P16 W23", with_views(_GROWTH + f""", keys AS (SELECT playbook_date, symbol, cutoff_date, month FROM fin), {_REV}, {_IND}
SELECT f.playbook_date, f.symbol, e.entry_date, f.quote_date, rnd(f.close, 4) AS close, rnd(base_pct, 4) AS base_eps_growth_pct, rnd(ml_pct, 4) AS ml_eps_delta_pct, rnd(base_pct + ml_pct, 4) AS eps_growth_total_pct,
 {', '.join(f"{_vs('i.close', f'ma{n}')} AS close_vs_ma{n}" for n in (5, 10, 20, 60, 240))}, {', '.join(f"{_vs('i.volume', f'vma{n}')} AS vol_vs_vma{n}" for n in (5, 10, 20))}, {_vs('ma5', 'ma20')} AS ma5_vs_ma20, {_vs('ma20', 'ma60')} AS ma20_vs_ma60,
 rnd(CASE WHEN 4 * sd > 0 THEN (i.close - (ma20 - 2 * sd)) / ((ma20 + 2 * sd) - (ma20 - 2 * sd)) END, 6) AS bb_position,
 rnd(CASE WHEN fresh THEN y1 END, 6) AS revenue_yoy_1m, rnd(CASE WHEN fresh THEN m1 END, 6) AS revenue_mom_1m, rnd(CASE WHEN fresh THEN y3 END, 6) AS revenue_yoy_3m_avg, rnd(CASE WHEN fresh THEN y1 - y3ago END, 6) AS revenue_yoy_accel,
 coalesce(base_pct IS NOT NULL AND ml_pct IS NOT NULL AND f.close > 0 AND base_pct + ml_pct > 0, false) AS candidate
FROM fin f JOIN entries e ON e.playbook_date = f.playbook_date AND e.entry_date IS NOT NULL ASOF LEFT JOIN ind i ON i.symbol = f.symbol AND f.cutoff_date >= i.date
LEFT JOIN rf ON rf.playbook_date = f.playbook_date AND rf.symbol = f.symbol"""))
def finalized_cohort(spark, sf):
    """All cohorts that can be entered: those up to the last trading day."""
    days = V.calendar(spark, sf)
    df = _strategy(spark, sf).withColumn("pred_delta", F.col("ly_target_eps") - F.col("pre_anchor_eps"))
    df = stage(df.join(V.entries(spark, sf).where("entry_date IS NOT NULL").select("playbook_date"), "playbook_date", "left_semi"))
    rows, candidates = cohort.finalize(df.drop("pred_delta"), df.select("playbook_date", "symbol", "pred_delta"), days, _indicators(spark, sf), V.monthly(spark, sf))
    marked = rows.join(candidates.select("playbook_date", "symbol", F.lit(True).alias("candidate")), cohort.KEY, "left")
    four, six = ["close", *cohort.GROWTH], _FINAL_FEATURES
    return marked.select(
        "playbook_date", "symbol", "entry_date", "quote_date", *[R(c, 4).alias(c) for c in four], *[R(c, 6).alias(c) for c in six],
        F.coalesce("candidate", F.lit(False)).alias("candidate"),
    )


@query("look_ahead_guard", "C9", with_views(f"""
WITH {_KEYS}, {_REV}, q AS (SELECT k.playbook_date, k.cutoff_date, max(x.date) AS quote, max(x.date) FILTER (x.date < k.cutoff_date) AS tech FROM keys k LEFT JOIN quotes x ON x.symbol = k.symbol AND x.date <= k.cutoff_date GROUP BY 1, 2),
 g AS (SELECT q.*, (SELECT max(rev_max_publish_time) FROM rf WHERE rf.playbook_date = q.playbook_date) AS rev FROM q),
 r AS (SELECT *, unnest(list_filter([CASE WHEN tech IS NULL OR quote IS NULL THEN 'unverifiable_technical' END, CASE WHEN tech > cutoff_date THEN 'technical_beyond_cutoff' END, CASE WHEN tech < quote THEN 'technical_behind_quotes' END,
   CASE WHEN tech > quote THEN 'technical_ahead_of_quotes' END, CASE WHEN rev IS NULL THEN 'unverifiable_revenue' END, CASE WHEN rev > replace(cutoff_date, '-', '') THEN 'revenue_beyond_cutoff' END], lambda x: x IS NOT NULL)) AS rule FROM g)
SELECT playbook_date, cutoff_date, tech, quote, rev, rule FROM r"""))
def look_ahead_guard(spark, sf):
    """The technical side is one day late on purpose, so that cohorts with a quote on the cutoff fail."""
    quotes = V.quotes(spark, sf)
    df = cohort.revenue_features(_keys(spark, sf), V.monthly(spark, sf))
    df = asof.asof_backward(df, quotes, ["symbol"], "cutoff_date", "date", [], matched_as="quote_date")
    df = asof.asof_backward(df, quotes, ["symbol"], "cutoff_date", "date", [], strict=True, matched_as="tech_snapshot_date")
    return cohort.guard_violations(df)


# ---- scoring and versions --------------------------------------------
_MEMBERS = "mem AS (SELECT playbook_date, symbol, unnest(['a', 'b', 'c']) AS model, unnest([ml_score, qty, disc * 1000]) AS score FROM scored_base)"


def _members(spark, sf):
    pairs = "stack(3, 'a', ml_score, 'b', qty, 'c', disc * 1000) AS (model, score)"
    return stage(V.scored_base(spark, sf).selectExpr("playbook_date", "symbol", pairs))


_COMBINE = """SELECT playbook_date, symbol, ml_score, row_number() OVER (PARTITION BY playbook_date ORDER BY ml_score DESC, symbol) AS ml_rank, 3 AS scored_by_ensemble_k, '{agg}' AS scored_by_ensemble_agg
 FROM (SELECT playbook_date, symbol, rnd({v}, 6) AS ml_score FROM {t} GROUP BY 1, 2)"""


@query("ensemble_mean_score", "C12 W15", with_views(f"WITH {_MEMBERS} " + _COMBINE.format(agg="score", v="avg(score)", t="mem")))
def ensemble_mean_score(spark, sf):
    """Scores are rounded before ranking so that ties are ties in both engines."""
    members = _members(spark, sf)
    df = members.groupBy("playbook_date", "symbol").agg(R(F.avg("score"), 6).alias("score")).withColumn("model", F.lit("a"))
    out = cohort.combine_scores(df, "score")
    return out.withColumns({"scored_by_ensemble_k": F.lit(3), "scored_by_ensemble_agg": F.lit("score")})


@query("ensemble_rank_score", "C12 W15 W16", with_views(f"""WITH {_MEMBERS}, rk AS (SELECT *, rank() OVER (PARTITION BY playbook_date, model ORDER BY score DESC) + (count(*) OVER (PARTITION BY playbook_date, model, score) - 1) / 2.0::DOUBLE AS r FROM mem)
 """ + _COMBINE.format(agg="rank", v="-avg(r)", t="rk")))
def ensemble_rank_score(spark, sf):
    return _round_all(cohort.combine_scores(_members(spark, sf), "rank"), 6)


@query("model_for_target", "J19 T7", with_views("""
WITH v AS (SELECT playbook_date AS version FROM cohort_calendar WHERE month IN (5, 8, 11))
SELECT c.playbook_date, max(v.version) AS train_through, strftime(CAST(max(v.version) AS DATE) - 1, '%Y-%m-%d') AS train_through_cutoff FROM cohort_calendar c LEFT JOIN v ON v.version < c.playbook_date GROUP BY 1"""))
def model_for_target(spark, sf):
    cal = V.playbook(spark, sf)
    models = cal.where("month IN (5, 8, 11)").select(F.col("playbook_date").alias("version"))
    return cohort.model_for_target(models, cal.select("playbook_date"))


@query("second_latest_cohort", "T7 T2", with_views("""
SELECT playbook_date, n FROM (SELECT playbook_date, count(*) AS n, row_number() OVER (ORDER BY playbook_date DESC) AS rn FROM scored_base GROUP BY 1) WHERE rn = 2"""))
def second_latest_cohort(spark, sf):
    sizes = V.scored_base(spark, sf).groupBy("playbook_date").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("playbook_date"))
    return sizes.withColumn("rn", F.row_number().over(w)).where("rn = 2").drop("rn")


@query("covered_cohort", "J25", with_views("SELECT max(playbook_date) AS playbook_date FROM entries e WHERE EXISTS (SELECT 1 FROM quotes q WHERE q.date >= e.entry_date)"))
def covered_cohort(spark, sf):
    newest = V.calendar(spark, sf).agg(F.max("date")).scalar()
    return V.entries(spark, sf).where(F.col("entry_date") <= newest).agg(F.max("playbook_date").alias("playbook_date"))


_OLDNEW = """o AS (SELECT playbook_date, symbol, ml_score, qty, row_number() OVER (PARTITION BY playbook_date ORDER BY ml_score DESC, symbol) AS rk FROM scored_base WHERE line_count >= 3),
 n AS (SELECT playbook_date, symbol, s AS ml_score, qty, row_number() OVER (PARTITION BY playbook_date ORDER BY s DESC, symbol) AS rk FROM (SELECT *, rnd(ml_score + qty * 10, 6) AS s FROM scored_base WHERE tax < 0.06)),
 b AS (SELECT coalesce(o.playbook_date, n.playbook_date) AS playbook_date, o.rk AS ro, n.rk AS rn, o.ml_score AS so, n.ml_score AS sn, o.qty AS qo, n.qty AS qn FROM o FULL JOIN n ON o.playbook_date = n.playbook_date AND o.symbol = n.symbol)"""


@query("version_compare", "C20 J21 A25 A26 A12 U4", with_views(f"""WITH {_OLDNEW},
 c AS (SELECT playbook_date, CASE WHEN stddev_samp(so) > 0 THEN corr(ra, rb) END AS s FROM (SELECT *, rank() OVER (PARTITION BY playbook_date ORDER BY so) AS ra, rank() OVER (PARTITION BY playbook_date ORDER BY sn) AS rb FROM b WHERE ro IS NOT NULL AND rn IS NOT NULL) GROUP BY 1 HAVING count(*) >= 3)
SELECT b.playbook_date, count(ro) AS rows_old, count(rn) AS rows_new, count(*) FILTER (ro IS NOT NULL AND rn IS NOT NULL) AS shared, count(*) FILTER (ro IS NULL) AS added, count(*) FILTER (rn IS NULL) AS removed,
 count(*) FILTER (ro <= 10 AND rn <= 10) AS top10_overlap, count(*) FILTER (ro <= 20 AND rn <= 20) AS top20_overlap, rnd(count(*) FILTER (ro IS NOT NULL AND rn IS NOT NULL) / count(*), 6) AS jaccard,
 rnd((coalesce(avg(abs(so - sn)), 0) + coalesce(avg(abs(qo - qn)), 0)) / nullif(count(DISTINCT CASE WHEN so IS NOT NULL AND sn IS NOT NULL THEN 1 END) * 2, 0), 6) AS mean_abs_diff,
 rnd((count(rn) - count(ro)) * 100.0 / nullif(count(ro), 0), 6) AS rows_diff_pct, rnd(any_value(c.s), 6) AS score_spearman
FROM b LEFT JOIN c ON c.playbook_date = b.playbook_date GROUP BY 1"""))
def version_compare(spark, sf):
    base = stage(V.scored_base(spark, sf))
    old = ranks.with_ordinal_rank(base.where("line_count >= 3"), ["playbook_date"], -F.col("ml_score"), "symbol", "rk")
    new = base.where("tax < 0.06").withColumn("ml_score", R(F.col("ml_score") + F.col("qty") * 10, 6))
    new = ranks.with_ordinal_rank(new, ["playbook_date"], -F.col("ml_score"), "symbol", "rk")
    return _round_all(cohort.compare_versions(stage(old), stage(new), "ml_score", "rk", ["ml_score", "qty"]), 6)

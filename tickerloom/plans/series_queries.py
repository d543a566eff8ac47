"""Queries over daily series: windows, holdings, margin, valuation, technical indicators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.jobs import derive
from tickerloom.operators import asof, windows as W
from tickerloom.plans import views as V
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.registry import query
from tickerloom.session import stage

R = N.rnd


def _round_all(df, digits, skip=()):
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double" and f.name not in skip]
    return df.withColumns({c: R(c, digits) for c in doubles})


@query("margin_pressure", "A1 P10 C4", with_views("""
SELECT date, market, symbol, name, margin_long_balance, margin_long_limit,
  rnd(lu, 4) AS margin_usage_ratio, rnd(lb - lp, 4) AS margin_long_balance_wow,
  rnd(CASE WHEN lp > 0 THEN (lb - lp) / lp * 100 END, 4) AS margin_long_balance_wow_pct,
  margin_short_balance, margin_short_limit, rnd(su, 4) AS short_usage_ratio,
  rnd(sb - sp, 4) AS margin_short_balance_wow,
  rnd(CASE WHEN sp > 0 THEN (sb - sp) / sp * 100 END, 4) AS margin_short_balance_wow_pct,
  rnd(cv, 4) AS short_cover_pressure,
  rnd(coalesce(lu, 0) * 0.45::DOUBLE + coalesce(su, 0) * 0.30::DOUBLE + coalesce(cv, 0) * 0.25::DOUBLE, 4) AS margin_pressure_score
FROM (SELECT *, CASE WHEN ll > 0 THEN lb / ll * 100 END AS lu, CASE WHEN sl > 0 THEN sb / sl * 100 END AS su,
       CASE WHEN sp > 0 THEN (buy + rep) / sp * 100 END AS cv, lb AS margin_long_balance, ll AS margin_long_limit,
       sb AS margin_short_balance, sl AS margin_short_limit
  FROM (SELECT date, market, symbol, max(name) AS name, sum(coalesce(margin_long_prev_balance, 0)) AS lp,
     sum(coalesce(margin_long_balance, 0)) AS lb, sum(coalesce(margin_long_limit, 0)) AS ll,
     sum(coalesce(margin_short_prev_balance, 0)) AS sp, sum(coalesce(margin_short_balance, 0)) AS sb,
     sum(coalesce(margin_short_limit, 0)) AS sl, sum(coalesce(margin_short_buy, 0)) AS buy,
     sum(coalesce(margin_short_cash_repay, 0)) AS rep FROM margin GROUP BY 1, 2, 3))"""))
def margin_pressure(spark, sf):
    return derive.margin_pressure(V.margin(spark, sf))


@query("short_interest", "A1 P11 C4", with_views("""
SELECT date, market, symbol, name, b AS sbl_balance, rnd(b - p, 4) AS sbl_balance_wow, rnd(bp, 4) AS sbl_balance_wow_pct,
  s AS sbl_sell, r AS sbl_repay, rnd(sr, 4) AS sbl_sell_repay_ratio, mb AS margin_short_balance,
  rnd(mb - mp, 4) AS margin_short_balance_wow, rnd(mpp, 4) AS margin_short_balance_wow_pct,
  rnd(coalesce(bp, 0) * 0.4::DOUBLE + coalesce(mpp, 0) * 0.4::DOUBLE + (coalesce(sr, 1) - 1) * 100 * 0.2::DOUBLE, 4) AS short_pressure_score
FROM (SELECT *, CASE WHEN p > 0 THEN (b - p) / p * 100 END AS bp, CASE WHEN mp > 0 THEN (mb - mp) / mp * 100 END AS mpp,
        CASE WHEN r > 0 THEN s / r END AS sr
  FROM (SELECT date, market, symbol, max(name) AS name, sum(coalesce(sbl_balance, 0)) AS b, sum(coalesce(sbl_prev_balance, 0)) AS p,
    sum(coalesce(sbl_sell, 0)) AS s, sum(coalesce(sbl_repay, 0)) AS r, sum(coalesce(margin_short_balance, 0)) AS mb,
    sum(coalesce(margin_short_prev_balance, 0)) AS mp FROM margin GROUP BY 1, 2, 3))"""))
def short_interest(spark, sf):
    return derive.short_interest(V.margin(spark, sf))


_ROLL = ", ".join(
    f"CASE WHEN count({c}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) = {n} "
    f"THEN rnd(avg({c}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING), 4) END AS {p}{n}"
    for p, c in (("ma", "close"), ("vma", "volume")) for n in derive.MA_LENGTHS
)


@query("moving_averages", "W1 F4", with_views(f"SELECT date, symbol, {_ROLL} FROM quotes"))
def moving_averages(spark, sf):
    q = V.quotes(spark, sf).select("date", "symbol", "close", "volume")
    lengths = derive.MA_LENGTHS
    df = W.with_rolling_means(q, "symbol", "date", {"close": lengths, "volume": lengths}, {"close": "ma", "volume": "vma"})
    return _round_all(df.drop("close", "volume"), 4)


@query("stochastic_rsv", "W2", with_views("""
SELECT date, symbol, rnd(coalesce((close - lo) / nullif(hi - lo, 0) * 100, 50), 4) AS rsv
FROM (SELECT *, CASE WHEN count(*) OVER w = 9 THEN min(low) OVER w END AS lo, CASE WHEN count(*) OVER w = 9 THEN max(high) OVER w END AS hi
 FROM quotes WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 8 PRECEDING))"""))
def stochastic_rsv(spark, sf):
    q = V.quotes(spark, sf)
    return q.select("date", "symbol", R(W.stochastic(q, W.series("symbol", "date")), 4).alias("rsv"))


@query("bollinger_bands", "W6 P15", with_views("""
SELECT date, symbol, rnd(m + 2 * s, 4) AS bb_upper, rnd(m, 4) AS bb_middle, rnd(m - 2 * s, 4) AS bb_lower,
  rnd(CASE WHEN m > 0 THEN close / m - 1 END, 6) AS close_to_ma20,
  rnd(CASE WHEN (m + 2 * s) - (m - 2 * s) > 0 THEN (close - (m - 2 * s)) / ((m + 2 * s) - (m - 2 * s)) END, 6) AS band_position
FROM (SELECT date, symbol, close, CASE WHEN count(*) OVER w = 20 THEN avg(close) OVER w END AS m, CASE WHEN count(*) OVER w = 20 THEN stddev_samp(close) OVER w END AS s
 FROM quotes WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING))"""))
def bollinger_bands(spark, sf):
    w = W.series("symbol", "date")
    q = V.quotes(spark, sf).withColumn("m", W.rolling_mean("close", w, 20)).withColumn("s", W.rolling_std("close", w, 20))
    q = q.withColumn("u", F.col("m") + 2 * F.col("s")).withColumn("l", F.col("m") - 2 * F.col("s"))
    return q.select(
        "date", "symbol", R("u", 4).alias("bb_upper"), R("m", 4).alias("bb_middle"), R("l", 4).alias("bb_lower"),
        R(N.ratio_to_average("close", "m"), 6).alias("close_to_ma20"), R(N.band_position("close", "l", "u"), 6).alias("band_position"),
    )


_STREAK = """
  s_{c} AS (SELECT date, symbol, sign(coalesce({c}_net, 0))::INT AS sg FROM joined),
  c_{c} AS (SELECT *, CASE WHEN sg = lag(sg) OVER (PARTITION BY symbol ORDER BY date) THEN 0 ELSE 1 END AS ch FROM s_{c}),
  g_{c} AS (SELECT *, sum(ch) OVER (PARTITION BY symbol ORDER BY date) AS seg FROM c_{c}),
  t_{c} AS (SELECT date, symbol, row_number() OVER (PARTITION BY symbol, seg ORDER BY date) * sg AS {c}_streak_days FROM g_{c})"""
_JOINED = "joined AS (SELECT q.date, q.symbol, q.high, q.low, q.close, q.volume, f.foreign_net, f.trust_net, f.dealer_net FROM quotes q LEFT JOIN flows f ON q.date = f.date AND q.symbol = f.symbol)"


@query("net_buy_streaks", "W7 J1", with_views(
    f"WITH {_JOINED}, {', '.join(_STREAK.format(c=c) for c in ('foreign', 'trust', 'dealer'))} "
    "SELECT date, symbol, foreign_streak_days, trust_streak_days, dealer_streak_days FROM t_foreign JOIN t_trust USING (date, symbol) JOIN t_dealer USING (date, symbol)"))
def net_buy_streaks(spark, sf):
    df = V.quotes(spark, sf).select("date", "symbol").join(V.flows(spark, sf).drop("market"), ["date", "symbol"], "left")
    df = W.with_streaks(df, "symbol", "date", {f"{c}_net": f"{c}_streak_days" for c in ("foreign", "trust", "dealer")})
    return df.drop("foreign_net", "trust_net", "dealer_net")


_EWM = """base AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS delta,
    row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
    coalesce((close - lo) / nullif(hi - lo, 0) * 100, 50) AS rsv
  FROM (SELECT *, CASE WHEN count(*) OVER w = 9 THEN min(low) OVER w END AS lo, CASE WHEN count(*) OVER w = 9 THEN max(high) OVER w END AS hi
        FROM joined WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 8 PRECEDING))),
 rec AS (
  SELECT symbol, rn, date, rsv::DOUBLE AS k, rsv::DOUBLE AS d, close AS e12, close AS e26, 0::DOUBLE AS dea,
     0::DOUBLE AS u6, 0::DOUBLE AS l6, 0::DOUBLE AS w6, 0::DOUBLE AS u12, 0::DOUBLE AS l12, 0::DOUBLE AS w12
  FROM base WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.rn, b.date, r.k + (b.rsv - r.k) / 3, r.d + (r.k + (b.rsv - r.k) / 3 - r.d) / 3,
     r.e12 + (b.close - r.e12) * 2 / 13, r.e26 + (b.close - r.e26) * 2 / 27,
     r.dea + ((r.e12 + (b.close - r.e12) * 2 / 13) - (r.e26 + (b.close - r.e26) * 2 / 27) - r.dea) * 2 / 10,
     r.u6 * 5 / 6 + greatest(b.delta, 0), r.l6 * 5 / 6 + greatest(-b.delta, 0), r.w6 * 5 / 6 + 1,
     r.u12 * 11 / 12 + greatest(b.delta, 0), r.l12 * 11 / 12 + greatest(-b.delta, 0), r.w12 * 11 / 12 + 1
  FROM rec r JOIN base b ON b.symbol = r.symbol AND b.rn = r.rn + 1)"""
_EWM_COLS = """rnd(k, 4) AS k, rnd(d, 4) AS d,
  CASE WHEN rn > 6 THEN rnd(100 - 100 / (1 + (u6 / w6) / (l6 / w6)), 4) END AS rsi6,
  CASE WHEN rn > 12 THEN rnd(100 - 100 / (1 + (u12 / w12) / (l12 / w12)), 4) END AS rsi12,
  rnd(e12 - e26, 4) AS macd_dif, rnd(dea, 4) AS macd_dea, rnd(e12 - e26 - dea, 4) AS macd_hist"""


@query("ewm_oscillators", "W3 W4 W5", with_views(f"WITH RECURSIVE {_JOINED}, {_EWM} SELECT date, symbol, {_EWM_COLS} FROM rec"))
def ewm_oscillators(spark, sf):
    q = V.quotes(spark, sf)
    q = q.withColumn("rsv", W.stochastic(q, W.series("symbol", "date"))).select("date", "symbol", "close", "rsv")
    return _round_all(W.with_ewm_indicators(q, "symbol", "date").drop("close", "rsv"), 4)


_TECHNICAL = (
    f"WITH RECURSIVE {_JOINED}, {_EWM}, {', '.join(_STREAK.format(c=c) for c in ('foreign', 'trust', 'dealer'))}, "
    f"roll AS (SELECT date, symbol, {_ROLL}, CASE WHEN count(*) OVER b = 20 THEN avg(close) OVER b END AS m, CASE WHEN count(*) OVER b = 20 THEN stddev_samp(close) OVER b END AS s "
    "FROM joined WINDOW b AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)) "
    f"SELECT date, symbol, roll.* EXCLUDE (date, symbol, m, s), {_EWM_COLS}, rnd(m + 2 * s, 4) AS bb_upper, rnd(m, 4) AS bb_middle, rnd(m - 2 * s, 4) AS bb_lower, "
    "foreign_streak_days, trust_streak_days, dealer_streak_days "
    "FROM roll JOIN rec USING (date, symbol) JOIN t_foreign USING (date, symbol) JOIN t_trust USING (date, symbol) JOIN t_dealer USING (date, symbol)"
)


@query("technical_indicators", "C1 J1 K9", with_views(_TECHNICAL))
def technical_indicators(spark, sf):
    return _round_all(derive.technical_indicators(V.quotes(spark, sf), V.flows(spark, sf)), 4)


@query("technical_window_override", "K9 C1", with_views(_TECHNICAL + " WHERE date BETWEEN '1998-01-01' AND '1998-12-31'"))
def technical_window_override(spark, sf):
    """All columns of one year, the same as in a full run."""
    df = derive.technical_indicators(V.quotes(spark, sf, end="1998-12-31"), V.flows(spark, sf, end="1998-12-31"), start="1998-01-01", end="1998-12-31")
    return _round_all(df, 4)


# First days of the runs that follow each other in `technical_incremental`.
RUNS = (None, "1994-05-10", "1997-01-01", "1998-08-01")


@query("technical_incremental", "K9 C1 W1 W3 W4 W5 W7", with_views(_TECHNICAL))
def technical_incremental(spark, sf):
    """Four runs, each over its own days only and the state the run before left."""
    state = out = None
    for start, following in zip(RUNS, (*RUNS[1:], None)):
        end = following and str(date.fromisoformat(following) - timedelta(days=1))
        rows, state = derive.technical_run(V.quotes(spark, sf, start, end), V.flows(spark, sf, start, end), state, followed=following is not None, digits=4)
        out = rows if out is None else out.unionByName(rows)
    return out


def _holding_sql(prefix):
    return with_views(f"""
WITH cum AS (SELECT date, market, symbol, sum({prefix}_net) OVER (PARTITION BY market, symbol ORDER BY date) AS h FROM flows)
SELECT c.date, c.market, c.symbol, f.name, f.issued_shares, c.h AS {prefix}_held_shares,
  CASE WHEN f.issued_shares > 0 THEN rnd(c.h / f.issued_shares * 100, 4) END AS {prefix}_held_ratio
FROM cum c LEFT JOIN foreign_holding f ON c.date = f.date AND c.market = f.market AND c.symbol = f.symbol""")


@query("trust_holding", "C3 W8 J2", _holding_sql("trust"))
def trust_holding(spark, sf):
    df = derive.cumulative_holding(V.flows(spark, sf), V.foreign_holding(spark, sf), "trust_net", "trust")
    return _round_all(df, 4)


@query("dealer_holding_incremental", "C3 J3 W8 K8 T4", _holding_sql("dealer"))
def dealer_holding_incremental(spark, sf):
    """Days up to 1998 first, then the later days continued from the stored state."""
    flows, fh = V.flows(spark, sf), V.foreign_holding(spark, sf)
    old = derive.cumulative_holding(flows.where("date <= '1998-06-30'"), fh, "dealer_net", "dealer")
    new = derive.cumulative_holding(flows, fh, "dealer_net", "dealer", state=old, after="1998-06-30")
    return _round_all(old.unionByName(new), 4)


@query("holder_bands", "A2", with_views("""
SELECT date, symbol, rnd(sum(CASE WHEN level BETWEEN 1 AND 8 THEN percentage ELSE 0 END), 4) AS small_holder_ratio,
  rnd(sum(CASE WHEN level BETWEEN 9 AND 11 THEN percentage ELSE 0 END), 4) AS mid_holder_ratio,
  rnd(sum(CASE WHEN level BETWEEN 12 AND 15 THEN percentage ELSE 0 END), 4) AS large_holder_ratio,
  sum(CASE WHEN level BETWEEN 1 AND 8 THEN holders ELSE 0 END) AS small_holder_count,
  sum(CASE WHEN level BETWEEN 12 AND 15 THEN holders ELSE 0 END) AS large_holder_count
FROM shareholding GROUP BY 1, 2"""))
def holder_bands(spark, sf):
    return _round_all(derive.shareholder_bands(V.shareholding(spark, sf)), 4)


@query("shareholding_concentration", "C5 A2 W9", with_views("""
WITH b AS (SELECT date, symbol, sum(CASE WHEN level BETWEEN 1 AND 8 THEN percentage ELSE 0 END) AS sm,
  sum(CASE WHEN level BETWEEN 9 AND 11 THEN percentage ELSE 0 END) AS mi,
  sum(CASE WHEN level BETWEEN 12 AND 15 THEN percentage ELSE 0 END) AS la,
  sum(CASE WHEN level BETWEEN 1 AND 8 THEN holders ELSE 0 END) AS small_holder_count,
  sum(CASE WHEN level BETWEEN 12 AND 15 THEN holders ELSE 0 END) AS large_holder_count FROM shareholding GROUP BY 1, 2)
SELECT date, symbol, rnd(la, 4) AS large_holder_ratio, rnd(sm, 4) AS small_holder_ratio, rnd(mi, 4) AS mid_holder_ratio,
  rnd(la - sm, 4) AS concentration_spread, rnd(la - lag(la) OVER w, 4) AS large_holder_ratio_wow,
  rnd(sm - lag(sm) OVER w, 4) AS small_holder_ratio_wow, rnd(mi - lag(mi) OVER w, 4) AS mid_holder_ratio_wow,
  rnd((la - sm) - lag(la - sm) OVER w, 4) AS concentration_spread_wow, large_holder_count, small_holder_count
FROM b WINDOW w AS (PARTITION BY symbol ORDER BY date)"""))
def shareholding_concentration(spark, sf):
    return derive.concentration(V.shareholding(spark, sf))


_TTM = """ttm AS (SELECT date, symbol, nav_per_share, eps_q, CASE WHEN count(*) OVER w = 4 THEN sum(eps_q) OVER w END AS ttm,
  CASE substr(date, 6, 1) WHEN '1' THEN substr(date, 1, 4) || '-05-15' WHEN '2' THEN substr(date, 1, 4) || '-08-14'
   WHEN '3' THEN substr(date, 1, 4) || '-11-14' ELSE (CAST(substr(date, 1, 4) AS INT) + 1) || '-03-31' END AS publish_date
 FROM reports WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING))"""


@query("trailing_eps", "W10 X10", with_views(f"WITH {_TTM} SELECT date, symbol, rnd(ttm, 6) AS ttm_eps_official, publish_date FROM ttm"))
def trailing_eps(spark, sf):
    df = derive.trailing_eps(V.reports(spark, sf))
    return df.select("date", "symbol", R("ttm_eps_official", 6).alias("ttm_eps_official"), "publish_date")


_ASOF = f"""{_TTM}, known AS (SELECT * FROM ttm WHERE ttm IS NOT NULL)"""


@query("price_report_asof", "J4", with_views(f"""
WITH {_ASOF} SELECT q.date, q.symbol, k.publish_date, rnd(k.ttm, 6) AS ttm_eps_official, k.nav_per_share
FROM quotes q ASOF LEFT JOIN known k ON q.symbol = k.symbol AND q.date >= k.publish_date"""))
def price_report_asof(spark, sf):
    known = derive.trailing_eps(V.reports(spark, sf)).where("ttm_eps_official IS NOT NULL")
    df = asof.asof_backward(
        V.quotes(spark, sf).select("date", "symbol"), known, ["symbol"], "date", "publish_date",
        ["ttm_eps_official", "nav_per_share"], matched_as="publish_date",
    )
    return df.withColumn("ttm_eps_official", R("ttm_eps_official", 6))


def pe_ratio(spark, sf):
    """Official PE per line: several rows share a key, the order of lines decides."""
    li = V._keyed(V.table(spark, sf, "lineitem"))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return li.select("date", "symbol", F.round("l_quantity", 2).alias("pe_ratio"), order.alias("row_order"))


_PE = """pe AS (SELECT date, symbol, arg_max(round(l_quantity, 2), (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS pe_official
 FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, printf('%04d', l_suppkey) AS symbol, * FROM lineitem) GROUP BY 1, 2)"""
_VAL = f"""{_ASOF}, {_PE}, val AS MATERIALIZED (
 SELECT q.date, q.symbol, q.close, k.ttm, k.nav_per_share, CASE WHEN k.ttm > 0 THEN rnd(q.close / k.ttm, 2) END AS pe
 FROM quotes q ASOF JOIN known k ON q.symbol = k.symbol AND q.date >= k.publish_date),
 series AS MATERIALIZED (SELECT symbol, list(date ORDER BY date) AS dates, list(pe ORDER BY date) AS pes FROM val WHERE pe IS NOT NULL GROUP BY 1),
 pct AS (SELECT symbol, dates[i] AS date, rnd((len(list_filter(pes[1:i], lambda x: x < pes[i])) + (len(list_filter(pes[1:i], lambda x: x = pes[i])) + 1) / 2.0::DOUBLE) / i * 100, 4) AS p
   FROM (SELECT symbol, dates, pes, unnest(range(1, len(pes) + 1)) AS i FROM series))"""


@query("valuation_daily", "C2 J4 W10 W11 U5 X10", with_views(f"""
WITH {_VAL}
SELECT v.date, v.symbol, rnd(v.close, 4) AS close, rnd(v.ttm, 6) AS ttm_eps_official, pe.pe_official, pct.p AS pe_percentile_official,
  rnd(v.ttm / nullif(v.nav_per_share, 0) * 100, 2) AS roe_official
FROM val v LEFT JOIN pe ON v.date = pe.date AND v.symbol = pe.symbol LEFT JOIN pct ON v.date = pct.date AND v.symbol = pct.symbol"""))
def valuation_daily(spark, sf):
    df = derive.valuation(V.quotes(spark, sf), V.reports(spark, sf), pe_ratio(spark, sf))
    return df.withColumns({"close": R("close", 4), "ttm_eps_official": R("ttm_eps_official", 6)})


@query("trailing_eps_reconcile", "A30 T3 T4", with_views(f"""
WITH {_ASOF}, stored AS (SELECT q.symbol, q.date, rnd(k.ttm, 1) AS ttm FROM quotes q ASOF JOIN known k ON q.symbol = k.symbol AND q.date >= k.publish_date
   QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY q.date DESC) = 1)
SELECT s.symbol, s.date, s.ttm AS ttm_eps_official, rnd(k.ttm, 6) AS expected_ttm, rnd(abs(s.ttm - k.ttm), 6) AS diff, abs(s.ttm - k.ttm) > 0.02 AS drifted
FROM stored s ASOF JOIN known k ON s.symbol = k.symbol AND s.date >= k.publish_date"""))
def trailing_eps_reconcile(spark, sf):
    """The stored side is the valuation rounded to one digit, so that some rows drift."""
    reports = V.reports(spark, sf)
    known = derive.trailing_eps(reports).where("ttm_eps_official IS NOT NULL")
    stored = asof.asof_backward(
        V.quotes(spark, sf).select("date", "symbol"), known, ["symbol"], "date", "publish_date", ["ttm_eps_official"]
    ).where("ttm_eps_official IS NOT NULL")
    df = derive.reconcile_trailing_eps(stored.withColumn("ttm_eps_official", R("ttm_eps_official", 1)), reports, 0.02)
    return df.withColumns({"expected_ttm": R("expected_ttm", 6), "diff": R("diff", 6)})


@query("index_regime_signals", "W20 W21 A6", with_views("""
WITH r AS (SELECT *, ln(index_close) - ln(lag(index_close) OVER (PARTITION BY index_name ORDER BY date)) AS log_ret FROM index_daily)
SELECT date, index_name, rnd(index_close, 4) AS index_close, rnd(log_ret, 6) AS log_ret,
 CASE WHEN count(*) OVER w20 >= 10 THEN rnd(avg(index_close) OVER w20, 4) END AS ma20,
 CASE WHEN count(*) OVER w60 >= 20 THEN rnd(avg(index_close) OVER w60, 4) END AS ma60,
 rnd(index_close / lag(index_close, 20) OVER w - 1, 6) AS ret_20d, rnd(index_close / lag(index_close, 60) OVER w - 1, 6) AS ret_60d,
 CASE WHEN count(log_ret) OVER w20 >= 10 THEN rnd(stddev_samp(log_ret) OVER w20 * sqrt(252), 6) END AS vol_20d_ann
FROM r WINDOW w AS (PARTITION BY index_name ORDER BY date), w20 AS (PARTITION BY index_name ORDER BY date ROWS 19 PRECEDING), w60 AS (PARTITION BY index_name ORDER BY date ROWS 59 PRECEDING)"""))
def index_regime_signals(spark, sf):
    from tickerloom.jobs import performance

    df = performance.index_signals(V.index_daily(spark, sf), ["index_name"])
    return df.select(
        "date", "index_name", R("index_close", 4).alias("index_close"), R("log_ret", 6).alias("log_ret"), R("ma20", 4).alias("ma20"),
        R("ma60", 4).alias("ma60"), R("ret_20d", 6).alias("ret_20d"), R("ret_60d", 6).alias("ret_60d"), R("vol_20d_ann", 6).alias("vol_20d_ann"),
    )


@query("running_drawdown", "W18", with_views("""
WITH c AS (SELECT symbol, date, sum(foreign_net) OVER (PARTITION BY symbol ORDER BY date) AS cum FROM flows),
 d AS (SELECT symbol, cum - max(cum) OVER (PARTITION BY symbol ORDER BY date) AS dd FROM c)
SELECT symbol, min(dd) AS max_drawdown FROM d GROUP BY 1"""))
def running_drawdown(spark, sf):
    w = W.series("symbol", "date")
    df = V.flows(spark, sf).withColumn("cum", W.cumulative("foreign_net", w)).withColumn("dd", W.drawdown("cum", w))
    return df.groupBy("symbol").agg(F.min("dd").alias("max_drawdown"))


@query("pe_percentile_backfill", "K11 A31", with_views(f"""
WITH {_VAL} SELECT v.symbol, v.date, coalesce(pct.p, -1) AS pe_percentile FROM val v LEFT JOIN pct ON v.date = pct.date AND v.symbol = pct.symbol"""))
def pe_percentile_backfill(spark, sf):
    from tickerloom.sinks import load

    stored = derive.valuation(V.quotes(spark, sf), V.reports(spark, sf), pe_ratio(spark, sf))
    stored = stage(stored.select("symbol", "date", "pe_percentile_official"))
    fresh = stored.where("pe_percentile_official IS NOT NULL").select("symbol", "date", F.col("pe_percentile_official").alias("pe_percentile"))
    old = stored.select("symbol", "date", F.lit(-1.0).alias("pe_percentile"))
    return load.update_column(old, fresh, ["symbol", "date"], "pe_percentile")

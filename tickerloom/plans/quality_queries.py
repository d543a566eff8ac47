"""Queries over data-quality checks and load contracts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.jobs import ingest, quality as Q
from tickerloom.operators import windows as W
from tickerloom.plans import views as V
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.registry import query
from tickerloom.plans.series_queries import _round_all
from tickerloom.session import shared_folder
from tickerloom.sinks import load, publish, versions

R = N.rnd

# ---- audits -----------------------------------------------------------
_NULLCOLS = ["margin_long_prev_balance", "margin_long_limit", "margin_short_prev_balance", "sbl_sell"]


@query("null_share_audit", "A20 C21", with_views(
    " UNION ALL ".join(f"SELECT market, '{c}' AS column_name, rnd(avg(({c} IS NULL)::INT) * 100, 4) AS null_pct, avg(({c} IS NULL)::INT) * 100 <= 50 AS passed FROM margin GROUP BY 1" for c in _NULLCOLS)))
def null_share_audit(spark, sf):
    return _round_all(Q.null_shares(V.margin(spark, sf), ["market"], _NULLCOLS, 50), 4)


_SHIFT = "bad AS (SELECT market, symbol, CASE WHEN volume > 45 THEN close * 2 ELSE open END AS open, high, low, close FROM quotes)"


@query("ohlc_audit", "A21 C21", with_views(f"""WITH {_SHIFT} SELECT market, sum(coalesce(high < open OR high < close OR low > open OR low > close, false)::INT) AS violations, count(*) AS rows FROM bad GROUP BY 1"""))
def ohlc_audit(spark, sf):
    """Busy days get a shifted open, as a misread column would give."""
    q = V.quotes(spark, sf).select("market", "close", "high", "low", "open", "volume")
    q = q.withColumn("open", F.when(F.col("volume") > 45, F.col("close") * 2).otherwise(F.col("open")))
    return Q.ohlc_violations(q, ["market"])


@query("category_rule_audit", "A22 C21", with_views("""
SELECT symbol, sum((eps_q - 4 < 0)::INT) AS negative_pe, sum((NOT regexp_matches(CASE WHEN orders_n > 12 THEN date ELSE substr(date, 1, 4) || 'M0' || substr(date, 6, 1) END, '^[0-9]{4}M(0[1-9]|1[0-2])$'))::INT) AS bad_month_token FROM reports GROUP BY 1"""))
def category_rule_audit(spark, sf):
    df = V.reports(spark, sf).withColumn("pe", F.col("eps_q") - 4)
    token = F.when(F.col("orders_n") > 12, F.col("date")).otherwise(F.concat(F.substring("date", 1, 4), F.lit("M0"), F.substring("date", 6, 1)))
    df = df.withColumn("token", token)
    return Q.rule_counts(df, ["symbol"], {"negative_pe": F.col("pe") < 0, "bad_month_token": ~Q.month_token_ok("token")})


@query("required_institutions_audit", "A22", with_views("""
WITH p AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS date, l_returnflag || l_linestatus AS inst FROM lineitem)
SELECT c.date, r.inst AS missing FROM calendar c CROSS JOIN (SELECT unnest(['AF', 'NF', 'RF', 'AO', 'NO', 'RO']) AS inst) r WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.date = c.date AND p.inst = r.inst)"""))
def required_institutions_audit(spark, sf):
    li = V._keyed(V.table(spark, sf, "lineitem")).withColumn("inst", F.concat("l_returnflag", "l_linestatus"))
    return Q.missing_required(li, ["date"], "inst", ["AF", "NF", "RF", "AO", "NO", "RO"])


@query("shareholder_level_audit", "A23 C21", with_views("SELECT date, symbol, count(*) AS rows, sum((level NOT BETWEEN 1 AND 15)::INT) AS outside FROM levels GROUP BY 1, 2 HAVING count(*) <> 15 OR sum((level NOT BETWEEN 1 AND 15)::INT) > 0"))
def shareholder_level_audit(spark, sf):
    return Q.level_violations(V.levels(spark, sf))


@query("duplicate_key_audit", "A31", with_views("SELECT l_orderkey, l_linenumber, count(*) AS rows, count(DISTINCT l_partkey) AS distinct_values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) > 1"))
def duplicate_key_audit(spark, sf):
    return Q.duplicate_keys(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")


# ---- reconciliation ---------------------------------------------------
def _stats_sql(t):
    return f"""(SELECT unnest(['rows', 'distinct_dates', 'distinct_symbols', 'sum_volume', 'min_volume', 'max_volume', 'mean_positive_volume']) AS metric,
 unnest([count(*)::DOUBLE, count(DISTINCT date), count(DISTINCT symbol), sum(volume), min(volume), max(volume), avg(volume) FILTER (volume > 0)]) AS value FROM {t})"""


@query("table_statistics", "A17", with_views(f"SELECT metric, rnd(value, 4) AS value FROM {_stats_sql('quotes')}"))
def table_statistics(spark, sf):
    return _round_all(Q.table_stats(V.quotes(spark, sf), ["volume"]), 4)


@query("statistics_compare", "A18 C23", with_views(f"""
WITH part AS (SELECT * FROM quotes WHERE date < '2001-10-01')
SELECT a.metric, rnd(a.value, 4) AS source_value, rnd(b.value, 4) AS target_value, abs(a.value - b.value) / greatest(abs(a.value), 1e-12) <= 1e-4 AS matches FROM {_stats_sql('quotes')} a FULL JOIN {_stats_sql('part')} b ON a.metric = b.metric"""))
def statistics_compare(spark, sf):
    q = V.quotes(spark, sf)
    df = Q.compare_stats(Q.table_stats(q, ["volume"]), Q.table_stats(q.where("date < '2001-10-01'"), ["volume"]))
    return _round_all(df, 4)


@query("row_count_reconcile", "A19 C23", with_views("""
SELECT q.date, q.market, q.n AS source_rows, coalesce(f.n, 0) AS target_rows, q.n = coalesce(f.n, 0) AS matches
FROM (SELECT date, market, count(*) AS n FROM quotes GROUP BY 1, 2) q LEFT JOIN (SELECT date, market, count(*) AS n FROM flows GROUP BY 1, 2) f ON q.date = f.date AND q.market = f.market"""))
def row_count_reconcile(spark, sf):
    return Q.reconcile_counts(V.quotes(spark, sf), V.flows(spark, sf), ["date", "market"])


# ---- completeness -----------------------------------------------------
@query("completeness", "A24 C24 J20 T2 U3", with_views("""
WITH s AS (SELECT min(date) AS d FROM (SELECT date FROM calendar ORDER BY date DESC LIMIT 10)),
 cnt AS (SELECT 'quotes' AS "table", market, date, count(*) AS n FROM quotes WHERE date >= (SELECT d FROM s) GROUP BY ALL UNION ALL SELECT 'flows', market, date, count(*) FROM flows WHERE date >= (SELECT d FROM s) GROUP BY ALL
   UNION ALL SELECT 'index_daily', '', date, count(*) FROM index_daily WHERE date >= (SELECT d FROM s) GROUP BY ALL),
 grid AS (SELECT g."table", g.market, d.date FROM (SELECT DISTINCT date FROM cnt) d CROSS JOIN (VALUES ('quotes', 'sii'), ('quotes', 'otc'), ('flows', 'sii'), ('flows', 'otc'), ('index_daily', '')) g("table", market)),
 f AS (SELECT g.*, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cnt c ON c."table" = g."table" AND c.market = g.market AND c.date = g.date),
 m AS (SELECT "table", market, median(n) AS median FROM f GROUP BY 1, 2)
SELECT f.*, m.median, CASE WHEN n = 0 THEN 'missing' WHEN m.median > 0 AND n < m.median * 0.5 THEN 'low' ELSE 'ok' END AS status FROM f JOIN m ON m."table" = f."table" AND m.market = f.market"""))
def completeness(spark, sf):
    quotes = V.quotes(spark, sf)
    return Q.completeness(quotes, {"quotes": quotes, "flows": V.flows(spark, sf)}, {"index_daily": V.index_daily(spark, sf)})


@query("presence_grid", "A34", with_views("""
WITH f AS (SELECT DISTINCT date, market FROM quotes GROUP BY date, market HAVING count(*) >= 12), g AS (SELECT DISTINCT date, market FROM flows GROUP BY date, market HAVING count(*) >= 12)
SELECT c.date, s.dataset, s.market FROM calendar c CROSS JOIN (VALUES ('quotes', 'sii'), ('quotes', 'otc'), ('flows', 'sii')) s(dataset, market)
WHERE NOT EXISTS (SELECT 1 FROM f WHERE s.dataset = 'quotes' AND f.date = c.date AND f.market = s.market) AND NOT EXISTS (SELECT 1 FROM g WHERE s.dataset = 'flows' AND g.date = c.date AND g.market = s.market)"""))
def presence_grid(spark, sf):
    def files(df, name):
        n = F.count(F.lit(1))
        return df.groupBy("date", "market").agg((n * 40).alias("bytes"), n.alias("lines")).withColumn("dataset", F.lit(name))

    stored = files(V.quotes(spark, sf), "quotes").unionByName(files(V.flows(spark, sf), "flows"))
    slots = [("quotes", "sii"), ("quotes", "otc"), ("flows", "sii")]
    return Q.presence_grid(stored, V.calendar(spark, sf), slots, min_lines=12)


@query("coverage_verdict", "A35", with_views("""
WITH u AS (SELECT DISTINCT symbol FROM quotes), r AS (SELECT symbol, CASE WHEN max(orders_n) >= 13 THEN 'ok' WHEN max(orders_n) >= 11 THEN 'report_not_published' ELSE 'too_small' END AS status FROM reports GROUP BY 1),
 a AS (SELECT count(*) AS universe, sum((status LIKE 'ok%')::INT) AS saved, sum((status IS NOT NULL AND status NOT LIKE 'ok%')::INT) AS failed, sum((status = 'too_small')::INT) AS hard_failed FROM u LEFT JOIN r ON u.symbol = r.symbol)
SELECT *, rnd(saved / universe, 6) AS coverage, saved / universe >= 0.8 AS fallback, CASE WHEN saved = 0 AND failed > 0 AND hard_failed = failed THEN 'fail' ELSE 'pass' END AS verdict FROM a"""))
def coverage_verdict(spark, sf):
    universe = V.quotes(spark, sf).select("symbol").distinct()
    most = V.reports(spark, sf).groupBy("symbol").agg(F.max("orders_n").alias("m"))
    status = F.when(F.col("m") >= 13, "ok").when(F.col("m") >= 11, "report_not_published").otherwise("too_small")
    return _round_all(Q.coverage_verdict(universe, most.select("symbol", status.alias("status"))), 6)


# ---- spikes -----------------------------------------------------------
_SPIKE_OUT = "market, symbol, date, rnd(close_prev, 4) AS close_prev, rnd(close_curr, 4) AS close_curr, rnd(close_next, 4) AS close_next, rnd(pct_change, 6) AS pct_change, reverted"
_UNDONE = "coalesce(CASE WHEN close_curr > close_prev THEN close_next < close_curr * 0.7::DOUBLE ELSE close_next > close_curr / 0.7::DOUBLE END, false) AS reverted"


@query("price_spikes", "C25 J17", with_views(f"""
WITH j AS (SELECT c.market, c.symbol, c.date, p.close AS close_prev, c.close AS close_curr, n.close AS close_next, (c.close - p.close) / nullif(p.close, 0) AS pct_change FROM quotes c
  JOIN quotes p ON p.symbol = c.symbol AND p.market = c.market AND CAST(p.date AS DATE) = CAST(c.date AS DATE) - 1 LEFT JOIN quotes n ON n.symbol = c.symbol AND n.market = c.market AND CAST(n.date AS DATE) = CAST(c.date AS DATE) + 1)
SELECT {_SPIKE_OUT} FROM (SELECT *, {_UNDONE} FROM j WHERE abs(pct_change) > 0.11)"""))
def price_spikes(spark, sf):
    df = Q.spikes(V.quotes(spark, sf))
    return _round_all(df.withColumn("pct_change", R("pct_change", 6)), 4, skip=("pct_change",))


@query("worst_spikes", "T6 C25", with_views(f"""
WITH j AS (SELECT market, symbol, date, lag(close) OVER w AS close_prev, close AS close_curr, lead(close) OVER w AS close_next, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS pct_change FROM quotes WINDOW w AS (PARTITION BY market, symbol ORDER BY date))
SELECT {_SPIKE_OUT} FROM (SELECT *, {_UNDONE} FROM j WHERE abs(pct_change) > 0.11) ORDER BY abs(pct_change) DESC, symbol, date LIMIT 200"""))
def worst_spikes(spark, sf):
    df = Q.worst(Q.spikes(V.quotes(spark, sf), days="trading"), "pct_change", 200, "symbol", "date")
    return _round_all(df.withColumn("pct_change", R("pct_change", 6)), 4, skip=("pct_change",))


# ---- snapshots --------------------------------------------------------
_SNAP = "daily AS (SELECT CAST(ts AS DATE) AS snapshot, count(*) AS n FROM events GROUP BY 1), snap AS (SELECT snapshot FROM daily WHERE n >= (SELECT avg(n) FROM daily))"


def _snapshots(spark, sf):
    """Days with at least the average number of events count as snapshot days."""
    daily = V.table(spark, sf, "events").groupBy(F.to_date("ts").alias("snapshot")).agg(F.count(F.lit(1)).alias("n"))
    return daily.where(F.col("n") >= daily.agg(F.avg("n")).scalar()).select("snapshot")


@query("snapshot_gaps", "W22", with_views(f"""WITH {_SNAP}, l AS (SELECT snapshot, lead(snapshot) OVER (ORDER BY snapshot) AS next_snapshot FROM snap WHERE snapshot BETWEEN DATE '2024-01-25' - 30 AND DATE '2024-01-25')
SELECT strftime(snapshot, '%Y-%m-%d') AS snapshot, strftime(next_snapshot, '%Y-%m-%d') AS next_snapshot, next_snapshot - snapshot AS gap_days FROM l WHERE next_snapshot - snapshot > 1"""))
def snapshot_gaps(spark, sf):
    df = Q.snapshot_gaps(_snapshots(spark, sf), F.to_date(F.lit("2024-01-25")), 30, 1)
    return df.select(F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot"), F.date_format("next_snapshot", "yyyy-MM-dd").alias("next_snapshot"), "gap_days")


@query("snapshot_freshness", "M4", with_views(f"""WITH {_SNAP}, a AS (SELECT coalesce(max(snapshot) FILTER (snapshot <= DATE '2024-01-25'), max(snapshot)) AS latest, sum((snapshot > DATE '2024-01-25')::INT) AS future FROM snap)
SELECT strftime(latest, '%Y-%m-%d') AS latest, future, coalesce(latest BETWEEN DATE '2024-01-18' AND DATE '2024-01-24', false) AS fresh FROM a"""))
def snapshot_freshness(spark, sf):
    df = Q.snapshot_freshness(_snapshots(spark, sf).distinct(), F.to_date(F.lit("2024-01-25")))
    return df.withColumn("latest", F.date_format("latest", "yyyy-MM-dd"))


# ---- load contracts ---------------------------------------------------
_OLD = "old AS (SELECT date, market, symbol, volume FROM quotes WHERE date < '2000-01-01')"
_NEW = "new AS (SELECT date, market, symbol, volume * 2 AS volume FROM quotes WHERE date >= '1999-06-01')"


def _slices(spark, sf):
    q = V.quotes(spark, sf).select("date", "market", "symbol", "volume")
    old = q.where("date < '2000-01-01'")
    new = q.where("date >= '1999-06-01'").withColumn("volume", F.col("volume") * 2)
    return old, new


@query("load_if_absent", "K1 K4 J13 U1", with_views(f"WITH {_OLD}, {_NEW} SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.date = new.date AND o.market = new.market)"))
def load_if_absent(spark, sf):
    old, new = _slices(spark, sf)
    return load.append_if_absent(old, new, ["date", "market"])


@query("reload_slices", "K2 K4", with_views(f"WITH {_OLD}, {_NEW} SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.date = old.date AND n.market = old.market)"))
def reload_slices(spark, sf):
    old, new = _slices(spark, sf)
    return load.replace_slices(old, new, ["date", "market"])


@query("replace_year_slice", "K6", with_views(f"WITH {_OLD}, {_NEW}, n99 AS (SELECT * FROM new WHERE substr(date, 1, 4) = '1999') SELECT substr(date, 1, 4) AS year, date, market, symbol, volume FROM (SELECT * FROM n99 UNION ALL SELECT * FROM old WHERE substr(date, 1, 4) <> '1999')"))
def replace_year_slice(spark, sf):
    old, new = (df.withColumn("year", F.substring("date", 1, 4)) for df in _slices(spark, sf))
    return load.replace_slices(old, new.where("year = '1999'"), ["year"])


@query("purge_periods", "K13", with_views("SELECT date, symbol, revenue_current FROM monthly WHERE date NOT IN ('1996M01', '1997M12', '1998M06')"))
def purge_periods(spark, sf):
    return load.purge_slices(V.monthly(spark, sf), "date", ["1996M01", "1997M12", "1998M06"]).select("date", "symbol", "revenue_current")


@query("high_water_append", "K8 M2", with_views("SELECT date, market, count(*) AS rows, sum(volume) AS volume FROM quotes WHERE date > (SELECT max(date) FROM flows WHERE date < '1999-03-15') GROUP BY 1, 2"))
def high_water_append(spark, sf):
    stored = V.flows(spark, sf).where("date < '1999-03-15'")
    new = load.after_high_water(V.quotes(spark, sf), stored)
    return new.groupBy("date", "market").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


@query("first_seen", "K10 M1 J13 U5", with_views("""
WITH s AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-03'), n AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-03')
SELECT user_id, '20240103' AS publish_time FROM n WHERE user_id NOT IN (SELECT user_id FROM s) UNION ALL SELECT user_id, '20240102' FROM s"""))
def first_seen(spark, sf):
    ev = V.table(spark, sf, "events")
    empty = ev.select("user_id").limit(0)
    seen = load.first_seen(empty, ev.where("ts < '2024-01-03'").select("user_id"), ["user_id"], "20240102")
    new = load.first_seen(seen, ev.where("ts >= '2024-01-03'").select("user_id"), ["user_id"], "20240103")
    return new.unionByName(seen)


@query("late_columns", "K12 U2", with_views("SELECT date, symbol, volume, CAST(NULL AS DOUBLE) AS foreign_net FROM quotes UNION ALL SELECT date, symbol, NULL, foreign_net FROM flows"))
def late_columns(spark, sf):
    q = V.quotes(spark, sf).select("date", "symbol", "volume")
    f = V.flows(spark, sf).select("date", "symbol", "foreign_net")
    return load.add_late_columns(q, {"foreign_net": "double"}).unionByName(f, allowMissingColumns=True)


@query("stacked_period_types", "K7 U1", with_views("""
SELECT date, symbol, 'quarter' AS period_type, rnd(eps_q, 6) AS eps FROM reports UNION ALL
SELECT date, symbol, 'accumulated', rnd(sum(eps_q) OVER (PARTITION BY symbol, substr(date, 1, 4) ORDER BY date), 6) FROM reports"""))
def stacked_period_types(spark, sf):
    r = V.reports(spark, sf).select("date", "symbol", F.col("eps_q").alias("eps"))
    w = W.series(["symbol", F.substring("date", 1, 4)], "date")
    return _round_all(load.stack_periods(r, r.withColumn("eps", W.cumulative("eps", w))), 6)


@query("code_book_merge", "K19", with_views("""
WITH o AS (SELECT p_brand AS statement, p_type AS code, min(p_name) AS name FROM part WHERE p_size <= 25 GROUP BY 1, 2),
 n AS (SELECT statement, code, name FROM (SELECT p_brand AS statement, p_type AS code, p_name AS name, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey DESC) AS rn FROM part WHERE p_size > 25) WHERE rn = 1)
SELECT coalesce(o.statement, n.statement) AS statement, coalesce(o.code, n.code) AS code, coalesce(n.name, o.name) AS name FROM o FULL JOIN n ON o.statement = n.statement AND o.code = n.code"""))
def code_book_merge(spark, sf):
    part = V.table(spark, sf, "part").select(F.col("p_brand").alias("statement"), F.col("p_type").alias("code"), F.col("p_name").alias("name"), "p_partkey", "p_size")
    old = part.where("p_size <= 25").groupBy("statement", "code").agg(F.min("name").alias("name"))
    return load.merge_code_book(old, part.where("p_size > 25"), ["statement", "code"], "name", "p_partkey")


@query("wide_pairs", "K14 A3", with_views("SELECT date, symbol, string_agg(account_code || '=' || CAST(CAST(round(value_num * 1e5) AS BIGINT) AS VARCHAR), ',' ORDER BY account_code) AS pairs FROM facts GROUP BY 1, 2"))
def wide_pairs(spark, sf):
    facts = V.facts(spark, sf).withColumn("v", F.round(F.col("value_num") * 1e5).cast("bigint").cast("string"))
    wide = load.wide_pairs(facts, ["date", "symbol"], "account_code", "v")
    return wide.select("date", "symbol", F.array_join(F.transform("pairs", lambda p: F.concat_ws("=", p["code"], p["value"])), ",").alias("pairs"))


@query("long_pairs", "P25 K14", with_views("SELECT date, symbol, account_code AS code, CAST(CAST(round(value_num * 1e5) AS BIGINT) AS VARCHAR) AS value, round(value_num * 1e5) AS value_num FROM facts"))
def long_pairs(spark, sf):
    facts = V.facts(spark, sf).withColumn("v", F.round(F.col("value_num") * 1e5).cast("bigint").cast("string"))
    return load.long_pairs(load.wide_pairs(facts, ["date", "symbol"], "account_code", "v"), ["date", "symbol"])


@query("publish_time_backfill", "K18", with_views("SELECT date, symbol, CASE WHEN revenue_current > 500 THEN '19990101' ELSE strftime(make_date(CAST(substr(date, 1, 4) AS INT), CAST(substr(date, 6, 2) AS INT), 10) + INTERVAL 1 MONTH, '%Y%m%d') END AS publish_time FROM monthly"))
def publish_time_backfill(spark, sf):
    known = F.when(F.col("revenue_current") > 500, F.lit("19990101"))
    return load.backfill_publish_time(V.monthly(spark, sf).select("date", "symbol", known.alias("publish_time")))


@query("layout_merge", "K20", with_views(f"WITH {_OLD}, {_NEW} SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.date = old.date AND n.market = old.market)"))
def layout_merge(spark, sf):
    old, new = _slices(spark, sf)
    return load.merge_layouts(new, old, ["date", "market"])


@query("load_row_filters", "C33 F1 F2 A19", with_views("""
WITH raw AS (SELECT date, CASE WHEN volume > 40 THEN symbol || 'X' ELSE symbol END AS symbol, CASE WHEN volume < 3 THEN NULL ELSE open END AS open, CASE WHEN volume < 3 THEN 0 ELSE close END AS close FROM quotes)
SELECT date, count(*) AS rows FROM raw WHERE regexp_full_match(symbol, '[0-9]{4}') AND (coalesce(open, 0) <> 0 OR coalesce(close, 0) <> 0) GROUP BY 1"""))
def load_row_filters(spark, sf):
    q = V.quotes(spark, sf)
    low = F.col("volume") < 3
    raw = q.select(
        "date", F.when(F.col("volume") > 40, F.concat("symbol", F.lit("X"))).otherwise(F.col("symbol")).alias("symbol"),
        F.when(~low, F.col("open")).alias("open"), F.when(low, 0.0).otherwise(F.col("close")).alias("close"),
    )
    return load.load_rows(raw).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query("keep_last_quote", "F11 U5", with_views("""
SELECT symbol, date, l_orderkey, l_linenumber, price FROM (SELECT printf('%04d', l_suppkey) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey, l_linenumber, l_extendedprice AS price,
 row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1"""))
def keep_last_quote(spark, sf):
    li = V._keyed(V.table(spark, sf, "lineitem"))
    order = [F.desc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return W.keep_last(li, ["symbol", "date"], order).select("symbol", "date", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))


# ---- publishing -------------------------------------------------------
@query("publish_payload", "K17 T1 X17", with_views("""
WITH m AS (SELECT max(playbook_date) AS d FROM scores), t AS (SELECT s.*, row_number() OVER (ORDER BY ml_rank) AS r FROM scores s, m WHERE s.playbook_date = m.d AND ml_rank <= 10)
SELECT '{"schema_version":1,"quote_date":"' || any_value(entry_date) || '","picks":[' || string_agg('{"rank":' || ml_rank || ',"symbol":"' || symbol || '"}', ',' ORDER BY ml_rank) || ']}' AS payload FROM t"""))
def publish_payload(spark, sf):
    scores = V.scores(spark, sf)
    newest = scores.agg(F.max("playbook_date")).scalar()
    rows = scores.where(F.col("playbook_date") == newest)
    return publish.picks_payload(rows, 10, "ml_rank", "entry_date", ["symbol"])


@query("summary_json", "K16 X17", with_views("""SELECT '{"rows":' || count(*) || ',"symbols":' || count(DISTINCT symbol) || ',"first":"' || min(date) || '","last":"' || max(date) || '"}' AS summary FROM quotes"""))
def summary_json(spark, sf):
    q = V.quotes(spark, sf)
    agg = q.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("symbol").alias("symbols"), F.min("date").alias("first"), F.max("date").alias("last"))
    return publish.json_row(agg, "summary")


@query("first_seen_stream", "M1 K10", with_views("SELECT user_id, strftime(min(ts), '%Y%m%d%H%M%S') AS first_seen FROM events GROUP BY 1"))
def first_seen_stream(spark, sf):
    """The events file read as a stream; the result table stands in the shared checkpoint folder."""
    import uuid

    from tickerloom.session import shared_folder
    from tickerloom.streaming.first_seen import run_first_seen

    folder = f"{shared_folder(spark)}/first-seen-{uuid.uuid4().hex}"
    schema = V.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet").select("user_id", "ts")
    run_first_seen(stream, f"{folder}/table", f"{folder}/progress", ["user_id"], "ts")
    return spark.read.parquet(f"{folder}/table").select("user_id", F.date_format("ts", "yyyyMMddHHmmss").alias("first_seen"))


# ---- loads into stored tables --------------------------------------------
def _table_root(spark):
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


@query("static_replace", "K3 C33 S20", with_views("SELECT symbol, name, issued_shares, industry, 2 AS load FROM issued"))
def static_replace(spark, sf):
    """A static table is loaded twice; readers see the second version whole."""
    root, full = _table_root(spark), V.issued(spark, sf)
    ingest.load_category(spark, "stock_info", full.where("industry < 10").withColumn("load", F.lit(1)), root)
    ingest.load_category(spark, "stock_info", full.withColumn("load", F.lit(2)), root)
    return versions.read_table(spark, f"{root}/stock_info")


@query("weekly_load", "K5 C33 F1", with_views("""
SELECT CAST(date AS VARCHAR) AS date, symbol, level, holders, shares, CASE WHEN date < '1996' THEN 1 ELSE 2 END AS load FROM levels WHERE (CAST(symbol AS INT) + level) % 7 <> 0"""))
def weekly_load(spark, sf):
    """Padded symbols and funds among them; snapshots that an earlier load stored are not loaded again."""
    fund = (F.col("symbol").cast("int") + F.col("level")) % 7 == 0
    raw = V.levels(spark, sf).withColumn("symbol", F.concat(F.lit(" "), "symbol", F.when(fund, F.lit("B")).otherwise(F.lit("  "))))
    root = _table_root(spark)
    ingest.load_category(spark, "shareholding", raw.where("date < '1996'").withColumn("load", F.lit(1)), root)
    ingest.load_category(spark, "shareholding", raw.withColumn("load", F.lit(2)), root)
    stored = spark.read.parquet(f"{root}/shareholding")
    return stored.select(F.col("date").cast("string").alias("date"), "symbol", "level", "holders", "shares", "load")


@query("monthly_load", "C33 K2 K4", with_views("""
SELECT date, CASE WHEN CAST(symbol AS INT) % 2 = 0 THEN 'sii' ELSE 'otc' END AS market, symbol, revenue_current, CASE WHEN date >= '1997' THEN 2 ELSE 1 END AS load FROM monthly"""))
def monthly_load(spark, sf):
    """All months, then those from 1997 on again by force."""
    rows = V.monthly(spark, sf).withColumn("n", F.col("symbol").cast("int")).select("date", V.market_of("n").alias("market"), "symbol", "revenue_current")
    root = _table_root(spark)
    ingest.load_category(spark, "monthly_revenue", rows.withColumn("load", F.lit(1)), root)
    ingest.load_category(spark, "monthly_revenue", rows.where("date >= '1997'").withColumn("load", F.lit(2)), root, force=True)
    return spark.read.parquet(f"{root}/monthly_revenue").select("date", "market", "symbol", "revenue_current", "load")


@query("yearly_load", "C33 K6", with_views("""
SELECT year(o_orderdate) AS year, printf('%04d', o_custkey % 100) AS symbol, count(*) AS orders, CASE WHEN year(o_orderdate) = 1995 THEN 2 ELSE 1 END AS load FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2"""))
def yearly_load(spark, sf):
    """Ex-dividend rows by year, preferred shares left out; one year comes in again by force."""
    o = V.table(spark, sf, "orders")
    code = F.concat(V.symbol_of(F.col("o_custkey") % 100), F.when(F.col("o_orderstatus") == "P", F.lit("A")).otherwise(F.lit("")))
    rows = o.select(F.year("o_orderdate").alias("year"), code.alias("symbol"))
    root = _table_root(spark)
    ingest.load_category(spark, "ex_dividend", rows.withColumn("load", F.lit(1)), root)
    ingest.load_category(spark, "ex_dividend", rows.where("year = 1995").withColumn("load", F.lit(2)), root, force=True)
    return spark.read.parquet(f"{root}/ex_dividend").groupBy("year", "symbol", "load").agg(F.count("*").alias("orders"))

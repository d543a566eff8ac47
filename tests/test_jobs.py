import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickerloom.jobs import cohort, derive, ingest, ml, performance as perf, quality
from tickerloom.plans import views as V
from tickerloom.session import stage
from tickerloom.sinks import load, publish
from tickerloom.sources import documents as D
from tickerloom.sources import reports as S
from tickerloom.streaming.first_seen import run_first_seen


# ---- derived tables ---------------------------------------------------
def test_margin_pressure_by_hand(spark):
    cols = "date string, market string, symbol string, name string, margin_long_prev_balance double, margin_long_balance double, margin_long_limit double, margin_short_prev_balance double, margin_short_balance double, margin_short_limit double, margin_short_buy double, margin_short_cash_repay double"
    data = [("d", "sii", "1", "n", 100.0, 150.0, 1000.0, 0.0, 10.0, 0.0, 5.0, None), ("d", "sii", "1", "m", None, 50.0, None, None, None, None, None, 1.0)]
    r = derive.margin_pressure(spark.createDataFrame(data, cols)).first()
    assert (r["name"], r["margin_long_balance"], r["margin_usage_ratio"], r["margin_long_balance_wow_pct"]) == ("n", 200.0, 20.0, 100.0)
    assert r["short_usage_ratio"] is None and r["short_cover_pressure"] is None and r["margin_pressure_score"] == 9.0


def test_concentration_incremental_equals_full(spark):
    data = [(d, s, lv, 10, float((hash_ := ord(s) + lv * i) % 17)) for i, d in enumerate(["w1", "w2", "w3"]) for s in "ab" for lv in range(1, 16) if not (s == "b" and d == "w2")]
    df = spark.createDataFrame(data, "date string, symbol string, level int, holders int, percentage double")
    full = derive.concentration(df).where("date > 'w2'")
    part = derive.concentration(df, after="w2")
    cols = ["date", "symbol", "large_holder_ratio_wow", "concentration_spread_wow"]
    assert rows(full, *cols) == rows(part, *cols)
    assert part.where("symbol = 'b'").first()["large_holder_ratio_wow"] is not None


def test_holding_incremental_equals_full(spark, sf):
    flows, fh = V.flows(spark, sf), V.foreign_holding(spark, sf)
    full = derive.cumulative_holding(flows, fh, "trust_net", "trust")
    old = derive.cumulative_holding(flows.where("date <= '1998'"), fh, "trust_net", "trust")
    new = derive.cumulative_holding(flows, fh, "trust_net", "trust", state=old, after="1998")
    cols = ["date", "symbol", "trust_held_shares"]
    assert rows(full, *cols) == rows(old.unionByName(new), *cols)


def test_valuation_incremental_equals_full_and_keeps_losses(spark):
    quotes = spark.createDataFrame([(f"2024-{m:02d}-01", "a", 10.0 + m) for m in range(1, 13)], "date string, symbol string, close double")
    reports = spark.createDataFrame([(f"2023Q{q}", "a", 1.0, 50.0) for q in (1, 2, 3, 4)] + [("2024Q1", "a", -9.0, 50.0)], "date string, symbol string, eps_q double, nav_per_share double")
    pe = spark.createDataFrame([("2024-05-01", "a", 1.0, 1), ("2024-05-01", "a", 2.0, 2)], "date string, symbol string, pe_ratio double, row_order int")
    full = derive.valuation(quotes, reports, pe)
    got = {r["date"]: r for r in full.collect()}
    assert min(got) == "2024-04-01" and got["2024-05-01"]["pe_official"] == 2.0 and got["2024-05-01"]["ttm_eps_official"] == 4.0
    assert got["2024-06-01"]["ttm_eps_official"] == -6.0 and got["2024-06-01"]["pe_percentile_official"] is None and got["2024-06-01"]["roe_official"] == -12.0
    old = full.where("date <= '2024-04-30'")
    new = derive.valuation(quotes, reports, pe, after="2024-04-30", history=old)
    cols = ["date", "ttm_eps_official", "pe_percentile_official"]
    assert rows(full.where("date > '2024-04-30'"), *cols) == rows(new, *cols)


# ---- performance ------------------------------------------------------
@pytest.fixture(scope="module")
def market(spark):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(150)]
    days = [d for d in days if d.weekday() < 5]
    q = [(d.isoformat(), s, None if (s == "C" and d.month == 4) else float(10 + i + k)) for i, d in enumerate(days) for k, s in enumerate("ABC")]
    quotes = spark.createDataFrame(q, "date string, symbol string, open double")
    entry = {"2024-01-11": "2024-01-11", "2024-02-11": "2024-02-12", "2024-03-11": "2024-03-11", "2024-04-11": "2024-04-11", "2024-05-16": "2024-05-16"}
    s = [(d, e, sym, 3.0 - k, k + 1) for d, e in entry.items() for k, sym in enumerate("ABC")]
    scores = spark.createDataFrame(s, "playbook_date string, entry_date string, symbol string, ml_score double, ml_rank int")
    return scores, quotes


def test_rotation_by_hand(spark, market):
    scores, quotes = market
    trades = stage(perf.rotation_trades(scores, quotes, [2, 3]))
    got = {(r["top_n"], r["playbook_date"], r["symbol"]): r for r in trades.collect()}
    assert {k[1] for k in got} == {"2024-01-11", "2024-04-11", "2024-05-16"}
    jan = got[(2, "2024-01-11", "A")]
    assert jan["exit_date"] == "2024-02-09" and jan["exit_reason"] == "monthly_rotation"
    shares = 100000 // jan["entry_price"]
    assert jan["shares"] == shares
    cost = (jan["entry_price"] + jan["exit_price"]) * shares * 0.001425 + jan["exit_price"] * shares * 0.003
    assert jan["net_pnl"] == pytest.approx((jan["exit_price"] - jan["entry_price"]) * shares - cost, abs=0.006)
    assert (3, "2024-04-11", "C") not in got
    assert got[(3, "2024-05-16", "A")]["exit_reason"] == "still_open"
    months = {(r["top_n"], r["playbook_date"]): r for r in perf.rotation_months(scores, quotes, trades, [2, 3]).collect()}
    feb, mar, apr = (months[(3, f"2024-{m}")] for m in ("02-11", "03-11", "04-11"))
    assert (feb["exits"], feb["entries"], feb["cohort_playbook_date"]) == (3, 0, "2024-01-11")
    assert (mar["exits"], mar["realized_net_pnl"]) == (0, 0.0) and apr["entries_failed_no_quote"] == 1


def test_sweep_at_one_n_equals_rotation(spark, market):
    scores, quotes = market
    wide = perf.rotation_trades(scores, quotes, [1, 2, 3]).where("top_n = 2")
    alone = perf.rotation_trades(scores, quotes, [2])
    assert rows(wide, "playbook_date", "symbol", "shares", "exit_reason") == rows(alone, "playbook_date", "symbol", "shares", "exit_reason")


def test_forward_returns_need_positive_opens(spark, market):
    scores, quotes = market
    got = perf.forward_returns(scores, quotes)
    assert got.where("symbol = 'C' AND playbook_date = '2024-04-11'").count() == 0
    assert got.where("playbook_date = '2024-05-16'").count() == 0
    r = got.where("symbol = 'A' AND playbook_date = '2024-03-11'").first()
    assert r["exit_date"] == "2024-04-10" and r["fwd_return_pct"] > 0


def test_drawdown_and_stats(spark):
    df = spark.createDataFrame([("k", i, v, v * 10) for i, v in enumerate([1.0, -3.0, 2.0, 4.0])], "k string, t int, r double, p double")
    r = perf.return_stats(df, ["k"], "t", "r", "p").first()
    assert (r["total_pnl"], r["max_drawdown_pnl"], r["positive_months_pct"], r["worst_month_return_pct"]) == (40.0, -30.0, 0.75, -3.0)


# ---- cohorts ----------------------------------------------------------
def test_rows_after_the_cutoff_change_nothing(spark, sf):
    cal = V.playbook(spark, sf).where("playbook_date = '1998-05-16'")
    keys = V.scored_base(spark, sf).select("playbook_date", "symbol").join(cal.select("playbook_date", "cutoff_date"), "playbook_date")
    monthly, quotes = V.monthly(spark, sf), V.quotes(spark, sf)
    full = cohort.revenue_features(keys, monthly)
    part = cohort.revenue_features(keys, monthly.where("publish_time <= '19980515'"))
    cols = ["symbol", "revenue_yoy_1m", "revenue_yoy_3m_avg", "rev_max_publish_time"]
    assert rows(full.fillna(0), *cols) == rows(part.fillna(0), *cols)
    a = cohort.latest_quotes(keys, quotes).where("quote_date IS NOT NULL")
    b = cohort.latest_quotes(keys, quotes.where("date <= '1998-05-15'")).where("quote_date IS NOT NULL")
    assert rows(a, "symbol", "quote_date", "avg_volume_20d") == rows(b, "symbol", "quote_date", "avg_volume_20d")


GUARD = "playbook_date string, cutoff_date string, tech_snapshot_date string, quote_date string, rev_max_publish_time string"


@pytest.mark.parametrize(
    "tech, quote, rev, rule",
    [
        ("2026-07-09", "2026-07-09", "20260710", None),
        ("2026-07-13", "2026-07-09", "20260710", "technical_beyond_cutoff"),
        ("2026-06-15", "2026-07-09", "20260710", "technical_behind_quotes"),
        ("2026-07-10", "2026-07-09", "20260710", "technical_ahead_of_quotes"),
        ("2026-07-09", "2026-07-09", "20260713", "revenue_beyond_cutoff"),
        ("2026-07-09", "2026-07-09", None, "unverifiable_revenue"),
        (None, "2026-07-09", "20260710", "unverifiable_technical"),
    ],
)
def test_look_ahead_guard(spark, tech, quote, rev, rule):
    df = spark.createDataFrame([("2026-07-11", "2026-07-10", tech, quote, rev), ("2026-07-11", "2026-07-10", None, "2026-06-15", None)], GUARD)
    found = {r["rule"] for r in cohort.guard_violations(df).collect()}
    if rule is None:
        assert not found
        cohort.assert_point_in_time(df)
    else:
        assert rule in found
        with pytest.raises(ValueError, match="look-ahead"):
            cohort.assert_point_in_time(df)


def test_ensemble_scores(spark):
    data = [("d", s, m, v) for m, vs in (("a", [10.0, 20.0, 30.0]), ("b", [5.0, 15.0, 25.0])) for s, v in zip("xyz", vs)]
    df = spark.createDataFrame(data, "playbook_date string, symbol string, model string, score double")
    assert rows(cohort.combine_scores(df, "rank"), "symbol", "ml_score", "ml_rank") == [("x", -3.0, 3), ("y", -2.0, 2), ("z", -1.0, 1)]
    assert rows(cohort.combine_scores(df), "symbol", "ml_score") == [("x", 7.5), ("y", 17.5), ("z", 27.5)]
    opposed = df.where("model = 'a'").union(df.where("model = 'a'").select("playbook_date", "symbol", F.lit("c"), -F.col("score")))
    assert rows(cohort.combine_scores(opposed, "rank"), "symbol", "ml_score", "ml_rank") == [("x", -2.0, 1), ("y", -2.0, 2), ("z", -2.0, 3)]


def test_two_cash_flow_meanings(spark):
    acc = spark.createDataFrame([("2024Q1", "a", 5.0), ("2024Q2", "a", 8.0), ("2024Q4", "a", 20.0)], "date string, symbol string, AAAA double")
    as_is = cohort.single_quarter_flow(acc, ["AAAA"], True)
    assert rows(as_is, "date", "AAAA") == [("2024Q1", 5.0), ("2024Q2", 3.0), ("2024Q4", 20.0)]
    strict = {r["date"]: r["AAAA"] for r in cohort.single_quarter_flow(acc, ["AAAA"], False).collect()}
    assert strict == {"2024Q1": None, "2024Q2": 3.0, "2024Q4": None}


# ---- quality ----------------------------------------------------------
def test_spikes_and_reversal(spark):
    data = [("sii", "a", "2024-01-01", 100.0), ("sii", "a", "2024-01-02", 200.0), ("sii", "a", "2024-01-03", 120.0), ("sii", "b", "2024-01-01", 0.0), ("sii", "b", "2024-01-02", 5.0)]
    got = quality.spikes(spark.createDataFrame(data, "market string, symbol string, date string, close double")).collect()
    assert {(r["symbol"], r["date"], r["reverted"]) for r in got} == {("a", "2024-01-02", True), ("a", "2024-01-03", False)}


@pytest.mark.parametrize("today, fresh", [("2026-07-19", True), ("2026-07-25", False), ("2026-07-17", False)])
def test_snapshot_freshness(spark, today, fresh):
    snaps = spark.createDataFrame([(datetime.date(2026, 7, 10),), (datetime.date(2026, 7, 17),), (datetime.date(2099, 7, 9),)], "snapshot date")
    r = quality.snapshot_freshness(snaps, F.to_date(F.lit(today))).first()
    assert (r["fresh"], r["future"]) == (fresh, 1)


def test_snapshot_gap(spark):
    days = [datetime.date(2026, 7, 3), datetime.date(2026, 7, 10), datetime.date(2026, 7, 24)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot date")
    gaps = quality.snapshot_gaps(df, F.to_date(F.lit("2026-07-26"))).collect()
    assert [(r["snapshot"].day, r["gap_days"]) for r in gaps] == [(10, 14)]
    assert quality.snapshot_gaps(df, F.to_date(F.lit("2026-09-26"))).count() == 0


# ---- readers ----------------------------------------------------------
def make_quote_file(folder, day, market, encoding="utf-8-sig", broken=False):
    d = folder / "daily_quotes" / day[:4] / day
    d.mkdir(parents=True, exist_ok=True)
    high = "9" if broken else "11"
    lines = [
        "每日收盤行情", "指數,收盤指數,漲跌(+/-),漲跌點數", '"加權","17,000.5",-,"100"', "指數,收盤指數,漲跌(+/-),漲跌點數", '"電子","800.0",+,"3.5"', "",
        '"證券代號","證券名稱","成交股數","開盤價","最高價","最低價","收盤價"', f'="2330","台積電","1,234","10","{high}","9","10.5"',
        '"0050A","etf","1","1","1","1","1"', '"1101","台泥","5","--","--","--"', "說明: x, y, z, w",
    ]
    (d / f"{market}.csv").write_text("\r\n".join(lines) + "\r\n", encoding=encoding)


def test_daily_conversion_end_to_end(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "tables"
    make_quote_file(raw, "20240102", "sii")
    make_quote_file(raw, "20240103", "sii", encoding="cp950")
    ingest.convert_daily(spark, str(raw), str(out), ["2024-01-02", "2024-01-03"], ["daily_quotes", "market_indices"])
    q = spark.read.parquet(str(out / "daily_quotes")).withColumn("date", F.col("date").cast("string"))
    got = {(r["date"], r["symbol"]): r for r in q.collect()}
    assert set(got) == {(d, s) for d in ("2024-01-02", "2024-01-03") for s in ("2330", "1101")}
    r = got[("2024-01-03", "2330")]
    assert (r["name"], r["volume"], r["high"], r["src_row"]) == ("台積電", 1234.0, 11.0, 8)
    assert got[("2024-01-02", "1101")]["close"] is None and r["value"] is None
    ix = spark.read.parquet(str(out / "market_indices"))
    assert rows(ix.where("date = '2024-01-02'"), "index_name", "index_close", "index_change_points") == [("加權", 17000.5, -100.0), ("電子", 800.0, 3.5)]
    make_quote_file(raw, "20240104", "sii", broken=True)
    with pytest.raises(ingest.AuditError, match="ohlc"):
        ingest.convert_daily(spark, str(raw), str(out), ["2024-01-04"], ["daily_quotes"])


def test_unknown_column_fails(spark):
    lines = spark.createDataFrame([("f", 1, "證券代號,證券名稱,新欄位,收盤價"), ("f", 2, "1101,a,b,3")], "src_file string, src_row int, value string")
    with pytest.raises(Exception, match="unknown report column"):
        S.report_table(lines, {"證券代號": "symbol", "證券名稱": "name", "收盤價": "close"}).collect()


def test_two_header_rows(spark):
    lines = spark.createDataFrame(
        [("f", 1, "title"), ("f", 2, "股票,,融資,,融券,"), ("f", 3, "代號,名稱,買進,賣出,買進,賣出"), ("f", 4, '1101,"a,b",1,2,3,4'), ("f", 5, "1102,c,1"), ("f", 6, "以上,,,")],
        "src_file string, src_row int, value string",
    )
    head = S.header_rows(lines).first()["header"]
    assert head == ["股票-代號", "股票-名稱", "融資-買進", "融資-賣出", "融券-買進", "融券-賣出"]
    got = {r["src_row"]: r["fields"] for r in S.report_rows(lines).collect()}
    assert got == {4: ["1101", "a,b", "1", "2", "3", "4"], 5: ["1102", "c", "1", "", "", ""]}


FILING = """<html><xbrli:context id="x"></xbrli:context><ix:nonNumeric name="tifrs-notes:ReportCategory">
Individual report</ix:nonNumeric><div id="BalanceSheet"></div><table><tr><td>1100</td><td>Cash</td>
<td><ix:nonFraction name="a" contextRef="AsOf20240331" sign="-">(5)</ix:nonFraction></td><td><ix:nonFraction name="a" contextRef="AsOf20231231">7</ix:nonFraction></td></tr></table>
<div id="StatementOfComprehensiveIncome"></div><tr><td>4000</td><td>Rev</td><td><ix:nonFraction name="r" contextRef="From20240101To20240331">1,000</ix:nonFraction></td></tr>
<div id="StatementsOfCashFlows"></div><tr><td>AAAA</td><td>Cfo</td><td><ix:nonFraction name="c" contextRef="From20240101To20240331" sign="-">30</ix:nonFraction></td></tr>
<div id="StatementsOfChangeInEquity"></div><tr><td>3XXX</td><td>Eq</td><td><ix:nonFraction name="e" contextRef="AsOf20240331">99</ix:nonFraction></td></tr></html>"""


def test_statement_facts_by_hand(spark):
    docs = spark.createDataFrame([("2024Q1", "1101", "20240510", FILING)], "date string, symbol string, publish_time string, html string")
    got = rows(D.statement_facts(docs), "category", "period_type", "account_code", "value_num")
    assert got == [
        ("balance_sheet", "as_of", "1100", -5.0), ("cash_flow", "accumulated", "AAAA", -30.0), ("cash_flow", "quarter", "AAAA", -30.0),
        ("income_statement", "accumulated", "4000", 1000.0), ("income_statement", "quarter", "4000", 1000.0),
    ]
    meta = D.document_meta(docs, "html", {"c": "tifrs-notes:ReportCategory"}).select(D.report_basis("c").alias("b")).first()
    assert meta["b"] == "individual"
    words = spark.createDataFrame([("Consolidated report",), ("Non-consolidated report",), ("other",)], "c string")
    assert [r["b"] for r in words.select(D.report_basis("c").alias("b")).collect()] == ["consolidated", "individual", None]


def test_reject_reasons(spark):
    df = spark.createDataFrame([("<html>" + "x" * 50 + "ix:nonFraction",), ("x" * 80,), ("<html>" + "x" * 80,), ("<html>",)], "h string")
    assert [r["r"] for r in df.select(D.reject_reason("h", 60).alias("r")).collect()] == [None, "invalid_html", "no_xbrl_markers", "too_small"]


def test_fourth_quarter_falls_back(spark):
    facts = spark.createDataFrame(
        [("2024Q3", "a", "accumulated", "4000", 70.0), ("2024Q4", "a", "accumulated", "4000", 100.0), ("2024Q4", "a", "accumulated", "5900", 9.0), ("2024Q4", "a", "quarter", "6900", 1.0), ("2024Q4", "a", "accumulated", "6900", 5.0)],
        "date string, symbol string, period_type string, account_code string, value_num double",
    )
    got = D.fill_fourth_quarter(facts).where("period_type = 'quarter'")
    assert rows(got, "account_code", "value_num") == [("4000", 30.0), ("5900", 9.0), ("6900", 1.0)]


# ---- sinks ------------------------------------------------------------
def test_slices_are_replaced_and_reruns_are_safe(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("d1", "sii", 1), ("d2", "sii", 2)], "date string, market string, v int")
    load.write_slices(a, path, ["date", "market"])
    b = spark.createDataFrame([("d2", "sii", 20), ("d3", "otc", 3)], "date string, market string, v int")
    for _ in range(2):
        load.write_slices(b, path, ["date", "market"])
    assert rows(spark.read.parquet(path), "date", "v") == [("d1", 1), ("d2", 20), ("d3", 3)]
    ingest.load_table(spark, spark.createDataFrame([("d3", "otc", 9), ("d4", "otc", 4)], "date string, market string, v int"), path, ["date", "market"])
    assert rows(spark.read.parquet(path), "date", "v") == [("d1", 1), ("d2", 20), ("d3", 3), ("d4", 4)]


def test_divergent_update_fails(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    fresh = spark.createDataFrame([("a", 5.0), ("a", 5.0)], "k string, v double")
    assert rows(load.update_column(old, fresh, ["k"], "v"), "k", "v") == [("a", 5.0), ("b", 2.0)]
    with pytest.raises(Exception, match="divergent"):
        load.update_column(old, fresh.union(spark.createDataFrame([("a", 6.0)], "k string, v double")), ["k"], "v").collect()


def test_payload_needs_one_quote_date(spark):
    df = spark.createDataFrame([(1, "a", "d"), (2, "b", "d"), (3, "c", "e")], "ml_rank int, symbol string, entry_date string")
    doc = publish.picks_payload(df, 2, "ml_rank", "entry_date", ["symbol"]).first()["payload"]
    assert doc == '{"schema_version":1,"quote_date":"d","picks":[{"rank":1,"symbol":"a"},{"rank":2,"symbol":"b"}]}'
    with pytest.raises(Exception, match="one quote date"):
        publish.picks_payload(df, 3, "ml_rank", "entry_date", ["symbol"]).collect()


def test_first_seen_stream_over_two_runs(spark, tmp_path):
    src = tmp_path / "in"
    schema = "k string, seen string"
    spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "2")], schema).coalesce(1).write.parquet(str(src / "p1"))
    for _ in range(2):
        run_first_seen(spark.readStream.schema(schema).parquet(f"{src}/*"), str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "seen")
    spark.createDataFrame([("a", "3"), ("c", "3")], schema).coalesce(1).write.parquet(str(src / "p2"))
    run_first_seen(spark.readStream.schema(schema).parquet(f"{src}/*"), str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "seen")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "seen") == [("a", "1"), ("b", "1"), ("c", "3")]


# ---- models -----------------------------------------------------------
def test_model_takes_missing_features(spark):
    data = [(i, float(i), None if i % 5 == 0 else float(i % 7), float(3 * i)) for i in range(60)]
    df = spark.createDataFrame(data, "year int, a double, b double, y double").withColumn("year", (F.col("year") / 20).cast("int"))
    out = ml.walk_forward(df, ["a", "b"], "y", "year", [1, 2], rounds=2, depth=2)
    assert out.count() == 40 and out.where("prediction IS NULL").count() == 0
    assert sorted({r["train_median"] for r in out.collect()}) == [28.5, 58.5]

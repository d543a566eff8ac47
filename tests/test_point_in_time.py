"""Late filings, foreign calendars, missing values and audits before a table is stored."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickerloom.functions import clean
from tickerloom.jobs import cohort, ingest, performance as perf
from tickerloom.operators import ranks
from test_jobs import make_quote_file

MONTHS = "symbol string, date string, yoy_pct double, mom_pct double, publish_time string"


def features(spark, filed):
    months = spark.createDataFrame(filed, MONTHS)
    one = spark.createDataFrame([("2026-07-11", "2026-07-10", "1101")], "playbook_date string, cutoff_date string, symbol string")
    return cohort.revenue_features(one, months).first()


def test_month_filed_after_the_cutoff_is_in_no_feature(spark):
    base = [("1101", "2026M03", 1.0, 0.0, "20260410"), ("1101", "2026M04", 2.0, 0.0, "20260510"), ("1101", "2026M06", 9.0, 5.0, "20260708")]
    r = features(spark, [*base, ("1101", "2026M05", 500.0, 0.0, "20260713")])
    assert r["rev_max_publish_time"] == "20260708" and r["revenue_month"] == "2026M06"
    assert (r["revenue_yoy_1m"], r["revenue_yoy_3m_avg"], r["revenue_yoy_accel"]) == (9.0, 4.0, 8.0)
    assert r == features(spark, base)


def test_latest_month_counts_not_latest_filing(spark):
    r = features(spark, [("1101", "2026M04", 2.0, 0.0, "20260510"), ("1101", "2026M06", 9.0, 5.0, "20260708"), ("1101", "2026M05", 4.0, 1.0, "20260709")])
    assert r["revenue_month"] == "2026M06" and r["rev_max_publish_time"] == "20260709"
    assert (r["revenue_yoy_1m"], r["revenue_mom_1m"], r["revenue_yoy_3m_avg"], r["revenue_yoy_accel"]) == (9.0, 5.0, 5.0, 7.0)


def test_stale_symbol_has_no_features(spark):
    r = features(spark, [("1101", "2026M05", 4.0, 1.0, "20260609")])
    assert r["revenue_yoy_1m"] is None and r["rev_max_publish_time"] == "20260609"


def test_trades_follow_the_given_calendar(spark):
    days = [f"2024-{m:02d}-{d:02d}" for m in (4, 5) for d in range(1, 29)]
    quotes = spark.createDataFrame([(d, "1101", 10.0) for d in days], "date string, symbol string, open double")
    scores = spark.createDataFrame(
        [("2024-04-11", "1101", "2024-04-11", 1.0), ("2024-05-16", "1101", "2024-05-16", 1.0)],
        "playbook_date string, symbol string, entry_date string, ml_score double",
    )
    calendar = spark.createDataFrame([(d,) for d in days if d not in ("2024-05-15", "2024-05-14")], "date string")
    trades = perf.rotation_trades(scores, quotes, [1], calendar=calendar)
    months = perf.rotation_months(scores, quotes, trades, [1], calendar=calendar)
    exits = {r["exit_date"] for r in trades.where("playbook_date = '2024-04-11'").collect()}
    assert exits == {"2024-05-13"} == {r["exit_date"] for r in months.where("playbook_date = '2024-05-16'").collect()}


def test_missing_trading_day_fails(spark):
    cohorts = spark.createDataFrame([("2024-04-11", "2024-04-11"), ("2024-05-16", "2024-05-16")], "playbook_date string, entry_date string")
    late = spark.createDataFrame([("2024-05-16",), ("2024-05-17",)], "date string")
    with pytest.raises(Exception, match="no trading day before the entry of cohort 2024-05-16"):
        perf.cohort_schedule(cohorts, late).collect()


def test_missing_values_have_no_rank(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", 5e9), ("d", None)], "k string, v double").withColumn("g", F.lit(1))
    assert rows(ranks.with_average_rank(df, ["g"], "v", "r"), "k", "r") == [("a", 1.0), ("b", None), ("c", 2.0), ("d", None)]
    assert ranks.value_distribution(df, ["g"], "v").count() == 2


def test_references_are_resolved_once(spark):
    df = spark.createDataFrame([("&copy;&#20013;&#x4E2D;&nbsp;x &amp;lt; &lt;b&gt; &eacute; &unknown; & y &#0; &#38;#65;",)], "t string")
    assert df.select(clean.resolve_references("t")).first()[0] == "©中中 x &lt; <b> é &unknown; & y &#0; &#65;"


def test_failed_audit_keeps_the_stored_slice(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "tables"
    make_quote_file(raw, "20240102", "sii")
    ingest.convert_daily(spark, str(raw), str(out), ["2024-01-02"], ["daily_quotes"])
    before = rows(spark.read.parquet(str(out / "daily_quotes")), "symbol", "high")
    make_quote_file(raw, "20240102", "sii", broken=True)
    with pytest.raises(ingest.AuditError, match="2024-01-02 sii: ohlc"):
        ingest.convert_daily(spark, str(raw), str(out), ["2024-01-02"], ["daily_quotes"])
    assert rows(spark.read.parquet(str(out / "daily_quotes")), "symbol", "high") == before
    with pytest.raises(ingest.AuditError, match="no report of 2024-01-05"):
        ingest.convert_daily(spark, str(raw), str(out), ["2024-01-05"], ["daily_quotes"])

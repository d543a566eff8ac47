"""Series that nobody asks for are left out before they are summed and sorted, days are read without symbols."""

from pyspark.sql import functions as F

from tickerloom.operators import asof
from tickerloom.plans import QUERIES
from tickerloom.plans import views as V
from tickerloom.session import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_asked_keys_are_kept_with_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4)], "symbol string, n int")
    asked = stage(spark.createDataFrame([("a",), ("a",), (None,), ("d",)], "symbol string"))
    got = sorted((tuple(r) for r in asof.with_keys_of(df, asked, ["symbol"]).collect()), key=str)
    assert got == sorted([("a", 1), ("a", 1), (None, 3)], key=str)
    assert asof.with_keys_of(df, asked, ["symbol"], most=2) is df


def test_filter_on_keys_reaches_the_rows_below_sums_and_windows(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("symbol"), "id").groupBy("symbol", (F.col("id") % 7).alias("day")).agg(F.sum("id").alias("n"))
    asked = stage(spark.createDataFrame([(1,), (2,)], "symbol bigint"))
    text = plan(asof.with_keys_of(df, asked, ["symbol"]))
    assert text.index("HashAggregate") < text.index("LeftSemi") < text.index("Range")


def test_a_cohort_sums_no_series_without_a_report(spark, sf):
    assert plan(QUERIES["strategy_cohort"](spark, sf)).count("LeftSemi") >= 4


def test_days_of_cohorts_are_read_without_symbols(spark, sf):
    assert "l_suppkey" not in plan(V.entries(spark, sf))
    days = {r[0] for r in V.scored_base(spark, sf).select("playbook_date").distinct().collect()}
    assert {r[0] for r in V.entries(spark, sf).select("playbook_date").collect()} == days


def test_lines_without_a_part_count_to_the_last_code(spark, monkeypatch):
    lines = [(pk, 5, 10.0, "1995-05-01") for pk in (None, 15, 31, None, 14, 0)]
    df = spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint, l_extendedprice double, _d string").withColumn("l_shipdate", F.to_timestamp("_d"))
    monkeypatch.setattr(V, "table", lambda *a: df)
    got = {tuple(r) for r in V.statements(spark, "").select("date", "symbol", "period_type", "account_code", "value_num").collect()}
    row = ("1995Q2", "0005")
    assert got == {(*row, "accumulated", "B02700", 0.04), (*row, "accumulated", "AAAA", 0.01), (*row, "quarter", "4000", 0.01)}

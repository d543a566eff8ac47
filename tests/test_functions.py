from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def texts(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", fn("v").alias("x")).orderBy("i").collect()]


def test_numbers_from_report_text(spark):
    assert texts(spark, C.to_number, "1,234.50", "--", " 7 ", "abc", "", None, "NaN", "Infinity", "-3", "1e3", "-.5") == [
        1234.5, None, 7.0, None, None, None, None, None, -3.0, 1000.0, -0.5,
    ]
    assert texts(spark, C.to_signed_number, "(1,234)", "　12 ", "(x)", "()", "(-5)") == [-1234.0, 12.0, None, None, None]


def test_empty_markers_and_symbols(spark):
    assert texts(spark, C.empty_to_null, "--", "------", "除權", "N/A", " a ", None) == [None, None, None, None, "a", None]
    assert texts(spark, C.clean_symbol, '="0050"', " 2330 ", "　1101") == ["0050", "2330", "1101"]
    assert texts(spark, lambda c: C.zero_pad(c, 4), "50", "12345") == ["0050", "12345"]


def test_account_names_and_markup(spark):
    assert texts(spark, C.clean_account_name, "　Cash  and　banks：", "、x。") == ["Cash and banks", "x"]
    assert texts(spark, C.strip_tags, "<b>a &amp; b</b>&nbsp;<i>c</i>", "1<br>2") == ["a & b c", "12"]


def test_signed_change(spark):
    df = spark.createDataFrame([("-", "1.5"), ("+", "1.5"), ("<p>-</p>", "2"), ("", "--"), (None, "3")], "s string, v string")
    assert [r["x"] for r in df.select(C.signed_change("s", "v").alias("x")).collect()] == [-1.5, 1.5, -2.0, None, 3.0]


def test_same_value(spark):
    pairs = [("12.0", "12"), ("12.5", "12.50004"), ("12.5", "12.6"), (None, "--"), ("3", "--"), ("0050", '="0050"'), ("a", "b"), ("1234", "1,234")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    got = [r["x"] for r in df.select(C.same_value("a", "b").alias("x")).collect()]
    assert got == [True, True, False, True, False, True, False, True]


def test_signed_growth_over_absolute_base(spark):
    pairs = [(150.0, 100.0, 50.0), (50.0, -100.0, 150.0), (-50.0, 100.0, -150.0), (-150.0, -100.0, -50.0), (100.0, 0.0, None), (None, 5.0, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, want double").orderBy("i")
    for r in df.select("want", N.signed_yoy("a", "b").alias("x")).collect():
        assert r["x"] == r["want"]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (None, 2.0)], "n double, d double")
    got = [tuple(r) for r in df.select(N.safe_div_positive("n", "d"), N.div_nonzero("n", "d"), N.clip("n", -5, 0.5)).collect()]
    assert got == [(0.5, 0.5, 0.5), (None, None, 0.5), (None, -0.5, 0.5), (None, None, None)]


def test_rounding_snaps_float_noise(spark):
    df = spark.createDataFrame([(3.8812499999999996,), (-0.00001,), (None,)], "x double")
    got = [r["r"] for r in df.select(N.rnd("x", 4).alias("r")).collect()]
    assert got == [3.8813, 0.0, None] and str(got[1]) == "0.0"


def test_correlation_labels(spark):
    df = spark.createDataFrame([(0.6,), (0.5,), (0.2,), (-0.3,), (-0.6,), (None,)], "r double")
    assert [r["x"] for r in df.select(N.correlation_label("r").alias("x")).collect()] == ["strong_up", "up", "non_monotonic", "down", "strong_down", "flat"]


def test_local_calendar_dates(spark):
    assert texts(spark, P.roc_to_iso, "111年01月12日", "99年1月2日", "2022-01-12", None) == ["2022-01-12", "2010-01-02", None, None]


def test_period_shifts(spark):
    assert texts(spark, lambda c: P.shift_quarter(c, -1), "2024Q1", "2024Q3") == ["2023Q4", "2024Q2"]
    assert texts(spark, lambda c: P.shift_month(c, -1), "2024M01", "2024M12") == ["2023M12", "2024M11"]
    assert texts(spark, P.statutory_publish_date, "2024Q1", "2024Q2", "2024Q3", "2024Q4") == ["2024-05-15", "2024-08-14", "2024-11-14", "2025-03-31"]
    assert texts(spark, P.revenue_publish_day, "2024M12", "2024M03") == ["20250110", "20240410"]
    assert texts(spark, P.quarter_span, "2024Q1", "2024Q4") == ["20240101-20240331", "20241001-20241231"]


def test_playbook_days(spark):
    assert texts(spark, P.latest_playbook_day, "2026-05-20", "2026-05-15", "2026-01-05") == ["2026-05-16", "2026-04-11", "2025-12-11"]
    assert texts(spark, P.is_playbook_day, "2026-05-16", "2026-05-15", "latest", None) == [True, False, False, False]


def test_playbook_calendar(spark):
    span = spark.createDataFrame([("2025-12-01", "2026-05-31")], "first string, last string")
    got = {r["playbook_date"]: r for r in P.playbook_calendar(span).collect()}
    assert sorted(got) == ["2025-12-11", "2026-01-11", "2026-02-11", "2026-03-11", "2026-04-11", "2026-05-16"]
    jan, may = got["2026-01-11"], got["2026-05-16"]
    assert (jan["target_q"], jan["anchor_q"], jan["feature_months"]) == ("2025Q4", "2025Q3", 3)
    assert (may["target_q"], may["anchor_q"], may["pre_anchor_q"], may["ly_anchor_q"]) == ("2026Q2", "2026Q1", "2025Q4", "2025Q1")
    assert may["cutoff_date"] == "2026-05-15" and may["expected_revenue_month"] == "2026M04" and may["feature_months"] == 1


def test_mixed_period_filter(spark):
    df = spark.createDataFrame([("2024Q1",), ("2024Q2",), ("2024M04",), ("2024M03",), ("2024-04-10",), ("junk",)], "t string")
    kept = df.where(P.in_day_range("t", "2024-04-01", "2024-04-30"))
    assert sorted(r["t"] for r in kept.collect()) == ["2024-04-10", "2024M04", "2024Q2"]

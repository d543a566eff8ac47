import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickerloom.operators import asof, ranks, windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; values tie, repeat and go missing."""
    rng = np.random.default_rng(7)
    n = 3000
    g = np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n))
    v = np.round(rng.normal(0, 50, n) ** 3, 1)
    v[rng.random(n) < 0.3] = 5.0
    v[::97] = 0.0
    pdf = pd.DataFrame({"g": g, "v": v, "id": [f"{i:05d}" for i in range(n)]})
    pdf.loc[::53, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df, pdf


def test_average_rank_matches_pandas(skewed):
    df, pdf = skewed
    got = ranks.with_average_rank(df, ["g"], "v", "r").select("id", "r").toPandas().set_index("id")["r"]
    want = pdf.set_index("id").groupby("g")["v"].rank()
    pd.testing.assert_series_equal(got.sort_index().astype(float), want.sort_index(), check_names=False)
    down = ranks.with_average_rank(df, [], "v", "r", descending=True).select("id", "r").toPandas().set_index("id")["r"]
    want = pdf.set_index("id")["v"].rank(ascending=False)
    pd.testing.assert_series_equal(down.sort_index().astype(float), want.sort_index(), check_names=False)


def test_ordinal_rank_is_a_total_order(skewed):
    df, pdf = skewed
    got = ranks.with_ordinal_rank(df.where("v IS NOT NULL"), ["g"], -F.col("v"), "id", "r").toPandas().set_index("id")["r"]
    p = pdf.dropna().sort_values(["g", "v", "id"], ascending=[True, False, True])
    want = (p.groupby("g").cumcount() + 1).set_axis(p["id"])
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_exact_percentiles_and_buckets(skewed):
    df, pdf = skewed
    got = ranks.exact_percentiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["v"].quantile([0.1, 0.5, 0.9]).unstack()
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float))
    b = ranks.with_quantile_bucket(df, ["g"], "v", 5, "b").select("id", "b").toPandas().set_index("id")["b"].sort_index()
    cut = pdf.set_index("id").groupby("g")["v"].transform(lambda s: pd.qcut(s, 5, labels=False, duplicates="drop")).sort_index()
    np.testing.assert_array_equal(b.to_numpy(float), cut.to_numpy(float))


def test_zscore_decile_correlation(skewed):
    df, pdf = skewed
    z = ranks.with_zscore(df, ["g"], "v", "z").select("id", "z").toPandas().set_index("id")["z"].sort_index().astype(float)
    s = pdf.set_index("id").groupby("g")["v"]
    want = ((pdf.set_index("id")["v"] - s.transform("mean")) / s.transform("std")).sort_index()
    np.testing.assert_allclose(z, want)
    pairs = df.withColumn("w", F.col("id").cast("double") * 2 + F.col("v"))
    c = ranks.correlations(pairs, ["g"], "v", "w").toPandas().set_index("g").sort_index()
    p = pdf.dropna().assign(w=lambda d: d["id"].astype(float) * 2 + d["v"])
    for g, part in p.groupby("g"):
        assert c.loc[g, "pearson"] == pytest.approx(part["v"].corr(part["w"]))
        assert c.loc[g, "spearman"] == pytest.approx(part["v"].rank().corr(part["w"].rank()))


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0)], "g string, x double, y double")
    assert ranks.correlations(df, ["g"], "x", "y").count() == 0
    assert ranks.with_quantile_bucket(df, ["g"], "x", 5, "b").where("b IS NOT NULL").count() == 0


def test_slices_are_monotone(spark):
    values = [-1e12, -3.0, -2.9, -1e-9, 0.0, 1e-300, 0.5, 0.50001, 1.0, 7.0, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["s"] for r in df.orderBy("v").select(ranks.slice_of(F.col("v")).alias("s")).collect()]
    assert got == sorted(got) and len(set(got)) >= 9


def test_asof_backward(spark):
    left = spark.createDataFrame([("a", "02"), ("a", "05"), ("a", "05"), ("b", "01")], "k string, t string")
    right = spark.createDataFrame([("a", "02", 1), ("a", "04", None), ("a", "09", 9)], "k string, u string, v int")
    got = asof.asof_backward(left, right, ["k"], "t", "u", ["v"], matched_as="at")
    assert sorted((r["k"], r["t"], r["at"], r["v"]) for r in got.collect() if r["at"]) == [("a", "02", "02", 1), ("a", "05", "04", None), ("a", "05", "04", None)]
    strict = asof.asof_backward(left, right, ["k"], "t", "u", ["v"], strict=True, matched_as="at")
    assert {(r["t"], r["at"]) for r in strict.collect()} == {("02", None), ("05", "04"), ("01", None)}


def test_asof_forward_two_meanings(spark):
    quotes = spark.createDataFrame(
        [("a", "2024-01-03", None), ("a", "2024-01-05", 7.0), ("b", "2024-01-09", 3.0)], "symbol string, date string, open double"
    )
    points = spark.createDataFrame([("a", "2024-01-02"), ("b", "2024-01-02")], "symbol string, d string")
    first = asof.asof_forward(points, quotes, ["symbol"], "d", "date", ["open"], 5, matched_as="at")
    assert sorted((r["symbol"], r["open"], r["at"]) for r in first.collect()) == [("a", None, "2024-01-03"), ("b", None, None)]
    valid = asof.asof_forward(points, quotes.where("open > 0"), ["symbol"], "d", "date", ["open"], 7)
    assert rows(valid, "symbol", "open") == [("a", 7.0), ("b", 3.0)]


def test_trading_day_neighbours(spark):
    cal = spark.createDataFrame([("2024-01-02",), ("2024-01-05",)], "date string")
    days = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-09",)], "d string")
    nxt = {r["d"]: r["n"] for r in asof.next_trading_day(days, cal, "d", "n").collect()}
    assert nxt == {"2024-01-02": "2024-01-02", "2024-01-03": "2024-01-05", "2024-01-09": None}
    prev = {r["d"]: r["p"] for r in asof.previous_trading_day(days, cal, "d", "p").collect()}
    assert prev == {"2024-01-02": None, "2024-01-03": "2024-01-02", "2024-01-09": "2024-01-05"}
    with pytest.raises(Exception, match="no day"):
        asof.require_found(asof.next_trading_day(days, cal, "d", "n"), "n", "no day").collect()


def series(spark, n=400, keys=("x", "y")):
    rng = np.random.default_rng(3)
    parts = []
    for k in keys:
        close = 100 + rng.normal(0, 1, n).cumsum()
        parts.append(pd.DataFrame({"symbol": k, "date": [f"{i:04d}" for i in range(n)], "close": close, "high": close + rng.random(n), "low": close - rng.random(n), "net": rng.integers(-1, 2, n).astype(float)}))
    pdf = pd.concat(parts, ignore_index=True)
    return spark.createDataFrame(pdf), pdf


def test_recursive_averages_match_formulas(spark):
    df, pdf = series(spark)
    df = df.withColumn("rsv", W.stochastic(df, W.series("symbol", "date")))
    got = W.with_ewm_indicators(df, "symbol", "date").toPandas().sort_values(["symbol", "date"])
    part = got[got["symbol"] == "x"].reset_index(drop=True)
    rsv, k = part["rsv"], [part["rsv"][0]]
    for v in rsv[1:]:
        k.append(k[-1] + (v - k[-1]) / 3)
    np.testing.assert_allclose(part["k"], k)
    assert part["rsi6"].isna().sum() == 6 and part["rsi12"].isna().sum() == 12
    assert rsv[:8].tolist() == [50.0] * 8
    np.testing.assert_allclose(part["macd_hist"], part["macd_dif"] - part["macd_dea"])


def test_streaks(spark):
    data = [("a", i, v) for i, v in enumerate([1.0, 2.0, None, 0.0, -1.0, -2.0, -3.0, 4.0])]
    df = spark.createDataFrame(data, "symbol string, date int, net double")
    got = W.with_streak(df, "symbol", "date", "net", "s").orderBy("date").collect()
    assert [r["s"] for r in got] == [1, 2, 0, 0, -1, -2, -3, 1]


def test_expanding_percentile_never_looks_ahead(spark):
    df, pdf = series(spark, 60, ("x",))
    full = W.with_expanding_percentile(df.select("symbol", "date", "close"), "symbol", "date", "close", "p")
    part = W.with_expanding_percentile(df.where("date < '0030'").select("symbol", "date", "close"), "symbol", "date", "close", "p")
    assert rows(full.where("date < '0030'"), "date", "p") == rows(part, "date", "p")


def test_rolling_needs_a_full_window(spark):
    df = spark.createDataFrame([("a", i, float(i) if i != 2 else None) for i in range(6)], "symbol string, date int, v double")
    got = df.withColumn("m", W.rolling_mean("v", W.series("symbol", "date"), 3)).orderBy("date").collect()
    assert [r["m"] for r in got] == [None, None, None, None, None, 4.0]


def test_prior_share(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 3.0, 2.0, 3.0])], "t int, v double")
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(0)).orderBy("t")
    assert [r["p"] for r in df.withColumn("p", W.prior_share_at_most("v", w)).orderBy("t").collect()] == [None, 1.0, 0.5, 1.0]


def test_rolling_means_are_exact_beside_large_and_missing_values(spark):
    values = [3e15, -3e15, 0.1, 0.2, None, 0.4, 0.5, -2.25, float("nan"), 1e-9, 0.1, float("inf"), 7.0, 8.0]
    df = spark.createDataFrame([("x", f"{i:02d}", v) for i, v in enumerate(values)], "symbol string, date string, v double")
    got = [r["m2"] for r in W.with_rolling_means(df, "symbol", "date", {"v": (2,)}, {"v": "m"}).orderBy("date").collect()]
    assert got[:4] == [None, 0.0, -1.5e15 + 0.05, pytest.approx(0.15, rel=1e-15)] and got[4:6] == [None, None]
    assert got[6:8] == [0.45, -0.875] and got[10] == pytest.approx(0.0500000005, rel=1e-12) and got[13] == 7.5

"""Members of seed groups from shared training rows, and the quotes that a rotation looks up."""

import random

import pytest
from pyspark.sql import functions as F

from tickerloom.jobs import ml, performance as perf
from tickerloom.plans import views as V
from tickerloom.session import stage


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(5)
    rows = [(d, f"{s:04d}", rng.choice([None, rng.uniform(0, 1)]), rng.uniform(0, 9), float(s % 5)) for d in ("2023-01-11", "2023-04-11", "2024-01-11", "2024-04-11", "2025-01-11") for s in range(40)]
    return stage(spark.createDataFrame(rows, "playbook_date string, symbol string, a double, b double, label double").repartition(3, "symbol"))


TARGETS = [("2024-01-11", "2024-01-11"), ("2024-01-11", "2024-04-11"), ("2025-01-11", "2025-01-11")]


def test_members_are_those_of_a_fit_per_seed(spark, panel):
    rows = panel.select("playbook_date", "symbol", "a", "b")
    got = {(r["playbook_date"], r["symbol"], r["model"]): r["score"] for r in ml.member_scores(panel, rows, ["a", "b"], TARGETS, [4, 7, 9], rounds=2, depth=2).collect()}
    expected = {}
    for fitted in ("2024-01-11", "2025-01-11"):
        served = [t for f, t in TARGETS if f == fitted]
        for seed in (4, 7, 9):
            model = ml.fit(panel.where(F.col("playbook_date") < fitted), ["a", "b"], "label", seed, rounds=2, depth=2)
            scored = ml.predict(model, rows.where(F.col("playbook_date").isin(served)), ["a", "b"], "score")
            expected |= {(r["playbook_date"], r["symbol"], seed): r["score"] for r in scored.collect()}
    assert got == expected and len(got) == 3 * 40 * 3


def test_seeds_share_the_imputed_rows_and_one_reading_of_the_candidates(spark, panel, monkeypatch):
    fits = []
    before = ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, *a, **b: fits.append(1) or before(self, *a, **b))
    members = ml.member_scores(panel, panel.select("playbook_date", "symbol", "a", "b"), ["a", "b"], TARGETS, [4, 7], rounds=2, depth=2)
    assert len(fits) == 2  # a fit date each, not a seed each
    assert members._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2
    assert not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(members._jdf).isDefined()


def test_groups_of_members_are_the_ensembles(spark, panel):
    rows = panel.select("playbook_date", "symbol", "a", "b")
    members = stage(ml.member_scores(panel, rows, ["a", "b"], TARGETS, [4, 7, 9], rounds=2, depth=2))
    for seeds in ([4, 7], [9]):
        whole = ml.ensemble_scores(panel, rows, ["a", "b"], TARGETS, seeds, rounds=2, depth=2)
        assert sorted(map(str, ml.combined_members(members, seeds).collect())) == sorted(map(str, whole.collect()))


def test_quotes_of_symbols_are_left_out_before_they_are_summed(spark, tmp_path):
    rng = random.Random(6)
    lines = [(k, float(rng.randrange(1, 9)), rng.uniform(1, 99), f"2024-01-{rng.randrange(1, 9):02d}") for k in (None, -1, 0, 7, 42, 9999, 12345) for _ in range(20)]
    spark.createDataFrame(lines, "l_suppkey bigint, l_quantity double, l_extendedprice double, d string").withColumn("l_shipdate", F.col("d").cast("timestamp")).drop("d").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked = stage(spark.createDataFrame([("null",), ("-001",), ("0007",), ("12345",), ("0007",), ("0500",)], "symbol string"))
    some = V.quotes(spark, str(tmp_path), symbols=asked)
    wanted = V.quotes(spark, str(tmp_path)).where(F.col("symbol").isin("null", "-001", "0007", "12345"))
    assert sorted(map(str, some.collect())) == sorted(map(str, wanted.collect())) and some.select("symbol").distinct().count() == 4
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in text and text.index("LeftSemi") > text.index("partial_sum")


def test_a_rotation_needs_the_quotes_of_its_picks_only(spark, tmp_path):
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in range(1, 28)]
    quotes = spark.createDataFrame([(d, f"{s:04d}", float(10 + s + i)) for i, d in enumerate(days) for s in range(9)], "date string, symbol string, open double")
    scores = spark.createDataFrame([(f"2024-{m:02d}-11", f"2024-{m:02d}-11", f"{s:04d}", float((s * m) % 7)) for m in (1, 4, 5, 6) for s in range(9)], "playbook_date string, entry_date string, symbol string, ml_score double")
    picks = perf.rotation_picks(scores, [1, 2])
    assert picks.groupBy("playbook_date").count().where("count = 2").count() == 4
    some = quotes.join(picks.select("symbol").distinct(), "symbol", "left_semi")
    calendar = quotes.select("date").distinct()
    assert some.count() < quotes.count()
    a, b = (sorted(map(str, perf.rotation_trades(scores, q, [1, 2], calendar=calendar).collect())) for q in (quotes, some))
    assert a == b and a

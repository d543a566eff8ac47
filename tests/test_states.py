"""As-of merges of many tables, forward reads, indicators continued from a state, the finalize job."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickerloom.jobs import cohort, derive
from tickerloom.operators import asof, recursion
from tickerloom.plans import QUERIES
from tickerloom.plans import views as V
from tickerloom.session import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(n):
    return f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"


# ---- as-of merge of many tables ----------------------------------------
def families_by_force(left, families):
    out = []
    for key, t, *rest in left:
        found = []
        for table in families:
            past = sorted((d, v) for k, d, v in table if k == key and d <= t)
            found.append(past[-1][1] if past else None)
        out.append((key, t, *rest, *found))
    return sorted(out, key=str)


def test_families_match_brute_force_in_one_exchange(spark):
    rng = random.Random(2)
    tables = [[(k, day(d), rng.choice([None, d + i])) for k in "abc" for d in sorted(rng.sample(range(100), 20))] for i in range(4)]
    left = [(rng.choice("abcd"), day(rng.randrange(110)), i) for i in range(60)] + [("a", day(50), 7), ("a", day(50), 7)]
    frames = [
        (spark.createDataFrame(t, "symbol string, date string, v int").withColumnRenamed("v", f"v{i}"), "date", [f"v{i}"], None) for i, t in enumerate(tables)
    ]
    df = spark.createDataFrame(left, "symbol string, cutoff_date string, n int")
    got = asof.asof_families(df, frames, ["symbol"], "cutoff_date")
    text = plan(got)
    assert text.count("Exchange hashpartitioning(symbol") == 1 and "Join" not in text
    assert sorted((tuple(r) for r in got.collect()), key=str) == families_by_force(left, tables)


def test_states_after_the_cutoff_change_nothing(spark, sf):
    keys = V.scored_base(spark, sf).select("playbook_date", "symbol").join(V.playbook(spark, sf).select("playbook_date", "cutoff_date"), "playbook_date")
    margin = stage(derive.margin_pressure(V.margin(spark, sf)).select("symbol", "date", "margin_usage_ratio"))
    last = keys.agg(F.max("cutoff_date")).first()[0]
    one = [(margin, "date", ["margin_usage_ratio"], "at")]
    later = margin.select("symbol", F.lit(f"{int(last[:4]) + 1}{last[4:]}").alias("date"), F.lit(-1.0).alias("margin_usage_ratio"))
    more = [(margin.union(later), "date", ["margin_usage_ratio"], "at")]
    a, b = (rows(asof.asof_families(keys, f, ["symbol"], "cutoff_date"), "playbook_date", "symbol", "cutoff_date", "at") for f in (one, more))
    assert a == b and all(r[3] is None or r[3] <= r[2] for r in a) and any(r[3] for r in a)


# ---- forward reads ------------------------------------------------------
@pytest.mark.parametrize("within", [0, 3, 7])
def test_forward_lookup_matches_brute_force(spark, within):
    rng = random.Random(within)
    states = [(k, day(d), float(d)) for k in "ab" for d in rng.sample(range(80), 25)]
    points = [(rng.choice("abc"), day(rng.randrange(80))) for _ in range(60)] + [("a", None), ("a", day(3)), ("a", day(3))]
    got = asof.forward_lookup(
        spark.createDataFrame(points, "k string, d string"), spark.createDataFrame(states, "k string, date string, open double"), ["k"], "d", "date", ["open"], within
    )
    number = {day(n): n for n in range(84)}
    ordinal = {d: __import__("datetime").date.fromisoformat(d).toordinal() for d in number}
    expected = set()
    for k, d in set(points):
        later = [(s, v) for kk, s, v in states if d and kk == k and 0 <= ordinal[s] - ordinal[d] <= within]
        if later:
            expected.add((k, d, min(later)[1], min(later)[0]))
    assert {tuple(r) for r in got.collect()} == expected and got.count() == len(expected)


@pytest.mark.parametrize("name", ["asof_forward_valid_open", "asof_forward_first_row"])
def test_forward_reads_make_no_row_per_day(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Generate explode" not in text


# ---- indicators from a state --------------------------------------------
SERIES = "date string, symbol string, high double, low double, close double, volume double"
FLOWS = "date string, symbol string, foreign_net double, trust_net double, dealer_net double"


def history(spark, days, seed=4):
    rng = random.Random(seed)
    quotes, flows = [], []
    for symbol in ("1", "2", "3"):
        price = 50.0
        for n in range(days):
            if symbol == "3" and n % 7 == 0:
                continue
            price = max(1.0, price + rng.uniform(-2, 2)) if symbol != "2" or n > 30 else price
            close = None if rng.random() < 0.03 else price
            quotes.append((day(n), symbol, price + 1, price - 1, close, float(rng.randrange(1, 99))))
            if rng.random() < 0.9:
                flows.append((day(n), symbol, *[rng.choice([None, 0.0, 5.0, 5.0, -3.0]) for _ in range(3)]))
    return spark.createDataFrame(quotes, SERIES), spark.createDataFrame(flows, FLOWS)


def test_runs_over_new_days_equal_the_full_run(spark):
    quotes, flows = history(spark, 330)
    full = {(r["symbol"], r["date"]): r.asDict() for r in derive.technical_indicators(quotes, flows).collect()}
    state, got = None, {}
    for a, b in ((0, 3), (3, 4), (4, 190), (190, 330)):
        span = lambda df: df.where((F.col("date") >= day(a)) & (F.col("date") < day(b)))  # noqa: E731, B023
        made, state = derive.technical_run(span(quotes), span(flows), state)
        got |= {(r["symbol"], r["date"]): r.asDict() for r in made.collect()}
    assert set(got) == set(full)
    for key, row in full.items():
        for name, value in row.items():
            assert got[key][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (key, name)
    assert state.count() == 3 and state.agg(F.max(F.size("s_close"))).first()[0] == 239
    again, after = derive.technical_run(quotes, flows, state)
    assert again.count() == 0 and after.count() == 3


def test_a_symbol_without_new_days_keeps_its_state(spark):
    quotes, flows = history(spark, 40)
    _, state = derive.technical_run(quotes, flows)
    _, after = derive.technical_run(quotes.where("symbol = '1' and date > '2030'"), flows, state)
    assert rows(after, "symbol", "s_last") == rows(state, "symbol", "s_last")


def test_a_run_reads_its_own_days_only(spark, sf):
    df = recursion.with_continued_indicators(
        V.quotes(spark, sf, "1998-01-01").join(V.flows(spark, sf, "1998-01-01").drop("market"), ["date", "symbol"], "left"), None, (5,), ["foreign_net"]
    )
    scans = [line for line in plan(df).split("\n") if "PushedFilters" in line]
    assert scans and all("GreaterThanOrEqual(l_shipdate" in line for line in scans)


# ---- finalize -------------------------------------------------------------
def finalize_inputs(spark):
    cohort_rows = spark.createDataFrame(
        [("2024-04-11", "2024-04-10", "1101", 4, 10.0, 5000.0, "2024-04-10", 1.0, 2.0, 4.0), ("2024-04-11", "2024-04-10", "1102", 4, 20.0, 9000.0, "2024-04-10", 1.0, 0.5, 4.0)],
        "playbook_date string, cutoff_date string, symbol string, month int, close double, quote_volume double, quote_date string, ly_q1_eps double, anchor_eps double, ttm_eps double",
    ).withColumns({f"ly_q{q}_eps": F.lit(0.0) for q in (2, 3, 4)})
    predictions = spark.createDataFrame([("2024-04-11", "1101", 0.5), ("2024-04-11", "1102", -5.0)], "playbook_date string, symbol string, pred_delta double")
    indicators = spark.createDataFrame(
        [("2024-04-10", s, *[9.0] * 5, *[4000.0] * 3, 12.0, 6.0) for s in ("1101", "1102")],
        "date string, symbol string, ma5 double, ma10 double, ma20 double, ma60 double, ma240 double, vma5 double, vma10 double, vma20 double, bb_upper double, bb_lower double",
    )
    monthly = spark.createDataFrame([(s, "2024M03", 3.0, 1.0, "20240409") for s in ("1101", "1102")], "symbol string, date string, yoy_pct double, mom_pct double, publish_time string")
    days = spark.createDataFrame([("2024-04-10",), ("2024-04-12",)], "date string")
    return cohort_rows, predictions, days, indicators, monthly


def test_finalize_makes_rows_and_candidates_and_is_repeatable(spark):
    df, predictions, *rest = finalize_inputs(spark)
    made, candidates = cohort.finalize(df, predictions, *rest)
    assert rows(made, "symbol", "entry_date", "base_eps_growth_pct", "ml_eps_delta_pct") == [("1101", "2024-04-12", 25.0, 12.5), ("1102", "2024-04-12", -12.5, -125.0)]
    assert rows(candidates, "symbol", "eps_growth_total_pct") == [("1101", 37.5)]
    again, _ = cohort.finalize(made.drop(*[c for c in made.columns if c.startswith(("close_vs", "vol_vs", "ma", "bb_", "revenue_"))]), predictions, *rest)
    assert rows(again, "symbol", "eps_growth_total_pct") == rows(made, "symbol", "eps_growth_total_pct")


def test_finalize_stops_at_the_guard_and_without_an_entry_day(spark):
    df, predictions, days, indicators, monthly = finalize_inputs(spark)
    with pytest.raises(ValueError, match="technical_behind_quotes"):
        cohort.finalize(df, predictions, days, indicators.withColumn("date", F.lit("2024-04-09")), monthly)
    with pytest.raises(ValueError, match="unverifiable_revenue"):
        cohort.finalize(df, predictions, days, indicators, monthly.where("false"))
    with pytest.raises(Exception, match="no trading day on or after a playbook day"):
        cohort.finalize(df, predictions, days.where("date < '2024-04-11'"), indicators, monthly)

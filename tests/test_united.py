"""Quotes, flows and states that lie side by side: rows as of a join, and nothing stored but the input of a step."""

import random

import numpy as np
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.jobs import derive
from tickerloom.operators import recursion

NETS = ["foreign_net", "trust_net", "dealer_net"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark):
    rng = random.Random(9)
    days = [f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}" for n in range(60)]
    quotes = [(d, s, 9.0, 3.0, rng.choice([None, rng.uniform(3, 9)]), float(rng.randrange(9))) for s in ("a", "b", "c", None) for d in days if rng.random() < 0.9]
    flows = [(d, s, *[rng.choice([None, 0.0, 4.0, -2.0]) for _ in NETS]) for s in ("a", "b", "d", None) for d in days if rng.random() < 0.8]
    quotes += [(None, "b", 9.0, 3.0, 5.0, 1.0)]
    flows += [(None, "b", 1.0, 1.0, 1.0), (days[-1], "a", 4.0, 4.0, 4.0), (days[-1], "a", 4.0, 4.0, 4.0)]
    return (
        spark.createDataFrame(quotes, "date string, symbol string, high double, low double, close double, volume double"),
        spark.createDataFrame(flows, f"date string, symbol string, {', '.join(f'{c} double' for c in NETS)}"),
    )


def listed(df):
    return sorted([tuple(str(v) for v in r) for r in df.collect()])


def test_flows_meet_their_quotes_as_in_a_left_join(spark):
    quotes, flows = tables(spark)
    joined = recursion.with_continued_indicators(quotes.join(flows, ["date", "symbol"], "left"), None, (5, 20), NETS)
    united = recursion.united(quotes, flows, None)
    made = recursion.indicators(united, (5, 20), NETS)
    assert listed(made) == listed(joined.select(made.columns)) and "Join" not in plan(made)
    after = recursion.next_states(united, (5, 20), NETS)
    assert listed(after) == listed(joined.where("s_last IS NOT NULL").select(after.columns)) and {r[0] for r in after.collect()} == {"a", "c", None}


def test_a_state_goes_on_where_its_symbol_has_new_days_and_stays_where_not(spark):
    quotes, flows = tables(spark)
    quotes, flows = quotes.where("symbol IN ('a', 'b') AND date IS NOT NULL"), flows.where("symbol IN ('a', 'b')").dropDuplicates(["date", "symbol"])
    full, whole = derive.technical_run(quotes, flows)
    old, state = derive.technical_run(quotes.where("date < '2024-02-10'"), flows.where("date < '2024-02-10'"))
    late = "date >= '2024-02-10' AND symbol = 'a'"
    new, after = derive.technical_run(quotes.where(late), flows.where("date >= '2024-02-10'"), state, followed=False)
    assert listed(new) == listed(full.where(late))
    assert listed(after) == listed(whole.where("symbol = 'a'").union(state.where("symbol = 'b'")))
    assert listed(old) == listed(full.where("date < '2024-02-10'"))


def test_a_run_stores_no_indicators_and_sends_no_missing_lists(spark):
    quotes, flows = tables(spark)
    rows, state = derive.technical_run(quotes, flows)
    assert "MapInArrow" in plan(rows) and "Exchange" not in plan(rows) and "Exchange" not in plan(state)
    stored = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0).output().mkString(" ")
    assert "close" in stored and "ma240" not in stored and "s_close" not in stored
    later, _ = derive.technical_run(quotes, flows, state, followed=False)
    text = plan(later)
    assert text.count("Exchange hashpartitioning(symbol") == 1 and "Join" not in text and "coalesce(_state" in text


def test_no_new_rows_at_all(spark):
    quotes, flows = tables(spark)
    _, state = derive.technical_run(quotes, flows)
    rows, after = derive.technical_run(quotes.where("false"), flows.where(F.lit(False)), state)
    assert rows.count() == 0 and listed(after) == listed(state)


def test_arrays_round_like_columns(spark):
    rng = random.Random(3)
    ties = [i + t + d for i in (0.0, 7.0, 123.0, 98765.0) for t in (0.00005, 0.12345, 0.99995) for d in (0.0, -5e-10, -4.9e-10, -5.1e-10, 1e-13, -1e-13)]
    values = [0.0, -0.0, 1e-7, 4.9e-5, 123456789.123456, 2.0**51 + 0.5, 2.0**60, 1e300, float("inf"), *ties, *[rng.uniform(-1e4, 1e4) for _ in range(2000)]]
    values += [-v for v in values]
    got = N.rounded(np.array([*values, np.nan]), 4)
    expected = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").orderBy("i").select(N.rnd("x", 4)).collect()]
    assert list(map(str, got[:-1].tolist())) == list(map(str, expected)) and np.isnan(got[-1])

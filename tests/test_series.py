"""Recursions over many whole series a batch."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import recursion, series
from tickerloom.operators import windows as W
from tickerloom.sources import reports


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_are_cut_only_where_a_series_ends():
    keys = [None] * 3 + ["a"] * 5 + ["b"] * 40 + list("cdefgh")
    batches = [pa.record_batch({"k": pa.array(keys[i : i + 4], pa.string()), "n": list(range(i, min(i + 4, len(keys))))}) for i in range(0, len(keys), 4)]
    tables = list(series.whole_series(batches, "k", 10))
    assert [n for t in tables for n in t["n"].to_pylist()] == list(range(len(keys))) and len(tables) > 2
    seen = [set(t["k"].to_pylist()) for t in tables]
    assert not any(a & b for i, a in enumerate(seen) for b in seen[:i])
    assert series.starts(pa.chunked_array([pa.array([None, None, "a"]), pa.array(["a", "b"])])).tolist() == [0, 2, 4]


def many(spark, symbols=300):
    rng = random.Random(1)
    made = [(f"{s:03d}", f"2024-01-{d:02d}", *[rng.choice([None, rng.uniform(1, 9), 5.0]) for _ in range(5)]) for s in range(symbols) for d in range(1, 1 + s % 29)]
    return spark.createDataFrame(made, "symbol string, date string, high double, low double, close double, volume double, foreign_net double")


def test_short_series_share_a_call(spark):
    df = many(spark, 40)
    first = recursion.with_continued_indicators(df.where("date < '2024-01-09'"), None, (5,), ["foreign_net"])
    state = first.where("s_last IS NOT NULL").select("symbol", *recursion.STATE_COLUMNS)
    made = [
        W.with_ewm_indicators(df.withColumn("rsv", F.lit(50.0)), "symbol", "date"), W.with_expanding_percentile(df, "symbol", "date", "close", "p"),
        first, recursion.with_continued_indicators(df, state, (5,), ["foreign_net"]),
    ]
    for out in made:
        assert "MapInArrow" in plan(out) and "GroupsInPandas" not in plan(out) and "GroupsInArrow" not in plan(out)


def test_a_series_does_not_depend_on_its_neighbours(spark):
    df = many(spark)
    whole = {(r["symbol"], r["date"]): r for r in recursion.with_continued_indicators(df, None, (5, 20), ["foreign_net"]).drop(*recursion.STATE_COLUMNS).collect()}
    assert len(whole) == df.count()
    for symbol in ("001", "028", "150"):
        for r in recursion.with_continued_indicators(df.where(F.col("symbol") == symbol), None, (5, 20), ["foreign_net"]).drop(*recursion.STATE_COLUMNS).collect():
            for c in df.columns + ["ma5", "ma20", "k", "rsi6", "macd_hist", "foreign_streak_days"]:
                assert whole[symbol, r["date"]][c] == pytest.approx(r[c], rel=1e-12) if isinstance(r[c], float) else whole[symbol, r["date"]][c] == r[c]


def test_files_are_decoded_few_at_a_time(spark):
    files = [("證券代號 a" * 50).encode("utf-8-sig" if i % 2 else "cp950") for i in range(1000)]
    batch = pa.record_batch({"src_file": [str(i) for i in range(1000)], "content": pa.array(files, pa.binary())})
    made = list(reports._decode(iter([batch])))
    assert max(b.num_rows for b in made) <= 64 and [f for b in made for f in b["src_file"].to_pylist()] == [str(i) for i in range(1000)]
    assert {t for b in made for t in b["text"].to_pylist()} == {"證券代號 a" * 50}
    df = spark.createDataFrame([("a", files[0]), ("b", files[1])], "src_file string, content binary")
    assert "MapInArrow" in plan(reports.decode_files(df)) and reports.decode_files(df).select("text").distinct().count() == 1

"""Data-quality checks: audits, reconciliation, completeness, spikes, lineage, freshness (rows A17-A24, A31-A35, C21-C25, J17, J20, J23, M4, W22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P


# ---- audits -----------------------------------------------------------
def null_shares(df: DataFrame, group: Sequence[str], columns: Sequence[str], threshold_pct: float) -> DataFrame:
    """Share of NULLs per key column in percent, and whether it passes the threshold."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    wide = df.groupBy(*group).agg(*aggs)
    pairs = ", ".join(f"'{c}', {c}" for c in columns)
    long = wide.selectExpr(*group, f"stack({len(columns)}, {pairs}) AS (column_name, share)")
    pct = F.col("share") * 100
    return long.select(*group, "column_name", pct.alias("null_pct"), (pct <= threshold_pct).alias("passed"))


def ohlc_broken() -> Column:
    """Whether a quote's high or low does not bound its open and close."""
    c = F.col
    return (c("high") < c("open")) | (c("high") < c("close")) | (c("low") > c("open")) | (c("low") > c("close"))


def ohlc_violations(quotes: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows per group whose high or low does not bound open and close."""
    hit = F.coalesce(ohlc_broken(), F.lit(False)).cast("int")
    return quotes.groupBy(*group).agg(F.sum(hit).alias("violations"), F.count(F.lit(1)).alias("rows"))


def rule_counts(df: DataFrame, group: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """How many rows satisfy each named condition (NULL counts as not)."""
    aggs = [F.sum(F.coalesce(cond, F.lit(False)).cast("int")).alias(name) for name, cond in rules.items()]
    return df.groupBy(*group).agg(*aggs)


def month_token_ok(c: str) -> Column:
    return F.col(c).rlike("^[0-9]{4}M(0[1-9]|1[0-2])$")


def missing_required(df: DataFrame, group: Sequence[str], column: str, required: Sequence[str]) -> DataFrame:
    """Required values a group lacks. The values are few, so the set per group is bounded."""
    present = F.collect_set(F.when(F.col(column).isin(list(required)), F.col(column)))
    wanted = F.array(*[F.lit(v) for v in required])
    agg = df.groupBy(*group).agg(present.alias("_p"))
    return agg.select(*group, F.explode(F.array_except(wanted, F.col("_p"))).alias("missing"))


def level_violations(shareholding: DataFrame, levels: int = 15) -> DataFrame:
    """Snapshot symbols without exactly `levels` rows, and their rows out of range."""
    outside = (~F.col("level").between(1, levels)).cast("int")
    agg = shareholding.groupBy("date", "symbol").agg(F.count(F.lit(1)).alias("rows"), F.sum(outside).alias("outside"))
    return agg.where((F.col("rows") != levels) | (F.col("outside") > 0))


def duplicate_keys(df: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Keys held by more than one row; with `value`, by more than one distinct value."""
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *([F.countDistinct(value).alias("distinct_values")] if value else [])
    )
    return agg.where(F.col("distinct_values" if value else "rows") > 1)


# ---- statistics and reconciliation -----------------------------------
def table_stats(df: DataFrame, numeric: Sequence[str], dates: str = "date", symbols: str = "symbol") -> DataFrame:
    """One row of statistics in long form: (metric, value)."""
    aggs = [F.count(F.lit(1)).cast("double").alias("rows")]
    for c in numeric:
        aggs += [
            F.sum(c).alias(f"sum_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
            F.avg(F.when(F.col(c) > 0, F.col(c))).alias(f"mean_positive_{c}"),
        ]
    base = df.agg(*aggs)
    # distinct counts by de-duplication: partial on every task, then a plain count
    n_dates = df.select(dates).distinct().agg(F.count(dates).cast("double").alias("distinct_dates"))
    n_symbols = df.select(symbols).distinct().agg(F.count(symbols).cast("double").alias("distinct_symbols"))
    wide = base.withColumn("distinct_dates", n_dates.scalar()).withColumn("distinct_symbols", n_symbols.scalar())
    names = wide.columns
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, value)")


def compare_stats(source: DataFrame, target: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Two statistics tables side by side; equal within the relative tolerance."""
    s = source.withColumnRenamed("value", "source_value")
    t = target.withColumnRenamed("value", "target_value")
    a, b = F.col("source_value"), F.col("target_value")
    off = F.abs(a - b) / F.greatest(F.abs(a), F.lit(1e-12))
    match = F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(off <= tolerance)
    return s.join(t, "metric", "full_outer").withColumn("matches", match)


def reconcile_counts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per key on both sides; keys missing on one side count 0."""
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("target_rows"))
    both = s.join(t, list(keys), "full_outer")
    both = both.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("source_rows", "target_rows")})
    return both.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


# ---- completeness -----------------------------------------------------
def latest_dates(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    return df.select(F.col(date).alias("date")).distinct().orderBy(F.desc("date")).limit(n)


def completeness(
    anchor: DataFrame, market_tables: dict[str, DataFrame], plain_tables: dict[str, DataFrame],
    markets: Sequence[str] = ("sii", "otc"), days: int = 10, min_ratio: float = 0.5,
) -> DataFrame:
    """Row counts per (table, market, date) of the last trading days: missing, low, or ok.

    Dates are those of any table from the oldest of the anchor's last `days` on.
    Tables are filtered to them before counting, so old partitions are not read.
    """
    start = latest_dates(anchor, days).agg(F.min("date")).scalar()
    parts = []
    cells = [(t, m) for t in market_tables for m in markets] + [(t, "") for t in plain_tables]
    for name, df in {**market_tables, **plain_tables}.items():
        market = F.lower("market") if name in market_tables else F.lit("")
        recent = df.where(F.col("date") >= start)
        counts = recent.groupBy(F.lit(name).alias("table"), market.alias("market"), "date").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts)
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.union(p)
    listed = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(m).alias("market")) for t, m in cells])
    grid = counts.select("date").distinct().select("date", F.inline(listed))
    full = grid.join(counts, ["table", "market", "date"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # a cell's series has one row per recent day
    median = F.percentile("n", F.lit(0.5)).over(Window.partitionBy("table", "market"))
    full = full.withColumn("median", median)
    status = (
        F.when(F.col("n") == 0, "missing").when((F.col("median") > 0) & (F.col("n") < F.col("median") * min_ratio), "low").otherwise("ok")
    )
    return full.withColumn("status", status)


def presence_grid(
    files: DataFrame, dates: DataFrame, datasets: Sequence[tuple[str, str]], min_bytes: int = 10, min_lines: int = 2
) -> DataFrame:
    """(date, dataset, market) slots whose raw file is absent, too small or too short.

    `files` has one row per stored file: date, dataset, market, bytes, lines.
    """
    slots = F.array(*[F.struct(F.lit(d).alias("dataset"), F.lit(m).alias("market")) for d, m in datasets])
    grid = dates.select("date", F.inline(slots))
    ok = files.where((F.col("bytes") >= min_bytes) & (F.col("lines") >= min_lines)).select("date", "dataset", "market")
    return grid.join(ok.distinct(), ["date", "dataset", "market"], "left_anti")


def coverage_verdict(universe: DataFrame, results: DataFrame, threshold: float = 0.8, benign: Sequence[str] = ("report_not_published",)) -> DataFrame:
    """Covered share of a universe, which report kinds to try, and the verdict of a fetch run.

    `results` holds one status per key: ok..., or a failure reason.
    """
    joined = universe.join(results, "symbol", "left")
    ok = F.col("status").startswith("ok")
    fail = F.col("status").isNotNull() & ~ok
    hard = fail & ~F.col("status").isin(list(benign))

    def n(cond: Column) -> Column:
        return F.sum(F.coalesce(cond, F.lit(False)).cast("int"))

    agg = joined.agg(F.count(F.lit(1)).alias("universe"), n(ok).alias("saved"), n(fail).alias("failed"), n(hard).alias("hard_failed"))
    coverage = F.try_divide(F.col("saved"), F.col("universe"))
    broken = (F.col("saved") == 0) & (F.col("failed") > 0) & (F.col("hard_failed") == F.col("failed"))
    return agg.withColumn("coverage", coverage).withColumn(
        "fallback", F.coalesce(coverage >= threshold, F.lit(False))
    ).withColumn("verdict", F.when(broken, "fail").otherwise("pass"))


# ---- spikes -----------------------------------------------------------
def spikes(quotes: DataFrame, pct: float = 0.11, revert: float = 0.7, days: str = "calendar") -> DataFrame:
    """Closes that moved more than `pct` since the day before, and whether the next day undid it.

    days="calendar" compares exact neighbouring days (a Monday then has no
    neighbour); days="trading" compares neighbouring rows of the series.
    """
    price = quotes.where("close IS NOT NULL").select("market", "symbol", "date", F.col("close").alias("close_curr"))
    key = ["market", "symbol", "date"]
    if days == "calendar":
        prev = price.select("market", "symbol", P.add_days("date", 1).alias("date"), F.col("close_curr").alias("close_prev"))
        nxt = price.select("market", "symbol", P.add_days("date", -1).alias("date"), F.col("close_curr").alias("close_next"))
        df = price.join(prev, key).join(nxt, key, "left")
    else:
        w = Window.partitionBy("market", "symbol").orderBy("date")
        df = price.withColumn("close_prev", F.lag("close_curr").over(w)).withColumn("close_next", F.lead("close_curr").over(w))
    change = N.div_nonzero(F.col("close_curr") - F.col("close_prev"), "close_prev")
    undone = F.when(F.col("close_curr") > F.col("close_prev"), F.col("close_next") < F.col("close_curr") * revert).otherwise(
        F.col("close_next") > F.col("close_curr") / revert
    )
    return df.withColumn("pct_change", change).where(F.abs("pct_change") > pct).withColumn("reverted", F.coalesce(undone, F.lit(False)))


def worst(df: DataFrame, by: str, n: int, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc(F.abs(by)), *tiebreak).limit(n)


# ---- snapshots --------------------------------------------------------
def snapshot_gaps(snapshots: DataFrame, today: Column, lookback: int = 30, max_gap: int = 9) -> DataFrame:
    """Neighbouring snapshot days within the look-back that are too far apart."""
    days = snapshots.select("snapshot").distinct()
    recent = days.where(F.col("snapshot").between(F.date_sub(today, lookback), today))
    w = Window.partitionBy(F.lit(0)).orderBy("snapshot")
    df = recent.withColumn("next_snapshot", F.lead("snapshot").over(w))
    return df.withColumn("gap_days", F.datediff("next_snapshot", "snapshot")).where(F.col("gap_days") > max_gap)


def snapshot_freshness(snapshots: DataFrame, today: Column, window_days: int = 7) -> DataFrame:
    """Latest snapshot not after today, and whether it lies in [today - window, today - 1].

    Future snapshots are left out unless there is nothing else; no snapshot is not fresh.
    """
    usable = F.max(F.when(F.col("snapshot") <= today, F.col("snapshot")))
    agg = snapshots.agg(F.coalesce(usable, F.max("snapshot")).alias("latest"), F.sum((F.col("snapshot") > today).cast("int")).alias("future"))
    fresh = F.col("latest").between(F.date_sub(today, window_days), F.date_sub(today, 1))
    return agg.withColumn("fresh", F.coalesce(fresh, F.lit(False)))


# ---- lineage ----------------------------------------------------------
def lineage_audit(rows: DataFrame, raw_lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that differ from the raw field they came from.

    `rows` carry src_file, src_row and src_col (`#`-joined 1-based field numbers
    in the order of `columns`, `x` where derived); `raw_lines` carry src_file,
    src_row and the split `fields`. One equi-join on (file, row), then columns
    compare side by side.
    """
    joined = rows.join(raw_lines.select("src_file", "src_row", "fields"), ["src_file", "src_row"], "left")
    parts = F.split("src_col", "#")
    checks = []
    for i, c in enumerate(columns):
        index = F.try_element_at(parts, F.lit(i + 1)).try_cast("int")
        raw = F.try_element_at("fields", index)
        checks.append(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("stored"), raw.alias("raw"), index.alias("_i")))
    long = joined.select("src_file", "src_row", F.col("fields").isNull().alias("_lost"), F.inline(F.array(*checks)))
    differs = ~F.coalesce(C.same_value("stored", "raw"), F.lit(False))
    return long.where(F.col("_i").isNotNull() & (F.col("_lost") | differs)).drop("_i", "_lost")

"""As-of joins and trading-day lookups (rows J3-J8, J18, J19, J25, T4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_on: str,
    right_on: str,
    cols: Sequence[str],
    strict: bool = False,
    tie_order: Sequence[str] = (),
    matched_as: str | None = None,
) -> DataFrame:
    """Left rows with `cols` of the last right row at or before them (before, if strict).

    Both sides are united and read in time order per key, so it is one shuffle
    and no pairs are built. The distinct (key, time) points of the left side are
    looked up, then joined back; a key with many rows per time point costs one
    point. `tie_order` orders right rows that share a time.
    """
    keys = list(keys)
    right_side = 2 if strict else 0
    payload = F.struct(F.col(right_on).alias("_at"), *[F.col(c) for c in cols])
    points = (
        left.select(*keys, F.col(left_on).alias("_t"))
        .distinct()
        .withColumn("_side", F.lit(1))
    )
    states = right.select(
        *keys,
        F.col(right_on).alias("_t"),
        F.lit(right_side).alias("_side"),
        payload.alias("_p"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tie_order)],
    )
    order = ["_t", "_side", *[f"_o{i}" for i in range(len(tie_order))]]
    w = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        points.unionByName(states, allowMissingColumns=True)
        .withColumn("_hit", F.last("_p", ignorenulls=True).over(w))
        .where("_side = 1")
        .select(*keys, F.col("_t").alias(left_on), "_hit")
    )
    out = left.join(found, [*keys, left_on], "left")
    picked = [F.col(f"_hit.{c}").alias(c) for c in cols]
    if matched_as:
        picked.append(F.col("_hit._at").alias(matched_as))
    return out.select(*left.columns, *picked)


def asof_families(
    left: DataFrame, families: Sequence[tuple[DataFrame, str, Sequence[str], str | None]], keys: Sequence[str], left_on: str
) -> DataFrame:
    """Left rows with the last row of every family at or before them: (table, its time, columns, name of the matched time or None).

    All tables and the left rows are united once and read in time order per key, holding the last state of each
    family: one exchange for any number of families, and no join back. Left rows travel whole and may share a point.
    """
    keys = list(keys)
    united = left.select(*keys, F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    for i, (table, at, cols, _) in enumerate(families):
        state = F.struct(F.col(at).alias("_at"), *[F.col(c) for c in cols])
        states = table.select(*keys, F.col(at).alias("_t"), F.lit(0).alias("_side"), state.alias(f"_p{i}"))
        united = united.unionByName(states, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    held = united.select("_side", "_left", *[F.last(f"_p{i}", ignorenulls=True).over(w).alias(f"_p{i}") for i in range(len(families))])
    picked = []
    for i, (_, _, cols, matched_as) in enumerate(families):
        picked += [F.col(f"_p{i}.{c}").alias(c) for c in cols]
        picked += [F.col(f"_p{i}._at").alias(matched_as)] if matched_as else []
    return held.where("_side = 1").select(*[F.col(f"_left.`{c}`").alias(c) for c in left.columns], *picked)


def forward_lookup(
    points: DataFrame, right: DataFrame, keys: Sequence[str], on: str, right_on: str, cols: Sequence[str], within_days: int
) -> DataFrame:
    """First right row from each (key, day) point up to `within_days` later: keys, `on`, cols, `_at`.

    Points and right rows are united and read backwards per key: the last right row seen is the next one in time,
    and counts if it is near enough. One row a point and one exchange, however wide the span. Right rows must be
    unique per (key, day).
    """
    keys = list(keys)
    asked = points.select(*keys, on).where(F.col(on).isNotNull()).distinct()
    asked = asked.select(*keys, F.col(on).cast("date").alias("_t"), F.lit(1).alias("_side"), F.col(on).alias("_on"))
    state = F.struct(F.col(right_on).cast("string").alias("_at"), F.col(right_on).cast("date").alias("_day"), *[F.col(c) for c in cols])
    states = right.select(*keys, F.col(right_on).cast("date").alias("_t"), F.lit(0).alias("_side"), state.alias("_p"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        asked.unionByName(states, allowMissingColumns=True).withColumn("_hit", F.last("_p", ignorenulls=True).over(w))
        .where("_side = 1").where(F.datediff("_hit._day", "_t") <= within_days)
    )
    return found.select(*keys, F.col("_on").alias(on), *[F.col(f"_hit.{c}").alias(c) for c in cols], F.col("_hit._at").alias("_at"))


def asof_forward(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_on: str, right_on: str, cols: Sequence[str],
    within_days: int, matched_as: str | None = None,
) -> DataFrame:
    """Left rows with `cols` of the first right row from their day up to `within_days` later."""
    found = forward_lookup(left, right, keys, left_on, right_on, cols, within_days)
    picked = [*cols, F.col("_at").alias(matched_as)] if matched_as else list(cols)
    return left.join(found, [*keys, left_on], "left").select(*left.columns, *picked)


def with_keys_of(df: DataFrame, asked: DataFrame, keys: Sequence[str], most: int = 500_000) -> DataFrame:
    """Rows of `df` whose keys (NULL like any other) stand in the stored table `asked`: series that nobody asks for are left
    out before they are summed and sorted. With more than `most` keys `df` stays as it is, since then the filter costs an exchange."""
    held = asked.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    if held.limit(most + 1).count() > most:
        return df
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(F.broadcast(held), match, "left_semi")


def latest_as_of(
    df: DataFrame, keys: Sequence[str], order: str, cutoff: Column | str | None = None
) -> DataFrame:
    """Last row per key not after the cutoff; `order` must be unique per key."""
    if cutoff is not None:
        df = df.where(F.col(order) <= cutoff)
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def trading_days(quotes: DataFrame, date: str = "date") -> DataFrame:
    return quotes.select(F.col(date).alias("date")).distinct()


def previous_trading_day(days: DataFrame, calendar: DataFrame, on: str, out: str) -> DataFrame:
    """Last calendar day strictly before `on`. The calendar has one row per day."""
    return asof_backward(days, calendar.select(F.col("date").alias(out)), [], on, out, [out], strict=True)


def next_trading_day(days: DataFrame, calendar: DataFrame, on: str, out: str) -> DataFrame:
    """First calendar day on or after `on`."""
    both = (
        days.select(F.col(on).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("string").alias("_d"))
        .distinct()
        .union(calendar.select("date", F.lit(0), "date"))
    )
    # read backwards: the nearest calendar day seen so far is the next one
    w = (
        Window.partitionBy(F.lit(0))
        .orderBy(F.desc("_t"), "_side")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        both.withColumn(out, F.last("_d", ignorenulls=True).over(w))
        .where("_side = 1")
        .select(F.col("_t").alias(on), out)
    )
    return days.join(found, on, "left").select(*days.columns, out)


def require_found(df: DataFrame, value: str, message: str) -> DataFrame:
    """Fail the job on a NULL lookup instead of carrying a wrong day forward."""
    ok = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
        F.raise_error(F.lit(message)).cast("string")
    )
    return df.withColumn(value, ok)

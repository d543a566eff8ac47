"""Ranks, quantiles and buckets of large groups (rows W13-W17, W19, A7, A10-A13, A28, A29).

A cross-section (all symbols of a cohort) may hold a third of all rows, so no
group is sorted in one task. Each group is cut into value slices; rows are
counted per slice, slice totals are summed up, and only rows within a slice are
ordered. The results are exact.

A slice is a fixed monotone function of the value (1,024 parts per doubling), so
it needs no sample, is the same in every retry, and a slice holds values within
0.07 % of each other. Equal values are counted before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS_PER_DOUBLING = 1024
ZERO_OFFSET = 1100 * PARTS_PER_DOUBLING


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match; key columns come from the left."""
    keys = list(keys)
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def slice_of(value: Column) -> Column:
    """Monotone slice number of a numeric value, NULL for NULL."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v)) * PARTS_PER_DOUBLING) + ZERO_OFFSET
    return F.when(v > 0, size).when(v < 0, -size).when(v == 0, F.lit(0))


def _offsets(sliced: DataFrame, group: Sequence[str], slices: Sequence[str], weight: Column) -> DataFrame:
    """Rows of the lower slices (`_below`) and of the whole group (`_total`), per slice."""
    per_slice = sliced.groupBy(*group, *slices).agg(F.sum(weight).alias("_n"))
    w = Window.partitionBy(*group)
    below = F.sum("_n").over(w.orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1))
    return per_slice.select(
        *group,
        *slices,
        F.coalesce(below, F.lit(0)).alias("_below"),
        F.sum("_n").over(w).alias("_total"),
    )


def _grouped(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if group:
        return df, list(group)
    return df.withColumn("_all", F.lit(0)), ["_all"]


def _ranked(df: DataFrame, value: str) -> Column:
    """Whether a row has a value to rank: neither NULL nor NaN."""
    there = F.col(value).isNotNull()
    return there & ~F.isnan(value) if df.schema[value].dataType.typeName() in ("double", "float") else there


def value_distribution(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Exact cumulative distribution: (group, value, n, below, total) per distinct value.

    `below` counts rows with a smaller value. NULL and NaN are left out. Rows are
    counted per value first, so ties never travel; both branches below read the
    same exchange of those counts.
    """
    df, g = _grouped(df, group)
    counts = df.where(_ranked(df, value)).groupBy(*g, value).agg(F.count(F.lit(1)).alias("n"))
    sliced = counts.withColumn("_slice", slice_of(F.col(value)))
    offsets = _offsets(sliced, g, ["_slice"], F.col("n"))
    within = Window.partitionBy(*g, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.coalesce(F.sum("n").over(within), F.lit(0)))
    out = join_on_keys(local, offsets, [*g, "_slice"])
    return out.select(
        *group, value, "n", (F.col("_below") + F.col("_local")).alias("below"), F.col("_total").alias("total")
    )


def with_average_rank(
    df: DataFrame, group: Sequence[str], value: str, out: str, descending: bool = False, pct: bool = False
) -> DataFrame:
    """Rank with ties averaged (1 = smallest, or largest if descending); NULL for NULL and NaN.

    Rows without a value are spread over the join by a hash instead of meeting in one task.
    """
    dist = value_distribution(df, group, value)
    first = F.col("total") - F.col("below") - F.col("n") if descending else F.col("below")
    rank = first + (F.col("n") + 1) / 2.0
    if pct:
        rank = rank / F.col("total")
    dist = dist.select(*group, value, rank.alias(out), F.lit(0).cast("bigint").alias("_spread"))
    spread = F.when(_ranked(df, value), F.lit(0)).otherwise(F.xxhash64(*df.columns))
    return join_on_keys(df.withColumn("_spread", spread), dist, [*group, value, "_spread"]).drop("_spread")


def with_ordinal_rank(
    df: DataFrame, group: Sequence[str], score: Column, tiebreak: str, out: str, prefix: int = 3
) -> DataFrame:
    """1..n by ascending `score` (negate to descend), ties in the order of a text column.

    Rows of one score are cut further by the first letters of the tiebreak, so a
    score that most rows share is spread as well.
    """
    columns = df.columns
    df, g = _grouped(df, group)
    cut = ["_s0", "_s1"]
    sliced = (
        df.withColumn("_score", score)
        .withColumn("_s0", slice_of(F.col("_score")))
        .withColumn("_s1", F.when(F.col("_s0").isNotNull(), F.substring(tiebreak, 1, prefix)))
    )
    # the letters only order rows of one score: within a slice the score leads
    heavy = sliced.groupBy(*g, "_score", *cut).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*g, "_s0").orderBy("_score", "_s1")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = heavy.withColumn("_before", before).drop("_n")
    offsets = _offsets(heavy, g, ["_s0"], F.col("_n")).drop("_total")
    place = join_on_keys(inner, offsets, [*g, "_s0"])
    place = place.select(*g, "_score", "_s0", "_s1", (F.col("_below") + F.col("_before")).alias("_base"))
    local = F.row_number().over(Window.partitionBy(*g, "_score", "_s0", "_s1").orderBy(tiebreak))
    ranked = join_on_keys(sliced.withColumn("_local", local), place, [*g, "_score", "_s0", "_s1"])
    return ranked.withColumn(out, (F.col("_base") + F.col("_local")).cast("bigint")).select(*columns, out)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first n rows per group. Each task keeps only its own first n before the shuffle."""
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float], distribution: DataFrame | None = None
) -> DataFrame:
    """Linear-interpolated percentiles per group, one column per name in `probs`."""
    dist = value_distribution(df, group, value) if distribution is None else distribution
    aggs = []
    for i, p in enumerate(probs.values()):
        place = (F.col("total") - 1) * F.lit(float(p))
        for side, row in (("l", F.floor(place)), ("h", F.ceil(place))):
            inside = (F.col("below") <= row) & (row < F.col("below") + F.col("n"))
            aggs.append(F.max(F.when(inside, F.col(value))).alias(f"_{side}{i}"))
    grouped = dist.groupBy(*group).agg(*aggs, F.max("total").alias("_t"))
    picked = []
    for i, (name, p) in enumerate(probs.items()):
        place = (F.col("_t") - 1) * F.lit(float(p))
        part = place - F.floor(place)
        picked.append((F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * part).alias(name))
    return grouped.select(*group, *picked)


def quantile_edges(df: DataFrame, group: Sequence[str], value: str, q: int) -> DataFrame:
    """Distinct quantile edges per group as an array `edges` (q + 1 entries before dropping repeats)."""
    names = {f"_e{i}": i / q for i in range(q + 1)}
    cuts = exact_percentiles(df, group, value, names)
    return cuts.select(*group, F.array_distinct(F.array(*names)).alias("edges"))


def with_quantile_bucket(df: DataFrame, group: Sequence[str], value: str, q: int, out: str) -> DataFrame:
    """Bucket 0..q-1 by quantile edges: right-closed, lowest included, repeated edges dropped.

    NULL where the value is NULL or the group has fewer than two distinct edges.
    """
    if not group:
        df2, g = _grouped(df, [])
        return with_quantile_bucket(df2, g, value, q, out).drop(*g)
    edges = quantile_edges(df, group, value, q)
    joined = join_on_keys(df, edges, group)
    inner = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    bucket = F.size(F.filter(inner, lambda e: F.col(value) > e))
    usable = F.col(value).isNotNull() & (F.size("edges") >= 2)
    return joined.withColumn(out, F.when(usable, bucket)).drop("edges")


def with_zscore(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """(x - mean) / sd within the group, NULL when sd is 0. Stats are pre-aggregated, then joined."""
    stats = df.groupBy(*group).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_sd"))
    joined = join_on_keys(df, stats, group)
    z = F.when(F.col("_sd") > 0, (F.col(value) - F.col("_m")) / F.col("_sd"))
    return joined.withColumn(out, z).drop("_m", "_sd")


def with_decile(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Cross-section decile 0.1 .. 1.0 from the average percent rank."""
    ranked = with_average_rank(df, group, value, "_pr", pct=True)
    tenth = F.least(F.greatest(F.ceil(F.col("_pr") * 10), F.lit(1)), F.lit(10)) / 10.0
    return ranked.withColumn(out, F.when(F.col("_pr").isNotNull(), tenth)).drop("_pr")


def correlations(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """(group, n, pearson, spearman) over rows where both are present; no row when sd of x is 0."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = list(group)
    ranked = with_average_rank(with_average_rank(both, g, x, "_rx"), g, y, "_ry")
    return (
        ranked.groupBy(*g)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.stddev_samp(x).alias("_sd"),
            pearson(F.col(x), F.col(y)).alias("pearson"),
            pearson(F.col("_rx"), F.col("_ry")).alias("spearman"),
        )
        .where("_sd > 0")
        .drop("_sd")
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation, NULL (not NaN) for a constant side."""
    r = F.corr(x, y)
    return F.when(~F.isnan(r), r)

"""Series windows (rows W1-W10, W18, W20-W23, J14-J16).

All of them run over a series table keyed by (key, order): one row per symbol
and period. Its groups are bounded by the calendar (a century of trading days is
about 25,000 rows), however many raw rows one symbol holds; reduce raw rows to
that grain first, which Spark does with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.clean import col
from tickerloom.operators.series import with_series_columns


def series(key: str | Sequence[str], order: str | Sequence[str]):
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*orders)


def rolling(agg, c: Column | str, window, n: int, min_rows: int | None = None) -> Column:
    """agg over the last n rows, NULL until `min_rows` non-null values are in the frame."""
    frame = window.rowsBetween(-(n - 1), 0)
    need = n if min_rows is None else min_rows
    return F.when(F.count(col(c)).over(frame) >= need, agg(col(c)).over(frame))


def rolling_mean(c, window, n, min_rows=None) -> Column:
    return rolling(F.avg, c, window, n, min_rows)


def rolling_std(c, window, n, min_rows=None) -> Column:
    return rolling(F.stddev_samp, c, window, n, min_rows)


def rolling_sum(c, window, n, min_rows=None) -> Column:
    return rolling(F.sum, c, window, n, min_rows)


# Whole part and the rest in units of 1e-12: both running sums are exact in long integers.
UNITS = 1e12
Columns = dict[str, Column]


def rolling_means(key, order, lengths: dict[str, Sequence[int]], names: dict[str, str]) -> tuple[Columns, Columns]:
    """The columns of `with_rolling_means` in two steps: running sums, and the means made of them."""
    w = series(key, order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    sums, means = {}, {}
    for c, ns in lengths.items():
        value = F.col(c).cast("double")
        value = F.when(F.abs(value) < float("inf"), value)
        whole = value.cast("bigint")
        parts = {"whole": whole, "rest": F.rint((value - whole) * UNITS).cast("bigint")}
        sums |= {f"_{k}_{c}": F.coalesce(F.sum(part).over(running), F.lit(0).cast("bigint")) for k, part in parts.items()}
        sums[f"_cnt_{c}"] = F.count(c).over(running)
        for n in ns:
            whole, rest, full = (F.col(f"_{k}_{c}") - F.lag(f"_{k}_{c}", n, 0).over(w) for k in ("whole", "rest", "cnt"))
            means[f"{names[c]}{n}"] = F.when(full == n, (whole.cast("double") + rest.cast("double") / UNITS) / n)
    return sums, means


def with_rolling_means(df: DataFrame, key, order, lengths: dict[str, Sequence[int]], names: dict[str, str]) -> DataFrame:
    """Means over several window lengths at a cost per row that does not grow with the length.

    A frame of 240 rows would be summed again for every row. Here running sums
    and a running count per column are taken, and a window is the difference to
    the row n before. The sums are long integers, so the differences are exact.
    NULL until n non-null values are in the window.
    `lengths` is column to window lengths, `names` column to output prefix.
    """
    sums, means = rolling_means(key, order, lengths, names)
    return df.withColumns(sums).withColumns(means).drop(*sums)


def change_from_previous(c, window, rows: int = 1) -> Column:
    return col(c) - F.lag(col(c), rows).over(window)


def pct_change(c, window, rows: int) -> Column:
    return F.try_divide(col(c), F.lag(col(c), rows).over(window)) - 1


def stochastic(df: DataFrame, window, high="high", low="low", close="close", n: int = 9) -> Column:
    """Place of the close within the n-row range in percent; 50 where undefined."""
    low_n = rolling(F.min, low, window, n)
    high_n = rolling(F.max, high, window, n)
    return F.coalesce(F.try_divide(col(close) - low_n, high_n - low_n) * 100, F.lit(50.0))


def streaks(key, order, nets: dict[str, str]) -> tuple[Columns, Columns]:
    """The columns of `with_streaks` in two steps: row numbers with the first rows of runs, and the lengths made of them."""
    w = series(key, order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    first, out = {"_rn": F.row_number().over(w)}, {}
    for c, o in nets.items():
        sign = F.signum(F.coalesce(F.col(c), F.lit(0.0))).cast("int")
        first[f"_new_{c}"] = ~sign.eqNullSafe(F.lag(sign).over(w))
        begin = F.max(F.when(F.col(f"_new_{c}"), F.col("_rn"))).over(running)
        out[o] = ((F.col("_rn") - begin + 1) * sign).cast("bigint")
    return first, out


def with_streaks(df: DataFrame, key, order, nets: dict[str, str]) -> DataFrame:
    """Signed length of the current run of same-sign values per column; a zero or NULL row is 0.

    `nets` is input to output column. A run's length is the row number less that
    of the run's first row, so every step reads the one (key, order) sort.
    """
    first, out = streaks(key, order, nets)
    return df.withColumns(first).withColumns(out).drop(*first)


def with_streak(df: DataFrame, key, order, net: str, out: str) -> DataFrame:
    return with_streaks(df, key, order, {net: out})


def cumulative(c, window) -> Column:
    return F.sum(col(c)).over(window.rowsBetween(Window.unboundedPreceding, 0))


def drawdown(c, window) -> Column:
    """Running total minus its running peak. `c` is the running total."""
    return col(c) - F.max(col(c)).over(window.rowsBetween(Window.unboundedPreceding, 0))


EWM_FIELDS = ["k", "d", "rsi6", "rsi12", "macd_dif", "macd_dea", "macd_hist"]


def with_ewm_indicators(
    df: DataFrame, key: str, order: str, close: str = "close", rsv: str = "rsv"
) -> DataFrame:
    """Recursive averages per series: K, D, RSI 6/12 and MACD.

    The recursion has no built-in form, so series go to Arrow, many whole ones a
    batch. All columns of `df` cross to Python and back, so call it while they are few.
    """

    def compute(pdf: pd.DataFrame, number: np.ndarray) -> dict[str, np.ndarray]:
        def ewm(values: pd.Series, **how: float) -> pd.Series:
            return pd.Series(values.groupby(number).ewm(**how).mean().to_numpy())

        price = pdf[close]
        k = ewm(pdf[rsv], alpha=1 / 3, adjust=False)
        delta = price.groupby(number).diff()
        out = {"k": k, "d": ewm(k, alpha=1 / 3, adjust=False)}
        for n in (6, 12):
            up = ewm(delta.clip(lower=0), com=n - 1, min_periods=n)
            down = ewm(-delta.clip(upper=0), com=n - 1, min_periods=n)
            out[f"rsi{n}"] = 100 - 100 / (1 + up / down)
        fast = ewm(price, span=12, adjust=False)
        slow = ewm(price, span=26, adjust=False)
        out["macd_dif"] = fast - slow
        out["macd_dea"] = ewm(out["macd_dif"], span=9, adjust=False)
        out["macd_hist"] = out["macd_dif"] - out["macd_dea"]
        return out

    result = with_series_columns(df, key, order, [close, rsv], EWM_FIELDS, compute)
    return result.select(
        *df.columns, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in EWM_FIELDS]
    )


def with_expanding_percentile(
    df: DataFrame, key: str, order: str, value: str, out: str
) -> DataFrame:
    """Percent rank of each value among its own and all earlier values, ties averaged.

    Runs per series in O(n log n); NULL values are neither ranked nor counted.
    """

    def compute(pdf: pd.DataFrame, number: np.ndarray) -> dict[str, np.ndarray]:
        return {out: pdf[value].groupby(number).expanding().rank(pct=True).to_numpy()}

    ranked = with_series_columns(df, key, order, [value], [out], compute)
    return ranked.withColumn(out, F.when(F.col(value).isNotNull() & ~F.isnan(out), F.col(out)))


def prior_share_at_most(c, window) -> Column:
    """Share of strictly earlier values that are not above the current one.

    For short series only (cohorts): the frame is held as an array.
    """
    prior = F.collect_list(col(c)).over(window.rowsBetween(Window.unboundedPreceding, -1))
    hits = F.size(F.filter(prior, lambda v: v <= col(c)))
    return F.try_divide(hits.cast("double"), F.size(prior).cast("double"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last under an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

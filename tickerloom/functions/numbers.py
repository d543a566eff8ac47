"""Null-safe arithmetic (rows P12-P16, P20, P22, P23, X14). ANSI mode stays on."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.functions.clean import col

COMMISSION_RATE = 0.001425
SALE_TAX_RATE = 0.003


def safe_div_positive(n: Column | str, d: Column | str) -> Column:
    """n / d, NULL unless the denominator is above zero."""
    return F.when(col(d) > 0, col(n) / col(d))


def div_nonzero(n: Column | str, d: Column | str) -> Column:
    """n / d, NULL when the denominator is zero."""
    return F.try_divide(col(n), col(d))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Bounded value. NULL stays NULL (least and greatest alone would skip it)."""
    value = col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def signed_yoy(current: Column | str, last_year: Column | str, digits: int = 2) -> Column:
    """Growth in percent over the absolute base, NULL for a zero or missing base."""
    base = col(last_year)
    return rnd(F.try_divide(col(current) - base, F.abs(base)) * 100, digits)


def rnd(c: Column | str, digits: int) -> Column:
    """Half-up rounding that takes a value within 5e-10 below a decimal tie as the tie.

    A tie then rounds up whatever float noise its sum took, and a negative zero
    never results.
    """
    value = col(c).cast("double")
    return F.round(value + F.signum(value) * F.lit(5e-10), digits) + F.lit(0.0)


def rounded(values: np.ndarray, digits: int) -> np.ndarray:
    """`rnd` of an array inside a task: by arithmetic, by the decimal text only next to ties and for large values."""
    v = values + np.sign(values) * 5e-10
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.abs(v) * 10.0**digits
        out = np.where(np.isfinite(v), np.copysign(np.floor(scaled + 0.5) / 10.0**digits, v), v)
        sure = (scaled < 1e9) & (np.abs(scaled - np.floor(scaled) - 0.5) > 1e-5)
    for i in np.flatnonzero(~sure & np.isfinite(v)):
        if abs(v[i]) < 2.0**53:  # beyond, there are no digits to round
            out[i] = float(Decimal(repr(float(v[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
        else:
            out[i] = v[i]
    return out + 0.0


def ratio_to_average(x: Column | str, average: Column | str) -> Column:
    """x / average - 1 where the average is positive."""
    return F.when(col(average) > 0, col(x) / col(average) - 1)


def band_position(x: Column | str, lower: Column | str, upper: Column | str) -> Column:
    """Place of x between two bands, NULL for a band of no width."""
    width = col(upper) - col(lower)
    return F.when(width > 0, (col(x) - col(lower)) / width)


def trade_cost(
    entry_value: Column,
    exit_value: Column,
    commission: float = COMMISSION_RATE,
    tax: float = SALE_TAX_RATE,
) -> Column:
    """Commission on both sides and tax on the sale."""
    return (entry_value + exit_value) * commission + exit_value * tax


def correlation_label(r: Column | str) -> Column:
    """Direction word of a feature/outcome correlation."""
    value = col(r)
    return (
        F.when(value.isNull() | F.isnan(value), "flat")
        .when(value > 0.5, "strong_up")
        .when(value > 0.2, "up")
        .when(value < -0.5, "strong_down")
        .when(value < -0.2, "down")
        .otherwise("non_monotonic")
    )

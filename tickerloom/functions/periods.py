"""Period tokens and the playbook calendar (rows X7-X13, K18, P21, S16, S17).

Dates are ISO strings, months `YYYYMnn`, quarters `YYYYQn`, publish times
`YYYYMMDD`; strings of one grammar compare in time order.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.clean import col

# fixed values: quarter whose earnings are predicted in each calendar month
TARGET_QUARTER = {1: 4, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2, 7: 2, 8: 3, 9: 3, 10: 3, 11: 4, 12: 4}
LATE_MONTHS = (5, 8, 11)


# ---- days -------------------------------------------------------------
def iso_date(iso: Column | str) -> Column:
    """Date of an ISO day string; NULL when it is none."""
    return col(iso).try_cast("date")


def add_days(iso: Column | str, days: int) -> Column:
    return F.date_add(iso_date(iso), days).cast("string")


def day_gap(start: Column | str, end: Column | str) -> Column:
    return F.datediff(iso_date(end), iso_date(start))


def roc_to_iso(text: Column | str) -> Column:
    """`111年01月12日` to `2022-01-12`; NULL when the pattern is absent."""
    pattern = "([0-9]+)年([0-9]+)月([0-9]+)日"
    year, month, day = (F.regexp_extract(col(text), pattern, i) for i in (1, 2, 3))
    iso = F.concat_ws(
        "-",
        (year.try_cast("int") + 1911).cast("string"),
        F.lpad(month, 2, "0"),
        F.lpad(day, 2, "0"),
    )
    return F.when(col(text).rlike(pattern), iso)


# ---- months and quarters ---------------------------------------------
def month_token(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("M"), F.lpad(month.cast("string"), 2, "0"))


def quarter_token(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))


def month_index(token: Column | str) -> Column:
    """Months since year 0; month_of_index is the inverse."""
    t = col(token)
    return F.substring(t, 1, 4).cast("int") * 12 + F.substring(t, 6, 2).cast("int") - 1


def month_of_index(index: Column) -> Column:
    return month_token(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"))


def quarter_index(token: Column | str) -> Column:
    t = col(token)
    return F.substring(t, 1, 4).cast("int") * 4 + F.substring(t, 6, 1).cast("int") - 1


def quarter_of_index(index: Column) -> Column:
    return quarter_token(F.floor(index / 4).cast("int"), (F.pmod(index, F.lit(4)) + 1).cast("int"))


def shift_month(token: Column | str, delta: int) -> Column:
    return month_of_index(month_index(token) + delta)


def shift_quarter(token: Column | str, delta: int) -> Column:
    return quarter_of_index(quarter_index(token) + delta)


def quarter_of_day(iso: Column | str) -> Column:
    d = iso_date(iso)
    return quarter_token(F.year(d), F.quarter(d))


def month_of_day(iso: Column | str) -> Column:
    d = iso_date(iso)
    return month_token(F.year(d), F.month(d))


def statutory_publish_date(quarter: Column | str) -> Column:
    """Day by which the statements of a quarter must be public."""
    year = F.substring(col(quarter), 1, 4).cast("int")
    q = F.substring(col(quarter), 6, 1)
    same_year = year.cast("string")
    return (
        F.when(q == "1", F.concat(same_year, F.lit("-05-15")))
        .when(q == "2", F.concat(same_year, F.lit("-08-14")))
        .when(q == "3", F.concat(same_year, F.lit("-11-14")))
        .otherwise(F.concat((year + 1).cast("string"), F.lit("-03-31")))
    )


def revenue_publish_day(token: Column | str) -> Column:
    """Monthly revenue is due on the 10th of the next month, as `YYYYMMDD`."""
    nxt = month_index(token) + 1
    year = F.floor(nxt / 12).cast("int").cast("string")
    month = F.lpad((F.pmod(nxt, F.lit(12)) + 1).cast("int").cast("string"), 2, "0")
    return F.concat(year, month, F.lit("10"))


def quarter_span(quarter: Column | str, accumulated: bool = False) -> Column:
    """`YYYYMMDD-YYYYMMDD` of the quarter, or of the year up to its end."""
    year = F.substring(col(quarter), 1, 4).cast("int")
    q = F.substring(col(quarter), 6, 1).cast("int")
    first = F.lit(1) if accumulated else (q - 1) * 3 + 1
    start = F.make_date(year, first, F.lit(1))
    end = F.last_day(F.make_date(year, q * 3, F.lit(1)))
    return F.concat_ws("-", F.date_format(start, "yyyyMMdd"), F.date_format(end, "yyyyMMdd"))


def period_bounds(token: Column | str) -> tuple[Column, Column]:
    """First and last ISO day of a day, month, or quarter token (mixed grammars)."""
    t = col(token)
    year = F.substring(t, 1, 4).try_cast("int")
    month = F.substring(t, 6, 2).try_cast("int")
    q = F.substring(t, 6, 1).try_cast("int")
    is_month, is_quarter = t.rlike("^[0-9]{4}M[0-9]{2}$"), t.rlike("^[0-9]{4}Q[1-4]$")
    first = (
        F.when(is_month, F.make_date(year, month, F.lit(1)))
        .when(is_quarter, F.make_date(year, (q - 1) * 3 + 1, F.lit(1)))
        .otherwise(t.try_cast("date"))
    )
    last = (
        F.when(is_month, F.last_day(F.make_date(year, month, F.lit(1))))
        .when(is_quarter, F.last_day(F.make_date(year, q * 3, F.lit(1))))
        .otherwise(t.try_cast("date"))
    )
    return first.cast("string"), last.cast("string")


def in_day_range(token: Column | str, start: str | None, end: str | None) -> Column:
    """A period is in range when it overlaps [start, end]."""
    first, last = period_bounds(token)
    keep = first.isNotNull()
    if start:
        keep = keep & (last >= start)
    if end:
        keep = keep & (first <= end)
    return keep


# ---- playbook ---------------------------------------------------------
def playbook_day(year: Column, month: Column) -> Column:
    """Run date of a playbook month: the 16th in May, August, November, else the 11th."""
    day = F.when(month.isin(*LATE_MONTHS), 16).otherwise(11)
    return F.make_date(year, month, day).cast("string")


def is_playbook_day(iso: Column | str) -> Column:
    d = col(iso).try_cast("date")
    return F.coalesce(playbook_day(F.year(d), F.month(d)) == col(iso), F.lit(False))


def latest_playbook_day(today: Column | str) -> Column:
    """Latest run date not after `today`."""
    d = iso_date(today)
    this = playbook_day(F.year(d), F.month(d))
    before = F.add_months(d, -1)
    return F.when(this <= d.cast("string"), this).otherwise(
        playbook_day(F.year(before), F.month(before))
    )


def target_quarter(year: Column, month: Column) -> Column:
    """Quarter predicted in a playbook month (January belongs to the year before)."""
    # the announcement season decides: Feb-Apr first quarter ... Nov-Jan fourth
    number = (
        F.when(month.between(2, 4), 1)
        .when(month.between(5, 7), 2)
        .when(month.between(8, 10), 3)
        .otherwise(4)
    )
    return quarter_token(F.when(month == 1, year - 1).otherwise(year), number)


def feature_month_count(month: Column) -> Column:
    """How many months of the target quarter have published revenue."""
    return F.pmod(month - 2, F.lit(3)).cast("int") + 1


def with_playbook_columns(df: DataFrame, date: str = "playbook_date") -> DataFrame:
    """Add year, month, cutoff and the quarters and months a cohort may look at."""
    d = F.to_date(F.col(date))
    year, month = F.year(d), F.month(d)
    target = target_quarter(year, month)
    return (
        df.withColumn("year", year)
        .withColumn("month", month)
        .withColumn("cutoff_date", add_days(F.col(date), -1))
        .withColumn("target_q", target)
        .withColumn("anchor_q", shift_quarter(F.col("target_q"), -1))
        .withColumn("pre_anchor_q", shift_quarter(F.col("target_q"), -2))
        .withColumn("ly_target_q", shift_quarter(F.col("target_q"), -4))
        .withColumn("ly_anchor_q", shift_quarter(F.col("target_q"), -5))
        .withColumn("expected_revenue_month", shift_month(month_token(F.col("year"), F.col("month")), -1))
        .withColumn("feature_months", feature_month_count(F.col("month")))
    )


def playbook_calendar(span: DataFrame) -> DataFrame:
    """One row per playbook month of a one-row table (first, last) of ISO days."""
    months = span.select(
        "first",
        "last",
        F.explode(
            F.sequence(
                F.trunc(F.to_date("first"), "month"),
                F.trunc(F.to_date("last"), "month"),
                F.expr("interval 1 month"),
            )
        ).alias("_m"),
    )
    days = months.select(
        playbook_day(F.year("_m"), F.month("_m")).alias("playbook_date"), "first", "last"
    )
    inside = days.where(F.col("playbook_date").between(F.col("first"), F.col("last")))
    return with_playbook_columns(inside.select("playbook_date"))


def next_iso_day(day: str) -> str:
    """The ISO day after an ISO day given as plain text."""
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()

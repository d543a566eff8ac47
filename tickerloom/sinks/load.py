"""Load contracts (rows K1-K14, K18-K20, M2): pure table-in, table-out functions plus thin writers.

Each contract is a join or a filter on the partition keys. Writers use dynamic
partition overwrite, so a rerun after a lost executor or a failed job replaces
the same slices again and never doubles rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import periods as P


# ---- contracts --------------------------------------------------------
def absent_slices(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose (date[, market]) slice is not stored yet."""
    present = stored.select(*keys).distinct()
    return incoming.join(present, list(keys), "left_anti")


def append_if_absent(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stored.unionByName(absent_slices(stored, incoming, keys))


def replace_slices(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without the slices that come in again, plus the incoming rows."""
    fresh = incoming.select(*keys).distinct()
    return stored.join(fresh, list(keys), "left_anti").unionByName(incoming)


def purge_slices(stored: DataFrame, period: str, tokens: Sequence[str]) -> DataFrame:
    """Drop whole days, months or quarters."""
    return stored.where(~F.col(period).isin(list(tokens)))


def first_seen(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], publish_time: Column | str) -> DataFrame:
    """Rows for keys not stored yet, stamped with the publish time; stored rows keep theirs."""
    when = F.lit(publish_time) if isinstance(publish_time, str) else publish_time
    new = incoming.join(stored.select(*keys), list(keys), "left_anti").withColumn("publish_time", when)
    return new.dropDuplicates(list(keys))


def after_high_water(df: DataFrame, stored: DataFrame, date: str = "date") -> DataFrame:
    """Rows later than the newest stored date; late rows are ignored by contract."""
    mark = stored.agg(F.max(date)).scalar()
    return df.where(mark.isNull() | (F.col(date) > mark))


def update_column(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Overwrite one column where `fresh` has a value; fail on divergent values for a key."""
    one = fresh.groupBy(*keys).agg(
        F.max(column).alias("_new"), F.min(column).alias("_low")
    )
    guarded = F.when(F.col("_new").eqNullSafe(F.col("_low")), F.col("_new")).otherwise(
        F.raise_error(F.lit(f"divergent values of {column} for one key")).cast(fresh.schema[column].dataType)
    )
    one = one.select(*keys, guarded.alias("_new"))
    joined = stored.join(one, list(keys), "left")
    return joined.withColumn(column, F.coalesce("_new", column)).select(*stored.columns)


def add_late_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns a table gained later, as NULL where it lacks them."""
    missing = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def stack_periods(quarter: DataFrame, accumulated: DataFrame) -> DataFrame:
    """Quarter and year-to-date files as one table with a period_type column."""
    return quarter.withColumn("period_type", F.lit("quarter")).unionByName(
        accumulated.withColumn("period_type", F.lit("accumulated"))
    )


def merge_code_book(old: DataFrame, new: DataFrame, keys: Sequence[str], name: str, source_order: str) -> DataFrame:
    """Code book where a new non-empty name wins; the latest row per key of the new side counts."""
    w = Window.partitionBy(*keys).orderBy(F.desc(source_order))
    named = new.where(F.trim(name) != "").withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    fresh = named.select(*keys, F.col(name).alias("_new"))
    return old.select(*keys, name).join(fresh, list(keys), "full_outer").select(
        *keys, F.coalesce(F.nullif(F.trim("_new"), F.lit("")), F.col(name)).alias(name)
    )


def wide_pairs(facts: DataFrame, keys: Sequence[str], code: str, value: str) -> DataFrame:
    """One row per key with its code/value pairs in code order (bounded by the code book)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(code).alias("code"), F.col(value).alias("value"))))
    return facts.groupBy(*keys).agg(pairs.alias("pairs"))


def long_pairs(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inverse of wide_pairs: blanks dropped, numbers parsed tolerantly."""
    long = wide.select(*keys, F.inline("pairs"))
    return long.where(F.trim("code") != "").withColumn("value_num", C.to_number("value"))


def backfill_publish_time(df: DataFrame, month: str = "date") -> DataFrame:
    """Month rows without a publish time get the 10th of the next month."""
    return df.withColumn("publish_time", F.coalesce("publish_time", P.revenue_publish_day(month)))


def merge_layouts(kept: DataFrame, old_layout: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of an older folder layout move over unless the key exists already."""
    return kept.unionByName(old_layout.join(kept.select(*keys).distinct(), list(keys), "left_anti"))


def load_rows(raw: DataFrame) -> DataFrame:
    """Row filters every market load applies: common stocks only, no all-empty quotes."""
    df = raw.where(common_stock("symbol"))
    prices = [c for c in ("open", "high", "low", "close", "volume") if c in raw.columns]
    if prices:
        df = df.where(any_nonzero(prices))
    return df


def common_stock(symbol: str) -> Column:
    return F.col(symbol).rlike("^[0-9]{4}$")


def any_nonzero(columns: Sequence[str]) -> Column:
    keep = F.lit(False)
    for c in columns:
        keep = keep | (F.coalesce(F.col(c), F.lit(0)) != 0)
    return keep


def renumber_lineage(df: DataFrame, file: str, position: str) -> DataFrame:
    """Row number in the written file: position + 2 (1-based, after the header)."""
    w = Window.partitionBy(file).orderBy(position)
    return df.withColumn("pced_row", (F.row_number().over(w) + 1).cast("bigint"))


# ---- writers ----------------------------------------------------------
def write_slices(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace exactly the partitions present in `df`; others stay untouched.

    Rows are clustered by partition value first so that each writes few files;
    AQE splits a partition value that holds too many rows.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)

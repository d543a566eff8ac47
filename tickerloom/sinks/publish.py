"""JSON outputs (rows K16, K17, X17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def picks_payload(
    rows: DataFrame, n: int, rank: str, quote_date: str, fields: Sequence[str], schema_version: int = 1
) -> DataFrame:
    """The best n rows as one JSON document; they must share one quote date.

    The array is bounded by n. The top rows are found before anything is collected.
    """
    best = rows.where(F.col(rank) <= n)
    pick = F.struct(F.col(rank).alias("rank"), *[F.col(f) for f in fields])
    agg = best.agg(
        F.array_sort(F.collect_list(pick)).alias("picks"), F.min(quote_date).alias("_lo"), F.max(quote_date).alias("_hi")
    )
    one_day = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.raise_error(F.lit("picks do not share one quote date")).cast("string")
    )
    doc = F.struct(F.lit(schema_version).alias("schema_version"), one_day.alias("quote_date"), "picks")
    return agg.select(F.to_json(doc).alias("payload"))


def json_row(summary: DataFrame, out: str) -> DataFrame:
    """A one-row summary as a JSON document."""
    return summary.select(F.to_json(F.struct(*summary.columns)).alias(out))

"""Table scans, dimensions and stored responses (rows S15-S23, J12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import periods as P


def scan_symbols(df: DataFrame, symbols: DataFrame | Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of some symbols in a day range; a symbol table is matched by a semi join."""
    if start:
        df = df.where(F.col("date") >= start)
    if end:
        df = df.where(F.col("date") <= end)
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return df.where(F.col("symbol").isin(list(symbols)))


def scan_periods(df: DataFrame, start: str | None, end: str | None, token: str = "date") -> DataFrame:
    """Rows whose day, month or quarter token overlaps a day range."""
    return df.where(P.in_day_range(token, start, end))


def latest_documents(docs: DataFrame, name: str) -> DataFrame:
    """Newest document per (quarter, symbol) of names `YYYYQn_symbol_YYYYMMDD.html`."""
    pattern = "([0-9]{4}Q[1-4])_([0-9]{4})_([0-9]{8})\\.html$"
    part = [F.regexp_extract(name, pattern, i) for i in (1, 2, 3)]
    df = docs.where(F.col(name).rlike(pattern)).select(
        part[0].alias("date"), part[1].alias("symbol"), part[2].alias("publish_time"), F.col(name).alias("document")
    )
    best = df.groupBy("date", "symbol").agg(F.max(F.struct("publish_time", "document")).alias("_b"))
    return best.select("date", "symbol", "_b.publish_time", "_b.document")


def cohort_artifacts(scored: DataFrame, min_rows: int = 50) -> DataFrame:
    """Scored cohorts with enough rows; the undated `latest` copy is not a cohort."""
    dated = scored.where(P.is_playbook_day("playbook_date"))
    big = dated.groupBy("playbook_date").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    return dated.join(big, "playbook_date", "left_semi")


def stock_info(raw: DataFrame) -> DataFrame:
    return raw.withColumn("symbol", C.zero_pad(C.clean_symbol("symbol"), 4))


def stock_tags(scraped: DataFrame, info: DataFrame) -> DataFrame:
    """Scraped tags plus the industry as a tag, without repeats."""
    industry = info.select("symbol", F.col("industry").cast("string").alias("tag"))
    return scraped.select("symbol", "tag").union(industry).where("tag IS NOT NULL").distinct()


def symbol_universe(monthly: DataFrame) -> DataFrame:
    """Four-digit codes not starting with 00 that reported in the latest month, sorted."""
    newest = monthly.agg(F.max("date")).scalar()
    latest = monthly.where(F.col("date") == newest)
    keep = F.col("symbol").rlike("^[0-9]{4}$") & ~F.col("symbol").startswith("00")
    return latest.where(keep).select("symbol").distinct().orderBy("symbol")


RESPONSE_SCHEMA = "struct<tables: array<struct<title: string, fields: array<string>, data: array<array<string>>>>>"


def response_rows(responses: DataFrame, key: str, body: str, title: str) -> DataFrame:
    """Rows of the titled table in a stored JSON response, else of its first table."""
    df = responses.withColumn("_t", F.from_json(body, RESPONSE_SCHEMA)["tables"])
    titled = F.filter("_t", lambda t: t["title"].contains(title))
    picked = F.when(F.size(titled) > 0, F.element_at(titled, 1)).otherwise(F.try_element_at("_t", F.lit(1)))
    df = df.select(key, picked.alias("_p"))
    return df.select(key, F.col("_p.fields").alias("header"), F.posexplode("_p.data").alias("_row", "fields")).select(
        key, (F.col("_row") + 1).alias("row"), "header", "fields"
    )


def field_of(name: str) -> Column:
    """Field under a header name, for rows of (header, fields)."""
    at = F.nullif(F.array_position("header", name).cast("int"), F.lit(0))
    return F.try_element_at("fields", at)

"""Raw reports to stored tables, category by category, each followed by its audit (rows C21, C32, C33)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.jobs import quality
from tickerloom.sinks import load, versions
from tickerloom.session import stage
from tickerloom.sources import reports

# the order of a daily run; it stops at the first failed audit
DAILY = [
    "daily_quotes", "institutional_investors", "foreign_holding", "margin_trading", "margin_sbl", "pe_ratio",
    "market_indices", "institutional_summary", "margin_summary",
]
# trailing unnamed fields of some reports
UNNAMED = [f"column_{i}" for i in (5, 8, 12, 16, 19)]


class AuditError(ValueError):
    """A converted table failed its audit."""


def convert(category: str, lines: DataFrame) -> DataFrame:
    """One category's report lines as its table, with lineage columns."""
    if category == "institutional_summary":
        return reports.institution_summary(lines)
    if category == "margin_summary":
        return reports.margin_summary(lines)
    types = schemas.type_names(category)
    if category == "market_indices":
        listed = reports.with_path_columns(reports.index_block(lines.where(F.col("src_file").contains("/daily_quotes/"))))
        other = reports.report_table(
            lines.where(F.col("src_file").contains("/market_indices/")), schemas.RAW_NAMES, ignore=UNNAMED,
            wanted=["index_name", "index_close", "index_change_points", "change"], index_report=True,
        )
        other = reports.with_path_columns(other).withColumn("index_change_points", F.coalesce("index_change_points", "change"))
        df = listed.unionByName(other.drop("change"), allowMissingColumns=True).withColumn("symbol", F.col("index_name"))
        return reports.enforce_schema(df, types)
    return reports.daily_report(lines, schemas.RAW_NAMES, types, UNNAMED)


def audit(category: str, table: DataFrame) -> DataFrame:
    """Every (date, market) of a table with `failed`, its failed checks as (check, detail); one pass over the table."""
    columns, threshold = schemas.AUDITS.get(category, ([], 100))
    share = lambda c: F.avg(F.col(c).isNull().cast("double")) * 100
    checks: list[tuple[str, Column, Column]] = [("null_share", share(c) > threshold, F.lit(c)) for c in columns]

    def counted(name: str, broken: Column) -> None:
        n = F.count_if(F.coalesce(broken, F.lit(False)))
        checks.append((name, n > 0, n.cast("string")))

    if category == "daily_quotes":
        counted("ohlc", quality.ohlc_broken())
    if category == "pe_ratio":
        counted("negative_pe", F.col("pe_ratio") < 0)
    if category == "institutional_summary":
        required = F.array(*[F.lit(v) for v in ("dealer_self", "investment_trust", "foreign_investors", "total")])
        lost = F.array_except(required, F.collect_set(F.when(F.array_contains(required, F.col("institution")), F.col("institution"))))
        checks.append(("institution", F.size(lost) > 0, F.element_at(lost, 1)))
    if "src_row" in table.columns:
        counted("lineage", F.col("src_file").isNull() | F.col("src_row").isNull())
    failed = [F.when(broken, F.struct(F.lit(name).alias("check"), detail.alias("detail"))) for name, broken, detail in checks]
    none = F.array().cast("array<struct<check:string,detail:string>>")
    return table.groupBy(F.col("date").cast("string").alias("date"), "market").agg((F.array_compact(F.array(*failed)) if failed else none).alias("failed"))


def convert_daily(spark: SparkSession, raw_root: str, table_root: str, days: Sequence[str], categories: Sequence[str] = tuple(DAILY)) -> None:
    """Convert, audit and store the given days (ISO) of each category; stop on the first failed audit.

    Only the folders of those days are read. The converted rows are staged and audited, and
    stored only when they pass, so a broken report leaves the stored slices as they were. A day
    without a folder and a report without a row fail the run as well.
    """
    for category in categories:
        sources = {"market_indices": ["market_indices", "daily_quotes"], "margin_summary": ["margin_trading"]}.get(category, [category])
        paths = {day: [p for s in sources for p in _day_folders(spark, raw_root, s, [day])] for day in days}
        missing = [day for day in days if not paths[day]]
        if missing:
            raise AuditError(f"{category}: no report of {', '.join(missing)}")
        lines = reports.to_lines(_read_all(spark, [p for day in days for p in paths[day]]))
        table = stage(convert(category, lines).where(F.col("date").cast("string").isin(list(days))))
        found = audit(category, table).orderBy("date", "market").collect()  # a row for each day and market asked for
        empty = [day for day in days if day not in {r["date"] for r in found}]
        if empty:
            raise AuditError(f"{category}: empty report of {', '.join(empty)}")
        for r in found:
            if r["failed"]:
                raise AuditError(f"{category} {r['date']} {r['market']}: {r['failed'][0]['check']} {r['failed'][0]['detail']}")
        load.write_slices(table, f"{table_root}/{category}", schemas.PARTITIONS["daily"])


def _day_folders(spark: SparkSession, root: str, category: str, days: Sequence[str]) -> list[str]:
    """Existing folders of the days, in either layout."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for day in days:
        compact = day.replace("-", "")
        for folder in (f"{root}/{category}/{compact[:4]}/{compact}", f"{root}/{category}/date={compact}"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.getFileSystem(conf).exists(path):
                found.append(folder)
                break
    return found


def _read_all(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(list(paths))
    return reports.decode_files(files.select(F.col("path").alias("src_file"), "content"))


# What each category loads: the columns of a slice (none: the table is replaced whole), whether only common stocks
# are taken, and whether symbols are stripped first.
LOADS = {
    **{c: (["date", "market"], True, False) for c in ("daily_quotes", "institutional_investors", "foreign_holding", "margin_trading", "margin_sbl", "pe_ratio")},
    "market_indices": (["date", "market"], False, False),
    **{c: (["date", "market"], False, False) for c in ("institutional_summary", "margin_summary")},
    "shareholding": (["date"], True, True), "monthly_revenue": (["date", "market"], True, False),
    "stock_info": ([], False, False), "stock_tags": ([], False, False), "ex_dividend": (["year"], True, False),
}


class LoadError(ValueError):
    """A stored slice does not hold what was loaded."""


def load_category(spark: SparkSession, category: str, incoming: DataFrame, table_root: str, force: bool = False) -> DataFrame:
    """Load rows of one category into its stored table by the rules of `LOADS`; the rows that were written.

    Slices that are stored already are left out unless `force` replaces them. What is stored afterwards is counted
    against what was loaded, slice by slice. An empty input loads nothing.
    """
    slices, stocks_only, stripped = LOADS[category]
    path = f"{table_root}/{category}"
    rows = incoming.withColumn("symbol", F.trim(F.col("symbol").cast("string"))) if stripped else incoming
    rows = load.load_rows(rows) if stocks_only else rows
    if not slices:
        if rows.limit(1).count():
            versions.replace_table(rows, path)
        return rows
    if not force and _exists(spark, path):
        rows = load.absent_slices(spark.read.parquet(path), rows, slices)
    rows = stage(rows)
    if not rows.limit(1).count():
        return rows
    load.write_slices(rows, path, slices)
    names = [F.col(c).cast("string").alias(c) for c in slices]
    loaded = rows.select(*names).groupBy(*slices).agg(F.count("*").alias("loaded"))
    held = spark.read.parquet(path).select(*names).groupBy(*slices).agg(F.count("*").alias("held"))
    wrong = loaded.join(held, slices, "left").where(~F.col("loaded").eqNullSafe(F.col("held"))).limit(1).collect()
    if wrong:
        raise LoadError(f"{category}: {wrong[0].asDict()}")
    return rows


def load_all(spark: SparkSession, incoming: dict[str, DataFrame], table_root: str, force: bool = False) -> dict[str, DataFrame]:
    """Load several categories in the order of `LOADS`; the first that fails stops the run."""
    return {c: load_category(spark, c, incoming[c], table_root, force) for c in LOADS if c in incoming}


def load_table(spark: SparkSession, incoming: DataFrame, path: str, partitions: Sequence[str], force: bool = False) -> DataFrame:
    """Load slices into a stored table: absent ones only, or all of them when forced. Returns what was written."""
    rows = load.load_rows(incoming) if "symbol" in incoming.columns else incoming
    if not force and _exists(spark, path):
        rows = load.absent_slices(spark.read.parquet(path), rows, partitions)
    load.write_slices(rows, path, partitions)
    return rows


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

"""Market tables mapped from the given tables; each is a plain DataFrame of (spark, sf_dir).

Symbols are suppliers (or customer classes), days are ship or order days. Raw
rows are reduced to the table's grain with partial aggregation before anything
else happens, so a supplier with a third of all rows still yields one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.operators import asof, ranks
from tickerloom.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_of(key: str | Column) -> Column:
    return F.format_string("%04d", F.col(key) if isinstance(key, str) else key)


def market_of(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, "sii").otherwise("otc")


def iso(ts: str | Column) -> Column:
    """ISO day of a timestamp; the cast is cheaper than a formatter."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("date").cast("string")


def cents(c: str) -> Column:
    """Money as whole cents: integer sums do not depend on the order of rows."""
    return F.round(F.col(c) * 100).cast("bigint")


def _keyed(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("date", iso("l_shipdate"))
        .withColumn("market", market_of("l_suppkey"))
        .withColumn("symbol", symbol_of("l_suppkey"))
    )


def _between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows of a span of days (ISO), on the typed column of the file, so that the scan is pruned."""
    if start:
        df = df.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz" if df.schema["l_shipdate"].dataType.typeName() == "timestamp_ntz" else "timestamp"))
    if end:
        after = F.lit(P.next_iso_day(end))
        df = df.where(F.col("l_shipdate") < after.cast("timestamp_ntz" if df.schema["l_shipdate"].dataType.typeName() == "timestamp_ntz" else "timestamp"))
    return df


def _named(df: DataFrame) -> DataFrame:
    """date, market and symbol as text, made from the day and number that rows were grouped by."""
    named = df.withColumns({"date": F.col("_day").cast("string"), "market": market_of("l_suppkey"), "symbol": symbol_of("l_suppkey")})
    return named.drop("_day", "l_suppkey")


def _of_symbols(df: DataFrame, symbols: DataFrame | None) -> DataFrame:
    """Lines of the symbols in a stored table, by number, before anything is summed. A symbol that is no number is a line without a supplier."""
    if symbols is None:
        return df
    return asof.with_keys_of(df, symbols.select(F.expr("try_cast(symbol AS bigint)").alias("l_suppkey")), ["l_suppkey"])


def quotes(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None, symbols: DataFrame | None = None) -> DataFrame:
    """date, market, symbol, open, high, low, close, volume, value, of a span of days and a stored table's symbols if given.

    The open is the volume-weighted price: like the other columns it is a sum or
    an extreme, so the rows aggregate by hash, partially on every task. Rows are
    grouped by number and day; the text keys are made once per group.
    """
    li = _of_symbols(_between(table(spark, sf, "lineitem"), start, end), symbols).withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    return _named(
        li.groupBy(F.col("l_shipdate").cast("date").alias("_day"), "l_suppkey")
        .agg(
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.avg("price").alias("close"),
            F.sum("l_quantity").alias("volume"),
            F.sum("l_extendedprice").alias("value"),
        )
    ).select(
        "date", "market", "symbol", F.when(F.col("volume") >= 5, F.col("value") / F.col("volume")).alias("open"),
        "high", "low", "close", "volume", "value",
    )


def flows(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Net institutional buying per day and symbol, of a span of days if given."""
    q = F.col("l_quantity")
    return _named(_between(table(spark, sf, "lineitem"), start, end).groupBy(F.col("l_shipdate").cast("date").alias("_day"), "l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", -q).when(F.col("l_returnflag") == "A", q).otherwise(0.0)).alias("foreign_net"),
        F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(-q)).alias("trust_net"),
        F.sum(F.when(F.col("l_discount") > 0.05, q).when(F.col("l_discount") < 0.05, -q).otherwise(0.0)).alias("dealer_net"),
    )).select("date", "market", "symbol", "foreign_net", "trust_net", "dealer_net")


def margin(spark: SparkSession, sf: str) -> DataFrame:
    """Raw margin and lending rows, several per (date, market, symbol), with missing values."""
    li = _keyed(table(spark, sf, "lineitem"))
    q = F.col("l_quantity")
    return li.select(
        "date", "market", "symbol", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("name"),
        F.when(F.col("l_returnflag") != "R", q).alias("margin_long_prev_balance"),
        (q * 1.25).alias("margin_long_balance"),
        F.when(F.col("l_linenumber") != 3, F.round(F.col("l_extendedprice") / 64, 0)).alias("margin_long_limit"),
        F.when(F.col("l_linestatus") == "O", q).alias("margin_short_prev_balance"),
        (q * 0.75).alias("margin_short_balance"),
        F.round(F.col("l_extendedprice") / 128, 0).alias("margin_short_limit"),
        F.when(F.col("l_returnflag") == "A", q).alias("margin_short_buy"),
        F.col("l_linenumber").cast("double").alias("margin_short_cash_repay"),
        F.when(F.col("l_linenumber") != 2, q).alias("sbl_prev_balance"),
        (q * 1.5).alias("sbl_balance"),
        F.when(F.col("l_returnflag") == "N", q).alias("sbl_sell"),
        F.when(F.col("l_linestatus") == "F", q).alias("sbl_repay"),
    )


def issued(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        symbol_of("s_suppkey").alias("symbol"), F.col("s_name").alias("name"),
        (F.round(F.col("s_acctbal") * 100, 0) + 1000000).alias("issued_shares"),
        F.col("s_nationkey").alias("industry"),
    )


def foreign_holding(spark: SparkSession, sf: str) -> DataFrame:
    f = flows(spark, sf)
    return f.join(issued(spark, sf), "symbol").select(
        "date", "market", "symbol", "name",
        F.when((F.col("foreign_net") != 0) & (F.col("trust_net") > -40), F.col("issued_shares")).alias("issued_shares"),
    )


def levels(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return o.groupBy(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-12-31")).alias("date"),
        symbol_of("c_nationkey").alias("symbol"),
        (F.col("o_custkey") % 15 + 1).alias("level"),
    ).agg(F.count(F.lit(1)).alias("holders"), F.sum(cents("o_totalprice")).alias("shares"))


def shareholding(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum("shares").over(Window.partitionBy("date", "symbol"))
    return levels(spark, sf).withColumn("percentage", F.lit(100.0) * F.col("shares") / total)


def reports(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(
        P.quarter_token(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("date"),
        symbol_of(F.col("o_custkey") % 100).alias("symbol"),
    ).agg(
        (F.sum(cents("o_totalprice")) / 1e8).alias("eps_q"),
        (F.count(F.lit(1)) * 10.0 - 30).alias("nav_per_share"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1)).alias("trend"),
        F.count(F.lit(1)).alias("orders_n"),
    )


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly revenue with growth rates, public on the 10th of the next month; every sixth is filed late, after the month that follows."""
    o = table(spark, sf, "orders")
    base = o.groupBy(
        P.month_token(F.year("o_orderdate"), F.month("o_orderdate")).alias("date"),
        symbol_of(F.col("o_custkey") % 100).alias("symbol"),
    ).agg((F.sum(cents("o_totalprice")) / 1e5).alias("revenue_current"))
    w = Window.partitionBy("symbol").orderBy("date")
    rev = F.col("revenue_current")
    late = (F.col("symbol").cast("int") + F.substring("date", 6, 2).cast("int")) % 6 == 0
    late_day = F.concat(F.substring(P.revenue_publish_day(P.shift_month(F.col("date"), 1)), 1, 6), F.lit("13"))
    return base.select(
        "date", "symbol", "revenue_current",
        ((rev / F.lag(rev).over(w) - 1) * 100).alias("mom_pct"),
        ((rev / F.lag(rev, 12).over(w) - 1) * 100).alias("yoy_pct"),
        F.when(late, late_day).otherwise(P.revenue_publish_day("date")).alias("publish_time"),
    )


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Long statement facts: one row per (quarter, symbol, code)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(
        P.quarter_token(F.year("l_shipdate"), F.quarter("l_shipdate")).alias("date"),
        symbol_of("l_suppkey").alias("symbol"),
        F.lit("quarter").alias("period_type"),
        F.concat("l_returnflag", "l_linestatus").alias("account_code"),
    ).agg((F.sum(cents("l_extendedprice")) / 1e5).alias("value_num"))


def index_daily(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("IDX"), (F.col("symbol").cast("int") % 4).cast("string"))
    return quotes(spark, sf).groupBy("date", name.alias("index_name")).agg(F.avg("close").alias("index_close"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    return days.select(F.col("date").cast("string"))


def playbook(spark: SparkSession, sf: str) -> DataFrame:
    """Playbook months touched by the quotes."""
    span = table(spark, sf, "lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    bounds = span.select(iso(F.trunc("a", "month")).alias("first"), iso(F.last_day("b")).alias("last"))
    return P.playbook_calendar(bounds)


def scored_base(spark: SparkSession, sf: str) -> DataFrame:
    """Scores per playbook day and symbol; rows are grouped by number and month, the text keys are made once per group."""
    li = table(spark, sf, "lineitem")
    base = li.groupBy(F.year("l_shipdate").alias("_year"), F.month("l_shipdate").alias("_month"), "l_suppkey").agg(
        N.rnd(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / F.sum("l_quantity"), 6).alias("ml_score"),
        N.rnd(F.avg("l_discount"), 8).alias("disc"),
        N.rnd(F.avg("l_tax"), 8).alias("tax"),
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("line_count"),
    )
    day = P.playbook_day(F.col("_year"), F.col("_month"))
    return base.select(day.alias("playbook_date"), symbol_of("l_suppkey").alias("symbol"), "ml_score", "disc", "tax", "qty", "line_count")


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """First trading day on or after each cohort date."""
    months = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("_year"), F.month("l_shipdate").alias("_month")).distinct()
    days = months.select(P.playbook_day(F.col("_year"), F.col("_month")).alias("playbook_date"))
    return asof.next_trading_day(days, calendar(spark, sf), "playbook_date", "entry_date")


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scored candidates per cohort with entry date and rank; staged, like the stored table it stands for."""
    joined = scored_base(spark, sf).join(
        entries(spark, sf).where("entry_date IS NOT NULL"), "playbook_date"
    )
    ranked = ranks.with_ordinal_rank(joined, ["playbook_date"], -F.col("ml_score"), "symbol", "ml_rank")
    return stage(ranked.select("playbook_date", "symbol", "entry_date", "ml_score", "disc", "tax", "qty", "line_count", "ml_rank"))


# fixed values: account codes assigned to line parts by remainder
STATEMENT_CODES = ["4000", "5900", "6300", "6900", "7900", "7950", "8200", "1100", "11XX", "21XX", "1XXX", "2XXX", "3XXX", "3300", "AAAA", "B02700"]


def statements(spark: SparkSession, sf: str) -> DataFrame:
    """Long facts with income, balance and cash period types; some codes are missing per quarter.

    A remainder has one code and one period type: rows are grouped by numbers, the text keys are made once per group.
    Lines without a part count to the last code.
    """
    slot = F.col("_slot")
    pick = F.element_at(F.array(*[F.lit(c) for c in STATEMENT_CODES]), (slot + 1).cast("int"))
    kind = F.when(slot < 7, "quarter").when(slot < 14, "as_of").otherwise("accumulated")
    sums = table(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").alias("_year"), F.quarter("l_shipdate").alias("_quarter"), "l_suppkey", F.coalesce(F.col("l_partkey") % 16, F.lit(15)).alias("_slot"),
    ).agg((F.sum(cents("l_extendedprice")) / 1e5).alias("value_num"))
    return sums.select(
        P.quarter_token(F.col("_year"), F.col("_quarter")).alias("date"), symbol_of("l_suppkey").alias("symbol"),
        kind.alias("period_type"), pick.alias("account_code"), "value_num",
    )


def quarterly(spark: SparkSession, sf: str) -> DataFrame:
    """Wide quarterly report rows."""
    o = table(spark, sf, "orders")
    sign = F.when(F.col("o_orderstatus") == "P", -cents("o_totalprice")).otherwise(cents("o_totalprice"))
    n = F.count(F.lit(1))
    return o.groupBy(
        P.quarter_token(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("date"),
        symbol_of(F.col("o_custkey") % 100).alias("symbol"), market_of("o_custkey").alias("market"),
    ).agg(
        (F.sum(cents("o_totalprice")) / 1e5).alias("revenue_q"), (F.sum(sign) / 1e6).alias("net_income_q"),
        (n * 3.0 - 12).alias("non_op_income_q"), (n * 4.0 - 20).alias("pretax_income_q"), (n * 100.0).alias("capital"),
        (F.sum(cents("o_totalprice")) / 1e8).alias("eps_q"), (n * 10.0 - 30).alias("nav_per_share"),
    )

"""Raw report lines and filings rendered from the given tables, so that the readers have whole-table input."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.plans import views as V
from tickerloom.sources.reports import slices


def path_of(category: str, date: str = "date", market: Column | str = "market") -> Column:
    compact = F.replace(F.col(date), F.lit("-"), F.lit(""))
    m = F.col(market) if isinstance(market, str) else market
    return F.concat(F.lit(f"/raw/{category}/"), F.substring(date, 1, 4), F.lit("/"), compact, F.lit("/"), m, F.lit(".csv"))


def _file(body: DataFrame, head: list[str], tail: list[str]) -> DataFrame:
    """Lines of each file: head lines, the body in its order, tail lines. `body` is (src_file, _order, value)."""
    w = Window.partitionBy("src_file").orderBy("_order")
    rows = body.select("src_file", (F.row_number().over(w) + len(head)).alias("src_row"), "value")
    sizes = body.groupBy("src_file").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    fixed = [F.struct(F.lit(i + 1).alias("src_row"), F.lit(t).alias("value")) for i, t in enumerate(head)]
    fixed += [F.struct((F.col("_n") + len(head) + i + 1).alias("src_row"), F.lit(t).alias("value")) for i, t in enumerate(tail)]
    return rows.union(sizes.select("src_file", F.inline(F.array(*fixed))))


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        ids, texts = part["doc_id"].to_pylist(), part["text"].to_pylist()
        content = [t.encode("cp950" if i % 2 else "utf-8-sig") for i, t in zip(ids, texts)]
        yield pa.RecordBatch.from_arrays([pa.array([str(i) for i in ids]), pa.array(content, pa.binary())], ["src_file", "content"])


def encoded_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files that open with a Chinese header word: odd ones in Big5 (ASCII beyond the header), even ones in UTF-8."""
    docs = V.table(spark, sf, "documents")
    plain = F.when(F.col("doc_id") % 2 == 1, F.regexp_replace("text", "[^\\x00-\\x7F]", "")).otherwise(F.col("text"))
    return docs.select("doc_id", F.concat(F.lit("證券代號"), plain).alias("text")).mapInArrow(_encoded, "src_file string, content binary")


def quote_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Daily quote reports: preamble, header, ragged rows, codes that are no common stock, footers."""
    q = V.quotes(spark, sf)
    code = F.when(F.col("volume") > 60, F.concat("symbol", F.lit("P"))).otherwise(F.col("symbol"))
    base = [F.concat(F.lit('="'), code, F.lit('"')), quoted(F.concat(F.lit("S, "), "symbol")), quoted(F.format_number("volume", 0))]
    full = F.concat_ws(",", *base, quoted(F.format_number(F.round("value", 2), 2)))
    line = F.when(F.col("volume") < 5, F.concat_ws(",", *base)).otherwise(full)
    body = q.select(path_of("daily_quotes").alias("src_file"), F.col("symbol").alias("_order"), line.alias("value"))
    head = ["﻿report of the day", "unit: shares", "證券代號,證券名稱,成交股數,成交金額"]
    return _file(body, head, ["說明: notes, a, b, c", '"Total","","1","2"'])


def two_row_header_lines(spark: SparkSession, sf: str) -> DataFrame:
    q = V.quotes(spark, sf)
    body = q.select(path_of("margin").alias("src_file"), F.col("symbol").alias("_order"), F.concat_ws(",", "symbol", "symbol", F.lit("1,2,3,4")).alias("value"))
    return _file(body, ["margin report", "股票,,融資,,融券,", "代號,名稱,買進,賣出,買進,賣出"], [])


def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Quote reports that open with an index block, its header repeated by the exchange."""
    ix = V.index_daily(spark, sf)
    close = F.format_number(N.rnd("index_close", 2), 2)
    sign = F.when(F.col("index_name").isin("IDX0", "IDX2"), "<p>-</p>").otherwise("<p>+</p>")
    line = F.concat_ws(",", "index_name", quoted(close), sign, quoted(F.format_number(N.rnd(F.col("index_close") / 10, 2), 2)))
    body = ix.select(path_of("daily_quotes", market=F.lit("sii")).alias("src_file"), F.col("index_name").alias("_order"), line.alias("value"))
    repeated = body.select("src_file").distinct().select("src_file", F.lit("IDX1z").alias("_order"), F.lit("指數,收盤指數,漲跌(+/-),漲跌點數").alias("value"))
    return _file(body.union(repeated), ["report", "指數,收盤指數,漲跌(+/-),漲跌點數"], ["", "證券代號,證券名稱,成交股數,成交金額", "0001,a,b,9"])


# fixed values: report names given to the six line classes
INSTITUTION_NAMES = {
    "AF": "自營商(自行買賣)", "AO": "自營商(避險)　", "NF": "投信", "NO": "外資及陸資(不含外資自營商)", "RF": "外資自營商", "RO": "八大行庫",
}


def institution_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = V._keyed(V.table(spark, sf, "lineitem")).withColumn("cls", F.concat("l_returnflag", "l_linestatus"))
    agg = li.groupBy("date", "market", "cls").agg(F.sum("l_quantity").alias("b"), F.sum(F.col("l_linenumber")).alias("s"))
    pairs = [F.lit(x) for item in INSTITUTION_NAMES.items() for x in item]
    name = F.element_at(F.create_map(*pairs), F.col("cls"))
    line = F.concat_ws(",", quoted(name), quoted(F.format_number("b", 0)), quoted(F.format_number("s", 0)), quoted(F.format_number(F.col("b") - F.col("s"), 0)))
    body = agg.select(path_of("institutional_summary").alias("src_file"), F.col("cls").alias("_order"), line.alias("value"))
    return _file(body, ["單位名稱,買進金額,賣出金額,買賣差額"], [])


def margin_summary_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Per day one report of each market: totals in the first four or among the last five lines."""
    q = V.quotes(spark, sf).groupBy("date", "market").agg(F.sum("volume").alias("v"), F.count(F.lit(1)).alias("n"))
    v, n = F.format_number("v", 0), F.format_number("n", 0)

    def numbers(k: int) -> list[Column]:
        return [quoted(v if i % 2 else n) for i in range(k)]

    sii = q.where("market = 'sii'").select(path_of("margin_trading").alias("src_file"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_order"), F.concat_ws(",", quoted(F.lit(name)), *numbers(5)).alias("value"))
        for i, name in enumerate(["融資(交易單位)", "融券(交易單位)", "融資金額(仟元)", "other"])
    ])))
    otc = q.where("market = 'otc'").select(path_of("margin_trading").alias("src_file"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_order"), line.alias("value")) for i, line in enumerate([
            F.lit('"0001","a","1"'), F.lit('"合計(張)","decoy"'), F.lit('"note"'), F.lit('"note"'),
            F.concat_ws(",", quoted(F.lit("合計(張)")), *numbers(14)), F.concat_ws(",", quoted(F.lit("融資金(仟元)")), *numbers(6)), F.lit('"end"'),
        ])
    ])))
    head = ["項目,買進,賣出,現金(券)償還,前日餘額,今日餘額"]
    return _file(sii.union(otc), head, [])


def shareholder_lines(spark: SparkSession, sf: str) -> DataFrame:
    lv = V.levels(spark, sf)
    total = lv.groupBy("date", "symbol").agg(F.sum("holders").alias("holders"), F.sum("shares").alias("shares")).withColumn("level", F.lit(17).cast("bigint"))
    rows = lv.unionByName(total)
    line = F.concat_ws(",", "date", F.concat("symbol", F.lit("  ")), "level", "holders", "shares", F.lit("1.5"))
    body = rows.select(F.concat(F.lit("/raw/tdcc/"), "date", F.lit(".csv")).alias("src_file"), F.struct("symbol", "level").alias("_order"), line.alias("value"))
    return _file(body, ["資料日期,證券代號,持股分級,人數,股數,占集保庫存數比例%"], [])


def revenue_lines(spark: SparkSession, sf: str) -> DataFrame:
    m = V.monthly(spark, sf)
    cents = F.round(F.col("revenue_current") * 100)
    text = F.when(F.col("mom_pct") < 0, F.concat(F.lit("("), F.format_number(cents, 0), F.lit(")"))).otherwise(F.format_number(cents, 0))
    line = F.concat_ws(",", "symbol", F.lit("n"), quoted(text), F.coalesce(F.format_string("%d", F.round(F.round("yoy_pct", 9)).cast("bigint")), F.lit("")), "publish_time")
    body = m.select(F.concat(F.lit("/raw/monthly/"), "date", F.lit("/market.csv")).alias("src_file"), F.col("symbol").alias("_order"), line.alias("value"))
    return _file(body, ["title", "公司代號,公司名稱,營業收入-當月營收,去年同月增減(%),出表日期"], ["合計,,1,2,3"])


def revenue_lines_by_language(spark: SparkSession, sf: str) -> DataFrame:
    """A report per month and market: odd months in English with a market column, even ones in Chinese with markets by file name."""
    m = V.monthly(spark, sf).withColumn("n", F.col("symbol").cast("int")).withColumn("market", V.market_of("n"))
    english = F.substring("date", 7, 1).cast("int") % 2 == 1
    cents = quoted(F.format_number(F.round(F.col("revenue_current") * 100), 0))
    grown = F.coalesce(F.format_string("%d", F.round(F.round("yoy_pct", 9)).cast("bigint")), F.lit(""))
    line = F.when(english, F.concat_ws(",", "symbol", F.lit("n"), cents, grown, "market")).otherwise(F.concat_ws(",", "symbol", F.lit("n"), cents, grown))
    name = F.when(english, "all").otherwise(F.col("market"))
    src = F.concat(F.lit("/raw/monthly/"), "date", F.lit("/"), name, F.lit(".csv"))
    body = m.select(src.alias("src_file"), F.col("symbol").alias("_order"), line.alias("value"), english.alias("_en"))
    head = {True: ["revenue of the month", "symbol,name,revenue,yoy_pct,market"], False: ["營收", "公司代號,公司名稱,營業收入-當月營收,營業收入-去年同月增減(%)"]}
    parts = [_file(body.where(F.col("_en") == F.lit(en)).drop("_en"), lines, ["合計,,1,2"]) for en, lines in head.items()]
    return parts[0].unionByName(parts[1])


def revenue_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per month with three tables: one with a title and a header row and an industry cell that spans its rows, one
    without a header, and one without a header that is too narrow."""
    m = V.monthly(spark, sf)
    kind = F.col("symbol").cast("int") % 3
    cells = [F.lit("<td>"), "symbol", F.lit("</td><td>Co &amp; "), "symbol", F.lit("</td><td>"), F.format_number(F.round(F.col("revenue_current") * 100), 0), F.lit("</td>")]
    rest = F.when(kind == 2, "<td>x</td>").otherwise("<td>1</td>" * 8)
    by_kind = m.select("date", kind.alias("kind"), F.struct("symbol", F.concat(*cells, rest).alias("row")).alias("r")).groupBy("date").pivot("kind", [0, 1, 2]).agg(F.array_sort(F.collect_list("r")))
    body = lambda k: F.concat(F.lit("<tr>"), F.array_join(F.transform(F.col(str(k)), lambda r: r["row"]), "</tr><tr>"), F.lit("</tr>"))
    head = "<tr><th colspan='12'>公司 revenue of the month</th></tr><tr><th>產業別</th><th>公司\n 代號</th><th>公司名稱</th><th>當月 營收</th>" + "".join(f"<th>c{i}</th>" for i in range(8)) + "</tr>"
    spanned = F.regexp_replace(body(0), "^<tr>", F.concat(F.lit("<tr><td rowspan='"), F.size("0").cast("string"), F.lit("'>1234 industry</td>")))
    total = "<tr><td colspan='2'>合計</td><td>9</td><td>9</td></tr>"
    tables = [F.concat(F.lit("<table>" + head), spanned, F.lit(total + "</table>")), F.concat(F.lit("<table>"), body(1), F.lit("</table>")), F.concat(F.lit("<table>"), body(2), F.lit("</table>"))]
    return by_kind.select("date", F.concat(F.lit("<html><body>"), *[F.coalesce(F.when(F.size(str(k)) > 0, t), F.lit("")) for k, t in enumerate(tables)], F.lit("</body></html>")).alias("html"))


def dividend_lines(spark: SparkSession, sf: str) -> DataFrame:
    o = V.table(spark, sf, "orders")
    roc = F.concat((F.year("o_orderdate") - 1911).cast("string"), F.lit("年"), F.date_format("o_orderdate", "MM"), F.lit("月"), F.date_format("o_orderdate", "dd"), F.lit("日"))
    code = F.when(F.col("o_orderstatus") == "P", F.concat(V.symbol_of(F.col("o_custkey") % 100), F.lit("A"))).otherwise(V.symbol_of(F.col("o_custkey") % 100))
    line = F.concat_ws(",", roc, code, F.lit("n"), quoted(F.format_number(F.round("o_totalprice"), 0)), "o_orderpriority")
    body = o.select(F.concat(F.lit("/raw/dividend/"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("src_file"), F.col("o_orderkey").alias("_order"), line.alias("value"))
    return _file(body, ["title", "資料日期,股票代號,名稱,除權息前收盤價,權/息"], [])


def filings(spark: SparkSession, sf: str) -> DataFrame:
    """One filing per (quarter, symbol): inline-tagged rows of three statements and its metadata.

    A filing lists its account codes, so the rows collected per key are bounded by the code book.
    """
    s = V.statements(spark, sf)
    span, ytd = P.quarter_span("date"), P.quarter_span("date", True)
    quarter = F.concat(F.lit("From"), F.substring(span, 1, 8), F.lit("To"), F.substring(span, 10, 8))
    acc = F.concat(F.lit("From"), F.substring(ytd, 1, 8), F.lit("To"), F.substring(ytd, 10, 8))
    as_of = F.concat(F.lit("AsOf"), F.substring(span, 10, 8))
    context = F.when(F.col("period_type") == "quarter", quarter).when(F.col("period_type") == "as_of", as_of).otherwise(acc)
    row = F.concat(
        F.lit("<tr><td>"), "account_code", F.lit("</td><td>　Title "), "account_code", F.lit("：</td><td><ix:nonFraction name='t:"), "account_code",
        F.lit('\' contextRef="'), context, F.lit('" sign="">'), F.format_number(F.round("value_num", 2), 2), F.lit("</ix:nonFraction></td></tr>"),
    )

    def rows(kind: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col("period_type") == kind, F.col("_row")))), "")

    g = s.withColumn("_row", row).groupBy("date", "symbol").agg(
        rows("as_of").alias("b"), rows("quarter").alias("i"), rows("accumulated").alias("c"), F.count(F.lit(1)).alias("n")
    )
    basis = F.when(F.col("n") < 9, "Non-consolidated report").when(F.col("n") < 11, "Individual report").otherwise("Consolidated report")
    html = F.concat(
        F.lit("<html><body><ix:nonNumeric name='tifrs-notes:CompanyChineseName'>Co &amp; "), "symbol", F.lit("</ix:nonNumeric><ix:nonNumeric name='tifrs-notes:Market'>Listed Company</ix:nonNumeric>"),
        F.lit("<ix:nonNumeric name='tifrs-notes:ReportCategory'>"), basis, F.lit("</ix:nonNumeric><div id=\"BalanceSheet\"></div>"), "b",
        F.lit('<div id="StatementOfComprehensiveIncome"></div>'), "i", F.lit('<div id="StatementsOfCashFlows"></div>'), "c",
        F.lit('<div id="StatementsOfChangeInEquity"></div><div id="ReportOfIndependentAuditors"></div></body></html>'),
    )
    return g.select("date", "symbol", F.lit("20200101").alias("publish_time"), html.alias("html"))

"""Queries over report readers, filings, stored responses and text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P
from tickerloom.jobs import quality as Q
from tickerloom.operators import windows as W
from tickerloom.plans import raw_views as RV
from tickerloom.plans import views as V
from tickerloom.plans.oracle_views import with_views
from tickerloom.plans.registry import query
from tickerloom.plans.series_queries import _round_all
from tickerloom.sinks import load
from tickerloom.sources import documents as D
from tickerloom.sources import reports as S
from tickerloom.sources import tables as T

R = N.rnd
QUOTE_MAP = {"證券代號": "symbol", "證券名稱": "name", "成交股數": "volume", "成交金額": "value"}
QUOTE_SCHEMA = {"date": "string", "market": "string", "symbol": "string", "volume": "double", "value": "double", "late_column": "double"}


# ---- reports ----------------------------------------------------------
_QUOTE_ROWS = "qr AS (SELECT *, 3 + row_number() OVER (PARTITION BY date, market ORDER BY symbol) AS src_row FROM quotes)"


@query("daily_quote_report", "S1 S5 S16 P1 P2 P4 P5 P6 F1 C32", with_views(f"""WITH {_QUOTE_ROWS} SELECT date, market, symbol, volume, CASE WHEN volume >= 5 THEN rnd(value, 2) END AS value, CAST(NULL AS DOUBLE) AS late_column,
 '/raw/daily_quotes/' || substr(date, 1, 4) || '/' || replace(date, '-', '') || '/' || market || '.csv' AS src_file, src_row, '1#3#4' AS src_col FROM qr WHERE volume <= 60"""))
def daily_quote_report(spark, sf):
    df = S.daily_report(RV.quote_lines(spark, sf), QUOTE_MAP, QUOTE_SCHEMA)
    return df.withColumn("value", R("value", 2))


@query("renumbered_lineage", "P7", with_views(f"""WITH {_QUOTE_ROWS} SELECT date, market, symbol, 1 + row_number() OVER (PARTITION BY date, market ORDER BY src_row) AS pced_row FROM qr WHERE volume <= 60"""))
def renumbered_lineage(spark, sf):
    df = S.daily_report(RV.quote_lines(spark, sf), QUOTE_MAP, QUOTE_SCHEMA)
    return load.renumber_lineage(df, "src_file", "src_row").select("date", "market", "symbol", "pced_row")


@query("day_range_scan", "S16 S18", with_views("SELECT date, market, symbol, volume FROM quotes WHERE date BETWEEN '1997-03-01' AND '1997-05-31'"))
def day_range_scan(spark, sf):
    return S.scan_days(V.quotes(spark, sf, "1997-03-01", "1997-05-31"), "1997-03-01", "1997-05-31").select("date", "market", "symbol", "volume")


@query("two_row_header", "S2 X4", with_views("SELECT DISTINCT date, market, 3 AS header_row, '股票-代號#股票-名稱#融資-買進#融資-賣出#融券-買進#融券-賣出' AS header FROM quotes"))
def two_row_header(spark, sf):
    head = S.with_path_columns(S.header_rows(RV.two_row_header_lines(spark, sf)))
    return head.select("date", "market", "header_row", F.concat_ws("#", "header").alias("header"))


@query("decoded_files", "S3", with_views(r"""
SELECT CAST(doc_id AS VARCHAR) AS src_file, length(t) AS chars, left(t, 4) AS head, md5(t) AS digest
FROM (SELECT doc_id, '證券代號' || CASE WHEN doc_id % 2 = 1 THEN regexp_replace(text, '[^\x00-\x7F]', '', 'g') ELSE text END AS t FROM documents)"""))
def decoded_files(spark, sf):
    """Every second file is in the exchange's legacy code page, the others are UTF-8 with a byte order mark."""
    back = S.decode_files(RV.encoded_files(spark, sf))
    return back.select("src_file", F.length("text").alias("chars"), F.left("text", F.lit(4)).alias("head"), F.md5("text").alias("digest"))


@query("document_lines", "S1 S3", with_views(r"""
SELECT doc_id, count(*) AS lines, max(i) AS last_row, sum(length(l)) AS chars FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS l, generate_subscripts(string_split(regexp_replace(text, '\n$', ''), chr(10)), 1) AS i FROM documents) GROUP BY 1"""))
def document_lines(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("src_file"), "text")
    lines = S.to_lines(docs)
    return lines.groupBy(F.col("src_file").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("src_row").alias("last_row"), F.sum(F.length("value")).alias("chars")
    )


@query("index_block", "S4 S6 P8 U1", with_views("""
SELECT date, index_name, index_name AS symbol, rnd(index_close, 2) AS index_close, CASE WHEN index_name IN ('IDX0', 'IDX2') THEN -1 ELSE 1 END * rnd(index_close / 10, 2) AS index_change_points FROM index_daily"""))
def index_block(spark, sf):
    df = S.with_path_columns(S.index_block(RV.index_lines(spark, sf)))
    return df.select("date", "index_name", F.col("index_name").alias("symbol"), "index_close", "index_change_points")


@query("institution_summary", "S7 X15", with_views("""
SELECT date, market, institution, b AS buy, s AS sell, b - s AS net FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, CASE WHEN l_suppkey % 2 = 0 THEN 'sii' ELSE 'otc' END AS market,
 CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'dealer_self' WHEN 'AO' THEN 'dealer_hedge' WHEN 'NF' THEN 'investment_trust' WHEN 'NO' THEN 'foreign_investors' WHEN 'RF' THEN 'foreign_dealer' END AS institution, sum(l_quantity) AS b, sum(l_linenumber) AS s FROM lineitem GROUP BY 1, 2, 3) WHERE institution IS NOT NULL"""))
def institution_summary(spark, sf):
    return S.institution_summary(RV.institution_lines(spark, sf)).drop("src_file", "src_row")


@query("margin_summary", "S8", with_views("""
WITH a AS (SELECT date, market, sum(volume) AS v, count(*) AS n FROM quotes GROUP BY 1, 2)
SELECT date, market, item, n AS buy, v AS sell, n AS cash_repay, v AS prev_balance, n AS today_balance FROM a, (SELECT unnest(['融資(交易單位)', '融券(交易單位)', '融資金額(仟元)']) AS item) WHERE market = 'sii'
UNION ALL SELECT date, market, item, buy, sell, cash_repay, prev_balance, today_balance FROM (SELECT date, market, unnest(['融資(交易單位)', '融券(交易單位)', '融資金額(仟元)']) AS item, unnest([n, v, n]) AS buy, unnest([v, n, v]) AS sell, unnest([n, n, n]) AS cash_repay, unnest([v, v, v]) AS prev_balance, unnest([v, v, v]) AS today_balance FROM a WHERE market = 'otc')"""))
def margin_summary(spark, sf):
    return S.margin_summary(RV.margin_summary_lines(spark, sf)).drop("src_file", "src_row")


@query("shareholder_snapshot", "S9 X15 X1", with_views("""
SELECT date, symbol, level, holders, shares, 1 + rn AS src_row FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY symbol, level) AS rn FROM (SELECT * FROM levels UNION ALL SELECT date, symbol, 17, sum(holders), sum(shares) FROM levels GROUP BY 1, 2)) WHERE level <= 15"""))
def shareholder_snapshot(spark, sf):
    df = S.shareholder_snapshot(RV.shareholder_lines(spark, sf))
    return df.select("date", "symbol", "level", "holders", "shares", "src_row")


@query("complete_snapshots", "S10", with_views("SELECT * FROM levels QUALIFY count(*) OVER (PARTITION BY date, symbol) = 15"))
def complete_snapshots(spark, sf):
    return S.complete_snapshots(V.levels(spark, sf))


@query("preferred_report_files", "S11", with_views("""
WITH f AS (SELECT date, CASE WHEN revenue_current > 1500 THEN 'market.csv' WHEN revenue_current > 900 THEN 'tmp.csv' ELSE symbol || '.csv' END AS file_name, symbol FROM monthly), r AS (SELECT *, CASE file_name WHEN 'market.csv' THEN 1 WHEN 'tmp.csv' THEN 2 ELSE 3 END AS k FROM f)
SELECT date, file_name, symbol FROM r QUALIFY k = min(k) OVER (PARTITION BY date)"""))
def preferred_report_files(spark, sf):
    rev = F.col("revenue_current")
    name = F.when(rev > 1500, "market.csv").when(rev > 900, "tmp.csv").otherwise(F.concat("symbol", F.lit(".csv")))
    files = V.monthly(spark, sf).select("date", name.alias("file_name"), "symbol")
    return S.preferred_files(files, F.col("date"))


@query("monthly_revenue_report", "S11 P3", with_views("""
SELECT date, symbol, CASE WHEN mom_pct < 0 THEN -1 ELSE 1 END * round(revenue_current * 100) AS revenue_current, rnd(yoy_pct, 0) AS yoy_pct, publish_time FROM monthly"""))
def monthly_revenue_report(spark, sf):
    mapping = {"公司代號": "symbol", "公司名稱": "name", "當月營收": "revenue_current", "去年同月增減(%)": "yoy_pct", "出表日期": "publish_time"}
    df = S.monthly_revenue(RV.revenue_lines(spark, sf), mapping)
    return df.select(F.regexp_extract("src_file", "/([0-9]{4}M[0-9]{2})/", 1).alias("date"), "symbol", "revenue_current", "yoy_pct", "publish_time")


@query("dividend_report", "S12 X9 P3", with_views("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, printf('%04d', o_custkey % 100) AS symbol, round(o_totalprice) AS close_before, o_orderpriority AS type, 2 + row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS src_row FROM orders
QUALIFY o_orderstatus <> 'P'"""))
def dividend_report(spark, sf):
    mapping = {"資料日期": "date", "股票代號": "symbol", "名稱": "name", "除權息前收盤價": "close_before", "權/息": "type"}
    df = S.dividends(RV.dividend_lines(spark, sf), mapping)
    return df.select("date", "symbol", "close_before", "type", "src_row")


@query("lineage_audit", "C22 J23 X16", with_views(f"""WITH {_QUOTE_ROWS} SELECT '/raw/daily_quotes/' || substr(date, 1, 4) || '/' || replace(date, '-', '') || '/' || market || '.csv' AS src_file, src_row, 'volume' AS column_name,
 CAST(volume + 1 AS BIGINT) AS stored, CAST(volume AS BIGINT) AS raw FROM qr WHERE volume <= 60 AND volume > 55"""))
def lineage_audit(spark, sf):
    """Large volumes are stored one too high on purpose; exactly those must be found."""
    lines = RV.quote_lines(spark, sf)
    rows = S.daily_report(lines, QUOTE_MAP, QUOTE_SCHEMA)
    rows = rows.withColumn("volume", F.when(F.col("volume") > 55, F.col("volume") + 1).otherwise(F.col("volume")))
    raw = lines.withColumn("fields", S.split_fields("value"))
    bad = Q.lineage_audit(rows, raw, ["symbol", "volume", "value"])
    return bad.select("src_file", "src_row", "column_name", C.to_number("stored").cast("bigint").alias("stored"), C.to_number("raw").cast("bigint").alias("raw"))


# ---- filings ----------------------------------------------------------
_SPAN = """CASE substr(date, 6, 1) WHEN '1' THEN '0101-' || substr(date, 1, 4) || '0331' WHEN '2' THEN '0401-' || substr(date, 1, 4) || '0630' WHEN '3' THEN '0701-' || substr(date, 1, 4) || '0930' ELSE '1001-' || substr(date, 1, 4) || '1231' END"""
_FACTS = """ff AS (SELECT date, symbol, period_type, account_code, value_num FROM statements UNION ALL
 SELECT date, symbol, CASE period_type WHEN 'quarter' THEN 'accumulated' ELSE 'quarter' END, account_code, value_num FROM statements WHERE substr(date, 6, 1) = '1' AND period_type <> 'as_of')"""


@query("statement_facts", "C27 S13 F10 P9 X5 X2", with_views(f"""WITH {_FACTS} SELECT date, symbol, CASE WHEN account_code IN ('AAAA', 'B02700') THEN 'cash_flow' WHEN account_code IN ('4000', '5900', '6300', '6900', '7900', '7950', '8200') THEN 'income_statement' ELSE 'balance_sheet' END AS category,
 period_type, account_code, 'Title ' || account_code AS account_name, rnd(value_num, 2) AS value_num FROM ff"""))
def statement_facts(spark, sf):
    df = D.statement_facts(RV.filings(spark, sf))
    return df.drop("publish_time", "value_text").withColumn("value_num", R("value_num", 2))


@query("fourth_quarter_fill", "J16 C27", with_views("""
WITH s AS (SELECT date, symbol, account_code, value_num FROM statements WHERE period_type = 'quarter'), a AS (SELECT date, symbol, account_code, sum(value_num) OVER (PARTITION BY symbol, account_code, substr(date, 1, 4) ORDER BY date) AS acc, value_num FROM s),
 kept AS (SELECT * FROM s WHERE date NOT LIKE '%Q4'), acc AS (SELECT date, symbol, account_code, acc FROM a)
SELECT date, symbol, account_code, rnd(value_num, 4) AS value_num FROM kept UNION ALL
SELECT x.date, x.symbol, x.account_code, rnd(x.acc - coalesce(y.acc, 0), 4) FROM acc x LEFT JOIN acc y ON y.symbol = x.symbol AND y.account_code = x.account_code AND y.date = substr(x.date, 1, 4) || 'Q3' WHERE x.date LIKE '%Q4'"""))
def fourth_quarter_fill(spark, sf):
    s = V.statements(spark, sf).where("period_type = 'quarter'")
    w = W.series(["symbol", "account_code", F.substring("date", 1, 4)], "date")
    acc = s.withColumn("value_num", W.cumulative("value_num", w)).withColumn("period_type", F.lit("accumulated"))
    facts = s.where(~F.col("date").endswith("Q4")).unionByName(acc)
    filled = D.fill_fourth_quarter(facts).where("period_type = 'quarter'")
    return _round_all(filled.drop("period_type"), 4)


@query("filing_metadata", "S14 X2", with_views("""
SELECT date, symbol, 'Co & ' || symbol AS name, 'sii' AS market, CASE WHEN count(*) < 11 THEN 'individual' ELSE 'consolidated' END AS report_category FROM statements GROUP BY 1, 2"""))
def filing_metadata(spark, sf):
    fields = {"name": "tifrs-notes:CompanyChineseName", "market": "tifrs-notes:Market", "report_category": "tifrs-notes:ReportCategory"}
    df = D.document_meta(RV.filings(spark, sf), "html", fields)
    return df.select("date", "symbol", "name", D.market_name("market").alias("market"), D.report_basis("report_category").alias("report_category"))


@query("latest_filing", "S15 T4", with_views("SELECT date, symbol, replace(CASE WHEN orders_n > 5 THEN '2003-02-01' ELSE '2002-11-30' END, '-', '') AS publish_time, date || '_' || symbol || '_' || replace(CASE WHEN orders_n > 5 THEN '2003-02-01' ELSE '2002-11-30' END, '-', '') || '.html' AS document FROM reports"))
def latest_filing(spark, sf):
    r = V.reports(spark, sf)
    first = r.select(F.concat_ws("_", "date", "symbol", F.lit("20021130.html")).alias("doc"))
    second = r.where("orders_n > 5").select(F.concat_ws("_", "date", "symbol", F.lit("20030201.html")).alias("doc"))
    return T.latest_documents(first.union(second).union(first.select(F.concat("doc", F.lit(".bak")))), "doc")


@query("quarterly_report", "C26 P19 P20 P21 P24", with_views(f"""
WITH q AS (SELECT date, symbol, max(value_num) FILTER (account_code = '4000') AS revenue_q, max(value_num) FILTER (account_code = '8200') AS ni_i, max(value_num) FILTER (account_code = '6300') AS ni_c FROM statements WHERE period_type = 'quarter' AND account_code IN ('4000', '8200', '6300') GROUP BY 1, 2),
 acc AS (SELECT date, symbol, revenue_q, ni_i, ni_c, sum(revenue_q) OVER w AS revenue_acc, sum(ni_i) OVER w AS ai, sum(ni_c) OVER w AS ac FROM q WINDOW w AS (PARTITION BY symbol, substr(date, 1, 4) ORDER BY date)),
 basis AS (SELECT date, symbol, CASE WHEN count(*) < 11 THEN 'individual' ELSE 'consolidated' END AS report_category FROM statements GROUP BY 1, 2),
 x AS (SELECT a.date, a.symbol, b.report_category, a.revenue_q, a.revenue_acc, CASE WHEN b.report_category = 'individual' THEN a.ni_i ELSE a.ni_c END AS net_income_q, CASE WHEN b.report_category = 'individual' THEN a.ai ELSE a.ac END AS net_income_acc FROM acc a JOIN basis b ON b.date = a.date AND b.symbol = a.symbol),
 bs AS (SELECT date, symbol, max(value_num) FILTER (account_code = '3XXX') AS eq, max(value_num) FILTER (account_code = '3300') AS cap, max(value_num) FILTER (account_code = '1XXX') AS ta, max(value_num) FILTER (account_code = '11XX') AS ca, max(value_num) FILTER (account_code = '21XX') AS cl, max(value_num) FILTER (account_code = '1100') AS inv FROM statements WHERE period_type = 'as_of' GROUP BY 1, 2)
SELECT x.date, x.symbol, x.report_category, rnd(x.revenue_q, 4) AS revenue_q, rnd(x.revenue_acc, 4) AS revenue_acc, rnd(l.revenue_acc, 4) AS revenue_acc_ly, rnd((x.revenue_acc - l.revenue_acc) / abs(l.revenue_acc) * 100, 2) AS revenue_acc_yoy,
 rnd(x.net_income_q, 4) AS net_income_q, rnd(l.net_income_acc, 4) AS net_income_acc_ly, rnd((x.net_income_acc - l.net_income_acc) / abs(l.net_income_acc) * 100, 2) AS net_income_acc_yoy,
 rnd(bs.eq / (bs.cap / 10), 2) AS nav_per_share, rnd(eq / ta * 100, 4) AS equity_to_assets_ratio, rnd(ca / cl, 4) AS current_ratio, rnd((ca - inv) / cl, 4) AS quick_ratio, substr(x.date, 1, 4) || {_SPAN.replace('date', 'x.date')} AS period_quarter
FROM x LEFT JOIN x l ON l.symbol = x.symbol AND l.date = (CAST(substr(x.date, 1, 4) AS INT) - 1) || substr(x.date, 5) LEFT JOIN bs ON bs.date = x.date AND bs.symbol = x.symbol"""))
def quarterly_report(spark, sf):
    """The mapped codes stand in for the accounts of a filing; year-to-date rows are running sums."""
    s = V.statements(spark, sf)
    rename = F.create_map(*[F.lit(x) for p in {"4000": "4000", "8200": "8200", "6300": "8610", "3XXX": "3XXX", "3300": "3110", "1XXX": "1XXX", "11XX": "11XX", "21XX": "21XX", "1100": "130X"}.items() for x in p])
    s = s.withColumn("account_code", F.try_element_at(rename, F.col("account_code"))).where("account_code IS NOT NULL AND period_type <> 'accumulated'")
    q = s.where("period_type = 'quarter'")
    # every (quarter, symbol) with any income row carries its running totals forward
    grid = q.select("date", "symbol").distinct().withColumn("account_code", F.explode(F.array(*[F.lit(c) for c in ("4000", "8200", "8610")])))
    dense = grid.join(q, ["date", "symbol", "account_code"], "left")
    w = W.series(["symbol", "account_code", F.substring("date", 1, 4)], "date")
    acc = dense.withColumn("value_num", W.cumulative("value_num", w)).withColumn("period_type", F.lit("accumulated"))
    # rows of all statement kinds decide the basis
    n = V.statements(spark, sf).groupBy("date", "symbol").agg(F.count(F.lit(1)).alias("n"))
    basis = n.select("date", "symbol", F.when(F.col("n") < 11, "individual").otherwise("consolidated").alias("report_category"))
    df = D.quarterly_report(s.unionByName(acc), basis)
    digits = {"revenue_q": 4, "revenue_acc": 4, "revenue_acc_ly": 4, "revenue_acc_yoy": 2, "net_income_q": 4, "net_income_acc_ly": 4, "net_income_acc_yoy": 2, "nav_per_share": 2, "equity_to_assets_ratio": 4, "current_ratio": 4, "quick_ratio": 4}
    return df.select("date", "symbol", "report_category", "period_quarter", *[R(c, d).alias(c) for c, d in digits.items()])


@query("blank_backfill", "P24", with_views("SELECT m.date, m.symbol, rnd(coalesce(m.yoy_pct, r.eps), 4) AS yoy_pct FROM monthly m LEFT JOIN (SELECT symbol, max(eps_q) AS eps FROM reports GROUP BY 1) r ON r.symbol = m.symbol"))
def blank_backfill(spark, sf):
    second = V.reports(spark, sf).groupBy("symbol").agg(F.max("eps_q").alias("yoy_pct"))
    df = D.backfill_blank(V.monthly(spark, sf).select("date", "symbol", "yoy_pct"), second, ["symbol"], ["yoy_pct"])
    return _round_all(df, 4)


# ---- pages ------------------------------------------------------------
PAGE_SECTIONS = {"nav": ("<nav>", "</nav>"), "article": ("<article>", "</article>")}
_LINKS = "SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2)) AS txt, unnest(range(0, len(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)))) AS pos"


@query("page_tag_facts", "S13 X2 X5", with_views(f"SELECT page_id, 'nav' AS category, pos AS fact_pos, href AS fact_name, trim(txt) AS value_text FROM ({_LINKS} FROM pages) WHERE trim(txt) <> ''"))
def page_tag_facts(spark, sf):
    parts = D.split_sections(V.table(spark, sf, "pages"), ["page_id"], "html", PAGE_SECTIONS)
    df = D.tagged_facts(parts, ["page_id"], ("a",), name="href", context="class")
    return df.select("page_id", "category", "fact_pos", "fact_name", "value_text")


@query("page_coded_rows", "S13 S22", with_views(f"""SELECT page_id, href AS fact_name, trim(txt) AS value_text, trim(txt) AS account_code FROM ({_LINKS} FROM pages) WHERE regexp_full_match(trim(txt), '[A-Za-z]+') GROUP BY ALL"""))
def page_coded_rows(spark, sf):
    parts = D.split_sections(V.table(spark, sf, "pages"), ["page_id"], "html", PAGE_SECTIONS)
    df = D.coded_rows(parts, ["page_id"], row="li", cell="a", pattern="^[A-Za-z]+$", tags=("a",), name="href", context="class")
    return df.select("page_id", "fact_name", "value_text", "account_code")


@query("page_table_rows", "S22", with_views("""
SELECT page_id, i - 1 AS row_pos, trim(regexp_extract(l, '>([^<]*)</a>', 1)) AS field FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS l, generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) AS i FROM pages)"""))
def page_table_rows(spark, sf):
    df = D.html_table_rows(V.table(spark, sf, "pages"), "page_id", "html", row="li", cell="a")
    return df.select("page_id", "row_pos", F.element_at("fields", 1).alias("field"))


@query("revenue_reports", "S11 P3 P1", with_views("""
SELECT date, CASE WHEN CAST(symbol AS INT) % 2 = 0 THEN 'sii' ELSE 'otc' END AS market, symbol, round(revenue_current * 100) AS revenue_current, rnd(yoy_pct, 0) AS yoy_pct FROM monthly"""))
def revenue_reports(spark, sf):
    """Reports of either language; the market comes from the row or from the file name."""
    return S.revenue_reports(RV.revenue_lines_by_language(spark, sf)).select("date", "market", "symbol", "revenue_current", "yoy_pct")


@query("rendered_revenue_tables", "S22 S11 P3", with_views("""
SELECT date, symbol, CASE CAST(symbol AS INT) % 3 WHEN 0 THEN 'header' ELSE 'position' END AS named_by, 'Co & ' || symbol AS name, round(revenue_current * 100) AS revenue FROM monthly WHERE CAST(symbol AS INT) % 3 <> 2"""))
def rendered_revenue_tables(spark, sf):
    """Tables with a header row, without one, and too narrow to be read by position."""
    rows = D.named_rows(D.table_grid(RV.revenue_pages(spark, sf), "date", "html"), "date")
    field = lambda name: F.col("fields").getItem(name)
    return rows.select("date", field("公司代號").alias("symbol"), "named_by", field("公司名稱").alias("name"), C.to_number(field("當月營收")).alias("revenue"))


@query("page_titles", "X5 P9 S14", with_views("""
SELECT page_id, regexp_replace(trim(regexp_replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&'), '[\\s]+', ' ', 'g')), '^[\\s,.;:]+|[\\s,.;:]+$', '', 'g') AS title FROM pages""".replace("\\\\", "\\")))
def page_titles(spark, sf):
    title = C.strip_tags(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1))
    return V.table(spark, sf, "pages").select("page_id", C.clean_account_name(title).alias("title"))


@query("document_reject_reason", "F12", with_views("""
SELECT source, id, CASE WHEN strlen(body) < 3000 THEN 'too_small' WHEN NOT contains(lower(body), '<html') THEN 'invalid_html' WHEN NOT contains(lower(body), 'example.com') THEN 'no_xbrl_markers' END AS reason
FROM (SELECT 'pages' AS source, page_id AS id, html AS body FROM pages UNION ALL SELECT 'documents', doc_id, text FROM documents)"""))
def document_reject_reason(spark, sf):
    """Pages and plain texts: some are too small, texts are no HTML, and some pages lack the marker."""
    pages = V.table(spark, sf, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("body"))
    texts = V.table(spark, sf, "documents").select(F.lit("documents"), "doc_id", "text")
    return pages.union(texts).select("source", "id", D.reject_reason("body", 3000, ("Example.com",)).alias("reason"))


# ---- responses and dimensions ----------------------------------------
@query("response_rows", "S23 X17", with_views("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events"""))
def response_rows(spark, sf):
    ev = V.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit('{"tables":[{"title":"other","fields":["x"],"data":[["0"]]},{"title":"the close table","fields":["type","k"],"data":[["'), "event_type", F.lit('","'), k, F.lit('"]]}]}'))
    rows = T.response_rows(ev.select("event_id", body.alias("body")), "event_id", "body", "close")
    return rows.select("event_id", T.field_of("k").cast("int").alias("k"), T.field_of("type").alias("event_type"))


@query("symbol_scan", "S18 J12", with_views("SELECT date, symbol, volume FROM quotes WHERE date BETWEEN '1996-01-01' AND '1997-06-30' AND symbol IN (SELECT symbol FROM issued WHERE issued_shares > 1500000)"))
def symbol_scan(spark, sf):
    rich = V.issued(spark, sf).where("issued_shares > 1500000")
    return T.scan_symbols(V.quotes(spark, sf, "1996-01-01", "1997-06-30"), rich, "1996-01-01", "1997-06-30").select("date", "symbol", "volume")


@query("period_range_scan", "S17", with_views("""
WITH t AS (SELECT DISTINCT date FROM monthly UNION SELECT DISTINCT date FROM reports UNION SELECT date FROM calendar), b AS (SELECT date, CASE WHEN date LIKE '%M%' THEN make_date(CAST(substr(date, 1, 4) AS INT), CAST(substr(date, 6, 2) AS INT), 1)
  WHEN date LIKE '%Q%' THEN make_date(CAST(substr(date, 1, 4) AS INT), CAST(substr(date, 6, 1) AS INT) * 3 - 2, 1) ELSE CAST(date AS DATE) END AS f FROM t)
SELECT date FROM b WHERE f <= DATE '1998-08-10' AND (CASE WHEN date LIKE '%M%' THEN last_day(f) WHEN date LIKE '%Q%' THEN last_day(f + INTERVAL 2 MONTH) ELSE f END) >= DATE '1998-02-15'"""))
def period_range_scan(spark, sf):
    tokens = V.monthly(spark, sf).select("date").union(V.reports(spark, sf).select("date")).union(V.calendar(spark, sf)).distinct()
    return T.scan_periods(tokens, "1998-02-15", "1998-08-10")


@query("stock_dimension", "S20 X3", with_views("SELECT printf('%04d', s_suppkey) AS symbol, upper(s_name) AS name, right(s_name, 3) AS tail FROM supplier"))
def stock_dimension(spark, sf):
    raw = V.table(spark, sf, "supplier").select(F.concat(F.lit('="'), F.col("s_suppkey").cast("string"), F.lit('" ')).alias("symbol"), "s_name")
    return T.stock_info(raw).select("symbol", F.upper("s_name").alias("name"), F.right("s_name", F.lit(3)).alias("tail"))


@query("stock_tags", "S20 U5", with_views("""
SELECT DISTINCT symbol, tag FROM (SELECT printf('%04d', l_suppkey) AS symbol, l_returnflag AS tag FROM lineitem UNION ALL SELECT symbol, CAST(industry AS VARCHAR) FROM issued)"""))
def stock_tags(spark, sf):
    scraped = V.table(spark, sf, "lineitem").select(V.symbol_of("l_suppkey").alias("symbol"), F.col("l_returnflag").alias("tag"))
    return T.stock_tags(scraped, V.issued(spark, sf))


@query("symbol_universe", "S21", with_views("SELECT DISTINCT symbol FROM (SELECT date, printf('%04d', CAST(symbol AS INT) * 7) AS symbol FROM month_base) WHERE date = (SELECT max(date) FROM month_base) AND symbol NOT LIKE '00%'"))
def symbol_universe(spark, sf):
    m = V.monthly(spark, sf).withColumn("symbol", V.symbol_of(F.col("symbol").cast("int") * 7))
    return T.symbol_universe(m)


@query("cohort_artifacts", "S19", with_views("SELECT playbook_date, symbol, ml_score FROM scored_base QUALIFY count(*) OVER (PARTITION BY playbook_date) >= 98"))
def cohort_artifacts(spark, sf):
    base = V.scored_base(spark, sf).select("playbook_date", "symbol", "ml_score")
    copy = base.select(F.lit("latest").alias("playbook_date"), "symbol", "ml_score")
    return T.cohort_artifacts(base.union(copy), 98)


# ---- cleaning ---------------------------------------------------------
@query("numeric_cleanse", "P2 P3 X6", with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount FROM lineitem"""))
def numeric_cleanse(spark, sf):
    li = V.table(spark, sf, "lineitem")
    text = F.format_number("l_extendedprice", 2)
    raw = F.when(F.col("l_linenumber") == 1, "--").when(F.col("l_returnflag") == "R", F.concat(F.lit("("), text, F.lit(")"))).otherwise(F.concat(F.lit(" "), text, F.lit("　")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", C.to_signed_number(raw).alias("amount"))


@query("symbol_cleanse", "P4 X1 X3", with_views("SELECT c_custkey, printf('%06d', c_custkey) AS code, lower(c_mktsegment) AS segment, substr(c_name, 1, 8) AS head FROM customer"))
def symbol_cleanse(spark, sf):
    cust = V.table(spark, sf, "customer")
    raw = F.concat(F.lit('="　'), F.col("c_custkey").cast("string"), F.lit(' "'))
    return cust.select("c_custkey", C.clean_symbol(raw, 6).alias("code"), F.lower("c_mktsegment").alias("segment"), F.substring("c_name", 1, 8).alias("head"))


@query("empty_markers", "X6 X2", with_views("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority, contains(o_orderpriority, 'NOT') AS has_not, starts_with(o_orderpriority, '1') AS urgent, regexp_extract(o_orderpriority, '^([0-9]+)-', 1) AS num FROM orders"""))
def empty_markers(spark, sf):
    o = V.table(spark, sf, "orders")
    pri = F.col("o_orderpriority")
    marker = F.when(F.year("o_orderdate") < 1997, "除權").when(F.year("o_orderdate") < 1998, "-----").otherwise(" N/A ")
    raw = F.when(F.col("o_orderstatus") == "F", marker).otherwise(pri)
    return o.select("o_orderkey", C.empty_to_null(raw).alias("priority"), pri.contains("NOT").alias("has_not"), pri.startswith("1").alias("urgent"), F.regexp_extract(pri, "^([0-9]+)-", 1).alias("num"))


@query("typed_equality", "X16", with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_linenumber = 1 THEN true WHEN l_linenumber = 2 THEN false ELSE true END AS same_number, l_linestatus = 'O' AS same_text FROM lineitem"""))
def typed_equality(spark, sf):
    li = V.table(spark, sf, "lineitem")
    stored = F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string")).when(F.col("l_linenumber") == 2, (F.col("l_extendedprice") + 1).cast("string")).otherwise(F.col("l_extendedprice").cast("string"))
    raw = F.when(F.col("l_linenumber") == 1, "--").otherwise(F.format_number("l_extendedprice", 2))
    text = C.same_value(F.lit("open"), F.when(F.col("l_linestatus") == "O", F.lit('"open"')).otherwise(F.lit("shut")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", C.same_value(stored, raw).alias("same_number"), text.alias("same_text"))


@query("safe_arithmetic", "P12 P13 P14 P20 X14", with_views("""
SELECT s_suppkey, rnd(CASE WHEN s_acctbal > 0 THEN 1000 / s_acctbal END, 6) AS positive_only, rnd(1000 / nullif(s_acctbal, 0), 6) AS nonzero, CASE WHEN s_nationkey > 3 THEN least(greatest(s_acctbal, 0), 5000) END AS clipped,
 rnd((s_acctbal - s_nationkey * 100) / abs(nullif(s_nationkey * 100, 0)) * 100, 2) AS yoy, ceil(s_acctbal / 7) AS up, rnd(sqrt(abs(s_acctbal)), 6) AS root, rnd(ln(abs(s_acctbal) + 1), 6) AS log1, floor(s_acctbal / 7) AS down, coalesce(nullif(s_nationkey, 3), -1) AS nation FROM supplier"""))
def safe_arithmetic(spark, sf):
    s = V.table(spark, sf, "supplier")
    bal, nation = F.col("s_acctbal"), F.col("s_nationkey")
    return s.select(
        "s_suppkey", R(N.safe_div_positive(F.lit(1000), bal), 6).alias("positive_only"), R(N.div_nonzero(F.lit(1000), bal), 6).alias("nonzero"),
        N.clip(F.when(nation > 3, bal), 0, 5000).alias("clipped"), N.signed_yoy(bal, nation * 100.0).alias("yoy"), F.ceil(bal / 7).alias("up"),
        R(F.sqrt(F.abs(bal)), 6).alias("root"), R(F.log(F.abs(bal) + 1), 6).alias("log1"), F.floor(bal / 7).alias("down"), F.coalesce(F.nullif(nation, F.lit(3)), F.lit(-1)).alias("nation"),
    )


@query("period_arithmetic", "X7 X8 X9 X10 K18 P21", with_views(f"""
WITH q AS (SELECT DISTINCT date FROM reports)
SELECT date, CASE substr(date, 6, 1) WHEN '1' THEN (CAST(substr(date, 1, 4) AS INT) - 1) || 'Q4' ELSE substr(date, 1, 5) || (CAST(substr(date, 6, 1) AS INT) - 1) END AS previous, (CAST(substr(date, 1, 4) AS INT) + 1) || substr(date, 5) AS next_year,
 CASE substr(date, 6, 1) WHEN '1' THEN substr(date, 1, 4) || '-05-15' WHEN '2' THEN substr(date, 1, 4) || '-08-14' WHEN '3' THEN substr(date, 1, 4) || '-11-14' ELSE (CAST(substr(date, 1, 4) AS INT) + 1) || '-03-31' END AS publish_date,
 substr(date, 1, 4) || {_SPAN} AS span, substr(date, 1, 4) || '0101-' || right({_SPAN}, 8) AS span_to_date FROM q"""))
def period_arithmetic(spark, sf):
    q = V.reports(spark, sf).select("date").distinct()
    return q.select(
        "date", P.shift_quarter("date", -1).alias("previous"), P.shift_quarter("date", 4).alias("next_year"), P.statutory_publish_date("date").alias("publish_date"),
        P.quarter_span("date").alias("span"), P.quarter_span("date", True).alias("span_to_date"),
    )


@query("day_arithmetic", "X7 X8 X9", with_views("""
SELECT date, strftime(CAST(date AS DATE) + 5, '%Y-%m-%d') AS later, strftime(CAST(date AS DATE) - 500, '%Y-%m-%d') AS earlier, CAST(date AS DATE) - DATE '1995-01-01' AS gap, year(CAST(date AS DATE)) || 'M' || strftime(CAST(date AS DATE), '%m') AS month,
 strftime(CAST(date AS DATE) - INTERVAL 1 MONTH, '%YM%m') AS previous_month, date AS from_roc FROM calendar"""))
def day_arithmetic(spark, sf):
    d = F.to_date("date")
    roc = F.concat((F.year(d) - 1911).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月"), F.dayofmonth(d).cast("string"), F.lit("日"))
    return V.calendar(spark, sf).select(
        "date", P.add_days("date", 5).alias("later"), P.add_days("date", -500).alias("earlier"), P.day_gap(F.lit("1995-01-01"), F.col("date")).alias("gap"),
        P.month_of_day("date").alias("month"), P.shift_month(P.month_of_day("date"), -1).alias("previous_month"), P.roc_to_iso(roc).alias("from_roc"),
    )


@query("row_filters", "F1 F2 F9", with_views("""
SELECT date, symbol FROM (SELECT date, symbol, open, CASE WHEN volume < 10 THEN 0 ELSE volume END AS volume FROM quotes) WHERE (coalesce(open, 0) <> 0 OR volume <> 0) AND substr(date, 6, 2) NOT IN ('02', '03')"""))
def row_filters(spark, sf):
    q = V.quotes(spark, sf).withColumn("volume", F.when(F.col("volume") < 10, 0.0).otherwise(F.col("volume")))
    keep = load.any_nonzero(["open", "volume"]) & load.common_stock("symbol") & ~F.substring("date", 6, 2).isin("02", "03")
    return q.where(keep).select("date", "symbol")


@query("set_operations", "U3 U4 U5 T5", with_views("""
WITH a AS (SELECT DISTINCT symbol FROM quotes WHERE volume > 140), b AS (SELECT DISTINCT symbol FROM flows WHERE foreign_net > 90)
SELECT 'only_first' AS part, symbol FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'both', symbol FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'any', symbol FROM (SELECT * FROM a UNION SELECT * FROM b)"""))
def set_operations(spark, sf):
    a = V.quotes(spark, sf).where("volume > 140").select("symbol").distinct()
    b = V.flows(spark, sf).where("foreign_net > 90").select("symbol").distinct()

    def tagged(part, df):
        return df.select(F.lit(part).alias("part"), "symbol")

    return tagged("only_first", a.subtract(b)).union(tagged("both", a.intersect(b))).union(tagged("any", a.union(b).distinct())).orderBy("part", "symbol")


@query("label_overlap", "J24 A20", with_views("SELECT source, count(*) AS docs, count(l.doc_id) AS labeled, rnd(avg(quality), 6) AS quality, rnd(avg((l.doc_id IS NULL)::INT) * 100, 4) AS null_pct FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1"))
def label_overlap(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "source").join(V.table(spark, sf, "labels"), "doc_id", "left")
    agg = d.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.count("quality").alias("labeled"), R(F.avg("quality"), 6).alias("quality"))
    shares = Q.null_shares(d, ["source"], ["quality"], 100).select("source", R("null_pct", 4).alias("null_pct"))
    return agg.join(shares, "source")

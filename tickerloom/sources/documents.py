"""Filing documents as tables (rows S13, S14, S22, F10, F12, J16, P19, C26, C27).

Documents are a table (doc, html). Tags, rows and cells come out by
regexp_extract_all and posexplode inside the JVM; nothing is collected. Facts
meet their account codes by an equi-join per document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions import clean as C
from tickerloom.functions import numbers as N
from tickerloom.functions import periods as P

# fixed values: section markers in the order of a filing
SECTIONS = {
    "balance_sheet": ('<div id="BalanceSheet"></div>', '<div id="StatementOfComprehensiveIncome"></div>'),
    "income_statement": ('<div id="StatementOfComprehensiveIncome"></div>', '<div id="StatementsOfCashFlows"></div>'),
    "cash_flow": ('<div id="StatementsOfCashFlows"></div>', '<div id="StatementsOfChangeInEquity"></div>'),
    "equity_changes": ('<div id="StatementsOfChangeInEquity"></div>', '<div id="ReportOfIndependentAuditors"></div>'),
}
# fixed values: fact names that belong to the cash flow statement
CASH_FLOW_HINTS = ["cashflows", "cashflow", "cashandcashequivalentsatbeginningofperiod", "cashandcashequivalentsatendofperiod"]
CASH_FLOW_PREFIX = "tifrs-scf:"
FACT_TAGS = ("ix:nonFraction", "ix:nonNumeric")
CODE_PATTERN = "^(?:[0-9A-Z]{4}|[A-Z][0-9]{4,5})$"
XBRL_MARKERS = ("ix:nonfraction", "ix:nonnumeric", "xbrli:context")


def split_sections(docs: DataFrame, doc: Sequence[str], html: str, sections: dict[str, tuple[str, str]] = SECTIONS) -> DataFrame:
    """(doc, category, body) per section found, plus one row with category NULL for all text outside sections.

    A section runs from its first marker to its second (case ignored), to the end
    of the document when that is absent.
    """
    marks = list(sections.values())
    df = docs.select(*doc, F.col(html).alias("_html"), F.lower(html).alias("_low"))
    starts = {f"_at{i}": F.locate(s.lower(), F.col("_low")) for i, (s, _) in enumerate(marks)}
    df = df.select(*doc, "_html", "_low", *[c.alias(n) for n, c in starts.items()])
    begin = [F.col(f"_at{i}") + len(s) for i, (s, _) in enumerate(marks)]
    cuts = [F.instr(F.substr("_low", b), e.lower()).alias(f"_cut{i}") for i, (b, (_, e)) in enumerate(zip(begin, marks))]
    df = df.select(*doc, "_html", *starts, *cuts)
    bodies = []
    for i, b in enumerate(begin):
        size = F.when(F.col(f"_cut{i}") > 0, F.col(f"_cut{i}") - 1).otherwise(F.length("_html"))
        bodies.append(F.when(F.col(f"_at{i}") > 0, F.substr("_html", b, size)).alias(f"_body{i}"))
    df = df.select(*doc, "_html", *bodies)
    outside = F.col("_html")
    for i in range(len(marks)):
        # a missing or empty section removes nothing: the stand-in text never occurs
        outside = F.replace(outside, F.coalesce(F.nullif(f"_body{i}", F.lit("")), F.lit("\u0000\u0000")), F.lit(" "))
    parts = [F.struct(F.lit(n).alias("category"), F.col(f"_body{i}").alias("body")) for i, n in enumerate(sections)]
    parts.append(F.struct(F.lit(None).cast("string").alias("category"), outside.alias("body")))
    return df.select(*doc, F.inline(F.array(*parts))).where("body IS NOT NULL")


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, f"(?i)\\b{name}\\s*=\\s*['\"]([^'\"]*)['\"]", 1)


def tagged_facts(parts: DataFrame, doc: Sequence[str], tags: Sequence[str] = FACT_TAGS, name: str = "name", context: str = "contextRef") -> DataFrame:
    """One row per fact tag: name, context, text, number. Facts without text are dropped."""
    union = "|".join(tags)
    whole = F.regexp_extract_all("body", F.lit(f"(?is)<((?:{union}))\\b[^>]*>.*?</\\1>"), F.lit(0))
    df = parts.select(*doc, "category", F.posexplode(whole).alias("fact_pos", "_tag"))
    head = F.regexp_extract("_tag", "^<[^>]*>", 0)
    text = C.strip_tags(F.col("_tag"))
    sign = attribute(head, "sign")
    df = df.select(
        *doc, "category", "fact_pos", F.regexp_extract("_tag", "^<([^\\s>]+)", 1).alias("fact_type"),
        attribute(head, name).alias("fact_name"), attribute(head, context).alias("context_ref"), sign.alias("sign"), text.alias("value_text"),
    ).where("value_text <> ''")
    number = C.to_signed_number(F.nullif("value_text", F.lit("-")))
    signed = F.when((F.col("sign") == "-") & (number > 0), -number).otherwise(number)
    return df.withColumn("value_num", F.when(F.lower("fact_type").endswith("nonfraction"), signed))


def coded_rows(
    parts: DataFrame, doc: Sequence[str], row: str = "tr", cell: str = "td", pattern: str = CODE_PATTERN,
    tags: Sequence[str] = FACT_TAGS, name: str = "name", context: str = "contextRef",
) -> DataFrame:
    """Account code of every fact that stands in a table row whose first cell is a code; the last row wins."""
    rows = F.regexp_extract_all("body", F.lit(f"(?is)<{row}\\b[^>]*>(.*?)</{row}>"), F.lit(1))
    df = parts.where("category IS NOT NULL").select(*doc, "category", F.posexplode(rows).alias("row_pos", "body"))
    cells = F.regexp_extract_all("body", F.lit(f"(?is)<{cell}\\b[^>]*>(.*?)</{cell}>"), F.lit(1))
    df = df.withColumn("_cells", cells).where(F.size("_cells") >= 1)
    code = C.strip_tags(F.element_at("_cells", 1))
    title = C.clean_account_name(C.strip_tags(F.coalesce(F.try_element_at("_cells", F.lit(2)), F.lit(""))))
    df = df.select(*doc, "category", "row_pos", code.alias("account_code"), title.alias("account_name"), "body").where(F.col("account_code").rlike(pattern))
    keyed = [*doc, "row_pos", "account_code", "account_name"]
    inside = tagged_facts(df, keyed, tags, name, context)
    order = F.struct("row_pos", "fact_pos")
    return inside.groupBy(*doc, "category", "fact_name", "context_ref", "value_text").agg(
        F.max_by(F.struct("account_code", "account_name"), order).alias("_c")
    ).select(*doc, "category", "fact_name", "context_ref", "value_text", "_c.account_code", "_c.account_name")


def classify(fact_name: Column, fact_type: Column, context: Column) -> Column:
    """Statement of a fact outside every section, by its name and context."""
    low = F.lower(fact_name)
    cash = low.startswith(CASH_FLOW_PREFIX)
    for hint in CASH_FLOW_HINTS:
        cash = cash | low.contains(hint)
    kind = F.when(context.startswith("AsOf"), "balance_sheet").when(context.contains("ComponentsOfEquity"), "equity_changes")
    return F.when(F.lower(fact_type).endswith("nonfraction"), kind.when(cash, "cash_flow").otherwise("income_statement"))


def period_type(category: Column, context: Column, quarter: Column) -> Column:
    """as_of, quarter, accumulated or both for a current-period fact; NULL for any other period."""
    span, year_span = P.quarter_span(quarter), P.quarter_span(quarter, accumulated=True)
    q_start, q_end = F.substring(span, 1, 8), F.substring(span, 10, 8)
    y_start = F.substring(year_span, 1, 8)
    as_of = F.regexp_extract(context, "^AsOf([0-9]{8})", 1)
    start = F.regexp_extract(context, "^From([0-9]{8})To[0-9]{8}", 1)
    end = F.regexp_extract(context, "^From[0-9]{8}To([0-9]{8})", 1)
    flow = category.isin("income_statement", "cash_flow") & (end == q_end)
    kinds = F.array_compact(
        F.array(
            F.when(category.isin("balance_sheet", "cash_flow") & (as_of == q_end), "as_of"),
            F.when(flow & (start == q_start), "quarter"),
            F.when(flow & (start == y_start), "accumulated"),
        )
    )
    return kinds


def statement_facts(docs: DataFrame, html: str = "html") -> DataFrame:
    """Typed facts of filings (date, symbol, publish_time, html), with account codes and period types.

    A fact that a filing states twice (same account, value and context) fails the job.
    """
    doc = ["date", "symbol", "publish_time"]
    parts = split_sections(docs, doc, html)
    facts = tagged_facts(parts, doc)
    placed = facts.withColumn(
        "category", F.coalesce("category", classify(F.col("fact_name"), F.col("fact_type"), F.col("context_ref")))
    )
    codes = coded_rows(parts, doc)
    key = [*doc, "category", "fact_name", "context_ref", "value_text"]
    df = placed.where("category <> 'equity_changes'").join(codes, key)
    df = df.withColumn("period_type", F.explode(period_type(F.col("category"), F.col("context_ref"), F.col("date"))))
    # Contexts of one period may show one value twice (members of equity); the same fact of one context may not stand twice.
    shown = [*doc, "category", "period_type", "account_code", "account_name", "value_text", "value_num"]
    once = df.groupBy(*shown, "context_ref").agg(F.count(F.lit(1)).alias("_n"))
    said = F.concat(F.lit("duplicate fact "), "account_code", F.lit(" of "), "symbol", F.lit(" in "), "date")
    checked = F.when(F.col("_n") == 1, F.col("account_code")).otherwise(F.raise_error(said).cast("string"))
    return once.withColumn("account_code", checked).select(*shown)


def fill_fourth_quarter(facts: DataFrame) -> DataFrame:
    """Single-quarter rows of a fourth quarter where missing: year to date less third quarter to date.

    Without a third-quarter value the year-to-date value stands in.
    """
    key = ["symbol", "account_code"]
    quarter = facts.where("period_type = 'quarter'")
    acc = facts.where("period_type = 'accumulated' AND value_num IS NOT NULL")
    q4 = acc.where(F.col("date").endswith("Q4"))
    q3 = acc.where(F.col("date").endswith("Q3")).select(
        P.shift_quarter("date", 1).alias("date"), *key, F.col("value_num").alias("_q3")
    )
    missing = q4.join(quarter.select("date", *key), ["date", *key], "left_anti").join(q3, ["date", *key], "left")
    made = missing.withColumn("value_num", F.col("value_num") - F.coalesce("_q3", F.lit(0.0))).withColumn("period_type", F.lit("quarter"))
    return facts.unionByName(made.select(*facts.columns))


def document_meta(docs: DataFrame, html: str, fields: dict[str, str], tag: str = "ix:nonNumeric", attr: str = "name") -> DataFrame:
    """Text of named tags as columns: column to attribute value."""
    out = {}
    for column, value in fields.items():
        pattern = f"(?is)<{tag}\\b[^>]*\\b{attr}\\s*=\\s*['\"]{value}['\"][^>]*>(.*?)</{tag}>"
        out[column] = F.nullif(C.strip_tags(F.regexp_extract(html, pattern, 1)), F.lit(""))
    return docs.withColumns(out)


def report_basis(c: Column | str) -> Column:
    """individual or consolidated; the non-consolidated wording contains the other and is tested first."""
    s = F.lower(F.trim(C.col(c)))
    return F.when(s.contains("individual") | s.rlike("non-?\\s*consolidated"), "individual").when(s.contains("consolidated"), "consolidated")


def market_name(c: Column | str) -> Column:
    s = F.lower(F.trim(C.col(c)))
    return F.when(s.contains("listed"), "sii").when(s.contains("otc") | s.contains("over-the-counter"), "otc").otherwise(s)


def reject_reason(html: Column | str, min_bytes: int, markers: Sequence[str] = XBRL_MARKERS) -> Column:
    """Why a stored document is not a valid report; NULL when it is one."""
    text = F.lower(C.col(html))
    marked = F.lit(False)
    for m in markers:
        marked = marked | text.contains(m.lower())
    return (
        F.when(F.octet_length(C.col(html)) < min_bytes, "too_small")
        .when(~text.contains("<html"), "invalid_html").when(~marked, "no_xbrl_markers")
    )


def html_table_rows(docs: DataFrame, doc: str, html: str, row: str = "tr", cell: str = "t[dh]", search_rows: int = 5, header_word: str = "代號") -> DataFrame:
    """Rows of stored HTML tables as (doc, row_pos, header, fields).

    The header is the first of the first rows that holds the word; without one
    the header is NULL and fields are taken by position.
    """
    rows = F.regexp_extract_all(html, F.lit(f"(?is)<{row}\\b[^>]*>(.*?)</{row}>"), F.lit(1))
    df = docs.select(doc, F.posexplode(rows).alias("row_pos", "_row"))
    cells = F.regexp_extract_all("_row", F.lit(f"(?is)<{cell}\\b[^>]*>(.*?)</{cell}>"), F.lit(1))
    df = df.select(doc, "row_pos", F.transform(cells, C.strip_tags).alias("fields"))
    has_word = F.exists("fields", lambda f: f.contains(header_word)) & (F.col("row_pos") < search_rows)
    head = df.where(has_word).groupBy(doc).agg(F.min("row_pos").alias("_h"), F.min_by("fields", "row_pos").alias("header"))
    joined = df.join(head, doc, "left")
    return joined.where(F.col("_h").isNull() | (F.col("row_pos") > F.col("_h"))).drop("_h")


# ---- tables as grids ---------------------------------------------------
class _Tables(HTMLParser):
    """The tables of a page as grids of texts: a cell that spans rows or columns fills all its places."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.grids: list[list[list[str]]] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append({"grid": [], "spans": {}, "cell": None})
        elif self.open and tag == "tr":
            self._end_cell()
            self._end_row()
            self.open[-1]["row"] = {}
        elif self.open and tag in ("td", "th"):
            self._end_cell()
            if self.open[-1].get("row") is None:
                self.open[-1]["row"] = {}
            size = {k: max(1, int(v)) for k, v in attrs if k in ("rowspan", "colspan") and (v or "").isdigit()}
            self.open[-1]["cell"] = (size.get("rowspan", 1), min(size.get("colspan", 1), 1000), [])

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag in ("td", "th", "tr", "table"):
            self._end_cell()
        if tag in ("tr", "table"):
            self._end_row()
        if tag == "table":
            self.grids.append(self.open.pop()["grid"])

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][2].append(data)

    def _end_cell(self) -> None:
        table = self.open[-1]
        if table["cell"] is None:
            return
        rows, columns, parts = table["cell"]
        table["cell"] = None
        row, at = table["row"], 0
        while at in row or at in table["spans"]:
            at += 1
        text = " ".join("".join(parts).split())
        for c in range(at, at + columns):
            row[c] = text
            if rows > 1:
                table["spans"][c] = (rows, text)

    def _end_row(self) -> None:
        table = self.open[-1]
        row = table.get("row")
        if row is None:
            return
        spans = {}
        for c, (left, text) in table["spans"].items():
            row.setdefault(c, text)
            if left > 1:
                spans[c] = (left - 1, text)
        table["spans"], table["row"] = spans, None
        table["grid"].append([row.get(c, "") for c in range(max(row) + 1)] if row else [])


def _grids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for doc, html in zip(pdf["doc"], pdf["html"]):
            parser = _Tables()
            parser.feed(html or "")
            out += [(doc, t, r, fields) for t, grid in enumerate(parser.grids) for r, fields in enumerate(grid)]
        yield pd.DataFrame(out, columns=["doc", "table_pos", "row_pos", "fields"])


def table_grid(docs: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, table_pos, row_pos, fields): the rows of every table, spans filled in. One document is one row of Arrow input."""
    kind = docs.schema[doc].dataType.simpleString()
    cells = docs.select(F.col(doc).alias("doc"), F.col(html).alias("html")).mapInPandas(_grids, f"doc {kind}, table_pos int, row_pos int, fields array<string>")
    return cells.withColumnRenamed("doc", doc)


# fixed values: columns of a revenue table without a header row, in order
REVENUE_COLUMNS = [
    "公司代號", "公司名稱", "當月營收", "上月營收", "去年當月營收", "上月比較增減(%)", "去年同月增減(%)", "當月累計營收", "去年累計營收", "前期比較增減(%)", "備註",
]


def _contains(word: str):
    return lambda f: f.contains(word)


def named_rows(
    grid: DataFrame, doc: str, needed: Sequence[str] = ("公司代號", "當月營收"), positional: Sequence[str] = tuple(REVENUE_COLUMNS),
    code: str = "公司代號", search_rows: int = 5, least_columns: int = 5, least_positional: int = 10,
) -> DataFrame:
    """(doc, table_pos, row_pos, named_by, fields): data rows of the tables of `table_grid`, as maps of column to text.

    The header of a table is the first of its first rows that holds all `needed` words (blanks ignored). A table without
    one is read by position if a code stands first in one of those rows and it is wide enough; narrow tables
    and all others are left out, as are rows without a code (totals, notes).
    """
    plain = F.transform("fields", lambda f: F.regexp_replace(f, "\\s", ""))
    rows = grid.withColumn("_plain", plain)
    near = F.col("row_pos") < search_rows
    has = F.lit(True)
    for word in needed:
        has = has & F.exists("_plain", _contains(word))
    tables = rows.groupBy(doc, "table_pos").agg(
        F.max(F.size("fields")).alias("_wide"), F.min(F.when(near & has, F.struct("row_pos", "_plain"))).alias("_head"),
        F.max(near & F.coalesce(F.get("_plain", F.lit(0)), F.lit("")).rlike("^[0-9]{4}")).alias("_coded"),
    )
    by_place = F.transform(F.sequence(F.lit(1), F.col("_wide")), lambda i: F.coalesce(F.get(F.array(*map(F.lit, positional)), i - 1), F.concat(F.lit("Unknown_"), (i - 1).cast("string"))))
    found = F.col("_head").isNotNull()
    tables = tables.where(F.col("_wide") >= least_columns).where(found | (F.col("_coded") & (F.col("_wide") >= least_positional))).select(
        doc, "table_pos", F.when(found, "header").otherwise("position").alias("named_by"), F.col("_head.row_pos").alias("_at"),
        F.when(found, F.col("_head._plain")).otherwise(by_place).alias("_names"),
    )
    joined = rows.join(tables, [doc, "table_pos"]).where(F.col("_at").isNull() | (F.col("row_pos") > F.col("_at")))
    # A name that a header repeats keeps its first column.
    pairs = F.zip_with("_names", "fields", lambda n, t: F.struct(n.alias("name"), F.coalesce(t, F.lit("")).alias("text")))
    pairs = F.filter(pairs, lambda p: p["name"].isNotNull() & (p["name"] != ""))
    first = F.aggregate(
        pairs, F.array().cast("array<struct<name:string,text:string>>"),
        lambda a, p: F.when(F.exists(a, lambda x: x["name"] == p["name"]), a).otherwise(F.array_append(a, F.struct(p["name"].alias("name"), p["text"].alias("text")))),
    )
    made = joined.select(doc, "table_pos", "row_pos", "named_by", F.map_from_entries(first).alias("fields"))
    return made.where(F.try_element_at("fields", F.lit(code)).rlike("^[0-9]{4}[A-Za-z0-9]*$"))


# ---- quarterly report -------------------------------------------------
INCOME = {"revenue": "4000", "op_income": "6900", "non_op_income": "7000", "pretax_income": "7900", "eps": "9750"}
NET_INCOME = {"consolidated": "8610", "individual": "8200"}
# fixed values: prepayment accounts left out of quick assets
PREPAID = ["1280", "1410", "1411", "1412", "1414", "1419", "1421"]


def quarterly_report(facts: DataFrame, basis: DataFrame) -> DataFrame:
    """One wide row per (quarter, symbol): quarter and year-to-date income, last year's, growth, ratios.

    `basis` has report_category per (date, symbol); it decides which account is
    net income, for last year by that quarter's own category.
    """
    codes = [*INCOME.values(), *NET_INCOME.values()]
    items = [*INCOME, "net_income"]

    def income(period: str) -> DataFrame:
        p = facts.where(F.col("period_type") == period).groupBy("date", "symbol").pivot("account_code", codes).agg(F.max("value_num"))
        p = p.join(basis, ["date", "symbol"])
        net = F.when(F.col("report_category") == "consolidated", F.col(NET_INCOME["consolidated"])).when(
            F.col("report_category") == "individual", F.col(NET_INCOME["individual"])
        ).otherwise(F.raise_error(F.lit("unknown report category")).cast("double"))
        return p.select("date", "symbol", *[F.col(c).alias(k) for k, c in INCOME.items()], net.alias("net_income"))

    q, acc = income("quarter"), income("accumulated")
    last = acc.select(P.shift_quarter("date", 4).alias("date"), "symbol", *[F.col(i).alias(f"{i}_acc_ly") for i in items])
    balance_codes = ["1XXX", "11XX", "130X", "21XX", "3XXX", "3110", *PREPAID]
    b = facts.where("period_type = 'as_of'").groupBy("date", "symbol").pivot("account_code", balance_codes).agg(F.max("value_num"))
    c = F.col
    prepaid = F.aggregate(F.array(*[F.coalesce(p, F.lit(0.0)) for p in PREPAID]), F.lit(0.0), lambda a, x: a + x)
    b = b.select(
        "date", "symbol", c("3110").alias("capital"), N.rnd(N.div_nonzero(c("3XXX"), c("3110") / 10), 2).alias("nav_per_share"),
        (N.div_nonzero("3XXX", "1XXX") * 100).alias("equity_to_assets_ratio"), N.div_nonzero("11XX", "21XX").alias("current_ratio"),
        N.div_nonzero(c("11XX") - c("130X") - prepaid, "21XX").alias("quick_ratio"),
    )
    df = q.select("date", "symbol", *[c(i).alias(f"{i}_q") for i in items])
    df = df.join(acc.select("date", "symbol", *[c(i).alias(f"{i}_acc") for i in items]), ["date", "symbol"], "full_outer")
    df = df.join(last, ["date", "symbol"], "left").join(b, ["date", "symbol"], "left").join(basis, ["date", "symbol"], "left")
    growth = {f"{i}_acc_yoy": N.signed_yoy(f"{i}_acc", f"{i}_acc_ly") for i in items}
    spans = {"period_quarter": P.quarter_span("date"), "period_accumulated": P.quarter_span("date", True)}
    return df.withColumns({**growth, **spans})


def backfill_blank(df: DataFrame, second: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Blank columns only are filled from a second source."""
    other = second.select(*keys, *[F.col(c).alias(f"_2_{c}") for c in columns])
    joined = df.join(other, list(keys), "left")
    return joined.withColumns({c: F.coalesce(c, f"_2_{c}") for c in columns}).select(*df.columns)

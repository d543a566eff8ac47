"""Delimited exchange reports (rows S1-S12, P1, P5-P7).

A report file has a preamble, one or two header lines, data, and footers. Files
become lines (src_file, src_row, value); everything after that is joins and
filters over lines, one small header row per file. A file is one market's report
of one day, so reading it whole is bounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.functions import clean as C

# fixed values: words that identify header, category and footer lines
HEADER_WORDS = ["證券代號", "代號"]
INDEX_WORD = "指數"
INDEX_CLOSE_WORD = "收盤指數"
CATEGORY_WORDS = ["融資", "融券", "借券"]
FOOTER_STARTS = ["說明:", "Total"]
FOOTER_EXACT = "以上"

# fixed values: institution names in the summary report
INSTITUTIONS = {
    "自營商(自行買賣)": "dealer_self",
    "自營商(避險)": "dealer_hedge",
    "投信": "investment_trust",
    "外資及陸資(不含外資自營商)": "foreign_investors",
    "外資及陸資(不含自營商)": "foreign_investors",
    "外資自營商": "foreign_dealer",
    "外資及陸資合計": "foreign_total",
    "自營商合計": "dealer_total",
    "合計": "total",
    "三大法人合計*": "total",
    "三大法人合計": "total",
}
KEPT_INSTITUTIONS = ["dealer_self", "dealer_hedge", "investment_trust", "foreign_investors", "foreign_dealer", "total"]

# fixed values: shareholding levels
LEVEL_NAMES = {
    "1": "1-999", "2": "1,000-5,000", "3": "5,001-10,000", "4": "10,001-15,000", "5": "15,001-20,000",
    "6": "20,001-30,000", "7": "30,001-40,000", "8": "40,001-50,000", "9": "50,001-100,000", "10": "100,001-200,000",
    "11": "200,001-400,000", "12": "400,001-600,000", "13": "600,001-800,000", "14": "800,001-1,000,000", "15": "1,000,001以上",
}


# ---- files to lines ---------------------------------------------------
SLICE_ROWS = 64


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: a batch has thousands of them, and whole files as Python text take several times its size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _text(raw: bytes) -> str:
    """UTF-8 first, else the exchange's legacy Big5 code page with replacement marks."""
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("cp950", errors="replace")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = pa.array([_text(raw) for raw in part["content"].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([part["src_file"], texts], ["src_file", "text"])


def decode_files(files: DataFrame) -> DataFrame:
    """(src_file, content bytes) to (src_file, text)."""
    return files.select("src_file", "content").mapInArrow(_decode, "src_file string, text string")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files under a path as (src_file, text); SQL decode has no Big5, so bytes go through Arrow."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return decode_files(files.select(F.col("path").alias("src_file"), "content"))


def to_lines(files: DataFrame) -> DataFrame:
    """(src_file, text) to (src_file, src_row, value), rows counted from 1."""
    lines = F.split(F.regexp_replace("text", "\\r?\\n$", ""), "\\r?\\n")
    return files.select("src_file", F.posexplode(lines).alias("_pos", "value")).select(
        "src_file", (F.col("_pos") + 1).alias("src_row"), F.regexp_replace("value", C.BYTE_ORDER_MARK, "").alias("value")
    )


def with_path_columns(df: DataFrame) -> DataFrame:
    """date and market from `.../YYYY/YYYYMMDD/market.csv` or `.../date=YYYYMMDD/market.csv`."""
    day = F.regexp_extract("src_file", "(?:/|date=)([0-9]{8})/[^/]+$", 1)
    market = F.regexp_extract("src_file", "/([A-Za-z]+)\\.csv$", 1)
    iso = F.date_format(F.to_date(F.when(day != "", day), "yyyyMMdd"), "yyyy-MM-dd")
    return df.withColumn("date", iso).withColumn("market", F.lower(market))


# ---- lines to tables --------------------------------------------------
def commas(c: Column | str) -> Column:
    return F.length(C.col(c)) - F.length(F.replace(C.col(c), F.lit(","), F.lit("")))


def raw_fields(c: Column | str) -> Column:
    """Comma-separated parts of a line; commas within quotes do not split."""
    return F.split(C.col(c), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')


def clean_field(c: Column) -> Column:
    """A field without its quotes and edge blanks (a leading = of a spreadsheet code goes as well)."""
    return F.trim(F.regexp_replace(c, '^\\s*=?"|"', ""))


def split_fields(c: Column | str) -> Column:
    """All fields of a line, cleaned."""
    return F.transform(raw_fields(c), clean_field)


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def header_rows(lines: DataFrame, words: Sequence[str] = HEADER_WORDS, index_report: bool = False) -> DataFrame:
    """First header line per file with its field names; a category line above it is merged in.

    Category names run on to the right until the next one and give `category-field`.
    """
    plain = F.replace(F.col("value"), F.lit('"'), F.lit(""))
    wanted = [*words, INDEX_WORD] if index_report else list(words)
    is_header = _contains_any(plain, wanted) & (commas(plain) >= 3)
    if not index_report:
        is_header = is_header & ~plain.contains(INDEX_CLOSE_WORD)
    is_category = _contains_any(plain, CATEGORY_WORDS) & (commas(plain) >= 3)
    first = lines.where(is_header).groupBy("src_file").agg(
        F.min("src_row").alias("header_row"), F.min_by("value", "src_row").alias("_head")
    )
    above = lines.where(is_category).select("src_file", (F.col("src_row") + 1).alias("header_row"), F.col("value").alias("_cat"))
    head = first.join(above, ["src_file", "header_row"], "left")
    names, cats = split_fields("_head"), split_fields("_cat")
    merged = merge_header(cats, names)
    return head.select("src_file", "header_row", F.when(F.col("_cat").isNull(), names).otherwise(merged).alias("header"))


def merge_header(cats: Column, names: Column) -> Column:
    """Two header rows to one. The running category is carried along by a fold over the few fields."""
    filled = F.aggregate(
        F.sequence(F.lit(1), F.size(names)),
        F.array().cast("array<string>"),
        lambda acc, i: F.concat(
            acc,
            F.array(F.coalesce(F.nullif(F.try_element_at(cats, i), F.lit("")), F.try_element_at(acc, F.lit(-1)), F.lit(""))),
        ),
    )
    return F.zip_with(
        filled, names, lambda c, n: F.when((c != "") & (n != ""), F.concat_ws("-", c, n)).when(n != "", n).otherwise(c)
    )


def report_lines(lines: DataFrame, head: DataFrame) -> DataFrame:
    """Data lines below the header joined with it; footers and lines without a first field are dropped."""
    body = lines.join(head, "src_file").where(F.col("src_row") > F.col("header_row"))
    first = clean_field(F.regexp_extract("value", '^\\s*(="[^"]*"|"[^"]*"|[^,]*)', 1))
    footer = first == FOOTER_EXACT
    for start in FOOTER_STARTS:
        footer = footer | first.startswith(start)
    return body.where((first != "") & ~footer).withColumn("_raw", raw_fields("value"))


def report_rows(lines: DataFrame, words: Sequence[str] = HEADER_WORDS, index_report: bool = False) -> DataFrame:
    """Data rows as (src_file, src_row, header, fields); ragged rows are padded or cut to the header."""
    body = report_lines(lines, header_rows(lines, words, index_report))
    width = F.size("header")
    padded = F.concat(F.transform("_raw", clean_field), F.array_repeat(F.lit(""), width))
    return body.select("src_file", "src_row", "header", F.slice(padded, 1, width).alias("fields"))


def _places(head: DataFrame, mapping: dict[str, str], wanted: Sequence[str], ignore: Sequence[str], contains: bool) -> DataFrame:
    """Per file the field number of each wanted column. Runs on the header rows only, one per file."""

    def normal(h: Column) -> Column:
        return F.regexp_replace(h, "[\\s　]+", "")

    def target(h: Column) -> Column:
        if contains:
            known = F.lit(None).cast("string")
            for raw, name in reversed(list(mapping.items())):
                known = F.when(normal(h).contains(raw), F.lit(name)).otherwise(known)
        else:
            known = C.map_literal(mapping, normal(h))
            known = F.coalesce(known, F.when(h.contains("代號"), F.lit("symbol")).when(h.contains("名稱"), F.lit("name")))
        skip = normal(h).isin(["", *ignore])
        return F.when(known.isNotNull(), known).when(skip, F.lit("")).otherwise(
            F.raise_error(F.concat(F.lit("unknown report column: "), h)).cast("string")
        )

    named = head.withColumn("_names", F.transform("header", target))
    at = [F.nullif(F.array_position("_names", n).cast("int"), F.lit(0)).alias(f"_at_{n}") for n in wanted]
    df = named.select("src_file", "header_row", F.size("header").alias("_width"), "_names", *at)
    numbers = [F.coalesce(F.col(f"_at_{n}").cast("string"), F.lit("x")) for n in wanted]
    # an unknown name must fail even when no wanted column needs it
    checked = F.array_max("_names").isNotNull()
    return df.withColumn("src_col", F.concat_ws("#", *numbers)).where(checked).drop("_names")


def report_table(
    lines: DataFrame, mapping: dict[str, str], words: Sequence[str] = HEADER_WORDS, ignore: Sequence[str] = (), contains: bool = False,
    wanted: Sequence[str] | None = None, index_report: bool = False,
) -> DataFrame:
    """Fields under their table names, with `src_col` holding their 1-based field numbers.

    `mapping` is raw name to column; an unmapped header fails the job. With
    `contains`, a raw name matches inside a header. Names are resolved once per
    file; a row then only picks its wanted fields. Of a repeated column the first
    counts; fields beyond a short row are NULL.
    """
    wanted = list(dict.fromkeys(mapping.values() if wanted is None else wanted))
    head = header_rows(lines, words, index_report)
    body = report_lines(lines, _places(head, mapping, wanted, ignore, contains))
    picked = [clean_field(F.try_element_at("_raw", F.col(f"_at_{n}"))).alias(n) for n in wanted]
    return body.select("src_file", "src_row", *picked, "src_col")


def enforce_schema(df: DataFrame, schema: dict[str, str], keep: Sequence[str] = ("src_file", "src_row", "src_col")) -> DataFrame:
    """Exactly the table's columns in order: missing ones NULL, numbers cast tolerantly."""
    out = []
    for name, kind in schema.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif kind == "double":
            out.append(C.to_signed_number(F.col(name).cast("string")).alias(name))
        else:
            out.append(F.col(name).cast("string").try_cast(kind).alias(name))
    return df.select(*out, *[c for c in keep if c in df.columns])


def daily_report(lines: DataFrame, mapping: dict[str, str], schema: dict[str, str], ignore: Sequence[str] = ()) -> DataFrame:
    """One market-day report to its table: date and market from the path, four-digit symbols only."""
    wanted = [c for c in schema if c in set(mapping.values()) and c not in ("date", "market")]
    df = with_path_columns(report_table(lines, mapping, ignore=ignore, wanted=wanted))
    df = df.withColumn("symbol", C.clean_symbol("symbol")).where(F.col("symbol").rlike("^[0-9]{4}$"))
    return enforce_schema(df, schema)


def index_block(lines: DataFrame) -> DataFrame:
    """Index rows inside a quotes report: from the closing-index header until the commas stop.

    Headers repeated within the block are dropped; the sign column, where there
    is one, is applied to the change.
    """
    few = lines.where(F.col("value").contains(INDEX_CLOSE_WORD)).groupBy("src_file").agg(
        F.min("src_row").alias("start"), F.min_by("value", "src_row").alias("_head")
    )
    after = lines.join(few, "src_file").where(F.col("src_row") >= F.col("start"))
    stop = after.where(commas("value") < 2).groupBy("src_file").agg(F.min("src_row").alias("stop"))
    block = after.join(stop, "src_file", "left").where(F.col("stop").isNull() | (F.col("src_row") < F.col("stop")))
    header, fields = split_fields("_head"), split_fields("value")

    def field(*names: str) -> Column:
        at = F.greatest(*[F.array_position(header, n) for n in names], F.lit(0))
        return F.when(at > 0, F.try_element_at(fields, at.cast("int")))

    name, close = field("指數", "報酬指數"), C.to_number(field(INDEX_CLOSE_WORD))
    signed = C.signed_change(field("漲跌(+/-)"), field("漲跌點數"))
    change = F.when(F.array_contains(header, "漲跌(+/-)"), signed).otherwise(C.to_number(field("漲跌點數", "漲跌")))
    out = block.where(F.col("src_row") > F.col("start")).select(
        "src_file", "src_row", name.alias("index_name"), close.alias("index_close"), change.alias("index_change_points")
    )
    return out.where((F.col("index_name") != "指數") & F.col("index_close").isNotNull())


def institution_summary(lines: DataFrame) -> DataFrame:
    """Institution totals: header on line 1, columns found by the words in their names."""
    head = lines.where("src_row = 1").select("src_file", split_fields("value").alias("header"))
    rows = lines.where("src_row > 1").join(head, "src_file").withColumn("fields", split_fields("value"))

    def field(*words: str) -> Column:
        hit = F.filter(F.sequence(F.lit(1), F.size("header")), lambda i: _contains_any(F.element_at("header", i), words))
        return F.try_element_at("fields", F.try_element_at(hit, F.lit(1)))

    name = C.map_literal(INSTITUTIONS, C.strip_text(field("單位名稱")))
    df = rows.select(
        "src_file", "src_row", name.alias("institution"), C.to_number(field("買進")).alias("buy"),
        C.to_number(field("賣出")).alias("sell"), C.to_number(field("差額", "買賣超")).alias("net"),
    )
    return with_path_columns(df.where(F.col("institution").isin(KEPT_INSTITUTIONS)))


def margin_summary(lines: DataFrame) -> DataFrame:
    """Market totals of margin trading: the first four lines of one market's report, the last five of the other's.

    The second market's total line holds both the long and the short item.
    """
    listed = lines.where(F.col("src_file").rlike("/sii\\.csv$") & F.col("src_row").between(2, 4)).withColumn("f", split_fields("value"))
    item = F.element_at("f", 1)

    def row(name: Column, buy: int, sell: int, repay: int, prev: int, today: int) -> Column:
        at = dict(zip(("buy", "sell", "cash_repay", "prev_balance", "today_balance"), (buy, sell, repay, prev, today)))
        return F.struct(name.alias("item"), *[C.to_number(F.try_element_at("f", F.lit(i))).alias(k) for k, i in at.items()])

    one = listed.where(item.contains("融資") | item.contains("融券")).select(
        "src_file", "src_row", F.inline(F.array(row(item, 2, 3, 4, 5, 6)))
    )
    size = lines.where(F.col("src_file").rlike("/otc\\.csv$")).groupBy("src_file").agg(F.max("src_row").alias("_n"))
    tail = lines.join(size, "src_file").where(F.col("src_row") > F.col("_n") - 5).withColumn("f", split_fields("value"))
    total = item.contains("合計(張)") & (F.size("f") >= 15)
    money = item.contains("融資金(仟元)") & (F.size("f") >= 7)
    both = F.array(row(F.lit("融資(交易單位)"), 4, 5, 6, 3, 7), row(F.lit("融券(交易單位)"), 13, 12, 14, 11, 15))
    amount = F.array(row(F.lit("融資金額(仟元)"), 4, 5, 6, 3, 7))
    two = tail.where(total | money).select("src_file", "src_row", F.inline(F.when(total, both).otherwise(amount)))
    market = F.when(F.col("src_file").rlike("/sii\\.csv$"), "sii").otherwise("otc")
    return with_path_columns(one.unionByName(two)).withColumn("market", market)


def shareholder_snapshot(lines: DataFrame) -> DataFrame:
    """Shareholder distribution: rows are numbered before levels above 15 are dropped."""
    f = split_fields("value")
    df = lines.where("src_row > 1").select(
        "src_file", "src_row", F.try_element_at(f, F.lit(1)).alias("date"), F.trim(F.try_element_at(f, F.lit(2))).alias("symbol"),
        F.try_element_at(f, F.lit(3)).try_cast("int").alias("level"), F.try_element_at(f, F.lit(4)).try_cast("bigint").alias("holders"),
        F.try_element_at(f, F.lit(5)).try_cast("bigint").alias("shares"), C.to_number(F.try_element_at(f, F.lit(6))).alias("percentage"),
    )
    return df.where("level <= 15").withColumn("level_name", C.map_literal(LEVEL_NAMES, F.col("level").cast("string")))


def complete_snapshots(rows: DataFrame, levels: int = 15) -> DataFrame:
    """Per-symbol snapshots united in one bulk table; symbols without exactly all levels are dropped."""
    n = rows.groupBy("date", "symbol").agg(F.count(F.lit(1)).alias("_n"))
    return rows.join(n.where(F.col("_n") == levels), ["date", "symbol"], "left_semi")


def preferred_files(files: DataFrame, folder: Column, name: str = "file_name") -> DataFrame:
    """Per folder: market.csv if present, else tmp.csv, else all files."""
    rank = F.when(F.col(name) == "market.csv", 1).when(F.col(name) == "tmp.csv", 2).otherwise(3)
    df = files.withColumn("_folder", folder).withColumn("_rank", rank)
    best = df.groupBy("_folder").agg(F.min("_rank").alias("_rank"))
    return df.join(best, ["_folder", "_rank"], "left_semi").drop("_folder", "_rank")


def monthly_revenue(lines: DataFrame, mapping: dict[str, str], ignore: Sequence[str] = (), english: bool = False) -> DataFrame:
    """Monthly revenue report: exact names in English files, contained names otherwise."""
    words = ["symbol"] if english else ["公司代號"]
    df = report_table(lines, mapping, words, ignore, contains=not english)
    numbers = [c for c in dict.fromkeys(mapping.values()) if c not in ("symbol", "name", "market", "comment", "publish_time")]
    df = df.withColumns({c: C.to_signed_number(c) for c in numbers})
    return df.where(F.col("symbol").rlike("^[0-9]+$"))


def revenue_reports(lines: DataFrame) -> DataFrame:
    """Monthly revenue reports in either language, all columns, with month and market.

    A file whose header (in its first five lines) has a field `symbol` is English and read by exact names, any other by
    contained names. The market is that of the row if the report has one, else that of the file's name.
    """
    near = lines.where(F.col("src_row") <= 5).where(F.exists(split_fields("value"), lambda f: f == "symbol"))
    english = near.select("src_file").distinct()
    columns = [c for c in dict.fromkeys(schemas.REVENUE_NAMES_EN.values())]
    parts = [
        monthly_revenue(lines.join(english, "src_file", "left_anti"), schemas.REVENUE_NAMES).withColumn("market", F.lit(None).cast("string")),
        monthly_revenue(lines.join(english, "src_file", "left_semi"), schemas.REVENUE_NAMES_EN, english=True),
    ]
    df = parts[0].select("src_file", "src_row", *columns).unionByName(parts[1].select("src_file", "src_row", *columns))
    named = F.lower(F.regexp_extract("src_file", "/([A-Za-z]+)\\.csv$", 1))
    return df.withColumn("market", F.coalesce(F.nullif(F.trim("market"), F.lit("")), named)).withColumn(
        "date", F.regexp_extract("src_file", "/([0-9]{4}M[0-9]{2})/", 1)
    )


def dividends(lines: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Dividend report: header in the first five rows, local calendar dates, four-digit symbols."""
    from tickerloom.functions.periods import roc_to_iso

    head = header_rows(lines.where("src_row <= 5"), ["股票代號"])
    body = lines.join(head, "src_file").where(F.col("src_row") > F.col("header_row")).withColumn("fields", split_fields("value"))

    def field(raw: str) -> Column:
        return F.try_element_at("fields", F.nullif(F.array_position("header", raw).cast("int"), F.lit(0)))

    df = body.select("src_file", "src_row", *[field(raw).alias(name) for raw, name in mapping.items()])
    df = df.withColumn("date", roc_to_iso("date")).withColumn("symbol", F.trim("symbol"))
    df = df.where(F.col("symbol").rlike("^[0-9]{4}$") & F.col("date").isNotNull())
    numbers = [c for c in mapping.values() if c not in ("date", "symbol", "name", "type")]
    return df.withColumns({c: C.to_signed_number(c) for c in numbers})


def scan_days(df: DataFrame, start: str | None, end: str | None, date: str = "date") -> DataFrame:
    """Day range filter on the partition column, in either of the two folder layouts."""
    if start:
        df = df.where(F.col(date) >= start)
    if end:
        df = df.where(F.col(date) <= end)
    return df

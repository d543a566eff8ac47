"""Versions of a replaced table, and loads by category."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickerloom.jobs import ingest
from tickerloom.sinks import versions
from tickerloom.sources import documents
from test_jobs import FILING


def test_readers_see_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    assert versions.replace_table(spark.range(5).toDF("x"), path) == 1
    before = versions.read_table(spark, path)
    assert versions.replace_table(spark.range(5, 8).toDF("x"), path) == 2
    assert rows(before, "x") == [(i,) for i in range(5)]  # a reader that began before keeps its version
    assert rows(versions.read_table(spark, path), "x") == [(5,), (6,), (7,)]
    assert versions.read_table(spark, path, 1).count() == 5


def test_failed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5).toDF("x"), path)
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken, path)
    assert [n for n, _ in versions.commits(spark, path)] == [1] and versions.read_table(spark, path).count() == 5
    assert versions.replace_table(spark.range(3).toDF("x"), path) == 2
    assert versions.drop_old_versions(spark, path, keep=1) == 2  # the first version and what the failed load left
    assert versions.read_table(spark, path).count() == 3 and len(versions.commits(spark, path)) == 1
    assert versions.replace_table(spark.range(4).toDF("x"), path) == 3


def test_a_commit_is_never_overwritten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5).toDF("x"), path)
    monkeypatch.setattr(versions, "commits", lambda *_: [])  # a second load that did not see the first commit
    with pytest.raises(Exception, match="[Ee]xist"):
        versions.replace_table(spark.range(9).toDF("x"), path)
    monkeypatch.undo()
    assert versions.read_table(spark, path).count() == 5


SHARES = "date string, symbol string, holders int"


def test_weekly_load_strips_filters_and_skips(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("2024-01-05", " 1101 ", 1), ("2024-01-05", "0050B", 2), ("2024-01-05", "1102  ", 3)], SHARES)
    assert ingest.load_category(spark, "shareholding", first, root).count() == 2
    again = spark.createDataFrame([("2024-01-05", "1101", 9), ("2024-01-12", "1101", 4)], SHARES)
    assert rows(ingest.load_category(spark, "shareholding", again, root), "date", "holders") == [("2024-01-12", 4)]
    ingest.load_category(spark, "shareholding", again, root, force=True)
    stored = spark.read.parquet(f"{root}/shareholding").withColumn("date", F.col("date").cast("string"))
    assert rows(stored, "date", "symbol", "holders") == [("2024-01-05", "1101", 9), ("2024-01-12", "1101", 4)]
    assert ingest.load_category(spark, "shareholding", first.limit(0), root).count() == 0


def test_index_names_are_no_stocks_but_stay(spark, tmp_path):
    data = [("2024-01-05", "sii", "taiex", 1.0), ("2024-01-05", "otc", "1101", 2.0)]
    indices = spark.createDataFrame(data, "date string, market string, symbol string, index_close double")
    made = ingest.load_all(spark, {"market_indices": indices, "daily_quotes": indices.withColumnRenamed("index_close", "close")}, str(tmp_path))
    assert list(made) == ["daily_quotes", "market_indices"]
    assert made["market_indices"].count() == 2 and rows(made["daily_quotes"], "symbol") == [("1101",)]


def test_empty_static_file_replaces_nothing(spark, tmp_path):
    info = spark.createDataFrame([("1101", "a")], "symbol string, name string")
    ingest.load_category(spark, "stock_info", info, str(tmp_path))
    ingest.load_category(spark, "stock_info", info.limit(0), str(tmp_path))
    assert versions.read_table(spark, f"{tmp_path}/stock_info").count() == 1


# ---- audits ---------------------------------------------------------------
QUOTES = "date string, market string, symbol string, open double, high double, low double, close double, src_file string, src_row int"


def test_audit_is_one_pass_over_the_table(spark):
    data = [
        ("2024-01-02", "sii", "1101", 10.0, 11.0, 9.0, 10.5, "f", 1), ("2024-01-02", "otc", "5483", 10.0, 9.5, 9.0, 10.5, "f", 2),
        ("2024-01-03", "sii", "1101", 10.0, 11.0, 9.0, 10.5, None, 1), ("2024-01-03", "sii", "1102", 10.0, 10.0, 10.5, 10.0, "f", 2),
    ]
    made = ingest.audit("daily_quotes", spark.createDataFrame(data, QUOTES).withColumn("volume", F.lit(1.0)))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") == 1 and text.count("Exchange hashpartitioning") == 1
    got = {(r["date"], r["market"]): [tuple(x) for x in r["failed"]] for r in made.collect()}
    assert got[("2024-01-02", "sii")] == [] and got[("2024-01-02", "otc")] == [("ohlc", "1")]
    assert got[("2024-01-03", "sii")] == [("ohlc", "1"), ("lineage", "1")]


def test_audit_names_what_is_missing(spark):
    data = [("2024-01-02", "sii", i) for i in ("dealer_self", "investment_trust", "total")] + [("2024-01-02", "otc", None)]
    got = ingest.audit("institutional_summary", spark.createDataFrame(data, "date string, market string, institution string"))
    assert {r["market"]: r["failed"][0]["detail"] for r in got.collect()} == {"sii": "foreign_investors", "otc": "dealer_self"}


def test_a_fact_stated_twice_fails(spark):
    row = '<tr><td>4000</td><td>Rev</td><td><ix:nonFraction name="r" contextRef="From20240101To20240331">1,000</ix:nonFraction></td></tr>'
    member = row.replace('From20240101To20240331"', 'From20240101To20240331_Member"')
    filing = lambda html: spark.createDataFrame([("2024Q1", "1101", "20240510", html)], "date string, symbol string, publish_time string, html string")
    assert documents.statement_facts(filing(FILING.replace(row, row + member))).where("account_code = '4000'").count() == 4
    with pytest.raises(Exception, match="duplicate fact 4000 of 1101 in 2024Q1"):
        documents.statement_facts(filing(FILING.replace(row, row + row))).collect()


# ---- tables of a page ------------------------------------------------------
def test_spans_fill_the_grid(spark):
    page = (
        "<table><tr><th rowspan=2>a</th><th colspan='2'>b</th></tr><tr><td>c<td>d</tr><tr><td>e</td></tr></table><p>x</p>"
        "<table><tr><td rowspan='9'>s</td><td>1 &lt; <b>2</b></td></tr><tr><td>3</td></tr><tr></tr></table><table></table>"
    )
    docs = spark.createDataFrame([(1, page), (2, None), (3, "<table><tr><td>open")], "id int, html string")
    got = rows(documents.table_grid(docs, "id", "html"), "id", "table_pos", "row_pos", "fields")
    assert got == [
        (1, 0, 0, ["a", "b", "b"]), (1, 0, 1, ["a", "c", "d"]), (1, 0, 2, ["e"]),
        (1, 1, 0, ["s", "1 < 2"]), (1, 1, 1, ["s", "3"]), (1, 1, 2, ["s"]),
    ]


def test_tables_are_named_by_header_or_by_position(spark):
    row = lambda cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    header = ["公司 代號", "公司名稱", "當月\n營收", "x", "x"]
    tables = {
        "late header": [["t"] * 5] * 4 + [header, ["1101", "a", "5", "p", "q"], ["合計", "", "9", "", ""]],
        "header too late": [["t"] * 5] * 5 + [header, ["1101", "a", "5", "p", "q"]],
        "wide": [["1101", "a", "5", *"abcdefgh", "more"], ["1102A", "b", "6", *"abcdefgh", "more"]],
        "narrow": [["1101", "a", "5", "p"]], "no header, nine columns": [["1101", "a", "5", *"abcdef"]], "no code": [["x"] * 11],
    }
    docs = spark.createDataFrame([(k, "<table>" + "".join(map(row, t)) + "</table>") for k, t in tables.items()], "id string, html string")
    got = {(r["id"], r["row_pos"]): (r["named_by"], r["fields"]) for r in documents.named_rows(documents.table_grid(docs, "id", "html"), "id").collect()}
    assert set(got) == {("late header", 5), ("wide", 0), ("wide", 1)}
    assert got[("late header", 5)] == ("header", {"公司代號": "1101", "公司名稱": "a", "當月營收": "5", "x": "p"})
    assert got[("wide", 1)][0] == "position" and got[("wide", 1)][1]["公司代號"] == "1102A" and got[("wide", 1)][1]["Unknown_11"] == "more"

"""Table schemas, keys and partition columns (one place for all of them).

Text columns are named; every other column is a double. The raw report names are
a lookup table of the exchanges' own header words.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# fixed values: report header words and the columns they fill
RAW_NAMES = {
    # keys
    "證券代號": "symbol",
    "代號": "symbol",
    "股票代號": "symbol",
    "證券名稱": "name",
    "名稱": "name",
    "公司名稱": "name",
    "股票名稱": "name",
    # quotes
    "成交股數": "volume",
    "成交筆數": "transactions",
    "成交金額": "value",
    "成交金額(元)": "value",
    "開盤價": "open",
    "開盤": "open",
    "最高價": "high",
    "最高": "high",
    "最低價": "low",
    "最低": "low",
    "收盤價": "close",
    "收盤": "close",
    "漲跌(+/-)": "direction",
    "漲跌價差": "change",
    "最後買價": "last_bid",
    "最後賣價": "last_ask",
    "最後買量(千股)": "last_bid_volume",
    "最後賣量(千股)": "last_ask_volume",
    "最後買量(張數)": "last_bid_volume",
    "最後賣量(張數)": "last_ask_volume",
    "最後揭示買價": "last_disclosed_bid",
    "最後揭示賣價": "last_disclosed_ask",
    "最後揭示買量": "last_disclosed_bid_volume",
    "最後揭示賣量": "last_disclosed_ask_volume",
    "次日漲停價": "next_day_upper_limit",
    "次日跌停價": "next_day_lower_limit",
    # valuation ratios
    "本益比": "pe_ratio",
    "殖利率(%)": "dividend_yield",
    "股利年度": "dividend_year",
    "每股股利(註)": "dividend_per_share",
    "股價淨值比": "pb_ratio",
    "財報年/季": "report_period",
    # institutional investors, listed market
    "外陸資買進股數(不含外資自營商)": "foreign_buy",
    "外陸資賣出股數(不含外資自營商)": "foreign_sell",
    "外陸資買賣超股數(不含外資自營商)": "foreign_net",
    "外資自營商買進股數": "foreign_dealer_buy",
    "外資自營商賣出股數": "foreign_dealer_sell",
    "外資自營商買賣超股數": "foreign_dealer_net",
    "投信買進股數": "trust_buy",
    "投信賣出股數": "trust_sell",
    "投信買賣超股數": "trust_net",
    "自營商買賣超股數": "dealer_net",
    "自營商買進股數(自行買賣)": "dealer_self_buy",
    "自營商賣出股數(自行買賣)": "dealer_self_sell",
    "自營商買賣超股數(自行買賣)": "dealer_self_net",
    "自營商買進股數(避險)": "dealer_hedge_buy",
    "自營商賣出股數(避險)": "dealer_hedge_sell",
    "自營商買賣超股數(避險)": "dealer_hedge_net",
    "三大法人買賣超股數": "total_net",
    # institutional investors, over the counter
    "外資及陸資(不含外資自營商)-買進股數": "foreign_buy",
    "外資及陸資(不含外資自營商)-賣出股數": "foreign_sell",
    "外資及陸資(不含外資自營商)-買賣超股數": "foreign_net",
    "外資自營商-買進股數": "foreign_dealer_buy",
    "外資自營商-賣出股數": "foreign_dealer_sell",
    "外資自營商-買賣超股數": "foreign_dealer_net",
    "外資及陸資-買進股數": "foreign_total_buy",
    "外資及陸資-賣出股數": "foreign_total_sell",
    "外資及陸資-買賣超股數": "foreign_total_net",
    "投信-買進股數": "trust_buy",
    "投信-賣出股數": "trust_sell",
    "投信-買賣超股數": "trust_net",
    "自營商(自行買賣)-買進股數": "dealer_self_buy",
    "自營商(自行買賣)-賣出股數": "dealer_self_sell",
    "自營商(自行買賣)-買賣超股數": "dealer_self_net",
    "自營商(避險)-買進股數": "dealer_hedge_buy",
    "自營商(避險)-賣出股數": "dealer_hedge_sell",
    "自營商(避險)-買賣超股數": "dealer_hedge_net",
    "自營商-買賣超股數": "dealer_net",
    "自營商-買進股數": "dealer_total_buy",
    "自營商-賣出股數": "dealer_total_sell",
    "三大法人買賣超股數合計": "total_net",
    # margin trading and lending, two header rows merged
    "融資-買進": "margin_long_buy",
    "融資-賣出": "margin_long_sell",
    "融資-現金償還": "margin_long_cash_repay",
    "融資-前日餘額": "margin_long_prev_balance",
    "融資-今日餘額": "margin_long_balance",
    "融資-次一營業日限額": "margin_long_limit",
    "融券-買進": "margin_short_buy",
    "融券-賣出": "margin_short_sell",
    "融券-現券償還": "margin_short_cash_repay",
    "融券-前日餘額": "margin_short_prev_balance",
    "融券-今日餘額": "margin_short_balance",
    "融券-次一營業日限額": "margin_short_limit",
    "融券-資券互抵": "offset_balance",
    "融券-現券": "margin_short_cash",
    "融券-註記": "margin_short_note",
    "借券賣出-當日餘額": "sbl_balance",
    "借券賣出-當日還券": "sbl_repay",
    "借券賣出-當日賣出": "sbl_sell",
    "借券賣出-前日餘額": "sbl_prev_balance",
    "借券賣出-次一營業日限額": "sbl_limit",
    "借券賣出-次一營業日可限額": "sbl_available_limit",
    "借券賣出-當日調整": "sbl_adjustment",
    "借券賣出-備註": "sbl_note",
    # margin trading and lending, single header row
    "融券當日餘額": "margin_short_balance",
    "融券賣出": "margin_short_sell",
    "融券買進": "margin_short_buy",
    "融券前日餘額": "margin_short_prev_balance",
    "融券現券": "margin_short_cash",
    "融券限額": "margin_short_limit",
    "融券": "margin_short_category",
    "借券賣出": "sbl_category",
    "借券賣出當日賣出": "sbl_sell",
    "借券賣出當日還券": "sbl_repay",
    "借券賣出當日餘額": "sbl_balance",
    "借券賣出前日餘額": "sbl_prev_balance",
    "借券賣出限額": "sbl_limit",
    "次一營業日可借券賣出限額": "sbl_available_limit",
    "借券賣出當日調整數額": "sbl_adjustment_amount",
    "備註": "note",
    "前資餘額(張)": "margin_long_prev_balance",
    "資買": "margin_long_buy",
    "資賣": "margin_long_sell",
    "現償": "margin_long_cash_repay",
    "資餘額": "margin_long_balance",
    "資屬證金": "margin_long_finance_company",
    "資使用率(%)": "margin_long_utilization",
    "資限額": "margin_long_limit",
    "前券餘額(張)": "margin_short_prev_balance",
    "券賣": "margin_short_sell",
    "券買": "margin_short_buy",
    "券償": "margin_short_cash_repay",
    "券餘額": "margin_short_balance",
    "券屬證金": "margin_short_finance_company",
    "券使用率(%)": "margin_short_utilization",
    "券限額": "margin_short_limit",
    "資券相抵(張)": "offset_balance",
    # foreign holding
    "發行股數": "issued_shares",
    "外資及陸資尚可投資股數": "foreign_investable_shares",
    "全體外資及陸資持有股數": "foreign_held_shares",
    "外資及陸資尚可投資比率": "foreign_investable_ratio",
    "全體外資及陸資持股比率": "foreign_held_ratio",
    "外資及陸資共用法令投資上限比率": "foreign_legal_limit_ratio",
    "陸資法令投資上限比率": "mainland_legal_limit_ratio",
    "國際證券編碼": "isin_code",
    "與前日異動原因(註)": "change_reason_note",
    "最近一次上市公司申報外資及陸資持股異動日期": "sii_last_update_date",
    "最近一次上櫃公司申報外資持股異動日期": "otc_last_update_date",
    # indices
    "指數": "index_name",
    "報酬指數": "index_name",
    "收盤指數": "index_close",
    "收市指數": "index_close",
    "漲跌點數": "index_change_points",
    "漲跌": "change",
    "漲跌幅度(%)": "index_change_pct",
    "大盤資訊連結": "index_info_link",
    # dividends
    "資料日期": "date",
    "除權息前收盤價": "close_before",
    "除權息參考價": "ref_price",
    "權值+息值": "rights_dividend_value",
    "權/息": "type",
}

# fixed values: header words of the monthly revenue report, matched inside a header.
# Longer words stand before the words they contain.
REVENUE_NAMES = {
    "公司代號": "symbol",
    "公司名稱": "name",
    "去年當月營收": "revenue_last_year",
    "當月營收": "revenue_current",
    "上月營收": "revenue_last_month",
    "上月比較增減(%)": "mom_pct",
    "去年同月增減(%)": "yoy_pct",
    "當月累計營收": "revenue_cumulative",
    "去年累計營收": "revenue_cumulative_last_year",
    "前期比較增減(%)": "cumulative_yoy_pct",
    "備註": "comment",
    "出表日期": "publish_time",
}
REVENUE_NAMES_EN = {
    "symbol": "symbol",
    "name": "name",
    "revenue": "revenue_current",
    "revenue_last_month": "revenue_last_month",
    "revenue_last_year": "revenue_last_year",
    "mom_pct": "mom_pct",
    "yoy_pct": "yoy_pct",
    "revenue_acc": "revenue_cumulative",
    "revenue_acc_last_year": "revenue_cumulative_last_year",
    "acc_yoy_pct": "cumulative_yoy_pct",
    "comment": "comment",
    "publish_time": "publish_time",
    "market": "market",
}

LINEAGE = ["pced_file", "pced_row", "pced_col"]
_KEY = ["date", "market", "symbol", "name"]
_SIDES = ("buy", "sell", "net")
_FLOWS = [f"{who}_{side}" for who in ("foreign", "foreign_dealer", "trust", "dealer_self", "dealer_hedge") for side in _SIDES]
_MARGIN = [f"margin_{side}_{what}" for side in ("long", "short") for what in ("buy", "sell", "cash_repay", "prev_balance", "balance", "limit")]
_GROWTH = [f"{item}_{part}" for item in ("revenue", "op_income", "non_op_income", "pretax_income", "net_income", "eps") for part in ("q", "acc", "acc_ly", "acc_yoy")]
_FACT = ["date", "symbol", "publish_time", "account_code", "value_text", "value_num"]

COLUMNS: dict[str, list[str]] = {
    "daily_quotes": [*_KEY, "open", "high", "low", "close", "volume", "value", "transactions", "change", "direction", "bid", "ask", *LINEAGE],
    "institutional_investors": [*_KEY, *_FLOWS, "dealer_net", "total_net", *LINEAGE],
    "foreign_holding": [
        *_KEY, "issued_shares", "foreign_investable_shares", "foreign_held_shares", "foreign_investable_ratio",
        "foreign_held_ratio", "foreign_legal_limit_ratio", *LINEAGE,
    ],
    "margin_trading": [*_KEY, *_MARGIN, "offset_balance", *LINEAGE],
    "margin_sbl": [
        *_KEY, "margin_short_prev_balance", "margin_short_balance", "margin_short_buy", "margin_short_sell",
        "sbl_prev_balance", "sbl_sell", "sbl_repay", "sbl_balance", *LINEAGE,
    ],
    "pe_ratio": [*_KEY, "pe_ratio", *LINEAGE],
    "market_indices": ["date", "market", "symbol", "index_name", "index_close", "index_change_points", *LINEAGE],
    "shareholding": ["date", "symbol", "level", "level_name", "holders", "shares", "percentage", *LINEAGE],
    "monthly_revenue": [
        *_KEY, "revenue_current", "revenue_last_month", "revenue_last_year", "mom_pct", "yoy_pct", "revenue_cumulative",
        "revenue_cumulative_last_year", "cumulative_yoy_pct", "comment", "publish_time", *LINEAGE,
    ],
    "quarterly_reports": [
        "date", "symbol", "market", "report_category", *_GROWTH, "capital", "nav_per_share", "equity_to_assets_ratio",
        "current_ratio", "quick_ratio", "publish_time", "period", "period_type",
    ],
    "balance_sheet": _FACT,
    "income_statement": _FACT,
    "cash_flow": _FACT,
    "code_book": ["statement_type", "account_code", "account_name_cht", "account_name_eng"],
    "stock_info": ["symbol", "name", "industry", "market", "listing_date", *LINEAGE],
    "stock_tags": ["symbol", "tag", *LINEAGE],
    "dividend": ["date", "symbol", "name", "close_before", "ref_price", "rights_dividend_value", "type", *LINEAGE],
    "valuation_daily": ["date", "symbol", "close", "ttm_eps_official", "pe_official", "pe_percentile_official", "roe_official", *LINEAGE],
}

TEXT_COLUMNS = {
    "symbol", "date", "market", "report_category", "name", "industry", "listing_date", "tag", "direction", "bid", "ask",
    "level_name", "statement_type", "index_name", "value_text", "comment", "publish_time", "period", "period_type",
    "account_code", "account_name", "account_name_cht", "account_name_eng", "type", "pced_file", "pced_col",
}
LONG_COLUMNS = {"pced_row", "level"}

# partition columns of the stored tables; the rest of the key sorts within files
PARTITIONS = {"daily": ["date", "market"], "weekly": ["date"], "monthly": ["date"], "quarterly": ["date", "period_type"], "dividend": ["year"]}

# (key columns, highest share of NULLs in percent) per audited table
AUDITS: dict[str, tuple[list[str], float]] = {
    "daily_quotes": (["open", "high", "low", "close", "volume"], 50),
    "institutional_investors": (["foreign_net", "trust_net", "dealer_net"], 50),
    "foreign_holding": (["foreign_held_shares", "foreign_investable_shares", "foreign_held_ratio"], 70),
    "margin_trading": (
        ["margin_long_buy", "margin_long_sell", "margin_long_balance", "margin_short_buy", "margin_short_sell", "margin_short_balance"], 90,
    ),
    "margin_sbl": (["margin_short_balance", "margin_short_buy", "margin_short_sell"], 90),
    "pe_ratio": (["pe_ratio"], 80),
}


def column_type(name: str):
    if name in TEXT_COLUMNS:
        return StringType()
    return LongType() if name in LONG_COLUMNS else DoubleType()


def table_schema(table: str) -> StructType:
    return StructType([StructField(c, column_type(c)) for c in COLUMNS[table]])


def type_names(table: str, lineage: bool = False) -> dict[str, str]:
    """Column to SQL type, for enforce_schema; lineage columns are added by the readers."""
    return {c: column_type(c).simpleString() for c in COLUMNS[table] if lineage or c not in LINEAGE}

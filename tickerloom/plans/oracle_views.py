"""SQL definitions of the mapped market tables, used by the oracles only."""

from __future__ import annotations

import re

PRICE = "l_extendedprice / l_quantity"
SYMBOL = "printf('%04d', l_suppkey)"
MARKET = "CASE WHEN l_suppkey % 2 = 0 THEN 'sii' ELSE 'otc' END"
DAY = "strftime(l_shipdate, '%Y-%m-%d')"

VIEWS: dict[str, str] = {
    "quotes": f"""
        SELECT {DAY} AS date, {MARKET} AS market, {SYMBOL} AS symbol,
               CASE WHEN sum(l_quantity) >= 5 THEN sum(l_extendedprice) / sum(l_quantity) END AS open,
               max({PRICE}) AS high, min({PRICE}) AS low, avg({PRICE}) AS close,
               sum(l_quantity) AS volume, sum(l_extendedprice) AS value
        FROM lineitem GROUP BY 1, 2, 3""",
    "flows": f"""
        SELECT {DAY} AS date, {MARKET} AS market, {SYMBOL} AS symbol,
               sum(CASE l_returnflag WHEN 'R' THEN -l_quantity WHEN 'A' THEN l_quantity ELSE 0 END) AS foreign_net,
               sum(CASE l_linestatus WHEN 'O' THEN l_quantity ELSE -l_quantity END) AS trust_net,
               sum(CASE WHEN l_discount > 0.05 THEN l_quantity WHEN l_discount < 0.05 THEN -l_quantity ELSE 0 END) AS dealer_net
        FROM lineitem GROUP BY 1, 2, 3""",
    "margin": f"""
        SELECT {DAY} AS date, {MARKET} AS market, {SYMBOL} AS symbol, 'S' || l_suppkey AS name,
               CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS margin_long_prev_balance,
               l_quantity * 1.25 AS margin_long_balance,
               CASE WHEN l_linenumber <> 3 THEN round(l_extendedprice / 64, 0) END AS margin_long_limit,
               CASE WHEN l_linestatus = 'O' THEN l_quantity END AS margin_short_prev_balance,
               l_quantity * 0.75 AS margin_short_balance,
               round(l_extendedprice / 128, 0) AS margin_short_limit,
               CASE WHEN l_returnflag = 'A' THEN l_quantity END AS margin_short_buy,
               l_linenumber AS margin_short_cash_repay,
               CASE WHEN l_linenumber <> 2 THEN l_quantity END AS sbl_prev_balance,
               l_quantity * 1.5 AS sbl_balance,
               CASE WHEN l_returnflag = 'N' THEN l_quantity END AS sbl_sell,
               CASE WHEN l_linestatus = 'F' THEN l_quantity END AS sbl_repay
        FROM lineitem""",
    "issued": """
        SELECT printf('%04d', s_suppkey) AS symbol, s_name AS name,
               round(100 * s_acctbal, 0) + 1000000 AS issued_shares, s_nationkey AS industry
        FROM supplier""",
    "foreign_holding": """
        SELECT f.date, f.market, f.symbol, i.name,
               CASE WHEN f.foreign_net <> 0 AND f.trust_net > -40 THEN i.issued_shares END AS issued_shares
        FROM flows f JOIN issued i ON f.symbol = i.symbol""",
    "levels": """
        SELECT year(o_orderdate) || '-12-31' AS date, printf('%04d', c_nationkey) AS symbol,
               1 + o_custkey % 15 AS level, count(*) AS holders,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS shares
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "shareholding": """
        SELECT date, symbol, level, holders, shares,
               100.0 * shares / sum(shares) OVER (PARTITION BY date, symbol) AS percentage
        FROM levels""",
    "reports": """
        SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS date,
               printf('%04d', o_custkey % 100) AS symbol,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e8 AS eps_q,
               count(*) * 10.0 - 30 AS nav_per_share,
               sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END) AS trend,
               count(*) AS orders_n
        FROM orders GROUP BY 1, 2""",
    "month_base": """
        SELECT year(o_orderdate) || 'M' || printf('%02d', month(o_orderdate)) AS date,
               printf('%04d', o_custkey % 100) AS symbol,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e5 AS revenue_current
        FROM orders GROUP BY 1, 2""",
    "monthly": """
        SELECT date, symbol, revenue_current,
               (revenue_current / lag(revenue_current) OVER w - 1) * 100 AS mom_pct,
               (revenue_current / lag(revenue_current, 12) OVER w - 1) * 100 AS yoy_pct,
               CASE WHEN (CAST(symbol AS INT) + CAST(substr(date, 6, 2) AS INT)) % 6 = 0
                    THEN strftime(make_date(CAST(substr(date, 1, 4) AS INT), CAST(substr(date, 6, 2) AS INT), 13) + INTERVAL 2 MONTH, '%Y%m%d')
                    ELSE strftime(make_date(CAST(substr(date, 1, 4) AS INT), CAST(substr(date, 6, 2) AS INT), 10) + INTERVAL 1 MONTH, '%Y%m%d') END AS publish_time
        FROM month_base WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    "facts": f"""
        SELECT year(l_shipdate) || 'Q' || quarter(l_shipdate) AS date, {SYMBOL} AS symbol,
               'quarter' AS period_type, l_returnflag || l_linestatus AS account_code,
               sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1e5 AS value_num
        FROM lineitem GROUP BY 1, 2, 3, 4""",
    "statements": f"""
        SELECT year(l_shipdate) || 'Q' || quarter(l_shipdate) AS date, {SYMBOL} AS symbol,
               CASE WHEN l_partkey % 16 < 7 THEN 'quarter' WHEN l_partkey % 16 < 14 THEN 'as_of' ELSE 'accumulated' END AS period_type,
               (['4000', '5900', '6300', '6900', '7900', '7950', '8200', '1100', '11XX', '21XX', '1XXX', '2XXX', '3XXX', '3300', 'AAAA', 'B02700'])[l_partkey % 16 + 1] AS account_code,
               sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1e5 AS value_num
        FROM lineitem GROUP BY 1, 2, 3, 4""",
    "quarterly": """
        SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS date, printf('%04d', o_custkey % 100) AS symbol,
               CASE WHEN o_custkey % 2 = 0 THEN 'sii' ELSE 'otc' END AS market,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e5 AS revenue_q,
               sum(CASE WHEN o_orderstatus = 'P' THEN -CAST(round(o_totalprice * 100) AS BIGINT) ELSE CAST(round(o_totalprice * 100) AS BIGINT) END) / 1e6 AS net_income_q,
               count(*) * 3.0::DOUBLE - 12 AS non_op_income_q, count(*) * 4.0::DOUBLE - 20 AS pretax_income_q, count(*) * 100.0::DOUBLE AS capital,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e8 AS eps_q, count(*) * 10.0::DOUBLE - 30 AS nav_per_share
        FROM orders GROUP BY 1, 2, 3""",
    "cohort_calendar": """
        SELECT playbook_date, month, strftime(CAST(playbook_date AS DATE) - 1, '%Y-%m-%d') AS cutoff_date, ti,
               (ti // 4) || 'Q' || (ti % 4 + 1) AS target_q, ((ti - 1) // 4) || 'Q' || ((ti - 1) % 4 + 1) AS anchor_q,
               ((ti - 2) // 4) || 'Q' || ((ti - 2) % 4 + 1) AS pre_anchor_q, ((ti - 4) // 4) || 'Q' || (ti % 4 + 1) AS ly_target_q,
               ((ti - 5) // 4) || 'Q' || ((ti - 5) % 4 + 1) AS ly_anchor_q, (month + 1) % 3 + 1 AS feature_months, year * 12 + month - 1 AS mi
        FROM (SELECT *, (CASE WHEN month = 1 THEN year - 1 ELSE year END) * 4 + (CASE WHEN month BETWEEN 2 AND 4 THEN 0 WHEN month BETWEEN 5 AND 7 THEN 1 WHEN month BETWEEN 8 AND 10 THEN 2 ELSE 3 END) AS ti
              FROM playbook)""",
    "index_daily": """
        SELECT date, 'IDX' || CAST(symbol AS INT) % 4 AS index_name, avg(close) AS index_close
        FROM quotes GROUP BY 1, 2""",
    "calendar": "SELECT DISTINCT date FROM quotes",
    "playbook": """
        SELECT strftime(make_date(year(m), month(m), CASE WHEN month(m) IN (5, 8, 11) THEN 16 ELSE 11 END), '%Y-%m-%d') AS playbook_date,
               year(m) AS year, month(m) AS month
        FROM (SELECT unnest(generate_series(date_trunc('month', min(CAST(date AS DATE))), max(CAST(date AS DATE)), INTERVAL 1 MONTH)) AS m FROM calendar)""",
    "scored_base": f"""
        SELECT strftime(make_date(year(l_shipdate), month(l_shipdate), CASE WHEN month(l_shipdate) IN (5, 8, 11) THEN 16 ELSE 11 END), '%Y-%m-%d') AS playbook_date,
               {SYMBOL} AS symbol,
               rnd(sum(l_extendedprice * (1 - l_discount)) / sum(l_quantity), 6) AS ml_score,
               rnd(avg(l_discount), 8) AS disc, rnd(avg(l_tax), 8) AS tax, sum(l_quantity) AS qty,
               count(*) AS line_count
        FROM lineitem GROUP BY 1, 2""",
    "entries": """
        SELECT playbook_date, (SELECT min(c.date) FROM calendar c WHERE c.date >= playbook_date) AS entry_date
        FROM (SELECT DISTINCT playbook_date FROM scored_base)""",
    "scores": """
        SELECT s.playbook_date, s.symbol, e.entry_date, s.ml_score, s.disc, s.tax, s.qty, s.line_count,
               row_number() OVER (PARTITION BY s.playbook_date ORDER BY ml_score DESC, s.symbol) AS ml_rank
        FROM scored_base s JOIN entries e ON s.playbook_date = e.playbook_date WHERE e.entry_date IS NOT NULL""",
}

_WORD = re.compile(r"[a-z_]+")


def _needs(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_WORD.findall(sql)) if w in VIEWS]


def _exact_round(sql: str) -> str:
    """Write rnd(x, n) as decimal rounding: ties do not depend on float noise."""
    while (at := sql.find("rnd(")) >= 0:
        depth, comma, i = 0, -1, at + 3
        while True:
            ch = sql[i]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = i
            if depth == 0:
                break
            i += 1
        value, digits = sql[at + 4 : comma], sql[comma + 1 : i].strip()
        sql = f"{sql[:at]}CAST(round(CAST(({value}) AS DECIMAL(38, 9)), {digits}) AS DOUBLE){sql[i + 1 :]}"
    return sql


def with_views(sql: str) -> str:
    """Prefix a statement with the definitions of every view it mentions.

    `rnd(x, n)` in the text stands for decimal rounding to n digits.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in _needs(VIEWS[name]):
            if need != name:
                add(need)
        ordered.append(name)

    for name in _needs(sql):
        add(name)
    defs = [f"{n} AS ({VIEWS[n].strip()})" for n in ordered]
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        body = body[len("WITH RECURSIVE") if recursive else len("WITH"):].strip()
        head = ",\n".join([*defs, body])
    else:
        head = ",\n".join(defs) + "\n" + body if defs else body
        if not defs:
            return _exact_round(body)
    return _exact_round(("WITH RECURSIVE " if recursive else "WITH ") + head)

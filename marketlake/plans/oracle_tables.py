"""DuckDB SQL for the queries of ``catalog_tables``, built from the same plain CTEs as the other oracles."""

from __future__ import annotations

from marketlake import schemas
from marketlake.plans.oracle_sql import (
    ACTS, EQ_CLEAN, EQ_NORM, EQ_VALID, FO_NORM, FO_VALID, L_EQUITY, PRICE_COLS, SILVER, fo_dedup, landed, silver_from, with_views,
)
from marketlake.sources.fixtures import VIEWS

_ROW = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus")
_DELIVERY = "CASE WHEN l_partkey % 10 < 1 THEN 0 WHEN l_partkey % 10 < 3 THEN 1 WHEN l_partkey % 10 < 6 THEN 2 ELSE 3 END"
#: Fields that a record cannot be without, by domain.
_NEEDED = {
    "equity": ("trade_date", "symbol", "series"), "fo": ("trade_date", "symbol", "instrument_type", "expiry_date"),
    "index": ("trade_date", "index_name"), "corporate": ("symbol", "action_type"),
    "surveillance": ("as_of_date", "symbol", "list_type"), "macro": (),
}
_BAD = "(ingested_at % 13 = 0 OR ingested_at % 17 = 0 OR ingested_at % 19 = 0)"


def _reason(fields) -> str:
    return "CASE " + " ".join(f"WHEN {f} IS NULL THEN 'missing_{f}'" for f in fields) + " END"


def _json_number(x: str) -> str:
    """A double as JSON, with 15 places."""
    size = f"abs({x})"
    return (f"CASE WHEN isnan({x}) THEN '\"NaN\"' WHEN isinf({x}) THEN CASE WHEN {x} < 0 THEN '\"-Infinity\"' ELSE '\"Infinity\"' END "
            f"WHEN {size} < 1e18 THEN concat(CASE WHEN {x} < 0 THEN '-' ELSE '' END, CAST(CAST(floor({size}) AS BIGINT) AS VARCHAR), '.', "
            f"lpad(CAST(CAST(floor(({size} - floor({size})) * 1e15) AS BIGINT) AS VARCHAR), 15, '0')) ELSE CAST({x} AS VARCHAR) END")


def _json_text(schema, mistyped: str) -> str:
    """A record as JSON text, without its null fields; a ``mistyped`` one holds text for its time."""
    parts = []
    for f in schema.fields:
        value = _json_number(f.name) if f.dataType.typeName() == "double" else f"CAST(to_json({f.name}) AS VARCHAR)"
        if f.name == "ingested_at":
            value = f"CASE WHEN {mistyped} THEN '\"soon\"' ELSE {value} END"
        parts.append(f"CASE WHEN {f.name} IS NOT NULL THEN concat('\"{f.name}\":', {value}) END")
    return "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"


def _silver_cols() -> str:
    return ("trade_date, symbol, series, open_adj, high_adj, low_adj, close_adj, open_raw, close_raw, total_quantity, "
            "total_turnover, delivery_pct, cumulative_adj_factor")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    eq_chain = (EQ_NORM, EQ_VALID, EQ_CLEAN)

    # the landing view over line items that know their delivery and their place in it
    view = ", ".join(c for c in VIEWS["equity_landing"].columns)
    landing_view = (f"equity_landing AS (SELECT {view}, row_number() OVER (ORDER BY {_DELIVERY}, {_ROW}) AS arrival FROM lineitem)")
    norm = EQ_NORM.replace("FROM equity_raw)", "FROM l_equity)")
    valid, l_equity = EQ_VALID, L_EQUITY.replace("'bhavcopy' AS source", "'bhavcopy' AS source, arrival")
    q["landed_arrival"] = f"""WITH {landing_view},
{l_equity},
{norm},
{valid}
SELECT * EXCLUDE (ingested_at, arrival, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY arrival) AS rn FROM eq_valid) t WHERE rn = 1"""

    q["business_keys_deliverable"] = landed("l_equity") + """
SELECT ingested_at, concat_ws('_', coalesce(symbol, 'None'), coalesce(trade_date, 'None'), 'DEL') AS message_key FROM l_equity"""
    q["enforce_schema_rejected"] = landed("l_equity", "l_fo") + f"""
SELECT 'equity_raw' AS record, ingested_at, trade_date, symbol, {_reason(_NEEDED['equity'])} AS reject_reason
FROM l_equity WHERE {_reason(_NEEDED['equity'])} IS NOT NULL
UNION ALL
SELECT 'fo_raw', ingested_at, trade_date, symbol, {_reason(_NEEDED['fo'])}
FROM l_fo WHERE {_reason(_NEEDED['fo'])} IS NOT NULL"""

    names = ("l_equity", "l_fo", "l_index", "l_corporate", "l_surveillance")
    sources = {d: f"l_{d}" for d in _NEEDED} | {"macro": "macro"}
    all_landed = landed(*names, extra_views=("macro",))
    q["message_outcomes"] = all_landed + "\n" + "\nUNION ALL ".join(
        f"""SELECT '{d}' AS domain, count(*) AS input, count(*) FILTER (WHERE NOT {_BAD} AND {ok}) AS accepted,
       count(*) FILTER (WHERE NOT {_BAD} AND NOT {ok}) AS rejected, count(*) FILTER (WHERE {_BAD}) AS malformed FROM {sources[d]}"""
        for d, fields in _NEEDED.items()
        for ok in ["(" + (" AND ".join(f"{f} IS NOT NULL" for f in fields) or "true") + ")"])
    records = {d: schemas.BY_NAME[n] for d, n in zip(_NEEDED, (
        "equity_raw", "fo_raw", "index_raw", "corporate_raw", "surveillance_raw", "macro"))}
    cut, blank = "ingested_at % 13 = 0", "ingested_at % 13 <> 0 AND ingested_at % 17 = 0"
    q["quarantined_messages"] = all_landed + "\n" + "\nUNION ALL ".join(
        f"""SELECT '{d}' AS domain, ingested_at AS id,
       CASE WHEN {blank} THEN 'empty_message' ELSE 'malformed_message' END AS reject_reason,
       CASE WHEN {cut} THEN left(text, length(text) - 1) WHEN {blank} THEN ' ' ELSE text END AS message,
       ingested_at % 13 <> 0 AND ingested_at % 17 <> 0 AS closed
FROM (SELECT ingested_at, {_json_text(records[d], f"NOT ({cut}) AND ingested_at % 19 = 0")} AS text FROM {s} WHERE {_BAD})"""
        for d, s in sources.items())
    q["macro_values"] = landed("l_macro") + """
SELECT ingested_at, trade_date, record_type, TRY_CAST(json_extract_string(data, '$.k') AS INTEGER) AS k,
       TRY_CAST(json_extract_string(data, '$.k') AS DOUBLE) AS k_double, json_extract_string(data, '$.raw') AS raw FROM l_macro"""

    q["stream_equity_first"] = with_views(("equity_raw",), *eq_chain) + "\nSELECT * FROM eq_clean"
    q["stream_fo_first"] = with_views(("fo_raw",), FO_NORM, FO_VALID, fo_dedup("fo_valid", False, "fo_c")) + "\nSELECT * FROM fo_c"

    since = "eq_since AS (SELECT * FROM eq_clean WHERE trade_date >= '1996-01-01')"
    q["table_scan_by_name"] = with_views(("equity_raw", "corporate"), *eq_chain, since, ACTS, silver_from("eq_since")) + f"""
SELECT {_silver_cols()} FROM silver WHERE year(CAST(trade_date AS DATE)) BETWEEN 1996 AND 1997"""
    q["silver_by_symbol"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS, SILVER) + """
SELECT symbol, trade_date, close_adj, max(trade_date) OVER (PARTITION BY symbol) AS last_date,
       count(*) OVER (PARTITION BY symbol) AS n_days FROM silver"""

    q["compaction_resumed"] = """WITH fed AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS trade_year,
  CASE WHEN year(l_shipdate) < 1997 THEN l_orderkey % 4 ELSE l_orderkey % 12 END AS feed FROM lineitem),
files AS (SELECT trade_year, count(DISTINCT feed) >= 10 AS rewritten FROM fed GROUP BY trade_year)
SELECT fed.* EXCLUDE (feed), rewritten FROM fed JOIN files USING (trade_year)"""
    q["serve_with_count"] = with_views(("surveillance_raw",)) + """
SELECT *, count(*) OVER () AS count FROM surveillance_raw WHERE list_type = 'GSM'"""
    q["compact_tables_run"] = """
SELECT 'lineitem' AS name, 'ok' AS status, true AS rewritten, count(*) AS rows FROM lineitem
UNION ALL SELECT 'missing', 'failed', false, 0
UNION ALL SELECT 'orders', 'ok', false, count(*) FROM orders"""
    q["silver_of_repeated_prices"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS, SILVER) + f"""
SELECT {_silver_cols()} FROM silver"""
    q["approx_stocks"] = with_views(("equity_raw",), *eq_chain) + """
SELECT CAST(year(CAST(trade_date AS DATE)) AS INTEGER) AS trade_year, count(DISTINCT symbol) AS total_stocks, true AS within_bound
FROM eq_clean GROUP BY 1"""
    q["cumulative_factor_asof"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS) + f"""
SELECT {PRICE_COLS},
       CASE WHEN count(adj_factor) = 0 THEN 1.0
            ELSE product(CASE WHEN adj_factor > 0 THEN adj_factor END ORDER BY ex_date DESC, adj_factor DESC) END
         AS cumulative_adj_factor
FROM (SELECT p.*, a.adj_factor, a.ex_date FROM eq_clean p LEFT JOIN acts_adj a
        ON p.symbol = a.symbol AND TRY_CAST(p.trade_date AS DATE) < a.ex_date) j
GROUP BY {PRICE_COLS}"""
    return q

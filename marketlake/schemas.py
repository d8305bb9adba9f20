"""Typed record schemas of the lake (one StructType per domain).

Dates are ``YYYY-MM-DD`` strings and event time is epoch milliseconds, as in
the declared record formats; prices are doubles end to end.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


EQUITY_RAW = _schema(
    ("ingested_at", L, False), ("trade_date", S, False), ("symbol", S, False),
    ("series", S, False), ("isin", S, True),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("last", D, True), ("prev_close", D, True),
    ("total_trades", L, True), ("total_quantity", L, True), ("total_turnover", D, True),
    ("deliverable_qty", L, True), ("delivery_pct", D, True), ("source", S, False),
)

FO_RAW = _schema(
    ("ingested_at", L, False), ("trade_date", S, False), ("symbol", S, False),
    ("instrument_type", S, False), ("expiry_date", S, False),
    ("strike_price", D, True), ("option_type", S, True),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("settle_price", D, True), ("contracts", L, True), ("value_in_lakh", D, True),
    ("open_interest", L, True), ("change_in_oi", L, True),
)

INDEX_RAW = _schema(
    ("ingested_at", L, False), ("trade_date", S, False), ("index_name", S, False),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("points_change", D, True), ("pct_change", D, True), ("volume", L, True),
    ("turnover_cr", D, True), ("pe_ratio", D, True), ("pb_ratio", D, True),
    ("div_yield", D, True),
)

CORPORATE_RAW = _schema(
    ("ingested_at", L, False), ("symbol", S, False), ("company_name", S, True),
    ("action_type", S, False), ("ex_date", S, True), ("record_date", S, True),
    ("bc_start_date", S, True), ("bc_end_date", S, True),
    ("nd_start_date", S, True), ("nd_end_date", S, True),
    ("details", S, True), ("series", S, True),
)

SURVEILLANCE_RAW = _schema(
    ("ingested_at", L, False), ("as_of_date", S, False), ("symbol", S, False),
    ("isin", S, True), ("company_name", S, True), ("list_type", S, False),
    ("stage", I, True), ("reason", S, True),
)

MACRO_RAW = _schema(
    ("ingested_at", L, False), ("trade_date", S, False), ("record_type", S, False),
    ("data", S, True),
)

OHLCV_ADJUSTED = _schema(
    ("trade_date", S, True), ("symbol", S, True), ("series", S, True),
    ("open_adj", D, True), ("high_adj", D, True), ("low_adj", D, True), ("close_adj", D, True),
    ("open_raw", D, True), ("close_raw", D, True),
    ("total_quantity", L, True), ("total_turnover", D, True), ("delivery_pct", D, True),
    ("cumulative_adj_factor", D, True),
)

MARKET_BREADTH = _schema(
    ("trade_date", S, True), ("advances", L, False), ("declines", L, False),
    ("unchanged", L, False), ("total_stocks", L, False), ("total_volume", L, True),
    ("total_turnover_cr", D, True), ("avg_return_pct", D, True), ("ad_ratio", D, True),
    ("put_oi", L, True), ("call_oi", L, True), ("pcr_oi", D, True),
)

# Defaults of the record formats for fields that have one.
DEFAULTS = {
    "equity_raw": {"source": "bhavcopy"},
}

# Fields without a default; a record missing one is rejected.
REQUIRED = {
    "equity_raw": ["ingested_at", "trade_date", "symbol", "series", "source"],
    "fo_raw": ["ingested_at", "trade_date", "symbol", "instrument_type", "expiry_date"],
    "index_raw": ["ingested_at", "trade_date", "index_name"],
    "corporate_raw": ["ingested_at", "symbol", "action_type"],
    "surveillance_raw": ["ingested_at", "as_of_date", "symbol", "list_type"],
}

BY_NAME = {
    "equity_raw": EQUITY_RAW,
    "fo_raw": FO_RAW,
    "index_raw": INDEX_RAW,
    "corporate_raw": CORPORATE_RAW,
    "surveillance_raw": SURVEILLANCE_RAW,
    "macro": MACRO_RAW,
}

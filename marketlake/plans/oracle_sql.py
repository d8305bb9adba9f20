"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the DataFrame code: plain SQL over the generated
tables, with the fixture views as CTEs. Row-level arithmetic is the same
IEEE operation sequence in both engines (factor products are multiplied in
ex-date order on both sides), so those values compare exactly; order-
dependent sums and averages are rounded identically on both sides.
"""

from __future__ import annotations

from marketlake.sources.fixtures import cte

# What Python's str.strip() and float() skip, and the text float() accepts.
PY_WHITESPACE = "[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
FLOAT_WHITESPACE = PY_WHITESPACE.replace("\\x1C-\\x20", "\\x20")
FLOAT_TEXT = (
    "^[+-]?(([0-9](_?[0-9])*[.]?|([0-9](_?[0-9])*)?[.][0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?"
    "|(?i:inf|infinity|nan))$"
)

FIXTURE_ORDER_EQ = "ingested_at, arrival_seq, tiebreak, total_turnover"
FIXTURE_ORDER_FO = "ingested_at, arrival_seq, tiebreak, value_in_lakh"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WHITESPACE}+|{PY_WHITESPACE}+$', '', 'g')"


def clean_text(x: str) -> str:
    return f"upper({strip(f'coalesce({x}, {chr(39)}{chr(39)})')})"


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def float_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{FLOAT_WHITESPACE}+|{FLOAT_WHITESPACE}+$', '', 'g')"


def safe_float(x: str) -> str:
    s = float_strip(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_matches({s}, '{FLOAT_TEXT}') THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END)"


def safe_int(x: str) -> str:
    return f"TRY_CAST(trunc({safe_float(x)}) AS BIGINT)"


def comma_float(x: str) -> str:
    return safe_float(f"replace(CAST({x} AS VARCHAR), ',', '')")


def nonneg(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN NULL ELSE {x} END"


def factor(details: str) -> str:
    s = f"upper({details})"
    bonus = r"BONUS.*?(\d+):(\d+)"
    split = r"RS\s+([\d.]+)\s+TO\s+RS\s+([\d.]+)"
    n = f"TRY_CAST(regexp_extract({s}, '{bonus}', 1) AS DOUBLE)"
    d = f"TRY_CAST(regexp_extract({s}, '{bonus}', 2) AS DOUBLE)"
    o = f"TRY_CAST(regexp_extract({s}, '{split}', 1) AS DOUBLE)"
    w = f"TRY_CAST(regexp_extract({s}, '{split}', 2) AS DOUBLE)"
    return (
        f"(CASE WHEN {details} IS NULL OR {details} = '' THEN 1.0 "
        f"WHEN regexp_matches({s}, '{bonus}') THEN coalesce({d} / nullif({d} + {n}, 0), 1.0) "
        f"WHEN regexp_matches({s}, '{split}') THEN coalesce(CASE WHEN {o} > 0 THEN {w} / {o} END, 1.0) "
        f"ELSE 1.0 END)"
    )


# --- shared CTE bodies -------------------------------------------------------

EQ_NORM = f"""eq_norm AS (
  SELECT * REPLACE ({clean_text('symbol')} AS symbol, {clean_text('series')} AS series,
    {nonneg('open')} AS open, {nonneg('high')} AS high, {nonneg('low')} AS low,
    {nonneg('close')} AS close, {nonneg('last')} AS last, {nonneg('prev_close')} AS prev_close)
  FROM equity_raw)"""

EQ_VALID = """eq_valid AS (
  SELECT * FROM eq_norm
  WHERE symbol <> '' AND close IS NOT NULL AND close > 0 AND NOT isnan(close))"""

EQ_CLEAN = f"""eq_clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY {FIXTURE_ORDER_EQ}) AS rn
    FROM eq_valid) WHERE rn = 1)"""

ACTS = f"""acts AS (
  SELECT DISTINCT symbol, TRY_CAST(CAST(ex_date AS VARCHAR) AS DATE) AS ex_date, details,
         {factor('details')} AS adj_factor
  FROM corporate WHERE regexp_matches(action_type, '(?i)bonus|split')),
acts_adj AS (SELECT * FROM acts WHERE adj_factor < 1.0)"""

SILVER = """silver AS (
  SELECT trade_date, symbol, series,
         CAST(open * f AS DOUBLE) AS open_adj, CAST(high * f AS DOUBLE) AS high_adj,
         CAST(low * f AS DOUBLE) AS low_adj, CAST(close * f AS DOUBLE) AS close_adj,
         open AS open_raw, close AS close_raw,
         total_quantity, total_turnover, delivery_pct, f AS cumulative_adj_factor
  FROM (
    SELECT p.trade_date, p.symbol, any_value(p.series) AS series, any_value(p.open) AS open,
           any_value(p.high) AS high, any_value(p.low) AS low, any_value(p.close) AS close,
           any_value(p.total_quantity) AS total_quantity,
           any_value(p.total_turnover) AS total_turnover,
           any_value(p.delivery_pct) AS delivery_pct,
           CASE WHEN count(a.adj_factor) = 0 THEN 1.0
                WHEN count(CASE WHEN a.adj_factor > 0 THEN 1 END) = 0 THEN NULL
                ELSE product(CASE WHEN a.adj_factor > 0 THEN a.adj_factor END
                             ORDER BY a.ex_date DESC, a.adj_factor DESC) END AS f
    FROM eq_clean p LEFT JOIN acts_adj a
      ON p.symbol = a.symbol AND TRY_CAST(p.trade_date AS DATE) < a.ex_date
    GROUP BY p.symbol, p.trade_date) t)"""

FO_NORM = f"""fo_norm AS (
  SELECT * REPLACE ({clean_text('symbol')} AS symbol,
    {clean_text('instrument_type')} AS instrument_type,
    nullif({clean_text('option_type')}, '') AS option_type,
    {nonneg('open')} AS open, {nonneg('high')} AS high, {nonneg('low')} AS low,
    {nonneg('close')} AS close, {nonneg('settle_price')} AS settle_price)
  FROM fo_raw)"""

FO_VALID = """fo_valid AS (
  SELECT * FROM fo_norm
  WHERE symbol IS NOT NULL AND symbol <> '' AND instrument_type IS NOT NULL
    AND instrument_type <> '' AND expiry_date IS NOT NULL AND expiry_date <> '')"""


def fo_dedup(src: str, per_day: bool, name: str) -> str:
    day = ", trade_date" if per_day else ""
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY symbol, instrument_type, expiry_date, strike_price, option_type{day}
      ORDER BY {FIXTURE_ORDER_FO}) AS rn
    FROM {src}) WHERE rn = 1)"""


AD = """ad AS (
  SELECT trade_date, advances, declines, n - advances - declines AS unchanged, total_stocks,
         total_volume, total_turnover_cr, CASE WHEN avg_return_pct = 0 THEN 0.0 ELSE avg_return_pct END AS avg_return_pct,
         CAST(advances AS DOUBLE) / nullif(declines, 0) AS ad_ratio
  FROM (
    SELECT trade_date,
           count(*) FILTER (WHERE close_adj > open_adj) AS advances,
           count(*) FILTER (WHERE close_adj < open_adj) AS declines,
           count(*) AS n,
           count(DISTINCT symbol) AS total_stocks,
           CAST(sum(total_quantity) AS BIGINT) AS total_volume,
           round(sum(total_turnover), 4) AS total_turnover_cr,
           round(avg((close_adj - open_adj) / nullif(open_adj, 0) * 100), 6) AS avg_return_pct
    FROM silver GROUP BY trade_date) x)"""

PCR = """pcr AS (
  SELECT trade_date, put_oi, call_oi, CAST(put_oi AS DOUBLE) / nullif(call_oi, 0) AS pcr_oi
  FROM (
    SELECT trade_date,
           CAST(sum(CASE WHEN option_type = 'PE' THEN open_interest END) AS BIGINT) AS put_oi,
           CAST(sum(CASE WHEN option_type = 'CE' THEN open_interest END) AS BIGINT) AS call_oi
    FROM fo_clean WHERE instrument_type IN ('OPTIDX', 'OPTSTK') GROUP BY trade_date) y)"""


def with_views(views: tuple[str, ...], *ctes: str) -> str:
    head = cte(*views)
    return head + (",\n" + ",\n".join(ctes) if ctes else "")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    eq_chain = (EQ_NORM, EQ_VALID, EQ_CLEAN)
    fo_chain = (FO_NORM, FO_VALID, fo_dedup("fo_valid", True, "fo_clean"))

    q["market_breadth"] = with_views(
        ("equity_raw", "corporate", "fo_raw"), *eq_chain, ACTS, SILVER, *fo_chain, AD, PCR,
    ) + "\nSELECT ad.*, pcr.put_oi, pcr.call_oi, pcr.pcr_oi FROM ad LEFT JOIN pcr USING (trade_date)"
    return q


# --- landed tables -------------------------------------------------------------

def _cols(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for e, n in pairs)


L_EQUITY = "l_equity AS (SELECT " + _cols(
    ("CAST(ingested_at AS BIGINT)", "ingested_at"), ("trade_date", "trade_date"),
    ("TckrSymb", "symbol"), ("SctySrs", "series"), ("ISIN", "isin"),
    (safe_float("OpnPric"), "open"), (safe_float("HghPric"), "high"), (safe_float("LwPric"), "low"),
    (safe_float("ClsPric"), "close"), (safe_float("LastPric"), "last"),
    (safe_float("PrvsClsgPric"), "prev_close"), (safe_int("TtlNbOfTxsExctd"), "total_trades"),
    (safe_int("TtlTradgVol"), "total_quantity"), (safe_float("TtlTrfVal"), "total_turnover"),
    ("CAST(NULL AS BIGINT)", "deliverable_qty"), ("CAST(NULL AS DOUBLE)", "delivery_pct"),
    ("'bhavcopy'", "source"),
) + " FROM equity_landing)"

L_FO = "l_fo AS (SELECT " + _cols(
    ("CAST(ingested_at AS BIGINT)", "ingested_at"), ("trade_date", "trade_date"),
    ("TckrSymb", "symbol"), ("FinInstrmTp", "instrument_type"), ("XpryDt", "expiry_date"),
    (safe_float("StrkPric"), "strike_price"), ("OptnTp", "option_type"),
    (safe_float("OpnPric"), "open"), (safe_float("HghPric"), "high"), (safe_float("LwPric"), "low"),
    (safe_float("ClsPric"), "close"), (safe_float("SttlmPric"), "settle_price"),
    (safe_int("TtlNbOfTxsExctd"), "contracts"), (safe_float("TtlTrfVal"), "value_in_lakh"),
    (safe_int("OpnIntrst"), "open_interest"), (safe_int("ChngInOpnIntrst"), "change_in_oi"),
) + " FROM fo_landing)"

L_INDEX = "l_index AS (SELECT " + _cols(
    ("CAST(ingested_at AS BIGINT)", "ingested_at"), ("trade_date", "trade_date"),
    ("coalesce(\"index\", indexSymbol, 'UNKNOWN')", "index_name"),
    (comma_float("open"), "open"), (comma_float("high"), "high"), (comma_float("low"), "low"),
    (comma_float("CASE WHEN last IS NOT NULL AND last <> '' THEN last ELSE indicativeClose END"), "close"),
    (comma_float("variation"), "points_change"), (comma_float("percentChange"), "pct_change"),
    ("CAST(0 AS BIGINT)", "volume"), ("CAST(0.0 AS DOUBLE)", "turnover_cr"),
    (comma_float("pe"), "pe_ratio"), (comma_float("pb"), "pb_ratio"), (comma_float("dy"), "div_yield"),
) + " FROM index_landing)"

L_CORPORATE = "l_corporate AS (SELECT " + _cols(
    ("CAST(ingested_at AS BIGINT)", "ingested_at"),
    (strip("coalesce(symbol, '')"), "symbol"), (blank_null("comp"), "company_name"),
    (strip("coalesce(subject, 'UNKNOWN')"), "action_type"), (blank_null("exDate"), "ex_date"),
    (blank_null("recDate"), "record_date"), (blank_null("bcStartDate"), "bc_start_date"),
    (blank_null("bcEndDate"), "bc_end_date"), (blank_null("ndStartDate"), "nd_start_date"),
    (blank_null("ndEndDate"), "nd_end_date"), (blank_null("subject"), "details"),
    (blank_null("coalesce(series, 'EQ')"), "series"),
) + " FROM corporate_landing)"


def _surv(view: str, sym: str, isin: str, name: str) -> str:
    cols = _cols(
        ("CAST(ingested_at AS BIGINT)", "ingested_at"), ("as_of_date", "as_of_date"),
        (strip(f"coalesce({sym}, '')"), "symbol"), (blank_null(isin), "isin"),
        (blank_null(name), "company_name"), ("list_type", "list_type"),
        (f"CAST({safe_int('stage')} AS INTEGER)", "stage"), (blank_null("reason"), "reason"),
    )
    nonempty = " OR ".join(f"{c} IS NOT NULL" for c in (sym, isin, name, "stage", "reason"))
    return f"SELECT {cols} FROM {view} WHERE {nonempty}"


L_SURVEILLANCE = ("l_surveillance AS (" + _surv("surveillance_landing_a", "symbol", "isin", "companyName")
                  + " UNION ALL " + _surv("surveillance_landing_b", "SYMBOL", "ISIN", "NAME") + ")")

L_MACRO = """l_macro AS (
  SELECT CAST(ingested_at AS BIGINT) AS ingested_at, trade_date, 'FII_DII' AS record_type, data
  FROM macro WHERE record_type = 'FII_DII'
  UNION ALL
  SELECT CAST(ingested_at AS BIGINT), trade_date, 'MARKET_STATUS',
         CASE WHEN json_valid(data) AND json_type(data) = 'OBJECT' THEN data
              ELSE CAST(json_object('raw', data) AS VARCHAR) END
  FROM macro WHERE record_type = 'MARKET_STATUS')"""

LANDED = {
    "l_equity": (("equity_landing",), L_EQUITY),
    "l_fo": (("fo_landing",), L_FO),
    "l_index": (("index_landing",), L_INDEX),
    "l_corporate": (("corporate_landing",), L_CORPORATE),
    "l_surveillance": (("surveillance_landing_a", "surveillance_landing_b"), L_SURVEILLANCE),
    "l_macro": (("macro",), L_MACRO),
}


def landed(*names: str, extra_views: tuple[str, ...] = (), extra: tuple[str, ...] = ()) -> str:
    views: list[str] = list(extra_views)
    for n in names:
        for v in LANDED[n][0]:
            if v not in views:
                views.append(v)
    return with_views(tuple(views), *[LANDED[n][1] for n in names], *extra)


PRICE_COLS = ("trade_date, symbol, series, open, high, low, close, total_quantity, "
              "total_turnover, delivery_pct")


def silver_from(src: str) -> str:
    return SILVER.replace("FROM eq_clean p", f"FROM {src} p")


def build_all() -> dict[str, str]:
    q = build()
    eq_chain = (EQ_NORM, EQ_VALID, EQ_CLEAN)
    fo_chain = (FO_NORM, FO_VALID, fo_dedup("fo_valid", True, "fo_clean"))
    eq_views = ("equity_raw",)

    for name in ("equity", "fo", "index", "corporate", "surveillance", "macro"):
        q[f"land_{name}"] = landed(f"l_{name}") + f"\nSELECT * FROM l_{name}"

    q["columnar_to_rows"] = """
SELECT l_orderkey*10+l_linenumber AS ingested_at,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trade_date, 'deliverable' AS source,
       unnest([concat('SYM', CAST(l_suppkey AS VARCHAR)),
               concat('SYM', CAST(l_partkey%100 AS VARCHAR))]) AS symbol,
       unnest([CAST(l_quantity AS BIGINT), CAST(l_quantity*2 AS BIGINT)]) AS deliverable_qty,
       unnest([l_discount*100, l_tax*100]) AS delivery_pct
FROM lineitem"""

    def key(*cols: str) -> str:
        return "concat_ws('_', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in cols) + ")"

    q["business_keys"] = landed(
        "l_equity", "l_index", "l_corporate", extra_views=("fo_raw", "surveillance_raw", "macro"),
    ) + f"""
SELECT 'equity' AS domain, {key('symbol', 'trade_date')} AS message_key FROM l_equity
UNION ALL SELECT 'fo', {key('symbol', 'instrument_type', 'expiry_date', 'strike_price', 'option_type')} FROM fo_raw
UNION ALL SELECT 'index', {key('index_name', 'trade_date')} FROM l_index
UNION ALL SELECT 'surveillance', {key('symbol', 'list_type', 'as_of_date')} FROM surveillance_raw
UNION ALL SELECT 'corporate', {key('symbol', 'action_type', 'ex_date')} FROM l_corporate
UNION ALL SELECT 'macro', {key('record_type', 'trade_date')} FROM macro"""

    q["enforce_schema"] = landed("l_equity") + (
        "\nSELECT * FROM l_equity WHERE trade_date IS NOT NULL AND symbol IS NOT NULL AND series IS NOT NULL")

    q["ingest_summary"] = landed("l_equity", "l_fo", "l_index", "l_corporate", "l_surveillance", "l_macro") + """,
per_domain AS (
SELECT domain, count(*) FILTER (WHERE ok) AS records, count(*) FILTER (WHERE NOT ok) AS errors,
       CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN 'ok'
            WHEN count(*) FILTER (WHERE NOT ok) > 0 THEN 'error' ELSE 'empty' END AS status
FROM (
  SELECT 'equity' AS domain, (trade_date IS NOT NULL AND symbol IS NOT NULL AND series IS NOT NULL) AS ok FROM l_equity
  UNION ALL SELECT 'fo', (trade_date IS NOT NULL AND symbol IS NOT NULL AND instrument_type IS NOT NULL
                          AND expiry_date IS NOT NULL) FROM l_fo
  UNION ALL SELECT 'index', (trade_date IS NOT NULL AND index_name IS NOT NULL) FROM l_index
  UNION ALL SELECT 'corporate', (symbol IS NOT NULL AND action_type IS NOT NULL) FROM l_corporate
  UNION ALL SELECT 'surveillance', (as_of_date IS NOT NULL AND symbol IS NOT NULL AND list_type IS NOT NULL)
            FROM l_surveillance
  UNION ALL SELECT 'macro', TRUE FROM l_macro) s
GROUP BY domain)
SELECT * FROM per_domain"""
    q["ingest_totals"] = q["ingest_summary"].replace(
        "SELECT * FROM per_domain",
        "SELECT CAST(sum(records) AS BIGINT) AS total_records, CAST(sum(errors) AS BIGINT) AS total_errors, "
        "coalesce(string_agg(CASE WHEN status = 'error' THEN domain END, ',' ORDER BY domain), '') "
        "AS failed_domains FROM per_domain")

    q["trading_calendar"] = with_views(eq_views) + """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS trade_date FROM (
  SELECT unnest(generate_series(CAST(min(trade_date) AS DATE), CAST(max(trade_date) AS DATE),
                                INTERVAL 1 DAY)) AS d
  FROM equity_raw) t
WHERE isodow(d) <= 5"""

    q["equity_normalise"] = with_views(eq_views, EQ_NORM) + "\nSELECT * FROM eq_norm"
    q["equity_valid"] = with_views(eq_views, EQ_NORM, EQ_VALID) + "\nSELECT * FROM eq_valid"
    q["equity_rejects"] = with_views(eq_views, EQ_NORM) + """
SELECT * FROM (
  SELECT *, CASE WHEN symbol = '' THEN 'missing_symbol' WHEN close IS NULL THEN 'missing_close'
                 WHEN NOT (close > 0) OR isnan(close) THEN 'non_positive_close' END AS reject_reason
  FROM eq_norm) r WHERE reject_reason IS NOT NULL"""
    q["equity_dedup"] = with_views(eq_views) + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY {FIXTURE_ORDER_EQ}) AS rn
  FROM equity_raw) t WHERE rn = 1"""
    q["equity_clean"] = with_views(eq_views, *eq_chain) + "\nSELECT * FROM eq_clean"

    fo_views = ("fo_raw",)
    q["fo_normalise"] = with_views(fo_views, FO_NORM) + "\nSELECT * FROM fo_norm"
    q["fo_valid"] = with_views(fo_views, FO_NORM, FO_VALID) + "\nSELECT * FROM fo_valid"
    fo_norm_landed = FO_NORM.replace("fo_norm AS", "fo_norm_l AS").replace("FROM fo_raw)", "FROM l_fo)")
    q["fo_rejects"] = landed("l_fo", extra=(fo_norm_landed,)) + """
SELECT * FROM (
  SELECT *, CASE WHEN symbol IS NULL OR symbol = '' THEN 'missing_symbol'
                 WHEN instrument_type IS NULL OR instrument_type = '' THEN 'missing_instrument_type'
                 WHEN expiry_date IS NULL OR expiry_date = '' THEN 'missing_expiry_date' END AS reject_reason
  FROM fo_norm_l) r WHERE reject_reason IS NOT NULL"""
    q["fo_dedup_contract"] = with_views(fo_views, FO_NORM, FO_VALID, fo_dedup("fo_valid", False, "fo_c")) + (
        "\nSELECT * FROM fo_c")
    q["fo_dedup_contract_day"] = with_views(fo_views, *fo_chain) + "\nSELECT * FROM fo_clean"
    q["fo_clean"] = q["fo_dedup_contract_day"]

    q["adjustment_factor"] = landed("l_corporate") + (
        f"\nSELECT symbol, details, {factor('details')} AS adj_factor FROM l_corporate")
    q["adjusting_actions"] = landed("l_corporate") + f"""
SELECT DISTINCT symbol, CAST(TRY_CAST(ex_date AS DATE) AS VARCHAR) AS ex_date, action_type, details,
       adj_factor
FROM (SELECT *, {factor('details')} AS adj_factor FROM l_corporate
      WHERE regexp_matches(action_type, '(?i)bonus|split')) a
WHERE adj_factor < 1.0"""
    q["actions_range_join"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS) + f"""
SELECT {', '.join('p.' + c.strip() for c in PRICE_COLS.split(','))},
       CAST(a.ex_date AS VARCHAR) AS ex_date, a.adj_factor
FROM eq_clean p LEFT JOIN acts_adj a
  ON p.symbol = a.symbol AND TRY_CAST(p.trade_date AS DATE) < a.ex_date"""
    q["cumulative_factor"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS) + f"""
SELECT {PRICE_COLS},
       CASE WHEN count(adj_factor) = 0 THEN 1.0
            ELSE product(CASE WHEN adj_factor > 0 THEN adj_factor END ORDER BY ex_date DESC, adj_factor DESC) END
         AS cumulative_adj_factor
FROM (SELECT p.*, a.adj_factor, a.ex_date FROM eq_clean p LEFT JOIN acts_adj a
        ON p.symbol = a.symbol AND TRY_CAST(p.trade_date AS DATE) < a.ex_date) j
GROUP BY {PRICE_COLS}"""
    since = "eq_since AS (SELECT * FROM eq_clean WHERE trade_date >= '1996-01-01')"
    q["ohlcv_adjusted"] = with_views(("equity_raw", "corporate"), *eq_chain, since, ACTS,
                                     silver_from("eq_since")) + "\nSELECT * FROM silver"
    q["advance_decline"] = with_views(("equity_raw", "corporate"), *eq_chain, ACTS, SILVER, AD) + (
        "\nSELECT * FROM ad")
    q["put_call_ratio"] = with_views(("fo_raw",), *fo_chain, PCR) + "\nSELECT * FROM pcr"

    q["lake_job_gold"] = q["market_breadth"]
    gold = with_views(("equity_raw", "corporate", "fo_raw"), *eq_chain, ACTS, SILVER, *fo_chain, AD, PCR,
                      "gold AS (SELECT ad.*, pcr.put_oi, pcr.call_oi, pcr.pcr_oi "
                      "FROM ad LEFT JOIN pcr USING (trade_date))")
    silver_sql = with_views(("equity_raw", "corporate"), *eq_chain, ACTS, SILVER)
    q["silver_after_new_actions"] = silver_sql + "\nSELECT * FROM silver"
    q["serve_ohlcv"] = silver_sql + """
SELECT trade_date, symbol, open_adj, high_adj, low_adj, close_adj, total_quantity, total_turnover,
       delivery_pct, cumulative_adj_factor
FROM silver WHERE symbol = 'SYM7' AND trade_date BETWEEN '1996-01-01' AND '1997-12-31'"""
    q["serve_ohlcv_raw"] = with_views(eq_views, *eq_chain) + """
SELECT trade_date, symbol, open, high, low, close, total_quantity, total_turnover, delivery_pct
FROM eq_clean WHERE symbol = 'SYM7' AND trade_date BETWEEN '1996-01-01' AND '1997-12-31'"""
    q["serve_breadth"] = gold + "\nSELECT * FROM gold WHERE trade_date BETWEEN '1997-01-01' AND '1998-06-30'"
    q["serve_fo_bhavcopy"] = with_views(fo_views, *fo_chain) + """
SELECT * FROM fo_clean
WHERE symbol = 'SYM7' AND trade_date = '1997-03-02'"""
    q["serve_surveillance"] = with_views(("surveillance_raw",)) + (
        "\nSELECT * FROM surveillance_raw WHERE list_type = 'GSM'")
    q["serve_surveillance_day"] = with_views(("surveillance_raw",)) + (
        "\nSELECT * FROM surveillance_raw WHERE list_type = 'ASM_LT' AND as_of_date = '2024-01-03'")
    q["adhoc_sql"] = silver_sql + """
SELECT symbol, count(*) AS n_days, max(close_adj) AS max_close_adj, min(cumulative_adj_factor) AS min_factor
FROM silver WHERE trade_date BETWEEN '1996-01-01' AND '1997-12-31' GROUP BY symbol"""

    q["stream_equity_clean"] = with_views(eq_views, EQ_NORM, EQ_VALID) + (
        "\nSELECT DISTINCT symbol, trade_date FROM eq_valid")
    q["stream_equity_dedup_ttl"] = q["stream_equity_clean"]
    q["stream_fo_clean"] = with_views(fo_views, FO_NORM, FO_VALID) + (
        "\nSELECT DISTINCT symbol, instrument_type, expiry_date, strike_price, option_type, trade_date "
        "FROM fo_valid")
    feeds = """WITH fed AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS trade_year,
  CASE WHEN year(l_shipdate) < 1997 THEN l_orderkey % 4 ELSE l_orderkey % 12 END AS feed FROM lineitem)"""
    q["compaction_plan"] = feeds + """
SELECT trade_year, count(DISTINCT feed) AS input_files, count(*) AS rows, count(DISTINCT feed) >= 10 AS rewrite
FROM fed GROUP BY trade_year"""
    q["compaction_rewrite"] = feeds + "\nSELECT * EXCLUDE (feed), true AS compact FROM fed"
    q["zorder_rewrite"] = with_views(eq_views, *eq_chain) + "\nSELECT * FROM eq_clean"
    return q

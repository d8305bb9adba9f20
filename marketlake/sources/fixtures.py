"""Domain-shaped inputs derived from the generated test tables.

Each view is declared once as (source table, projection, filter) in SQL
expression text that Spark and DuckDB both accept. ``load`` builds the Spark
DataFrame (a pruned, filtered Parquet scan); ``cte`` renders the same view for
the DuckDB oracle. Nothing is materialised: the views are lazy projections,
so column pruning and filter pushdown reach the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    table: str
    columns: tuple[str, ...]
    where: str | None = None


_PRICE = "l_extendedprice/l_quantity"
_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
# Derivatives trade on three days of each month, so a contract trades on several days.
_FO_DAY = "CAST(CAST(date_trunc('month', l_shipdate) AS DATE) + CAST(l_partkey%3 AS INT) AS STRING)"
# One fetch delivers many records under one ingestion time; their sequence in it is stored.
_FETCH = "CAST(floor(l_orderkey/20) AS BIGINT)*1000 AS ingested_at"
_SEQUENCE = "l_orderkey*10+l_linenumber AS arrival_seq"

VIEWS: dict[str, View] = {
    # Equity bhavcopy records (bronze input). ``tiebreak`` orders rows that
    # share an order line; it is fixture-only.
    "equity_raw": View("lineitem", (
        _FETCH, _SEQUENCE,
        f"{_DAY} AS trade_date",
        "concat(' sym', CAST(l_suppkey AS STRING), ' ') AS symbol",
        "CASE l_returnflag WHEN 'N' THEN 'eq ' WHEN 'A' THEN 'BE' ELSE 'SM' END AS series",
        "concat('INE', CAST(l_partkey AS STRING)) AS isin",
        f"{_PRICE} AS open",
        f"{_PRICE}*(1+l_tax) AS high",
        f"{_PRICE}*(1-l_discount) AS low",
        f"CASE WHEN l_linenumber=7 THEN -1*{_PRICE} "
        f"WHEN l_linenumber%3=0 THEN {_PRICE}*(1-l_discount) "
        f"WHEN l_linenumber%3=1 THEN {_PRICE}*(1+l_tax) "
        f"ELSE {_PRICE} END AS close",
        f"CASE WHEN l_linenumber=5 THEN -1*{_PRICE} ELSE {_PRICE}*(1+l_discount) END AS last",
        f"CASE WHEN l_linenumber=4 THEN NULL ELSE {_PRICE}*(1-l_tax) END AS prev_close",
        "CAST(l_orderkey%997 AS BIGINT) AS total_trades",
        "CAST(l_quantity AS BIGINT) AS total_quantity",
        "l_extendedprice AS total_turnover",
        "CASE WHEN l_linenumber=3 THEN NULL ELSE CAST(l_quantity AS BIGINT)%7 END AS deliverable_qty",
        "l_discount*100 AS delivery_pct",
        "'bhavcopy' AS source",
        "l_partkey AS tiebreak",
    )),
    # Corporate actions of the whole table, 20 for each symbol; action_type
    # carries the subject text, as details does. Some ex-dates are malformed.
    "corporate": View("part", (
        "concat('SYM', CAST(CAST(floor(p_partkey/20) AS BIGINT) AS STRING)) AS symbol",
        "CAST(p_partkey AS BIGINT) AS ingested_at",
        "CASE p_size%5 WHEN 0 THEN 'BONUS - 1:1' "
        "WHEN 1 THEN 'FACE VALUE SPLIT FROM RS 10 TO RS 2' "
        "WHEN 2 THEN 'DIVIDEND - RS 5 PER SHARE' "
        "WHEN 3 THEN 'bonus 3:2' ELSE 'RIGHTS 1:4' END AS action_type",
        "CASE WHEN p_partkey%23=0 THEN 'to be announced' "
        "ELSE CAST(DATE '1996-01-01' + CAST(p_partkey*37%2000 AS INT) AS STRING) END AS ex_date",
        "CASE p_size%5 WHEN 0 THEN 'BONUS - 1:1' "
        "WHEN 1 THEN 'FACE VALUE SPLIT FROM RS 10 TO RS 2' "
        "WHEN 2 THEN 'DIVIDEND - RS 5 PER SHARE' "
        "WHEN 3 THEN 'bonus 3:2' ELSE 'RIGHTS 1:4' END AS details",
    )),
    # Derivatives bhavcopy records; some lack the symbol, the instrument or the expiry.
    "fo_raw": View("lineitem", (
        _FETCH, _SEQUENCE,
        f"{_FO_DAY} AS trade_date",
        "CASE WHEN l_linenumber=6 AND l_partkey%4=0 THEN '  ' "
        "ELSE concat(' sym', CAST(l_suppkey AS STRING)) END AS symbol",
        "CASE l_returnflag WHEN 'N' THEN 'optidx' WHEN 'A' THEN 'OPTSTK ' ELSE 'FUTSTK' END "
        "AS instrument_type",
        "CASE WHEN l_linenumber=5 AND l_partkey%4=1 THEN NULL WHEN l_linenumber=4 AND l_partkey%4=2 THEN '' "
        "ELSE CAST(last_day(CAST(l_shipdate AS DATE)) AS STRING) END AS expiry_date",
        f"CASE WHEN l_returnflag='R' THEN NULL "
        f"ELSE CAST(floor({_PRICE}/40000) AS DOUBLE)*20000000 + 0.5*(l_partkey%2) END AS strike_price",
        "CASE WHEN l_returnflag='R' THEN '' WHEN l_linestatus='O' THEN 'ce' ELSE 'PE ' END "
        "AS option_type",
        f"{_PRICE} AS open",
        "CAST(NULL AS DOUBLE) AS high",
        "CAST(NULL AS DOUBLE) AS low",
        f"CASE WHEN l_linenumber=7 THEN -1*{_PRICE} ELSE {_PRICE}*(1-l_discount) END AS close",
        f"{_PRICE}*(1+l_tax) AS settle_price",
        "CAST(l_linenumber AS BIGINT) AS contracts",
        "l_extendedprice AS value_in_lakh",
        "CAST(l_quantity AS BIGINT)*100 AS open_interest",
        "CAST(l_linenumber-4 AS BIGINT) AS change_in_oi",
        "l_partkey AS tiebreak",
    )),
    # Index snapshot items as delivered (strings with thousands separators,
    # a missing name on some items, '-' and '0' last prices).
    "index_landing": View("events", (
        "event_id AS ingested_at",
        "CAST(CAST(ts AS DATE) AS STRING) AS trade_date",
        "CASE WHEN user_id%7=0 THEN NULL ELSE concat('IDX ', CAST(user_id AS STRING)) END AS \"index\"",
        "concat('S', CAST(user_id AS STRING)) AS indexSymbol",
        "concat('1,', CAST(100+user_id AS STRING), '.5') AS open",
        "CAST(NULL AS STRING) AS high",
        "CAST(NULL AS STRING) AS low",
        "CASE event_type WHEN 'error' THEN '-' WHEN 'view' THEN '0' "
        "ELSE CAST(1000+user_id AS STRING) END AS last",
        "'2,000.25' AS indicativeClose",
        "CASE WHEN event_type='click' THEN concat('-', CAST(user_id%9 AS STRING), '.25') "
        "ELSE NULL END AS variation",
        "CAST(value AS STRING) AS percentChange",
        "CASE WHEN user_id%5=0 THEN '' ELSE '22.5' END AS pe",
        "CAST(NULL AS STRING) AS pb",
        "'1.1' AS dy",
    )),
    # Surveillance list records (symbol still padded).
    "surveillance_raw": View("customer", (
        "CAST(c_custkey AS BIGINT) AS ingested_at",
        "CAST(DATE '2024-01-01' + CAST(c_custkey%5 AS INT) AS STRING) AS as_of_date",
        "concat(' CUST', CAST(c_custkey AS STRING), ' ') AS symbol",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'ASM_LT' WHEN 'MACHINERY' THEN 'ASM_ST' "
        "WHEN 'HOUSEHOLD' THEN 'GSM' ELSE 'FO_BAN' END AS list_type",
        "CASE WHEN c_mktsegment='HOUSEHOLD' THEN c_nationkey%7 ELSE NULL END AS stage",
        "c_name AS company_name",
    )),
    # Macro records: FII/DII items and market-status payloads (JSON text).
    "macro": View("events", (
        "event_id AS ingested_at",
        "CAST(CAST(ts AS DATE) AS STRING) AS trade_date",
        "CASE event_type WHEN 'purchase' THEN 'FII_DII' ELSE 'MARKET_STATUS' END AS record_type",
        "props AS data",
    )),
    # Equity landing rows in the exchange's column names, all strings, with
    # blanks, junk and signed/exponent numbers to exercise the safe casts.
    "equity_landing": View("lineitem", (
        "l_orderkey*10+l_linenumber AS ingested_at",
        f"{_DAY} AS trade_date",
        "CASE WHEN l_linenumber=6 THEN NULL ELSE concat('SYM', CAST(l_suppkey AS STRING)) END "
        "AS TckrSymb",
        "CASE l_returnflag WHEN 'N' THEN 'EQ' WHEN 'A' THEN 'BE' ELSE 'SM' END AS SctySrs",
        "concat('INE', CAST(l_partkey AS STRING)) AS ISIN",
        f"CAST({_PRICE} AS STRING) AS OpnPric",
        f"CASE WHEN l_linenumber=2 THEN '' ELSE CAST({_PRICE}*(1+l_tax) AS STRING) END AS HghPric",
        f"CASE WHEN l_linenumber=3 THEN ' n/a ' ELSE CAST({_PRICE}*(1-l_discount) AS STRING) END "
        "AS LwPric",
        f"CASE WHEN l_linenumber=4 THEN concat(' ', CAST(l_quantity AS STRING), ' ') "
        f"WHEN l_linenumber=5 THEN '12d' ELSE CAST({_PRICE} AS STRING) END AS ClsPric",
        "CASE WHEN l_linenumber=1 THEN '1e2' ELSE NULL END AS LastPric",
        "CASE WHEN l_linenumber=1 THEN '-0.5' ELSE '.5' END AS PrvsClsgPric",
        "CASE WHEN l_linenumber=2 THEN concat(CAST(l_quantity AS STRING), '7') "
        "WHEN l_linenumber=3 THEN '-7.9' ELSE CAST(l_quantity AS STRING) END AS TtlTradgVol",
        "CAST(l_extendedprice AS STRING) AS TtlTrfVal",
        "CASE WHEN l_linenumber=4 THEN 'x' ELSE CAST(l_orderkey%97 AS STRING) END "
        "AS TtlNbOfTxsExctd",
    )),
    # Derivatives landing rows in the exchange's column names, all strings.
    "fo_landing": View("lineitem", (
        "l_orderkey*10+l_linenumber AS ingested_at",
        f"{_DAY} AS trade_date",
        "CASE l_returnflag WHEN 'N' THEN 'OPTIDX' WHEN 'A' THEN 'OPTSTK' ELSE 'FUTSTK' END "
        "AS FinInstrmTp",
        "CASE WHEN l_linenumber=6 THEN ' ' ELSE concat('SYM', CAST(l_suppkey AS STRING)) END AS TckrSymb",
        "CASE WHEN l_linenumber=5 AND l_returnflag='R' THEN NULL "
        "ELSE CAST(CAST(l_shipdate AS DATE)+30 AS STRING) END AS XpryDt",
        f"CASE WHEN l_returnflag='R' THEN ' ' "
        f"ELSE CAST(CAST(floor({_PRICE}/100) AS DOUBLE)*100 AS STRING) END AS StrkPric",
        "CASE WHEN l_returnflag='R' THEN NULL WHEN l_linestatus='O' THEN 'CE' ELSE 'PE' END "
        "AS OptnTp",
        f"CAST({_PRICE} AS STRING) AS OpnPric",
        "CAST(NULL AS STRING) AS HghPric",
        "'abc' AS LwPric",
        f"CAST({_PRICE}*(1-l_discount) AS STRING) AS ClsPric",
        f"CAST({_PRICE}*(1+l_tax) AS STRING) AS SttlmPric",
        "CAST(l_linenumber AS STRING) AS TtlNbOfTxsExctd",
        "CAST(l_extendedprice AS STRING) AS TtlTrfVal",
        "CAST(l_quantity*100 AS STRING) AS OpnIntrst",
        "CAST(l_linenumber-4 AS STRING) AS ChngInOpnIntrst",
    )),
    # Corporate-action landing items (string fields, padding, blanks, nulls),
    # one per part: the whole table.
    "corporate_landing": View("part", (
        "CAST(p_partkey AS BIGINT) AS ingested_at",
        "CASE WHEN p_partkey%13=0 THEN NULL ELSE concat(' SYM', CAST(p_partkey%100 AS STRING), ' ') END "
        "AS symbol",
        "CASE WHEN p_partkey%11=0 THEN '  ' ELSE p_name END AS comp",
        "CASE WHEN p_partkey%17=0 THEN NULL "
        "WHEN p_size%5=0 THEN ' BONUS - 1:1 ' "
        "WHEN p_size%5=1 THEN 'FACE VALUE SPLIT FROM RS 10 TO RS 2' "
        "WHEN p_size%5=2 THEN 'DIVIDEND - RS 5 PER SHARE' "
        "WHEN p_size%5=3 THEN 'bonus 3:2' ELSE 'RIGHTS 1:4' END AS subject",
        "CAST(DATE '1996-01-01' + CAST(p_partkey*37%2000 AS INT) AS STRING) AS exDate",
        "CASE WHEN p_partkey%3=0 THEN '' "
        "ELSE CAST(DATE '1996-01-03' + CAST(p_partkey*37%2000 AS INT) AS STRING) END AS recDate",
        "CASE WHEN p_partkey%2=0 THEN NULL ELSE '-' END AS bcStartDate",
        "CAST(NULL AS STRING) AS bcEndDate",
        "CASE WHEN p_partkey%7=0 THEN ' 2024-01-01 ' ELSE NULL END AS ndStartDate",
        "CAST(NULL AS STRING) AS ndEndDate",
        "CASE WHEN p_partkey%4=0 THEN NULL WHEN p_partkey%4=1 THEN ' ' ELSE 'EQ' END AS series",
    )),
    # Surveillance landing items. Lists deliver either camel-case keys
    # (symbol, isin, companyName) or upper-case keys (SYMBOL, ISIN, NAME).
    "surveillance_landing_a": View("customer", (
        "CAST(c_custkey AS BIGINT) AS ingested_at",
        "CAST(DATE '2024-01-01' + CAST(c_custkey%5 AS INT) AS STRING) AS as_of_date",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'ASM_LT' WHEN 'MACHINERY' THEN 'ASM_ST' "
        "WHEN 'HOUSEHOLD' THEN 'GSM' ELSE 'FO_BAN' END AS list_type",
        "CASE WHEN c_custkey%8<>0 THEN concat(' CUST', CAST(c_custkey AS STRING), ' ') END AS symbol",
        "CASE WHEN c_custkey%3=0 THEN concat('INE', CAST(c_custkey AS STRING)) "
        "WHEN c_custkey%3=1 THEN ' ' END AS isin",
        "CASE WHEN c_custkey%8<>0 THEN c_name END AS companyName",
        "CASE WHEN c_mktsegment='HOUSEHOLD' THEN CAST(c_nationkey%7 AS STRING) END AS stage",
        "CASE WHEN c_custkey%6=0 THEN 'price band' WHEN c_custkey%6=2 THEN '' END AS reason",
    ), "c_custkey%2=0"),
    "surveillance_landing_b": View("customer", (
        "CAST(c_custkey AS BIGINT) AS ingested_at",
        "CAST(DATE '2024-01-01' + CAST(c_custkey%5 AS INT) AS STRING) AS as_of_date",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'ASM_LT' WHEN 'MACHINERY' THEN 'ASM_ST' "
        "WHEN 'HOUSEHOLD' THEN 'GSM' ELSE 'FO_BAN' END AS list_type",
        "concat('CUST', CAST(c_custkey AS STRING)) AS SYMBOL",
        "CASE WHEN c_custkey%3=0 THEN concat('INE', CAST(c_custkey AS STRING)) END AS ISIN",
        "concat(c_name, ' LTD') AS NAME",
        "CASE WHEN c_mktsegment='HOUSEHOLD' THEN CAST(c_nationkey%7 AS STRING) END AS stage",
        "CAST(NULL AS STRING) AS reason",
    ), "c_custkey%2=1"),
}


def path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated test table, scanned by Spark."""
    return spark.read.parquet(path(sf_dir, name))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    view = VIEWS[name]
    df = table(spark, sf_dir, view.table)
    if view.where:
        df = df.where(view.where)
    return df.selectExpr(*[c.replace('"', "`") for c in view.columns])


def cte(*names: str) -> str:
    """``WITH`` clause defining the named views for the DuckDB oracle."""
    parts = []
    for name in names:
        view = VIEWS[name]
        where = f" WHERE {view.where}" if view.where else ""
        parts.append(f"{name} AS (SELECT {', '.join(view.columns)} FROM {view.table}{where})")
    return "WITH " + ",\n".join(parts)

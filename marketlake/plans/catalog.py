"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Inputs are the fixture views over the generated tables (``sources.fixtures``),
so every query's work grows with the tables. Outputs alias every computed
column; order-dependent floating sums/averages are rounded the same way as in
the DuckDB oracle.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import adjust, breadth, clean, maintain
from marketlake.plans import lake
from marketlake.plans.serve import Lake
from marketlake.session import scratch_path
from marketlake.sources import fixtures, landing
from marketlake.streaming import clean_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixture arrival order (ingestion time, stored sequence, then fixture tie breakers).
EQ_ORDER = ("ingested_at", "arrival_seq", "tiebreak", "total_turnover")
FO_ORDER = ("ingested_at", "arrival_seq", "tiebreak", "value_in_lakh")

# Parameters of the serving queries.
SERVE_SYMBOL = "sym7"
SERVE_FROM, SERVE_TO = "1996-01-01", "1997-12-31"
SERVE_FO_DAY = "1997-03-02"
BREADTH_FROM, BREADTH_TO = "1997-01-01", "1998-06-30"
SILVER_START = "1996-01-01"


def _load(spark: SparkSession, sf_dir: str):
    return lambda name: fixtures.load(spark, sf_dir, name)


def _round_breadth(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_turnover_cr": F.round("total_turnover_cr", 4),
        # no negative zero
        "avg_return_pct": F.when(F.round("avg_return_pct", 6) == 0, 0.0).otherwise(F.round("avg_return_pct", 6)),
    })


def _ex_date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ex_date", F.col("ex_date").cast("string"))


# --- sources / landing -------------------------------------------------------

def land_equity(spark, sf_dir):
    return landing.land_equity(_load(spark, sf_dir)("equity_landing"))


def land_fo(spark, sf_dir):
    return landing.land_fo(_load(spark, sf_dir)("fo_landing"))


def land_index(spark, sf_dir):
    return landing.land_index(_load(spark, sf_dir)("index_landing"))


def land_corporate(spark, sf_dir):
    return landing.land_corporate(_load(spark, sf_dir)("corporate_landing"))


def land_surveillance(spark, sf_dir):
    load = _load(spark, sf_dir)
    return landing.land_surveillance([load("surveillance_landing_a"), load("surveillance_landing_b")])


def land_macro(spark, sf_dir):
    macro = _load(spark, sf_dir)("macro")
    return landing.land_macro(
        macro.where(F.col("record_type") == "FII_DII"),
        macro.where(F.col("record_type") == "MARKET_STATUS"),
    )


def columnar_to_rows(spark, sf_dir):
    """Each line item stands for one columnar deliverable-position payload."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    columnar = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingested_at"),
        F.col("l_shipdate").cast("date").cast("string").alias("trade_date"),
        F.array(F.concat(F.lit("SYM"), F.col("l_suppkey").cast("string")),
                F.concat(F.lit("SYM"), (F.col("l_partkey") % 100).cast("string"))).alias(" Symbol "),
        F.array(F.col("l_quantity").cast("bigint"),
                (F.col("l_quantity") * 2).cast("bigint")).alias("Deliverable Qty"),
        F.array(F.col("l_discount") * 100, F.col("l_tax") * 100).alias("Delivery Pct"),
    )
    return landing.columnar_to_rows(columnar, [" Symbol ", "Deliverable Qty", "Delivery Pct"])


def business_keys(spark, sf_dir):
    load = _load(spark, sf_dir)
    domains = {
        "equity": landing.land_equity(load("equity_landing")),
        "fo": load("fo_raw"),
        "index": landing.land_index(load("index_landing")),
        "surveillance": load("surveillance_raw"),
        "corporate": landing.land_corporate(load("corporate_landing")),
        "macro": load("macro"),
    }
    out = None
    for name, df in domains.items():
        part = df.select(F.lit(name).alias("domain"), landing.business_key(name, df).alias("message_key"))
        out = part if out is None else out.unionByName(part)
    return out


def enforce_schema(spark, sf_dir):
    accepted, _ = landing.enforce_schema(land_equity(spark, sf_dir), "equity_raw")
    return accepted


def ingest_summary(spark, sf_dir):
    return landing.ingest_summary([
        ("equity", land_equity(spark, sf_dir)),
        ("fo", land_fo(spark, sf_dir)),
        ("index", land_index(spark, sf_dir)),
        ("corporate", land_corporate(spark, sf_dir)),
        ("surveillance", land_surveillance(spark, sf_dir)),
        ("macro", land_macro(spark, sf_dir)),
    ])


def ingest_totals(spark, sf_dir):
    return landing.ingest_totals(ingest_summary(spark, sf_dir))


def trading_calendar(spark, sf_dir):
    """Trading weekdays spanning the equity records' date range."""
    from marketlake.sources.calendar import weekdays_between

    eq = _load(spark, sf_dir)("equity_raw")
    bounds = eq.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    return weekdays_between(bounds, "lo", "hi")


# --- cleaning ------------------------------------------------------------------

def equity_normalise(spark, sf_dir):
    return clean.equity_normalise(_load(spark, sf_dir)("equity_raw"))


def equity_valid(spark, sf_dir):
    return clean.equity_valid(equity_normalise(spark, sf_dir))


def equity_rejects(spark, sf_dir):
    return clean.equity_rejects(equity_normalise(spark, sf_dir))


def equity_dedup(spark, sf_dir):
    return clean.equity_dedup(_load(spark, sf_dir)("equity_raw"), EQ_ORDER)


def equity_clean(spark, sf_dir):
    return clean.equity_clean(_load(spark, sf_dir)("equity_raw"), EQ_ORDER)


def fo_normalise(spark, sf_dir):
    return clean.fo_normalise(_load(spark, sf_dir)("fo_raw"))


def fo_valid(spark, sf_dir):
    return clean.fo_valid(fo_normalise(spark, sf_dir))


def fo_rejects(spark, sf_dir):
    """Dead letters of the FO landing: records without symbol/type/expiry."""
    return clean.fo_rejects(clean.fo_normalise(land_fo(spark, sf_dir)))


def fo_dedup_contract(spark, sf_dir):
    return clean.fo_dedup_contract(fo_valid(spark, sf_dir), FO_ORDER)


def fo_dedup_contract_day(spark, sf_dir):
    return clean.fo_dedup_contract_day(fo_valid(spark, sf_dir), FO_ORDER)


def fo_clean(spark, sf_dir):
    return clean.fo_clean(_load(spark, sf_dir)("fo_raw"), FO_ORDER)


# --- adjustment (silver) ------------------------------------------------------

def adjustment_factor(spark, sf_dir):
    from marketlake.functions.factor import adjustment_factor as factor

    corp = land_corporate(spark, sf_dir)
    return corp.select("symbol", "details", factor("details").alias("adj_factor"))


def adjusting_actions(spark, sf_dir):
    """P2-P5 over the landed corporate-action feed (one item per part)."""
    return _ex_date_text(adjust.adjusting_actions(land_corporate(spark, sf_dir)))


def actions_range_join(spark, sf_dir):
    prices = equity_clean(spark, sf_dir).select(*adjust.PRICE_COLUMNS)
    joined = adjust.actions_range_join(prices, _load(spark, sf_dir)("corporate"))
    return _ex_date_text(joined)


def cumulative_factor(spark, sf_dir):
    prices = equity_clean(spark, sf_dir)
    return adjust.cumulative_factor_interval(prices.select(*adjust.PRICE_COLUMNS), _load(spark, sf_dir)("corporate"))


def _silver(spark, sf_dir, start_date=None):
    load = _load(spark, sf_dir)
    return lake.silver(load("equity_raw"), load("corporate"), EQ_ORDER, start_date=start_date)


def ohlcv_adjusted(spark, sf_dir):
    return _silver(spark, sf_dir, SILVER_START)


# --- aggregation (gold) -------------------------------------------------------

def advance_decline(spark, sf_dir):
    return _round_breadth(breadth.advance_decline(_silver(spark, sf_dir)))


def put_call_ratio(spark, sf_dir):
    return breadth.put_call_ratio(lake.fo_bronze_for_pcr(_load(spark, sf_dir)("fo_raw"), FO_ORDER))


def market_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean -> adjust -> breadth, joined with the put-call ratio."""
    load = _load(spark, sf_dir)
    gold = lake.gold(load("equity_raw"), load("corporate"), load("fo_raw"),
                     order=EQ_ORDER, fo_order=FO_ORDER)
    return _round_breadth(gold)


def lake_job_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job: silver and gold written to the shared folder, gold read back."""
    load = _load(spark, sf_dir)
    paths = lake.run_lake(load("equity_raw"), load("corporate"), load("fo_raw"),
                          scratch_path(spark, "lake"), order=EQ_ORDER, fo_order=FO_ORDER)
    return _round_breadth(spark.read.parquet(paths["gold"]).drop("trade_year"))


# --- serving -------------------------------------------------------------------

def _lake(spark, sf_dir, *tables: str) -> Lake:
    """A serving surface over the named tables, each written once in a session and scanned by name."""
    from marketlake.plans.catalog_tables import served

    build = {
        "silver": lambda: _silver(spark, sf_dir),
        "gold": lambda: market_breadth(spark, sf_dir),
        "fo": lambda: fo_clean(spark, sf_dir),
        "surveillance": lambda: _load(spark, sf_dir)("surveillance_raw"),
        "equity": lambda: equity_clean(spark, sf_dir),
    }
    return Lake.from_names(spark, **{t: served(spark, sf_dir, t, build[t]) for t in tables})


def silver_after_new_actions(spark, sf_dir):
    """Silver is built before the last actions arrive, then the years they change are rebuilt."""
    load, path = _load(spark, sf_dir), scratch_path(spark, "late-actions")
    corporate = load("corporate")
    late = F.col("ex_date") < "1997-07-01"  # early ex-dates, known late
    lake.write_silver(lake.silver(load("equity_raw"), corporate.where(~late), EQ_ORDER), path)
    lake.rebuild_silver(load("equity_raw"), corporate, corporate.where(late), path, EQ_ORDER)
    return spark.read.parquet(path).drop("trade_year")


def serve_ohlcv(spark, sf_dir):
    return _lake(spark, sf_dir, "silver").get_ohlcv(SERVE_SYMBOL, SERVE_FROM, SERVE_TO)


def serve_ohlcv_raw(spark, sf_dir):
    return _lake(spark, sf_dir, "equity").get_ohlcv_raw(SERVE_SYMBOL, SERVE_FROM, SERVE_TO)


def serve_breadth(spark, sf_dir):
    return _lake(spark, sf_dir, "gold").get_market_breadth(BREADTH_FROM, BREADTH_TO)


def serve_fo_bhavcopy(spark, sf_dir):
    return _lake(spark, sf_dir, "fo").get_fo_bhavcopy(SERVE_SYMBOL, SERVE_FO_DAY)


def serve_surveillance(spark, sf_dir):
    return _lake(spark, sf_dir, "surveillance").get_surveillance("gsm", None)


def serve_surveillance_day(spark, sf_dir):
    return _lake(spark, sf_dir, "surveillance").get_surveillance("asm_lt", "2024-01-03")


ADHOC_SQL = (
    "SELECT symbol, count(*) AS n_days, max(close_adj) AS max_close_adj, "
    "min(cumulative_adj_factor) AS min_factor "
    "FROM {silver} WHERE trade_date BETWEEN :d0 AND :d1 GROUP BY symbol"
)


def adhoc_sql(spark, sf_dir):
    return _lake(spark, sf_dir, "silver").query(ADHOC_SQL, {"d0": SERVE_FROM, "d1": SERVE_TO})


# --- streaming -----------------------------------------------------------------

# Micro-batches to cut a landing into, files in each, and records in a file: more in each as the landing
# grows, so the fixed cost of a batch (state and files of every task) is not paid for a few records.
STREAM_BATCHES, BATCH_FILES, MOST_BATCH_FILES = 4, 4, 400
FILE_RECORDS, MOST_FILE_RECORDS = 4_000, 250_000


def _land_messages(raw: DataFrame, path: str) -> int:
    """Write records as JSON message files; returns how many files a micro-batch takes."""
    n = raw.count()
    records = min(max(n // (STREAM_BATCHES * BATCH_FILES), FILE_RECORDS), MOST_FILE_RECORDS)
    raw.write.option("maxRecordsPerFile", records).mode("overwrite").json(path, compression="gzip")
    return min(max(math.ceil(n / records / STREAM_BATCHES), BATCH_FILES), MOST_BATCH_FILES)


# State partitions a core: each costs a Python worker, a load and a commit in every micro-batch.
CORE_STATE_PARTITIONS = 4


def _state_partitions(spark) -> int:
    """As many state partitions as keep all cores busy; not more than the session's shuffle partitions."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, CORE_STATE_PARTITIONS * spark.sparkContext.defaultParallelism)


def _stream_keys(spark, sf_dir, domain: str) -> DataFrame:
    view = "equity_raw" if domain == "equity" else "fo_raw"
    src = scratch_path(spark, f"{domain}-landing")
    out = scratch_path(spark, f"{domain}-bronze")
    ckpt = scratch_path(spark, f"{domain}-checkpoint")
    # Land the raw records as JSON message files (several per table so the
    # stream runs several micro-batches).
    files = _land_messages(fixtures.load(spark, sf_dir, view), src)
    stream = clean_stream.read_stream(spark, src, clean_stream.RAW_SCHEMAS[domain],
                                      fmt="json", max_files_per_trigger=files)
    if domain == "equity":
        cleaned = clean_stream.equity_clean_stream(stream)
        keys = list(clean.EQUITY_KEY)
    else:
        cleaned = clean_stream.fo_clean_stream(stream)
        keys = list(clean.FO_CONTRACT_DAY_KEY)
    # A multi-year backfill in one run: partition by year, not by day.
    cleaned = cleaned.withColumn("trade_year", F.substring("trade_date", 1, 4))
    # the keys of 24 or 48 hours do not stay in the executors' heap
    query = clean_stream.start_query(
        spark, lambda: clean_stream.write_bronze(cleaned, out, ckpt, partition_by=("trade_year",)), conf=clean_stream.ROCKSDB)
    clean_stream.run_available_now(query)
    return spark.read.parquet(out).select(*keys)


def stream_equity_dedup_ttl(spark, sf_dir):
    """C3 with processing-time TTL state (exact variant), key set output."""
    from marketlake.streaming import ttl_dedup

    src = scratch_path(spark, "equity-landing-ttl")
    out = scratch_path(spark, "equity-bronze-ttl")
    ckpt = scratch_path(spark, "equity-checkpoint-ttl")
    files = _land_messages(fixtures.load(spark, sf_dir, "equity_raw"), src)
    stream = clean_stream.read_stream(spark, src, clean_stream.RAW_SCHEMAS["equity"], fmt="json",
                                      max_files_per_trigger=files)
    valid = stream.transform(clean.equity_normalise).transform(clean.equity_valid)
    deduped = ttl_dedup.dedup_with_ttl_rows(valid, list(clean.EQUITY_KEY))
    query = ttl_dedup.start_with_conf(spark, lambda: (
        deduped.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()),
        state_partitions=_state_partitions(spark))
    clean_stream.run_available_now(query)
    return spark.read.parquet(out).select(*clean.EQUITY_KEY)


def stream_equity_clean(spark, sf_dir):
    return _stream_keys(spark, sf_dir, "equity")


def stream_fo_clean(spark, sf_dir):
    return _stream_keys(spark, sf_dir, "fo")


# --- maintenance -----------------------------------------------------------------

def zorder_rewrite(spark, sf_dir):
    """M2 over a written table: its split points and the rewrite read the files, not the cleaning plan."""
    path = scratch_path(spark, "zorder-input")
    equity_clean(spark, sf_dir).write.parquet(path)
    return maintain.zorder(spark.read.parquet(path), ["symbol", "trade_date"])


COMPACT_FEEDS = 12
# Tasks for the years of a feed: this many less one in a row, and those without a date, have one each.
COMPACT_YEARS = 16


def _many_files(spark, sf_dir) -> str:
    """Line items by ship year, in feeds: one file for each feed and year.

    Years before 1997 come in fewer feeds than a compaction asks for.
    """
    path = scratch_path(spark, "small-files")
    li = fixtures.table(spark, sf_dir, "lineitem").withColumn("trade_year", F.year("l_shipdate"))
    feed = F.when(F.col("trade_year") < 1997, F.col("l_orderkey") % 4).otherwise(F.col("l_orderkey") % COMPACT_FEEDS)
    li = li.withColumn("feed", feed).where(F.col("feed").between(0, COMPACT_FEEDS - 1))
    # each year's rows of a feed are one file: a task for each of them, by number, as hashes would
    # put several years into one; all feeds are dealt in one reading of the table
    year = F.coalesce(F.pmod("trade_year", F.lit(COMPACT_YEARS - 1)), F.lit(COMPACT_YEARS - 1))
    dealt = li.repartitionById(COMPACT_FEEDS * COMPACT_YEARS, (F.col("feed") * COMPACT_YEARS + year).cast("int"))
    dealt.drop("feed").write.partitionBy("trade_year").parquet(path)
    return path


def compaction_plan(spark, sf_dir):
    """M1: which partition directories of a written table need compaction."""
    plan = maintain.compaction_plan(spark.read.parquet(_many_files(spark, sf_dir)))
    year = F.regexp_extract("partition", "trade_year=([0-9]+)", 1).cast("int")
    return plan.select(year.alias("trade_year"), "input_files", "rows", "rewrite")


def compaction_rewrite(spark, sf_dir):
    """M1/M2: the compacted table, still partitioned, with whether its small files are gone."""
    src, dst = _many_files(spark, sf_dir), scratch_path(spark, "compacted")
    maintain.rewrite(spark, src, dst, ["l_suppkey", "l_shipdate"])
    files = maintain.compaction_plan(spark.read.parquet(dst))
    year = F.regexp_extract("partition", "trade_year=([0-9]+)", 1).cast("int")
    few = files.select(year.alias("trade_year"), (F.col("input_files") < maintain.MIN_INPUT_FILES).alias("compact"))
    return spark.read.parquet(dst).join(F.broadcast(few), "trade_year")


QUERIES: dict[str, Query] = {
    "land_equity": land_equity,
    "land_fo": land_fo,
    "land_index": land_index,
    "land_corporate": land_corporate,
    "land_surveillance": land_surveillance,
    "land_macro": land_macro,
    "columnar_to_rows": columnar_to_rows,
    "business_keys": business_keys,
    "enforce_schema": enforce_schema,
    "ingest_summary": ingest_summary,
    "ingest_totals": ingest_totals,
    "trading_calendar": trading_calendar,
    "equity_normalise": equity_normalise,
    "equity_valid": equity_valid,
    "equity_rejects": equity_rejects,
    "equity_dedup": equity_dedup,
    "equity_clean": equity_clean,
    "fo_normalise": fo_normalise,
    "fo_valid": fo_valid,
    "fo_rejects": fo_rejects,
    "fo_dedup_contract": fo_dedup_contract,
    "fo_dedup_contract_day": fo_dedup_contract_day,
    "fo_clean": fo_clean,
    "adjustment_factor": adjustment_factor,
    "adjusting_actions": adjusting_actions,
    "actions_range_join": actions_range_join,
    "cumulative_factor": cumulative_factor,
    "ohlcv_adjusted": ohlcv_adjusted,
    "advance_decline": advance_decline,
    "put_call_ratio": put_call_ratio,
    "market_breadth": market_breadth,
    "lake_job_gold": lake_job_gold,
    "silver_after_new_actions": silver_after_new_actions,
    "serve_ohlcv": serve_ohlcv,
    "serve_ohlcv_raw": serve_ohlcv_raw,
    "serve_breadth": serve_breadth,
    "serve_fo_bhavcopy": serve_fo_bhavcopy,
    "serve_surveillance": serve_surveillance,
    "serve_surveillance_day": serve_surveillance_day,
    "adhoc_sql": adhoc_sql,
    "stream_equity_clean": stream_equity_clean,
    "stream_equity_dedup_ttl": stream_equity_dedup_ttl,
    "stream_fo_clean": stream_fo_clean,
    "zorder_rewrite": zorder_rewrite,
    "compaction_plan": compaction_plan,
    "compaction_rewrite": compaction_rewrite,
}

"""Registered queries over written and named tables, delivered files, messages and streams with payload."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import adjust, breadth, clean, maintain
from marketlake.plans import lake, tables
from marketlake.session import exists, scratch_path
from marketlake.sources import fixtures, landing
from marketlake.streaming import clean_stream, first_arrival

# --- delivered files ----------------------------------------------------------------

#: Shares of the line items, in tenths, that four deliveries bring: the later, the larger.
DELIVERIES = ((0, 1), (1, 3), (3, 6), (6, 10))
#: The order of the items within a file, down to equal rows.
_IN_FILE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _delivered(spark: SparkSession, sf_dir: str) -> str:
    """The equity landing items as JSON files, one delivery after the other, each file in order.

    A delivery is many files that are written side by side, so their times say
    nothing: all items of a symbol's day are in one of them.
    """
    path = scratch_path(spark, "delivered")
    view = fixtures.VIEWS["equity_landing"]
    items = fixtures.table(spark, sf_dir, view.table)
    for low, high in DELIVERIES:
        part = items.where(F.pmod("l_partkey", F.lit(10)).between(low, high - 1))
        part = part.repartition("l_suppkey", F.col("l_shipdate").cast("date")).sortWithinPartitions(*_IN_FILE)
        # all of them come in one fetch: only the delivery tells which was first
        part.selectExpr(*view.columns).withColumn("ingested_at", F.lit(1)).write.mode("append").json(path, compression="gzip")
    return path


def landed_arrival(spark, sf_dir):
    """First arrivals of landed equity items, by the production order: the file delivered first, then the place in it."""
    path = _delivered(spark, sf_dir)
    items = landing.with_arrival(landing.read_delivered(spark, path), landing.delivered_files(spark, path))
    return clean.equity_clean(landing.land_equity(items), clean.ARRIVAL_ORDER).drop("arrival_seq", "ingested_at")


def business_keys_deliverable(spark, sf_dir):
    """Keys of the deliverable-position records."""
    equity = landing.land_equity(fixtures.load(spark, sf_dir, "equity_landing"))
    return equity.select("ingested_at", landing.deliverable_key(equity).alias("message_key"))


def enforce_schema_rejected(spark, sf_dir):
    """The rejected half of the equity and derivatives records, with the field that they lack."""
    out = None
    for name, land, view in (("equity_raw", landing.land_equity, "equity_landing"), ("fo_raw", landing.land_fo, "fo_landing")):
        _, rejected = landing.enforce_schema(land(fixtures.load(spark, sf_dir, view)), name)
        part = rejected.select(F.lit(name).alias("record"), "ingested_at", "trade_date", "symbol",
                               landing.reject_reason(rejected, name).alias("reject_reason"))
        out = part if out is None else out.unionByName(part)
    return out


# --- messages -------------------------------------------------------------------------

#: Every so-many-th message by its ingestion time is cut off, is blank, or holds text for a time.
CUT, BLANK, MISTYPED = 13, 17, 19


def _messages(spark, sf_dir) -> dict[str, tuple[str, DataFrame]]:
    load = lambda n: fixtures.load(spark, sf_dir, n)
    landed = {
        "equity": ("equity_raw", landing.land_equity(load("equity_landing"))),
        "fo": ("fo_raw", landing.land_fo(load("fo_landing"))),
        "index": ("index_raw", landing.land_index(load("index_landing"))),
        "corporate": ("corporate_raw", landing.land_corporate(load("corporate_landing"))),
        "surveillance": ("surveillance_raw", landing.land_surveillance(
            [load("surveillance_landing_a"), load("surveillance_landing_b")])),
        "macro": ("macro", load("macro").select(*schemas.MACRO_RAW.fieldNames())),
    }
    at = F.col("id")
    value = (F.when(at % CUT == 0, F.expr("substring(text, 1, length(text) - 1)"))
             .when(at % BLANK == 0, F.lit(" "))
             .when(at % MISTYPED == 0, F.regexp_replace("text", '"ingested_at":[0-9]+', '"ingested_at":"soon"'))
             .otherwise(F.col("text")))
    # each record is written as JSON once, in a projection of its own
    return {d: (name, df.select(F.col("ingested_at").alias("id"), F.to_json(F.struct("*")).alias("text"))
                .select("id", value.alias("value"))) for d, (name, df) in landed.items()}


def message_outcomes(spark, sf_dir):
    """Of each domain's messages, how many are accepted, lack a field, or do not decode."""
    out = None
    for domain, (name, messages) in _messages(spark, sf_dir).items():
        part = clean_stream.message_outcomes(messages, name).select(F.lit(domain).alias("domain"), "*")
        out = part if out is None else out.unionByName(part)
    return out


#: Numbers with a point in a message, outside of its strings.
_POINTED = r'(?<=[^\\]":)-?[0-9]+\.[0-9]+(?:E-?[0-9]+)?'


def _numbers_alike(text):
    """A message with its pointed numbers written with 15 places: engines write the same number in different ways."""
    def written(x):
        size = F.abs(x)
        places = F.floor((size - F.floor(size)) * F.lit(1e15)).cast("string")
        plain = F.concat(F.when(x < 0, "-").otherwise(""), F.floor(size).cast("string"), F.lit("."), F.lpad(places, 15, "0"))
        return F.when(size < 1e18, plain).otherwise(x.cast("string"))

    numbers = F.transform(F.regexp_extract_all(text, F.lit(_POINTED), F.lit(0)).cast("array<double>"), written)
    return F.array_join(F.zip_with(F.split(text, _POINTED, -1), numbers, lambda part, n: F.concat(
        part, F.coalesce(n, F.lit("")))), "")


def quarantined_messages(spark, sf_dir):
    """The malformed messages of all domains: their text as it came, whether it is closed, and why."""
    out = None
    for domain, (name, messages) in _messages(spark, sf_dir).items():
        bad = clean_stream.malformed_messages(messages, schemas.BY_NAME[name])
        part = bad.select(F.lit(domain).alias("domain"), "id", "reject_reason", _numbers_alike(F.col("message")).alias("message"),
                          F.col("message").endswith("}").alias("closed"))
        out = part if out is None else out.unionByName(part)
    return out


def macro_values(spark, sf_dir):
    """Fields of the macro payloads, read by path from their VARIANT form."""
    macro = fixtures.load(spark, sf_dir, "macro")
    landed = landing.land_macro(macro.where("record_type = 'FII_DII'"), macro.where("record_type = 'MARKET_STATUS'"))
    return landing.macro_fields(landing.macro_variant(landed), {
        "k": ("$.k", "int"), "k_double": ("$.k", "double"), "raw": ("$.raw", "string")})


# --- streams with payload -----------------------------------------------------------------

def _stream_first(spark, sf_dir, view: str, start, order: str, feeds: int = 4, **how) -> DataFrame:
    raw = fixtures.load(spark, sf_dir, view)
    src, out, state, ckpt = (scratch_path(spark, f"first-{n}") for n in ("landing", "bronze", "state", "checkpoint"))
    # fetches come one after the other, each as message files of its own, and the stream goes on after each:
    # a fetch is one micro-batch, however many files it has
    last = raw.agg(F.max("ingested_at")).first()[0] or 0
    for i in range(feeds):
        part = F.least(F.floor(F.col("ingested_at") * feeds / (last + 1)), F.lit(feeds - 1)) == i
        raw.where(part).write.mode("append").json(src, compression="gzip")
        # a backfill of many years: partitioned by year, not by day
        stream = clean_stream.read_stream(spark, src, raw.schema).withColumn("trade_year", F.substring("trade_date", 1, 4))
        clean_stream.run_available_now(start(stream, ckpt, out, state, order=(*clean.ARRIVAL_ORDER, "tiebreak", order),
                                             partition_by=("trade_year",), **how))
    return first_arrival.read_bronze(spark, out, raw)


def stream_equity_first(spark, sf_dir):
    """C7 on a stream: the whole row of each key's first arrival."""
    return _stream_first(spark, sf_dir, "equity_raw", first_arrival.start_equity, "total_turnover")


def stream_fo_first(spark, sf_dir):
    """C6 on a stream as coded (48 h, one record per contract): the whole row of each contract's first arrival."""
    return _stream_first(spark, sf_dir, "fo_raw", first_arrival.start_fo, "value_in_lakh", per_day=False)


# --- tables by name --------------------------------------------------------------------------

SILVER_BUCKETS = 8
_SERVED: dict[tuple, str] = {}


def served(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    """The name of a table of this session that is written once: silver, equity, fo by symbol, the others by year."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    name = _SERVED.get(key)
    if name is None or not spark.catalog.tableExists(name):
        name = f"{kind}_{zlib.crc32(sf_dir.encode()):08x}"
        path = scratch_path(spark, f"served-{kind}")
        layout = {"surveillance": tables.Layout(("as_of_date",)), "gold": tables.Layout(("trade_year",))}.get(
            kind, tables.symbol_layout(SILVER_BUCKETS))
        df = build()
        tables.write(df if kind == "surveillance" else lake.with_trade_year(df), name, path, layout)
        _SERVED[key] = name
    return name


def table_scan_by_name(spark, sf_dir):
    """Silver written by year, named, its partitions recovered, and the years of a range scanned by that name."""
    from marketlake.plans import catalog

    path = scratch_path(spark, "named-silver")
    lake.write_silver(catalog.ohlcv_adjusted(spark, sf_dir), path)
    name = f"silver_named_{zlib.crc32(path.encode()):08x}"
    tables.register(spark, name, path, tables.Layout(("trade_year",)))
    return spark.table(name).where(F.col("trade_year").between(1996, 1997)).drop("trade_year")


def silver_by_symbol(spark, sf_dir):
    """Silver in buckets of symbols, joined with itself on the symbol without moving it: each day beside the last one."""
    from marketlake.plans import catalog

    silver = spark.table(served(spark, sf_dir, "silver", lambda: catalog._silver(spark, sf_dir)))
    # days as numbers are aggregated by hash; a greatest text would sort (and spill) every bucket first
    latest = silver.groupBy("symbol").agg(F.max(F.unix_date(F.col("trade_date").try_cast("date"))).alias("_last"),
                                          F.count("*").alias("n_days"))
    latest = latest.select("symbol", F.date_from_unix_date("_last").cast("string").alias("last_date"), "n_days")
    # a bucket's symbols are few beside its days: they are the hash table, and no bucket is sorted
    return silver.join(latest.hint("shuffle_hash"), "symbol").select("symbol", "trade_date", "close_adj", "last_date", "n_days")


def serve_with_count(spark, sf_dir):
    """V6: a served selection with its row count, observed while the rows are written."""
    from marketlake.plans import catalog
    from marketlake.plans.serve import with_count

    rows, seen = with_count(catalog.serve_surveillance(spark, sf_dir), "served")
    path = scratch_path(spark, "served-rows")
    rows.write.parquet(path)
    return spark.read.parquet(path).withColumn("count", F.lit(seen.get["count"]).cast("bigint"))


# --- maintenance, aggregates, factors -------------------------------------------------------

class _Stopped(Exception):
    """Ends a compaction after a few commits."""


def compaction_resumed(spark, sf_dir):
    """M1: a compaction that is stopped after two commits and run again; with each year, whether it was rewritten."""
    from marketlake.plans import catalog

    src = catalog._many_files(spark, sf_dir)
    journal, staging = scratch_path(spark, "journal"), scratch_path(spark, "staged")
    commits = []

    def stop(names):
        commits.extend(names)
        if len(commits) == 2:
            raise _Stopped

    order = ["l_suppkey", "l_shipdate"]
    try:
        maintain.compact_in_place(spark, src, journal, staging, order, commit_bytes=0, after_commit=stop)
    except _Stopped:
        pass
    commits += maintain.compact_in_place(spark, src, journal, staging, order, commit_bytes=0)
    years = sorted(int(c.split("=")[1]) for c in commits)
    return maintain.read_compacted(spark, src, journal).withColumn("rewritten", F.col("trade_year").isin(years))


def compact_tables_run(spark, sf_dir):
    """M3: a run over tables of which one is missing; what became of each, and its rows afterwards."""
    from marketlake.plans import catalog

    small, few, out = catalog._many_files(spark, sf_dir), scratch_path(spark, "few-files"), scratch_path(spark, "compacted-run")
    fixtures.table(spark, sf_dir, "orders").coalesce(1).write.parquet(few)
    sources = {"lineitem": (small, ["l_suppkey", "l_shipdate"]), "missing": (f"{out}/no-such-table", ["symbol"]),
               "orders": (few, ["o_custkey", "o_orderdate"])}
    status = maintain.compact_tables([(n, lambda n=n, s=s, z=z: maintain.rewrite(spark, s, f"{out}/{n}", z))
                                      for n, (s, z) in sources.items()])
    parts = None
    for name, (source, _) in sources.items():
        ok, rewritten = status[name] == "ok", exists(spark, f"{out}/{name}")
        rows = spark.read.parquet(f"{out}/{name}" if rewritten else source) if ok else spark.range(0)
        part = rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), F.lit("ok" if ok else "failed").alias("status"), F.lit(rewritten).alias("rewritten"), "rows")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def silver_of_repeated_prices(spark, sf_dir):
    """A2: price rows that come twice are one row of silver."""
    from marketlake.plans import catalog

    prices = catalog.equity_clean(spark, sf_dir).select(*adjust.PRICE_COLUMNS)
    return adjust.ohlcv_adjusted(prices.unionByName(prices), fixtures.load(spark, sf_dir, "corporate"))


def approx_stocks(spark, sf_dir):
    """A4's twin: distinct symbols by year from stored daily sketches, beside the exact count and whether the bound holds."""
    from marketlake.plans import catalog

    silver, path = catalog._silver(spark, sf_dir), scratch_path(spark, "sketches")
    breadth.symbol_sketches(silver).write.parquet(path)
    by_year = spark.read.parquet(path).withColumn("trade_year", F.year(F.col("trade_date").try_cast("date")))
    approx = breadth.distinct_symbols(by_year, "trade_year")
    exact = (lake.with_trade_year(catalog.equity_clean(spark, sf_dir)).groupBy("trade_year")
             .agg(F.count_distinct("symbol").alias("total_stocks")))
    error = F.abs(F.col("approx_stocks") - F.col("total_stocks"))
    # four standard errors of a sketch of 2^12 registers
    return approx.join(exact, "trade_year").select(
        "trade_year", "total_stocks", (error <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("total_stocks"))).alias("within_bound"))


def cumulative_factor_asof(spark, sf_dir):
    """P6 without a broadcast: factors carried along each symbol's days."""
    prices = clean.equity_clean(fixtures.load(spark, sf_dir, "equity_raw"), ("ingested_at", "arrival_seq", "tiebreak", "total_turnover"))
    return adjust.cumulative_factor_asof(prices.select(*adjust.PRICE_COLUMNS), fixtures.load(spark, sf_dir, "corporate"))


QUERIES = {f.__name__: f for f in (
    landed_arrival, business_keys_deliverable, enforce_schema_rejected, message_outcomes, quarantined_messages, macro_values,
    stream_equity_first, stream_fo_first, table_scan_by_name, silver_by_symbol, serve_with_count, compaction_resumed,
    compact_tables_run, silver_of_repeated_prices, approx_stocks, cumulative_factor_asof)}

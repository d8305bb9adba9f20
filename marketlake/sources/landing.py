"""Landing files -> typed raw records.

Landing rows arrive in the exchange's own column names with every value as
text (read with an all-string schema, never inferred). Normalisation is a
single projection of native expressions per domain, so it runs map-side in
whole-stage codegen over any number of files; a column absent from a file
reads as null, like a missing key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.casts import (
    blank_to_null, comma_float, parse_number, python_float_text, py_strip, safe_float, safe_int, trim_numbers, truthy_text,
)


def _get(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _first_present(df: DataFrame, *names: str) -> Column:
    """``item.get(a, item.get(b, ...))``: first column present in the file.

    A null value counts as missing (the text form of a JSON null).
    """
    return F.coalesce(*[_get(df, n) for n in names])


def _with_trimmed(items: DataFrame, names: Sequence[str]) -> DataFrame:
    """Number columns trimmed in a projection of their own; absent ones are null."""
    absent = {n: F.lit(None).cast("string") for n in names if n not in items.columns}
    return trim_numbers(items.withColumns(absent) if absent else items, names)


def _now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def _context(df: DataFrame, name: str, value: str | None) -> Column:
    if value is not None:
        return F.lit(value)
    return _get(df, name)


def _ingested(df: DataFrame) -> Column:
    return F.coalesce(_get(df, "ingested_at").cast("bigint"), _now_ms())


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, and the stored arrival number if the batch has one."""
    kept = ["arrival_seq"] if "arrival_seq" in df.columns else []
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *kept)


def _project(items: DataFrame, cols: dict[str, Column]) -> DataFrame:
    kept = ["arrival_seq"] if "arrival_seq" in items.columns else []
    return items.select(*[c.alias(n) for n, c in cols.items()], *kept)


# Exchange column name -> record field, equity bhavcopy.
EQUITY_TEXT = {"TckrSymb": "symbol", "SctySrs": "series", "ISIN": "isin"}
EQUITY_FLOAT = {
    "OpnPric": "open", "HghPric": "high", "LwPric": "low", "ClsPric": "close",
    "LastPric": "last", "PrvsClsgPric": "prev_close", "TtlTrfVal": "total_turnover",
}
EQUITY_INT = {"TtlTradgVol": "total_quantity", "TtlNbOfTxsExctd": "total_trades"}

# Exchange column name -> record field, derivatives bhavcopy.
FO_TEXT = {
    "FinInstrmTp": "instrument_type", "TckrSymb": "symbol", "XpryDt": "expiry_date",
    "OptnTp": "option_type",
}
FO_FLOAT = {
    "StrkPric": "strike_price", "OpnPric": "open", "HghPric": "high", "LwPric": "low",
    "ClsPric": "close", "SttlmPric": "settle_price", "TtlTrfVal": "value_in_lakh",
}
FO_INT = {"TtlNbOfTxsExctd": "contracts", "OpnIntrst": "open_interest",
          "ChngInOpnIntrst": "change_in_oi"}


def land_equity(items: DataFrame, trade_date: str | None = None) -> DataFrame:
    """Equity bhavcopy items -> equity_raw (source ``bhavcopy``)."""
    items = _with_trimmed(items, [*EQUITY_FLOAT, *EQUITY_INT])
    cols = {"ingested_at": _ingested(items), "trade_date": _context(items, "trade_date", trade_date)}
    cols.update({dst: _get(items, src) for src, dst in EQUITY_TEXT.items()})
    cols.update({dst: parse_number(src) for src, dst in EQUITY_FLOAT.items()})
    cols.update({dst: parse_number(src).try_cast("bigint") for src, dst in EQUITY_INT.items()})
    cols.update({"deliverable_qty": F.lit(None), "delivery_pct": F.lit(None),
                 "source": F.lit("bhavcopy")})
    return _conform(_project(items, cols), schemas.EQUITY_RAW)


def land_fo(items: DataFrame, trade_date: str | None = None) -> DataFrame:
    """Derivatives bhavcopy items -> fo_raw (instrument codes passed through)."""
    items = _with_trimmed(items, [*FO_FLOAT, *FO_INT])
    cols = {"ingested_at": _ingested(items), "trade_date": _context(items, "trade_date", trade_date)}
    cols.update({dst: _get(items, src) for src, dst in FO_TEXT.items()})
    cols.update({dst: parse_number(src) for src, dst in FO_FLOAT.items()})
    cols.update({dst: parse_number(src).try_cast("bigint") for src, dst in FO_INT.items()})
    return _conform(_project(items, cols), schemas.FO_RAW)


def land_index(items: DataFrame, trade_date: str | None = None) -> DataFrame:
    """S3: index snapshot items -> index_raw.

    Name: ``index``, else ``indexSymbol``, else ``UNKNOWN``. Close: ``last``
    when it is truthy (non-empty text, or a number other than 0), else
    ``indicativeClose``. Numbers may come typed or as text with thousands
    separators. Volume and turnover are not in the snapshot (0).
    """
    last = _get(items, "last")
    if dict(items.dtypes).get("last", "string") == "string":
        truthy = truthy_text(last)
    else:  # a number as delivered: 0 is not truthy, NaN is
        truthy = last.isNotNull() & (last != 0)
    close_text = F.when(truthy, last.cast("string")).otherwise(_get(items, "indicativeClose").cast("string"))
    cols = {
        "ingested_at": _ingested(items),
        "trade_date": _context(items, "trade_date", trade_date),
        "index_name": F.coalesce(_get(items, "index"), _get(items, "indexSymbol"), F.lit("UNKNOWN")),
        "open": comma_float(_get(items, "open")),
        "high": comma_float(_get(items, "high")),
        "low": comma_float(_get(items, "low")),
        "close": comma_float(close_text),
        "points_change": comma_float(_get(items, "variation")),
        "pct_change": comma_float(_get(items, "percentChange")),
        "volume": F.lit(0),
        "turnover_cr": F.lit(0.0),
        "pe_ratio": comma_float(_get(items, "pe")),
        "pb_ratio": comma_float(_get(items, "pb")),
        "div_yield": comma_float(_get(items, "dy")),
    }
    return _conform(_project(items, cols), schemas.INDEX_RAW)


def land_corporate(items: DataFrame) -> DataFrame:
    """Corporate-action items -> corporate_raw.

    Strings are stripped and blanks become null; action_type and details
    both carry ``subject`` (action_type defaults to ``UNKNOWN``); series
    defaults to ``EQ``.
    """
    def text(name: str) -> Column:
        return blank_to_null(_get(items, name))

    subject = _get(items, "subject")
    cols = {
        "ingested_at": _ingested(items),
        "symbol": py_strip(F.coalesce(_get(items, "symbol"), F.lit(""))),
        "company_name": text("comp"),
        "action_type": py_strip(F.coalesce(subject, F.lit("UNKNOWN"))),
        "ex_date": text("exDate"),
        "record_date": text("recDate"),
        "bc_start_date": text("bcStartDate"),
        "bc_end_date": text("bcEndDate"),
        "nd_start_date": text("ndStartDate"),
        "nd_end_date": text("ndEndDate"),
        "details": text("subject"),
        "series": blank_to_null(F.coalesce(_get(items, "series"), F.lit("EQ"))),
    }
    return _conform(_project(items, cols), schemas.CORPORATE_RAW)


# Item keys of the surveillance lists (first present wins).
SURVEILLANCE_KEYS = {
    "symbol": ("symbol", "SYMBOL"),
    "isin": ("isin", "ISIN"),
    "company_name": ("companyName", "NAME"),
}


def _surveillance_list(items: DataFrame, list_type: str | Column | None,
                       as_of_date: str | None) -> DataFrame:
    item_cols = [c for keys in SURVEILLANCE_KEYS.values() for c in keys] + ["stage", "reason"]
    present = [F.col(c) for c in item_cols if c in items.columns]
    non_empty = F.lit(False)
    for c in present:
        non_empty = non_empty | c.isNotNull()
    lt = list_type if isinstance(list_type, Column) else (
        F.lit(list_type) if list_type is not None else _get(items, "list_type"))
    cols = {
        "ingested_at": _ingested(items),
        "as_of_date": _context(items, "as_of_date", as_of_date),
        "symbol": py_strip(F.coalesce(_first_present(items, *SURVEILLANCE_KEYS["symbol"]), F.lit(""))),
        "isin": blank_to_null(_first_present(items, *SURVEILLANCE_KEYS["isin"])),
        "company_name": blank_to_null(_first_present(items, *SURVEILLANCE_KEYS["company_name"])),
        "list_type": lt,
        "stage": safe_int(_get(items, "stage")).try_cast("int"),
        "reason": blank_to_null(_get(items, "reason")),
    }
    return _conform(_project(items.where(non_empty), cols), schemas.SURVEILLANCE_RAW)


def land_surveillance(
    lists: DataFrame | Sequence[DataFrame] | dict[str, DataFrame],
    as_of_date: str | None = None,
) -> DataFrame:
    """S5 + O4: surveillance list items -> surveillance_raw, lists unioned.

    ``lists`` is a mapping list_type -> items, or DataFrame(s) carrying a
    ``list_type`` column. Each list may use camel-case or upper-case keys.
    Empty items (no field present) are skipped; ``stage`` is ``int(stage)``.
    """
    if isinstance(lists, DataFrame):
        lists = [lists]
    if isinstance(lists, dict):
        parts = [_surveillance_list(df, lt, as_of_date) for lt, df in lists.items()]
    else:
        parts = [_surveillance_list(df, None, as_of_date) for df in lists]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def land_macro(fii_dii: DataFrame, status: DataFrame, trade_date: str | None = None) -> DataFrame:
    """S6 + O5: FII/DII items (one record each) and market-status payloads.

    Payloads are JSON text; a status that is not a JSON object becomes
    ``{"raw": "<text>"}``.
    """
    def payload_obj(c: Column) -> Column:
        is_obj = F.try_parse_json(c).isNotNull() & (F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"))
        return F.when(is_obj, c).otherwise(F.to_json(F.struct(c.cast("string").alias("raw"))))

    def part(df: DataFrame, record_type: str, data: Column) -> DataFrame:
        return _project(df, {
            "ingested_at": _ingested(df),
            "trade_date": _context(df, "trade_date", trade_date),
            "record_type": F.lit(record_type),
            "data": data,
        })

    return part(fii_dii, "FII_DII", F.col("data")).unionByName(
        part(status, "MARKET_STATUS", payload_obj(F.col("data")))
    )


def macro_variant(macro: DataFrame) -> DataFrame:
    """S6 with the payload as VARIANT: any JSON value; text that is no JSON becomes a string in ``raw``."""
    parsed = F.try_parse_json("data")
    return macro.withColumn("data", F.coalesce(
        parsed, F.try_parse_json(F.to_json(F.struct(F.col("data").alias("raw"))))))


def macro_fields(macro: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """One typed column for each (path, type) of a VARIANT payload; null where the path or the type is not met."""
    return macro.select("ingested_at", "trade_date", "record_type", *[
        F.try_variant_get("data", path, kind).alias(name) for name, (path, kind) in paths.items()])


def columnar_to_rows(columnar: DataFrame, array_cols: Sequence[str],
                     trade_date: str | None = None) -> DataFrame:
    """A columnar payload (parallel arrays) -> one row per index.

    Output names are ``strip().lower()`` with spaces as underscores; rows are
    tagged with trade_date and source ``deliverable``.
    """
    renamed = {c: c.strip().lower().replace(" ", "_") for c in array_cols}
    zipped = F.arrays_zip(*[F.col(f"`{c}`").alias(renamed[c]) for c in array_cols])
    base = columnar.select(
        _ingested(columnar).alias("ingested_at"),
        _context(columnar, "trade_date", trade_date).alias("trade_date"),
        F.lit("deliverable").alias("source"),
        F.inline(zipped),
    )
    return base


def business_key(domain: str, df: DataFrame) -> Column:
    """Message key of a record (parts render as Python formats them, null as ``None``)."""
    types = dict(df.dtypes)

    def part(c: str) -> Column:
        text = python_float_text(F.col(c)) if types[c] == "double" else F.col(c).cast("string")
        return F.coalesce(text, F.lit("None"))

    parts = {
        "equity": ["symbol", "trade_date"],
        "fo": ["symbol", "instrument_type", "expiry_date", "strike_price", "option_type"],
        "index": ["index_name", "trade_date"],
        "surveillance": ["symbol", "list_type", "as_of_date"],
        "corporate": ["symbol", "action_type", "ex_date"],
        "macro": ["record_type", "trade_date"],
    }[domain]
    return F.concat_ws("_", *[part(c) for c in parts])


def deliverable_key(df: DataFrame) -> Column:
    """S11 for deliverable-position records: ``symbol_date_DEL``."""
    return F.concat(business_key("equity", df), F.lit("_DEL"))


def index_items(payloads: DataFrame) -> DataFrame:
    """S3 as delivered: one payload with a ``data`` array of items -> one row per item.

    Columns of the payload beside ``data`` (fetch time, trade date) are kept;
    a payload without items gives no row.
    """
    rest = [c for c in payloads.columns if c != "data"]
    return payloads.select(*rest, F.inline("data"))


#: Columns that say where a delivered row stood, until it is numbered.
_PLACE = ("_file", "_block", "_row")


def read_delivered(spark: SparkSession, source: str) -> DataFrame:
    """As-delivered JSON lines with the place of each row: its file and the block of the file it was read from."""
    df = spark.read.json(source)
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def delivered_files(spark: SparkSession, source: str) -> DataFrame:
    """(_file, rank): the files in the order they were delivered, by modification time, then path.

    One small row for each file (the listing that any read of them holds);
    their content is not read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
             .select(F.col("path").alias("_file"), "modificationTime"))
    order = Window.orderBy("modificationTime", "_file")
    return files.select("_file", (F.row_number().over(order) - 1).cast("decimal(13,0)").alias("rank"))


def with_arrival(items: DataFrame, files: DataFrame, first_rank: int = 0) -> DataFrame:
    """Number delivered items in the order of delivery (``arrival_seq``): by file, then place in the file.

    ``items`` come from ``read_delivered`` (exploded payloads keep their file),
    ``files`` from ``delivered_files``. All items of one fetch share its
    ingestion time; the stored number says which came first, whatever sizes the
    files have and in whichever tasks they were read. Numbers of one file are
    below those of the next, and all are at or above ``first_rank`` files, so a
    later run continues where an earlier one stopped. Unique, not gap-free.
    """
    # within a task rows keep their order in the block; the lower 33 bits count them
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = items.withColumn("_row", row).join(files, "_file")
    wide = lambda c: c.cast("decimal(38,0)")
    number = (wide(F.col("rank") + F.lit(first_rank)) * F.lit(10**15).cast("decimal(16,0)")
              + wide(F.col("_block"))) * F.lit(10**10).cast("decimal(11,0)") + wide(F.col("_row"))
    return placed.withColumn("arrival_seq", number.cast("decimal(38,0)")).drop(*_PLACE, "rank")


def next_rank(landed: DataFrame) -> int:
    """The first file rank after those in a landed table."""
    last = landed.agg(F.max("arrival_seq")).first()[0] if "arrival_seq" in landed.columns else None
    return 0 if last is None else int(last) // 10**25 + 1


def enforce_schema(
    records: DataFrame,
    name: str,
) -> tuple[DataFrame, DataFrame]:
    """Conform to the domain schema, fill defaults, split off rejects.

    Returns (accepted, rejected); a record is rejected when a required field
    without a default is null. ``ingested_at`` defaults to now (ms).
    """
    schema = schemas.BY_NAME[name]
    defaults = dict(schemas.DEFAULTS.get(name, {}))
    cols = []
    for f in schema.fields:
        c = _get(records, f.name).cast(f.dataType)
        if f.name == "ingested_at":
            c = F.coalesce(c, _now_ms())
        elif f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    conformed = records.select(*cols)
    required = [c for c in schemas.REQUIRED.get(name, []) if c not in defaults and c != "ingested_at"]
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    flagged = conformed.withColumn("_ok", ok)
    return (flagged.where("_ok").drop("_ok"), flagged.where(~F.col("_ok")).drop("_ok"))


def reject_reason(records: DataFrame, name: str) -> Column:
    """``missing_<field>`` for the first required field that a record lacks, else null."""
    defaults = schemas.DEFAULTS.get(name, {})
    found = F.lit(None).cast("string")
    for c in reversed(schemas.REQUIRED.get(name, [])):
        if c not in defaults and c != "ingested_at":
            found = F.when(_get(records, c).isNull(), F.lit(f"missing_{c}")).otherwise(found)
    return found


def ingest_summary(results: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Per domain -- records accepted, rejected, and a status.

    ``results`` pairs a domain name with its landed records; acceptance is
    the S12 rule for that domain. One pass, one row per domain.
    """
    parts = []
    for domain, df in results:
        name = {"equity": "equity_raw", "fo": "fo_raw", "index": "index_raw",
                "corporate": "corporate_raw", "surveillance": "surveillance_raw",
                "macro": "macro"}.get(domain, domain)
        ok = F.lit(True)
        for c in schemas.REQUIRED.get(name, []):
            if c in df.columns and c not in schemas.DEFAULTS.get(name, {}) and c != "ingested_at":
                ok = ok & F.col(c).isNotNull()
        parts.append(df.select(F.lit(domain).alias("domain"), ok.alias("_ok")))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("domain").agg(
        F.count_if("_ok").alias("records"),
        F.count_if(~F.col("_ok")).alias("errors"),
    ).withColumn("status", F.when(F.col("records") > 0, F.lit("ok"))
                 .when(F.col("errors") > 0, F.lit("error")).otherwise(F.lit("empty")))


def ingest_totals(summary: DataFrame) -> DataFrame:
    """S13 run totals: records and errors over all domains, and the sorted,
    comma-separated list of failed domains (every record rejected). The input
    is one row per domain, so the list is bounded by the number of domains."""
    return summary.agg(
        F.sum("records").alias("total_records"),
        F.sum("errors").alias("total_errors"),
        F.concat_ws(",", F.array_sort(F.collect_list(
            F.when(F.col("status") == "error", F.col("domain"))))).alias("failed_domains"),
    )

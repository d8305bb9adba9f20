"""Record cleaning: normalise, reject, de-duplicate.

The normalise and filter steps are column expressions shared verbatim by the
batch and streaming pipelines (``marketlake.streaming``). De-duplication is
where the two differ: batch keeps the first arrival per key by a total order,
streaming bounds state with a watermark.

First-arrival dedup is an aggregation (``min`` of a struct whose leading
fields are the arrival order), not a ``row_number`` window: the aggregate
combines map-side, so a key holding a third of all rows is reduced to one row
per input partition before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import clean_text, non_negative

EQUITY_PRICES = ("open", "high", "low", "close", "last", "prev_close")
FO_PRICES = ("open", "high", "low", "close", "settle_price")

# Dedup keys. Equity: one record per symbol and day (series is not part of
# the key). FO "contract": as keyed by the stream job (no trade date).
# FO "contract_day": one record per contract per day, as documented.
EQUITY_KEY = ("symbol", "trade_date")
FO_CONTRACT_KEY = ("symbol", "instrument_type", "expiry_date", "strike_price", "option_type")
FO_CONTRACT_DAY_KEY = FO_CONTRACT_KEY + ("trade_date",)

# Arrival order of landed records: the fetch's time, then the record's stored
# place in it (all records of one fetch share the time). Together they are unique.
ARRIVAL_ORDER = ("ingested_at", "arrival_seq")


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    return df.withColumns({k: v for k, v in exprs.items() if k in df.columns})


def equity_normalise(df: DataFrame) -> DataFrame:
    """symbol/series stripped and upper-cased (null -> ''), negative prices -> null."""
    exprs = {"symbol": clean_text("symbol"), "series": clean_text("series")}
    exprs.update({p: non_negative(p) for p in EQUITY_PRICES})
    return _replace(df, exprs)


def equity_valid(df: DataFrame) -> DataFrame:
    """Keep rows with a symbol and a positive close (NaN is not positive)."""
    c = F.col("close")
    return df.where((F.col("symbol") != "") & (c > 0) & ~F.isnan(c))


def equity_rejects(df: DataFrame) -> DataFrame:
    """Rows C2 drops, with a reason (dead-letter output)."""
    c = F.col("close")
    reason = (
        F.when(F.col("symbol") == "", F.lit("missing_symbol"))
        .when(c.isNull(), F.lit("missing_close"))
        .when(~(c > 0) | F.isnan(c), F.lit("non_positive_close"))
    )
    return df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def fo_normalise(df: DataFrame) -> DataFrame:
    """C4: symbol/instrument_type cleaned; option_type cleaned with '' -> null."""
    opt = clean_text("option_type")
    exprs = {
        "symbol": clean_text("symbol"),
        "instrument_type": clean_text("instrument_type"),
        "option_type": F.when(opt != "", opt),
    }
    exprs.update({p: non_negative(p) for p in FO_PRICES})
    return _replace(df, exprs)


def fo_valid(df: DataFrame) -> DataFrame:
    """Symbol, instrument_type and expiry_date all non-empty."""
    def present(c: str):
        return F.col(c).isNotNull() & (F.col(c) != "")
    return df.where(present("symbol") & present("instrument_type") & present("expiry_date"))


def fo_rejects(df: DataFrame) -> DataFrame:
    """Rows C5 drops, with the first missing field as the reason (dead letters)."""
    def missing(c: str):
        return F.col(c).isNull() | (F.col(c) == "")
    reason = (
        F.when(missing("symbol"), F.lit("missing_symbol"))
        .when(missing("instrument_type"), F.lit("missing_instrument_type"))
        .when(missing("expiry_date"), F.lit("missing_expiry_date"))
    )
    return df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def first_arrival(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Keep, per key, the row that arrived first.

    ``order`` names the columns of the arrival order and must be unique within
    a key: then the winner does not depend on which other columns are carried.
    A missing order column is an error. Output columns keep the input order.
    """
    keys, order = list(keys), list(order)
    if missing := [c for c in order if c not in df.columns]:
        raise ValueError(f"arrival order columns {missing} are missing; land them with the records")
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_first")
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias("_first"))
        .select(*[F.col(k) for k in keys], "_first.*")
        .select(*df.columns)
    )


def equity_dedup(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """C3 (batch): first record per (symbol, trade_date)."""
    return first_arrival(df, EQUITY_KEY, order)


def fo_dedup_contract(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """C6 as keyed by the stream job: first record per contract, any day.

    In batch there is no state expiry, so this keeps exactly one row per
    contract over the whole input.
    """
    return first_arrival(df, FO_CONTRACT_KEY, order)


def fo_dedup_contract_day(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """C6 as documented: first record per contract per trading day."""
    return first_arrival(df, FO_CONTRACT_DAY_KEY, order)


def equity_clean(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Normalise -> reject -> first arrival per (symbol, trade_date)."""
    return df.transform(equity_normalise).transform(equity_valid).transform(equity_dedup, order)


def fo_clean(
    df: DataFrame,
    order: Sequence[str],
    per_day: bool = True,
) -> DataFrame:
    """Normalise -> validity filter -> contract dedup (per day by default)."""
    dedup = fo_dedup_contract_day if per_day else fo_dedup_contract
    return df.transform(fo_normalise).transform(fo_valid).transform(dedup, order)


__all__ = [
    "equity_normalise", "equity_valid", "equity_rejects", "equity_dedup", "equity_clean",
    "fo_normalise", "fo_valid", "fo_rejects", "fo_dedup_contract", "fo_dedup_contract_day", "fo_clean",
    "first_arrival",
]

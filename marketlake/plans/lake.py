"""End-to-end batch plans: bronze -> silver -> gold.

Each plan is one lazy DataFrame so Catalyst sees the whole job: the clean,
adjust and aggregate steps share one optimisation pass, filters reach the
scans, and only the columns the result needs are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import adjust, breadth, clean

# Columns the gold table needs from the bronze tables (plus arrival order).
SILVER_INPUT = adjust.PRICE_COLUMNS
PCR_INPUT = clean.FO_CONTRACT_DAY_KEY + ("open_interest",)


def _keep(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    wanted = list(dict.fromkeys([*cols, *order]))
    return df.select(*[c for c in wanted if c in df.columns])


def silver(
    equity_raw: DataFrame,
    corporate: DataFrame,
    order: Sequence[str],
    start_date: str | None = None,
) -> DataFrame:
    """Clean equity records (C7) and back-adjust them.

    Only the price columns and the arrival order are carried through the
    dedup shuffle; the order is unique per key (``clean.first_arrival``), so
    pruning does not change which row wins.
    """
    prices = clean.equity_clean(_keep(equity_raw, SILVER_INPUT, order), order)
    return adjust.ohlcv_adjusted(
        prices.select(*SILVER_INPUT), corporate, start_date=start_date,
        prices_unique=True,
    )


def fo_bronze_for_pcr(fo_raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """C8 restricted to the columns the put-call ratio reads."""
    return clean.fo_clean(_keep(fo_raw, PCR_INPUT, order), order, per_day=True)


def gold(
    equity_raw: DataFrame,
    corporate: DataFrame,
    fo_raw: DataFrame,
    order: Sequence[str],
    fo_order: Sequence[str],
    start_date: str | None = None,
) -> DataFrame:
    """Flagship: market breadth with put-call ratio, one row per trade date."""
    return breadth.market_breadth(
        silver(equity_raw, corporate, order, start_date),
        fo_bronze_for_pcr(fo_raw, fo_order),
    )


def with_trade_year(df: DataFrame) -> DataFrame:
    """Partition column for yearly layouts (``years(trade_date)``)."""
    return df.withColumn("trade_year", F.year(F.col("trade_date").try_cast("date")))


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    A rebuild from a start date therefore replaces the touched years and
    keeps older history, instead of dropping the whole table. Rows are dealt by
    partition first: adaptive execution joins small partitions in a task and
    splits large ones, so files are bounded in number and in size.
    """
    dealt = df.hint("rebalance", *partition_by) if partition_by else df
    (dealt.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by)
       .parquet(path))


def write_silver(silver_df: DataFrame, path: str) -> None:
    """Silver table partitioned by ``trade_year`` (``years(trade_date)``)."""
    write_partitioned(with_trade_year(silver_df), path, ["trade_year"])


def write_gold(gold_df: DataFrame, path: str) -> None:
    """Gold table partitioned by ``trade_year``; no global sort before the write."""
    write_partitioned(with_trade_year(gold_df), path, ["trade_year"])


def affected_years(silver: DataFrame, new_actions: DataFrame) -> list[int]:
    """Years of silver whose factors a new action changes: its symbol trades there before the ex-date.

    A few dozen numbers at most, whatever the tables.
    """
    latest = (adjust.adjusting_actions(new_actions).groupBy(F.col("symbol").alias("_s"))
              .agg(F.max("ex_date").alias("_hi")))
    hit = silver.join(latest, (F.col("symbol") == F.col("_s"))
                      & (F.col("trade_date").cast("string").try_cast("date") < F.col("_hi")), "left_semi")
    return sorted(r["trade_year"] for r in hit.select("trade_year").distinct().collect() if r["trade_year"] is not None)


def rebuild_silver(
    equity_raw: DataFrame,
    corporate: DataFrame,
    new_actions: DataFrame,
    path: str,
    order: Sequence[str],
) -> list[int]:
    """After new splits or bonuses, rebuild the years of silver that they change.

    ``corporate`` holds all actions, the new ones included. A back-adjustment
    reaches from the ex-date to the symbol's first day, so every earlier year
    in which a symbol with a new action trades is computed anew and replaces
    its partition; other years are left alone. Returns the rebuilt years.
    """
    years = affected_years(equity_raw.sparkSession.read.parquet(path), new_actions)
    if years:
        raw = equity_raw.where(F.substring("trade_date", 1, 4).isin([f"{y:04d}" for y in years]))
        write_silver(silver(raw, corporate, order), path)
    return years


def run_lake(
    equity_raw: DataFrame,
    corporate: DataFrame,
    fo_raw: DataFrame,
    root: str,
    *,
    order: Sequence[str],
    fo_order: Sequence[str],
    start_date: str | None = None,
) -> dict[str, object]:
    """Daily batch: bronze -> silver (written) -> gold (written).

    Silver is written under ``root`` (a shared folder, e.g. below
    ``spark.checkpoint.dir``) and gold is computed from the *written* silver
    table, so a lost executor during the gold stage recomputes from silver
    files, not from the raw landing data.

    ``start_date`` rebuilds from that date on; it is floored to 1 January so
    every ``trade_year`` partition the dynamic overwrite replaces is rebuilt
    whole. A newly arrived split/bonus changes the factors of all earlier
    prices of its symbol: after new actions run ``rebuild_silver`` first. Row counts are observed during the writes (no re-run).
    """
    from pyspark.sql import Observation

    spark = equity_raw.sparkSession
    if start_date:
        start_date = f"{start_date[:4]}-01-01"
    paths = {"silver": f"{root}/silver/ohlcv_adjusted", "gold": f"{root}/gold/market_breadth",
             "fo": f"{root}/bronze/fo_for_pcr"}
    silver_obs, gold_obs = Observation("silver"), Observation("gold")
    silver_df = silver(equity_raw, corporate, order, start_date)
    write_silver(silver_df.observe(silver_obs, F.count(F.lit(1)).alias("rows")), paths["silver"])
    write_partitioned(fo_bronze_for_pcr(fo_raw, fo_order), paths["fo"], [])
    silver_t = spark.read.parquet(paths["silver"]).drop("trade_year")
    # silver was written by this job: one row per (symbol, trade_date)
    gold_df = breadth.market_breadth(silver_t, spark.read.parquet(paths["fo"]), unique_symbol_days=True)
    write_gold(gold_df.observe(gold_obs, F.count(F.lit(1)).alias("rows")), paths["gold"])
    return {**paths, "silver_rows": silver_obs.get["rows"], "gold_rows": gold_obs.get["rows"]}

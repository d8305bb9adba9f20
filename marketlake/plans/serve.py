"""Parametrised serving queries over the lake tables (V1-V6).

Arguments are bound as literals (``args=`` / ``F.lit``), never spliced into
SQL text. Filters on symbol/date reach the table scans (and partition
pruning when the tables are partitioned by trade_year / trade_date).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OHLCV_COLUMNS = (
    "trade_date", "symbol", "open_adj", "high_adj", "low_adj", "close_adj",
    "total_quantity", "total_turnover", "delivery_pct", "cumulative_adj_factor",
)

RAW_OHLCV_COLUMNS = (
    "trade_date", "symbol", "open", "high", "low", "close",
    "total_quantity", "total_turnover", "delivery_pct",
)


def _year_bounds(from_date: str, to_date: str):
    """Partition-pruning predicate on ``trade_year`` implied by a date range."""
    return F.col("trade_year").between(int(from_date[:4]), int(to_date[:4]))


@dataclass
class Lake:
    """Serving surface over the silver, gold and bronze tables."""

    spark: SparkSession
    silver: DataFrame | None = None
    gold: DataFrame | None = None
    fo: DataFrame | None = None
    surveillance: DataFrame | None = None
    equity: DataFrame | None = None

    @classmethod
    def from_tables(cls, spark: SparkSession, silver: str | None = None, gold: str | None = None,
                    fo: str | None = None, surveillance: str | None = None,
                    equity: str | None = None) -> "Lake":
        """Serve written Parquet tables (e.g. the paths ``run_lake`` returns).

        Partition columns (``trade_year``, ``trade_date``) are read back as
        written; ``trade_date`` is kept as ISO text.
        """
        def read(path):
            if path is None:
                return None
            df = spark.read.parquet(path)
            if "trade_date" in df.columns:
                df = df.withColumn("trade_date", F.col("trade_date").cast("string"))
            return df

        return cls(spark, silver=read(silver), gold=read(gold), fo=read(fo),
                   surveillance=read(surveillance), equity=read(equity))

    @classmethod
    def from_names(cls, spark: SparkSession, **names: str) -> "Lake":
        """Serve tables of the session catalog by name (``silver="db.silver"``, ...)."""
        return cls(spark, **{kind: spark.table(name) for kind, name in names.items()})

    def get_ohlcv(self, symbol: str, from_date: str, to_date: str) -> DataFrame:
        """V2: adjusted series of one symbol, inclusive date range, by date."""
        df = self.silver
        if "trade_year" in df.columns:
            df = df.where(_year_bounds(from_date, to_date))
        return (
            df.where((F.col("symbol") == F.lit(symbol.upper()))
                     & F.col("trade_date").between(F.lit(from_date), F.lit(to_date)))
            .select(*OHLCV_COLUMNS)
            .orderBy(F.col("trade_date").asc_nulls_last())
        )

    def get_ohlcv_raw(self, symbol: str, from_date: str, to_date: str) -> DataFrame:
        """Unadjusted series of one symbol from the cleaned bronze table."""
        df = self.equity
        if "trade_year" in df.columns:
            df = df.where(_year_bounds(from_date, to_date))
        return (
            df.where((F.col("symbol") == F.lit(symbol.upper()))
                              & F.col("trade_date").between(F.lit(from_date), F.lit(to_date)))
            .select(*RAW_OHLCV_COLUMNS)
            .orderBy(F.col("trade_date").asc_nulls_last())
        )

    def get_market_breadth(self, from_date: str, to_date: str) -> DataFrame:
        """V3: all breadth columns for an inclusive date range, by date."""
        df = self.gold
        if "trade_year" in df.columns:
            df = df.where(_year_bounds(from_date, to_date)).drop("trade_year")
        return (
            df.where(F.col("trade_date").between(F.lit(from_date), F.lit(to_date)))
            .orderBy(F.col("trade_date").asc_nulls_last())
        )

    def get_fo_bhavcopy(self, symbol: str, trade_date: str) -> DataFrame:
        """V4 + O2: all contracts of a symbol on a day, by expiry, strike, type."""
        df = self.fo
        if "trade_year" in df.columns:
            df = df.where(_year_bounds(trade_date, trade_date)).drop("trade_year")
        return (
            df.where((F.col("symbol") == F.lit(symbol.upper()))
                          & (F.col("trade_date") == F.lit(trade_date)))
            .orderBy(F.col("expiry_date").asc_nulls_last(),
                     F.col("strike_price").asc_nulls_last(),
                     F.col("option_type").asc_nulls_last())
        )

    def get_surveillance(self, list_type: str | None = None,
                         as_of_date: str | None = None) -> DataFrame:
        """V5 + O3: optional AND-ed filters; newest date first, then symbol."""
        df = self.surveillance
        if list_type:
            df = df.where(F.col("list_type") == F.lit(list_type.upper()))
        if as_of_date:
            df = df.where(F.col("as_of_date") == F.lit(as_of_date))
        return df.orderBy(F.col("as_of_date").desc_nulls_last(), F.col("symbol").asc_nulls_last())

    def query(self, sql: str, args: dict | None = None) -> DataFrame:
        """V1: ad-hoc SQL over the lake tables with bound parameters.

        Tables are referenced as ``{silver}``, ``{gold}``, ``{fo}``,
        ``{surveillance}``, ``{equity}``; parameters as ``:name``.
        """
        tables = {k: v for k, v in {
            "silver": self.silver, "gold": self.gold, "fo": self.fo,
            "surveillance": self.surveillance, "equity": self.equity,
        }.items() if v is not None}
        return self.spark.sql(sql, args=args or {}, **tables)


def with_count(df: DataFrame, name: str = "rows"):
    """V6: rows plus their count from the same execution (``observe``)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("count")), obs

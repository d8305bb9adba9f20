"""Trading-weekday calendar.

Generated by Spark from a (start, end) pair: ``sequence`` + ``explode`` +
a weekday filter. The calendar is one row per day, so even a century is
36,525 rows -- it is built where the bounds live, not on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_START = "2020-01-01"


def weekdays_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Every Monday-Friday from ``lo`` to ``hi`` inclusive, as ISO strings."""
    days = bounds.select(
        F.explode(F.sequence(F.col(lo).try_cast("date"), F.col(hi).try_cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("d")
    )
    return days.where(F.weekday("d") < 5).select(F.col("d").cast("string").alias("trade_date"))


def trading_weekdays(spark: SparkSession, start: str = DEFAULT_START,
                     end: str | None = None) -> DataFrame:
    """Weekdays from ``start`` to ``end`` (default: yesterday)."""
    hi = F.lit(end).try_cast("date") if end else F.date_sub(F.current_date(), 1)
    bounds = spark.range(1).select(F.lit(start).alias("lo"), hi.cast("string").alias("hi"))
    return weekdays_between(bounds)

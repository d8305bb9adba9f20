"""Split/bonus back-adjustment of daily prices (silver layer: P1-P7, J1, A1, A2).

Two plans compute the cumulative factor -- the product of all adjusting
factors whose ex-date is after the trade date:

* ``cumulative_factor_interval`` (default): per symbol, the factor is constant
  between consecutive ex-dates; those intervals (with their suffix products)
  are built on the small action table and prices join them on symbol with a
  range condition -- one match per price row, fully code-generated.
* ``cumulative_factor_asof`` (when the action table is too large to broadcast):
  interval starts and prices in one sorted pass, each price carrying the factor
  of the last start before it -- no join.

Factors of zero follow Spark's ``log(0) = null`` rule of the log-sum form:
they are skipped, and a price whose matching factors are all zero gets a null
factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.factor import ADJUSTING_ACTION, adjustment_factor

PRICE_COLUMNS = (
    "trade_date", "symbol", "series", "open", "high", "low", "close",
    "total_quantity", "total_turnover", "delivery_pct",
)

# Size bound for broadcasting the interval table, in bytes, measured
# on the data (not estimated from file statistics).
BROADCAST_ACTIONS_MAX_BYTES = 64 * 1024 * 1024

def since(prices: DataFrame, start_date: str | None) -> DataFrame:
    """``trade_date >= start_date`` (string compare, partition-prunable)."""
    return prices if not start_date else prices.where(F.col("trade_date") >= F.lit(start_date))


def adjusting_actions(actions: DataFrame, dedupe: bool = True) -> DataFrame:
    """bonus/split actions with a real (< 1) factor and a parsed ex-date.

    With ``dedupe`` an action re-delivered with the same (symbol, ex_date,
    details) counts once instead of compounding its factor.
    """
    acts = actions.where(F.col("action_type").rlike(ADJUSTING_ACTION)).select(
        "symbol",
        F.col("ex_date").cast("string").try_cast("date").alias("ex_date"),
        "action_type",
        "details",
        adjustment_factor("details").alias("adj_factor"),
    ).where(F.col("adj_factor") < 1.0)
    if dedupe:
        acts = acts.dropDuplicates(["symbol", "ex_date", "details"])
    return acts


def _trade_day():
    return F.col("trade_date").cast("string").try_cast("date")


def _measure(adjusting: DataFrame) -> int:
    """Bytes of the interval table (one row for each action). One small job."""
    row = adjusting.where(F.col("ex_date").isNotNull()).agg(
        F.coalesce(F.sum(F.length("symbol") + 64), F.lit(0)).alias("b")).first()
    return int(row["b"])


def factor_intervals(adjusting: DataFrame) -> DataFrame:
    """Per symbol, the validity intervals of the cumulative factor.

    With a symbol's actions sorted by (ex_date, factor) as e_1..e_k, a trade
    date d in [e_(i-1), e_i) is matched by exactly the actions i..k, so its
    factor is the product of that suffix. A running product over the actions
    in descending order gives every suffix product in one O(k) pass. One row
    per action: ``_lo`` (null for i = 1), ``_hi``, ``_f`` (null when every
    matched factor is zero), ``_hit`` = true. Dates on or after e_k match no
    interval (factor 1.0). Actions without a valid ex-date match no price.
    """
    acts = adjusting.where(F.col("ex_date").isNotNull()).select("symbol", "ex_date", "adj_factor", "details")
    # details tell actions of one day with equal factors apart, so both orders are each other's reverse
    asc = Window.partitionBy("symbol").orderBy("ex_date", "adj_factor", "details")
    desc = (Window.partitionBy("symbol").orderBy(F.desc("ex_date"), F.desc("adj_factor"), F.desc("details"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    positive = F.when(F.col("adj_factor") > 0, F.col("adj_factor"))
    return acts.select(
        F.col("symbol").alias("_s"),
        F.lag("ex_date").over(asc).alias("_lo"),
        F.col("ex_date").alias("_hi"),
        F.when(F.count(positive).over(desc) > 0, F.product(positive).over(desc)).alias("_f"),
        F.lit(True).alias("_hit"),
    )


def cumulative_factor_interval(
    prices: DataFrame,
    actions: DataFrame,
    broadcast: bool | None = None,
) -> DataFrame:
    """Prices with ``cumulative_adj_factor`` (interval plan, the default).

    Prices join the per-symbol factor intervals on ``symbol`` with the range
    ``_lo <= trade_date < _hi`` as join condition. The intervals of a symbol
    do not overlap, so each price row matches at most one: no fan-out, no
    regroup, and the probe side stays in whole-stage codegen. The interval
    table is broadcast, when its measured size is under
    ``BROADCAST_ACTIONS_MAX_BYTES``; beyond it the factors are carried along
    each symbol's days instead (``cumulative_factor_asof``).
    """
    adjusting = adjusting_actions(actions)
    intervals = factor_intervals(adjusting)
    if broadcast is None:
        broadcast = _measure(adjusting) <= BROADCAST_ACTIONS_MAX_BYTES
    if not broadcast:
        return cumulative_factor_asof(prices, actions)
    right = F.broadcast(intervals)
    d = _trade_day()
    cond = (
        (F.col("symbol") == F.col("_s"))
        & (F.col("_lo").isNull() | (d >= F.col("_lo")))
        & (d < F.col("_hi"))
    )
    factor = F.when(F.col("_hit").isNull(), F.lit(1.0)).otherwise(F.col("_f"))
    return (
        prices.join(right, cond, "left")
        .select(*prices.columns, factor.alias("cumulative_adj_factor"))
    )


def cumulative_factor_asof(prices: DataFrame, actions: DataFrame) -> DataFrame:
    """Prices with ``cumulative_adj_factor``, without a join (for action tables too large to broadcast).

    Intervals and prices are united and sorted by symbol and day; each price
    carries the factor of the last interval start before it. A symbol's days
    are cut at the turn of each year, and every interval enters each year that
    it reaches, so a symbol with a third of all rows is spread over as many
    tasks as it has years. Years before the first action of any symbol are one
    stretch. Rows come back as they were, repeated ones included.
    """
    intervals = factor_intervals(adjusting_actions(actions))
    first, last = intervals.agg(F.min(F.year("_hi")), F.max(F.year("_hi"))).first()
    if first is None:
        return prices.withColumn("cumulative_adj_factor", F.lit(1.0))

    def stretch(year: Column) -> Column:
        return F.greatest(F.lit(first - 1), F.least(F.lit(last + 1), year))

    years = F.sequence(stretch(F.coalesce(F.year("_lo"), F.lit(first - 1))), stretch(F.year(F.date_sub("_hi", 1))))
    starts = intervals.select("_s", "_lo", "_f", F.explode(years).alias("_y")).select(
        F.col("_s").alias("symbol"), "_y", F.when(F.col("_y") >= first, F.greatest(
            "_lo", F.make_date("_y", F.lit(1), F.lit(1)))).otherwise(F.col("_lo")).alias("_d"), F.struct("_f").alias("_start"))
    # after a symbol's last action nothing is adjusted
    ends = intervals.groupBy("_s").agg(F.max("_hi").alias("_d")).select(
        F.col("_s").alias("symbol"), stretch(F.year("_d")).alias("_y"), "_d", F.struct(F.lit(1.0).alias("_f")).alias("_start"))
    rows = prices.withColumns({"_d": _trade_day(), "_y": stretch(F.year(_trade_day()))}).withColumn(
        "_row", F.struct(*prices.columns)).select("symbol", "_y", "_d", "_row")
    united = rows.unionByName(starts.unionByName(ends), allowMissingColumns=True)
    before = (Window.partitionBy("symbol", "_y").orderBy(F.col("_d").asc_nulls_first(), F.col("_row").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = united.withColumn("_c", F.last("_start", ignorenulls=True).over(before)).where("_row IS NOT NULL")
    # without a day nothing is known of the actions that follow
    factor = F.when(F.col("_c").isNull() | F.col("_d").isNull(), F.lit(1.0)).otherwise(F.col("_c._f"))
    return carried.select("_row.*", factor.alias("cumulative_adj_factor"))


def actions_range_join(prices: DataFrame, actions: DataFrame) -> DataFrame:
    """Prices LEFT JOIN adjusting actions ON symbol AND date(trade_date) < ex_date."""
    acts = adjusting_actions(actions).select(
        F.col("symbol").alias("_a_symbol"), "ex_date", "adj_factor"
    )
    cond = (F.col("symbol") == F.col("_a_symbol")) & (_trade_day() < F.col("ex_date"))
    return prices.join(acts, cond, "left").drop("_a_symbol")


def apply_factor(adjusted: DataFrame) -> DataFrame:
    """OHLC times the factor; raw open/close kept; volume not adjusted."""
    f = F.col("cumulative_adj_factor")
    return adjusted.select(
        "trade_date", "symbol", "series",
        (F.col("open") * f).cast("double").alias("open_adj"),
        (F.col("high") * f).cast("double").alias("high_adj"),
        (F.col("low") * f).cast("double").alias("low_adj"),
        (F.col("close") * f).cast("double").alias("close_adj"),
        F.col("open").cast("double").alias("open_raw"),
        F.col("close").cast("double").alias("close_raw"),
        "total_quantity", "total_turnover", "delivery_pct",
        f.alias("cumulative_adj_factor"),
    )


def ohlcv_adjusted(
    prices: DataFrame,
    actions: DataFrame,
    start_date: str | None = None,
    prices_unique: bool = False,
    broadcast: bool | None = None,
) -> DataFrame:
    """Silver table: back-adjusted OHLCV per (symbol, trade_date).

    ``prices_unique`` declares that no two price rows are identical on the ten
    price columns (true for the output of ``equity_clean``, which keeps one
    row per symbol and day); otherwise identical rows are collapsed first.
    """
    prices = since(prices, start_date)
    base = prices.select(*PRICE_COLUMNS)
    if not prices_unique:
        base = base.dropDuplicates(list(PRICE_COLUMNS))
    return apply_factor(cumulative_factor_interval(base, actions, broadcast))

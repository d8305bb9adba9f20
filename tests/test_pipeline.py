"""Properties of the clean / adjust / breadth operators on the sf0.001 fixtures."""

from __future__ import annotations

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import adjust, breadth, clean
from marketlake.plans import catalog, lake
from marketlake.sources import fixtures


def _eq(spark, sf_dir):
    return fixtures.load(spark, sf_dir, "equity_raw")


def test_dedup_is_idempotent_and_unique(spark, sf_dir):
    once = clean.equity_clean(_eq(spark, sf_dir), catalog.EQ_ORDER)
    twice = clean.equity_dedup(once, catalog.EQ_ORDER)
    assert once.count() == twice.count()
    assert once.groupBy("symbol", "trade_date").count().where("count > 1").count() == 0
    assert once.exceptAll(twice).count() == 0


def test_dedup_keeps_first_arrival(spark, sf_dir):
    valid = clean.equity_valid(clean.equity_normalise(_eq(spark, sf_dir)))
    w = Window.partitionBy("symbol", "trade_date").orderBy(*catalog.EQ_ORDER)
    expected = valid.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = clean.equity_dedup(valid, catalog.EQ_ORDER)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_dedup_hot_key_is_pre_aggregated(spark):
    # one key holding most rows: the plan aggregates before the exchange
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id").cast("string"))).alias("symbol"),
        F.lit("2024-01-01").alias("trade_date"),
        F.col("id").alias("ingested_at"),
        (F.col("id") * 1.5).alias("close"),
    )
    out = clean.equity_dedup(df, ("ingested_at",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")  # partial agg below the exchange
    hot = out.where("symbol = 'HOT'").first()
    assert hot["ingested_at"] == 0 and out.count() == 20000 - 6667 + 1


def regrouped_factor(prices, actions):
    """The textbook form: every later action of a price, and the product by a sum of logarithms."""
    joined = adjust.actions_range_join(prices.select(*adjust.PRICE_COLUMNS), actions)
    product = F.exp(F.sum(F.log("adj_factor")))
    return joined.groupBy(*adjust.PRICE_COLUMNS).agg(
        F.when(F.count("adj_factor") > 0, product).otherwise(F.lit(1.0)).alias("cumulative_adj_factor"))


def test_interval_and_join_factor_agree(spark, sf_dir):
    prices = clean.equity_clean(_eq(spark, sf_dir), catalog.EQ_ORDER).select(*adjust.PRICE_COLUMNS)
    corp = fixtures.load(spark, sf_dir, "corporate")
    a = adjust.cumulative_factor_interval(prices, corp).select("symbol", "trade_date",
                                                             F.col("cumulative_adj_factor").alias("a"))
    j = regrouped_factor(prices, corp).select("symbol", "trade_date",
                                                           F.col("cumulative_adj_factor").alias("j"))
    both = a.join(j, ["symbol", "trade_date"])
    assert both.count() == prices.count()
    assert both.where(F.abs(F.col("a") - F.col("j")) > 1e-12).count() == 0


def test_factor_properties(spark, sf_dir):
    silver = catalog._silver(spark, sf_dir)
    # factor <= 1 and non-decreasing in date per symbol; the latest price is unadjusted
    assert silver.where("cumulative_adj_factor > 1").count() == 0
    w = Window.partitionBy("symbol").orderBy("trade_date")
    drops = silver.withColumn("prev", F.lag("cumulative_adj_factor").over(w)).where(
        "cumulative_adj_factor < prev - 1e-15")
    assert drops.count() == 0
    latest = silver.withColumn("rk", F.row_number().over(w.orderBy(F.desc("trade_date")))).where("rk = 1")
    assert latest.where("cumulative_adj_factor <> 1.0").count() == 0


def test_broadcast_is_size_checked(spark, sf_dir, monkeypatch):
    prices = clean.equity_clean(_eq(spark, sf_dir), catalog.EQ_ORDER).select(*adjust.PRICE_COLUMNS)
    corp = fixtures.load(spark, sf_dir, "corporate")
    small = adjust.cumulative_factor_interval(prices, corp)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in small
    monkeypatch.setattr(adjust, "BROADCAST_ACTIONS_MAX_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = adjust.cumulative_factor_interval(prices, corp)
        assert "BroadcastExchange" not in big._jdf.queryExecution().executedPlan().toString()
        assert big.count() == prices.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_breadth_invariants(spark, sf_dir):
    silver = catalog._silver(spark, sf_dir)
    ad = breadth.advance_decline(silver)
    per_day = silver.groupBy("trade_date").count()
    joined = ad.join(per_day, "trade_date")
    assert joined.where("advances + declines + unchanged <> count").count() == 0
    assert ad.count() == per_day.count()


def test_pcr_null_when_no_calls(spark):
    fo = spark.createDataFrame(
        [("2024-01-01", "OPTIDX", "PE", 10), ("2024-01-02", "OPTSTK", "CE", 0),
         ("2024-01-02", "OPTSTK", "PE", 5), ("2024-01-03", "FUTSTK", "CE", 7)],
        "trade_date string, instrument_type string, option_type string, open_interest long")
    got = {r["trade_date"]: r for r in breadth.put_call_ratio(fo).collect()}
    assert got["2024-01-01"]["call_oi"] is None and got["2024-01-01"]["pcr_oi"] is None
    assert got["2024-01-02"]["pcr_oi"] is None and "2024-01-03" not in got


def test_gold_plan_shuffles_each_big_table_once(spark, sf_dir):
    load = lambda n: fixtures.load(spark, sf_dir, n)
    gold = lake.gold(load("equity_raw"), load("corporate"), load("fo_raw"),
                     order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = gold._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # equity dedup, FO dedup, two per-date partial aggregates, action prep
    exchanges = plan.count("Exchange hashpartitioning")
    assert exchanges <= 6, plan
    assert "BroadcastHashJoin" in plan


def test_unique_symbol_days_count_is_exact_and_shuffle_free(spark, sf_dir):
    from marketlake.session import scratch_path

    path = scratch_path(spark, "silver-unique")
    catalog._silver(spark, sf_dir).write.parquet(path)
    silver = spark.read.parquet(path)
    exact = breadth.advance_decline(silver).select("trade_date", "total_stocks")
    fast = breadth.advance_decline(silver, unique_symbol_days=True)
    assert fast.select("trade_date", "total_stocks").exceptAll(exact).count() == 0
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # only the per-date partial rows move


def test_zorder_splits_a_hot_value(spark):
    from marketlake.operators import maintain

    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("symbol"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).alias("trade_date"),
        F.col("id"),
    )
    z = maintain.zorder(df, ["symbol", "trade_date"], num_partitions=6)
    sizes = [r[1] for r in z.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 10000  # the 10,000-row hot value is not one partition
    assert z.exceptAll(df).count() == 0 and z.count() == df.count()


def test_interval_plan_is_a_broadcast_equi_join(spark, sf_dir):
    prices = clean.equity_clean(_eq(spark, sf_dir), catalog.EQ_ORDER).select(*adjust.PRICE_COLUMNS)
    i = adjust.cumulative_factor_interval(prices, fixtures.load(spark, sf_dir, "corporate"))
    assert i.count() == prices.count()
    plan = i._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_zorder_tells_symbols_with_a_common_prefix_apart(spark):
    from marketlake.operators import maintain

    df = spark.range(500).select(F.format_string("NIFTY50_%04d", "id").alias("symbol"), F.lit("2024-01-01").alias("trade_date"))
    z = maintain.with_zorder(df, ["symbol", "trade_date"])
    assert z.select("_z").distinct().count() == 500
    ranked = [r["symbol"] for r in z.orderBy("_z").collect()]
    assert ranked == sorted(ranked)


def test_tied_arrivals_keep_the_same_row_in_every_plan(spark):
    """All records of a fetch share a time: the stored sequence decides, whatever columns are carried."""
    eq = spark.createDataFrame(
        [(5, 2, "2024-01-02", "ABC", "EQ", 1.0), (5, 1, "2024-01-02", "abc ", "EQ", 9.0), (4, 9, "2024-01-03", "ABC", "EQ", 3.0)],
        "ingested_at long, arrival_seq long, trade_date string, symbol string, series string, close double")
    for c in ("open", "high", "low", "total_turnover", "delivery_pct"):
        eq = eq.withColumn(c, F.col("close"))
    eq = eq.withColumn("total_quantity", F.lit(1).cast("long"))
    corp = spark.createDataFrame([], "symbol string, ex_date string, action_type string, details string")
    full = clean.equity_clean(eq, clean.ARRIVAL_ORDER)
    silver = lake.silver(eq, corp, clean.ARRIVAL_ORDER)
    assert sorted((r.trade_date, r.close) for r in full.collect()) == [("2024-01-02", 9.0), ("2024-01-03", 3.0)]
    assert sorted((r.trade_date, r.close_raw) for r in silver.collect()) == [("2024-01-02", 9.0), ("2024-01-03", 3.0)]
    fo = spark.createDataFrame(
        [(7, 1, "2024-01-02", "N", "OPTIDX", "2024-01-25", 100.0, "PE", 1.0, 900), (7, 2, "2024-01-02", "N", "OPTIDX", "2024-01-25", 100.0, "PE", 0.5, 100)],
        "ingested_at long, arrival_seq long, trade_date string, symbol string, instrument_type string, expiry_date string, "
        "strike_price double, option_type string, close double, open_interest long")
    assert [r.open_interest for r in clean.fo_clean(fo, clean.ARRIVAL_ORDER).collect()] == [900]
    assert [r.open_interest for r in lake.fo_bronze_for_pcr(fo, clean.ARRIVAL_ORDER).collect()] == [900]
    with pytest.raises(ValueError, match="arrival_seq"):
        clean.equity_clean(eq.drop("arrival_seq"), clean.ARRIVAL_ORDER)


def test_interval_plan_edge_cases(spark):
    prices = spark.createDataFrame(
        [("2024-01-01", "A"), ("2024-02-01", "A"), ("2024-03-01", "A"), ("2024-04-01", "A"),
         ("bad-date", "A"), ("2024-01-01", "B"), ("2024-01-01", "Z")],
        "trade_date string, symbol string")
    acts = spark.createDataFrame(
        [("A", "2024-02-01", "BONUS 1:1"), ("A", "2024-02-01", "SPLIT RS 10 TO RS 5"),
         ("A", "2024-03-15", "SPLIT RS 10 TO RS 2"), ("B", "2024-06-01", "SPLIT RS 10 TO RS 0")],
        "symbol string, ex_date string, details string").withColumn("action_type", F.col("details"))
    got = {(r["symbol"], r["trade_date"]): r["cumulative_adj_factor"]
           for r in adjust.cumulative_factor_interval(prices, acts).collect()}
    assert got[("A", "2024-01-01")] == 0.5 * 0.5 * 0.2
    assert got[("A", "2024-02-01")] == 0.2      # ex-date equal to trade date: not applied
    assert got[("A", "2024-03-01")] == 0.2
    assert got[("A", "2024-04-01")] == 1.0
    assert got[("A", "bad-date")] == 1.0
    assert got[("B", "2024-01-01")] is None     # only a zero factor matches
    assert got[("Z", "2024-01-01")] == 1.0

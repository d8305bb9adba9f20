"""Partitioned sinks (S16) and serving over written tables (V2-V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.plans import catalog, lake
from marketlake.plans.serve import Lake, with_count
from marketlake.session import scratch_path


def test_silver_round_trip_dynamic_overwrite(spark, sf_dir):
    path = scratch_path(spark, "silver")
    silver = catalog._silver(spark, sf_dir)
    lake.write_silver(silver, path)
    first = spark.read.parquet(path)
    n_first = first.count()
    assert n_first == silver.count()
    years = [r[0] for r in first.select("trade_year").distinct().orderBy("trade_year").collect()]
    # rebuild only the last year: older partitions must survive
    last = silver.where(F.substring("trade_date", 1, 4) == str(years[-1]))
    lake.write_silver(last, path)
    again = spark.read.parquet(path)
    assert again.count() == n_first
    assert again.drop("trade_year").exceptAll(silver).count() == 0


def test_serving_prunes_year_partitions(spark, sf_dir):
    path = scratch_path(spark, "silver-serve")
    lake.write_silver(catalog._silver(spark, sf_dir), path)
    lk = Lake(spark, silver=spark.read.parquet(path))
    df = lk.get_ohlcv("sym7", "1996-01-01", "1996-12-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "trade_year" in plan
    expected = catalog._silver(spark, sf_dir).where(
        "symbol = 'SYM7' AND trade_date BETWEEN '1996-01-01' AND '1996-12-31'")
    assert df.count() == expected.count()
    dates = [r[0] for r in df.collect()]
    assert dates == sorted(dates)


def test_with_count_observes_in_one_pass(spark, sf_dir):
    df, obs = with_count(catalog.serve_surveillance(spark, sf_dir))
    rows = df.collect()
    assert obs.get["count"] == len(rows) > 0


def test_adhoc_sql_binds_parameters(spark, sf_dir):
    lk = Lake(spark, silver=catalog._silver(spark, sf_dir))
    evil = "1996-01-01' OR '1'='1"
    out = lk.query("SELECT count(*) AS n FROM {silver} WHERE trade_date = :d", {"d": evil})
    assert out.first()["n"] == 0


def test_run_lake_writes_silver_then_gold(spark, sf_dir):
    from marketlake.sources import fixtures

    load = lambda n: fixtures.load(spark, sf_dir, n)
    root = scratch_path(spark, "lake")
    paths = lake.run_lake(load("equity_raw"), load("corporate"), load("fo_raw"), root,
                          order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER)
    gold = spark.read.parquet(paths["gold"]).drop("trade_year")
    expected = lake.gold(load("equity_raw"), load("corporate"), load("fo_raw"),
                         order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER)
    cols = ["trade_date", "advances", "declines", "unchanged", "total_stocks", "total_volume",
            "put_oi", "call_oi"]
    assert gold.select(*cols).exceptAll(expected.select(*cols)).count() == 0
    assert gold.count() == expected.count() == paths["gold_rows"]
    assert paths["silver_rows"] == spark.read.parquet(paths["silver"]).count()
    # a mid-year restart rebuilds whole years and loses nothing
    again = lake.run_lake(load("equity_raw"), load("corporate"), load("fo_raw"), root,
                          order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER, start_date="1998-07-15")
    assert spark.read.parquet(again["silver"]).count() == paths["silver_rows"]


def test_jobs_cli_silver_gold_compact(spark, sf_dir):
    from marketlake import jobs
    from marketlake.operators import clean as clean_ops
    from marketlake.sources import fixtures

    root = scratch_path(spark, "jobs")
    eq = clean_ops.equity_clean(fixtures.load(spark, sf_dir, "equity_raw"), catalog.EQ_ORDER)
    eq.write.parquet(f"{root}/bronze_eq")
    fixtures.load(spark, sf_dir, "corporate").write.parquet(f"{root}/corp")
    fixtures.load(spark, sf_dir, "fo_raw").write.parquet(f"{root}/fo_raw")
    jobs.run(["silver", "--equity", f"{root}/bronze_eq", "--corporate", f"{root}/corp",
              "--out", f"{root}/silver"], spark)
    jobs.run(["gold", "--silver", f"{root}/silver", "--fo", f"{root}/fo_raw", "--fo-raw",
              "--out", f"{root}/gold"], spark)
    gold = spark.read.parquet(f"{root}/gold")
    assert gold.count() == catalog.market_breadth(spark, sf_dir).count()
    status = jobs.run(["compact", f"{root}/silver={root}/silver_c", f"{root}/missing={root}/x"], spark)
    assert status[f"{root}/silver"] == "ok" and status[f"{root}/missing"].startswith("failed")


def test_jobs_stream_with_dead_letters(spark, sf_dir):
    from marketlake import jobs
    from marketlake.operators import clean as clean_ops
    from marketlake.sources import fixtures

    root = scratch_path(spark, "jobs-stream")
    raw = fixtures.load(spark, sf_dir, "equity_raw")
    raw.write.option("maxRecordsPerFile", 2000).json(f"{root}/landing")
    jobs.run(["stream", "equity", "--source", f"{root}/landing", "--out", f"{root}/bronze",
              "--checkpoint", f"{root}/ckpt", "--dead-letters", f"{root}/dlq"], spark)
    bronze, dlq = spark.read.parquet(f"{root}/bronze"), spark.read.parquet(f"{root}/dlq")
    valid = clean_ops.equity_valid(clean_ops.equity_normalise(raw))
    assert bronze.select("symbol", "trade_date").distinct().count() == \
        valid.select("symbol", "trade_date").distinct().count()
    assert dlq.count() == raw.count() - valid.count() > 0
    assert dlq.where("reject_reason IS NULL").count() == 0


def test_start_date_prunes_bronze_partitions(spark, sf_dir):
    from marketlake.operators import adjust as adjust_ops
    from marketlake.sources import fixtures

    path = scratch_path(spark, "bronze-by-day")
    catalog.equity_clean(spark, sf_dir).write.partitionBy("trade_date").parquet(path)
    bronze = spark.read.parquet(path).withColumn("trade_date", F.col("trade_date").cast("string"))
    corp = fixtures.load(spark, sf_dir, "corporate")
    silver = adjust_ops.ohlcv_adjusted(bronze, corp, start_date="1997-01-01", prices_unique=True)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "1997-01-01" in plan
    assert silver.where("trade_date < '1997-01-01'").count() == 0 and silver.count() > 0


def test_lake_from_written_tables(spark, sf_dir):
    from marketlake.sources import fixtures

    load = lambda n: fixtures.load(spark, sf_dir, n)
    paths = lake.run_lake(load("equity_raw"), load("corporate"), load("fo_raw"),
                          scratch_path(spark, "lake-serve"), order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER)
    lk = Lake.from_tables(spark, silver=paths["silver"], gold=paths["gold"])
    ohlcv = lk.get_ohlcv("sym7", "1996-01-01", "1997-12-31")
    assert ohlcv.count() == catalog.serve_ohlcv(spark, sf_dir).count()
    assert "PartitionFilters" in ohlcv._jdf.queryExecution().executedPlan().toString()
    breadth_rows = lk.get_market_breadth("1997-01-01", "1998-06-30")
    assert breadth_rows.count() == catalog.serve_breadth(spark, sf_dir).count()
    assert "trade_year" not in breadth_rows.columns


def test_jobs_serve_returns_rows_and_count(spark, sf_dir):
    from marketlake import jobs
    from marketlake.sources import fixtures

    load = lambda n: fixtures.load(spark, sf_dir, n)
    paths = lake.run_lake(load("equity_raw"), load("corporate"), load("fo_raw"),
                          scratch_path(spark, "lake-cli"), order=catalog.EQ_ORDER, fo_order=catalog.FO_ORDER)
    out = jobs.run(["serve", "ohlcv", "--table", paths["silver"], "--symbol", "sym7",
                    "--from-date", "1996-01-01", "--to-date", "1997-12-31"], spark)
    assert out["count"] == len(out["data"]) == catalog.serve_ohlcv(spark, sf_dir).count()
    dates = [r["trade_date"] for r in out["data"]]
    assert dates == sorted(dates)

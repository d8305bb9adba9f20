"""Streaming cleaner (file source, several micro-batches, restart) and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import clean, maintain
from marketlake.plans import catalog
from marketlake.session import scratch_path
from marketlake.sources import fixtures
from marketlake.streaming import clean_stream


def test_stream_dedup_matches_batch_keys_and_restarts(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "equity_raw")
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    first, second = raw.where("ingested_at % 2 = 0"), raw.where("ingested_at % 2 = 1")
    first.write.option("maxRecordsPerFile", 1000).json(src)

    def run():
        stream = clean_stream.read_stream(spark, src, clean_stream.RAW_SCHEMAS["equity"],
                                          max_files_per_trigger=1)
        q = clean_stream.write_bronze(clean_stream.equity_clean_stream(stream), out, ckpt,
                                      partition_by=("series",))
        clean_stream.run_available_now(q)

    run()
    n1 = spark.read.parquet(out).count()
    second.write.mode("append").option("maxRecordsPerFile", 1000).json(src)
    run()  # restart from the checkpoint: only new files are read
    bronze = spark.read.parquet(out)
    keys = bronze.select("symbol", "trade_date")
    batch = clean.equity_valid(clean.equity_normalise(raw)).select("symbol", "trade_date").distinct()
    assert keys.count() == keys.distinct().count() == batch.count() >= n1
    assert keys.exceptAll(batch).count() == 0


def test_zorder_preserves_rows(spark, sf_dir):
    df = catalog.equity_clean(spark, sf_dir)
    z = maintain.zorder(df, ["symbol", "trade_date"], num_partitions=4)
    assert z.exceptAll(df).count() == 0 and df.exceptAll(z).count() == 0


def test_zorder_value_clusters(spark):
    df = spark.range(0, 4096).select((F.col("id") % 64).alias("a"), (F.col("id") / 64).cast("long").alias("b"))
    z = maintain.with_zorder(df, ["a", "b"], bits=6)
    # quantile buckets: at most one pair of adjacent values shares a bucket
    assert z.select("_z").distinct().count() >= 63 * 63
    near = z.where("a < 3 AND b < 3").agg(F.max("_z")).first()[0]
    far = z.where("a > 60 AND b > 60").agg(F.min("_z")).first()[0]
    assert near < 64 <= far


def test_compaction_rewrite_and_fault_isolation(spark, sf_dir):
    src, dst = scratch_path(spark, "small"), scratch_path(spark, "compacted")
    eq = catalog.equity_clean(spark, sf_dir)
    eq.repartition(12).write.parquet(src)
    plan = maintain.compaction_plan(spark.read.parquet(src)).first()
    assert plan["input_files"] >= 10 and plan["rewrite"]
    n = maintain.rewrite(spark, src, dst)
    out = spark.read.parquet(dst)
    assert n == 1 and out.exceptAll(eq).count() == 0 and out.count() == eq.count()

    # a table with fewer than 10 files is left alone
    one = scratch_path(spark, "one-file")
    eq.coalesce(1).write.parquet(one)
    assert maintain.rewrite(spark, one, scratch_path(spark, "unused")) == 0

    def boom():
        raise RuntimeError("missing table")

    status = maintain.compact_tables([("bad", boom), ("good", lambda: None)])
    assert status["good"] == "ok" and status["bad"].startswith("failed")


def test_parse_messages_round_trip(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "equity_raw").drop("tiebreak", "arrival_seq")
    msgs = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    back = clean_stream.parse_messages(msgs, clean_stream.RAW_SCHEMAS["equity"])
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    bad = spark.createDataFrame([("not json",)], "value string")
    assert clean_stream.parse_messages(bad, clean_stream.RAW_SCHEMAS["equity"]).first()["symbol"] is None


def test_ttl_dedup_variants_match_batch_keys(spark, sf_dir):
    from marketlake.streaming import ttl_dedup

    raw = fixtures.load(spark, sf_dir, "equity_raw")
    src = scratch_path(spark, "ttl-src")
    raw.write.option("maxRecordsPerFile", 2000).json(src)
    batch = clean.equity_valid(clean.equity_normalise(raw)).select("symbol", "trade_date").distinct()
    before = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    for variant in (ttl_dedup.dedup_with_ttl_rows, ttl_dedup.dedup_with_ttl, ttl_dedup.dedup_with_timeout):
        out, ckpt = scratch_path(spark, "ttl-out"), scratch_path(spark, "ttl-ckpt")
        stream = clean_stream.read_stream(spark, src, clean_stream.RAW_SCHEMAS["equity"],
                                          max_files_per_trigger=1)
        valid = stream.transform(clean.equity_normalise).transform(clean.equity_valid)
        deduped = variant(valid, list(clean.EQUITY_KEY))
        q = ttl_dedup.start_with_conf(spark, lambda: (
            deduped.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start()), state_partitions=4)
        clean_stream.run_available_now(q, timeout_s=300)
        keys = spark.read.parquet(out).select("symbol", "trade_date")
        assert keys.count() == keys.distinct().count() == batch.count()
        assert keys.exceptAll(batch).count() == 0
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == before


def test_watermark_dedup_on_rocksdb_state_store(spark, sf_dir):
    from marketlake.streaming import ttl_dedup

    raw = fixtures.load(spark, sf_dir, "equity_raw")
    src, out, ckpt = (scratch_path(spark, n) for n in ("rsrc", "rout", "rckpt"))
    raw.write.option("maxRecordsPerFile", 2000).json(src)
    stream = clean_stream.read_stream(spark, src, clean_stream.RAW_SCHEMAS["equity"], max_files_per_trigger=1)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ttl_dedup.ROCKSDB_PROVIDER)
    try:
        q = clean_stream.write_bronze(clean_stream.equity_clean_stream(stream), out, ckpt, partition_by=())
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    clean_stream.run_available_now(q)
    keys = spark.read.parquet(out).select("symbol", "trade_date")
    batch = clean.equity_valid(clean.equity_normalise(raw)).select("symbol", "trade_date").distinct()
    assert keys.count() == batch.count() and keys.exceptAll(batch).count() == 0


def test_event_stream_dedup_matches_batch_distinct(spark):
    # events as several Parquet files, one per micro-batch, explicit schema
    sf = "/root/testdata/sf0.01"
    events = spark.read.parquet(f"{sf}/events.parquet")
    src, out, ckpt = (scratch_path(spark, n) for n in ("ev-src", "ev-out", "ev-ckpt"))
    events.orderBy("event_id").write.option("maxRecordsPerFile", 2000).parquet(src)
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
              .withColumn("day", F.to_date("ts")))
    deduped = clean_stream.first_per_key_stream(stream, ["user_id", "day"], "ts", "24 hours")
    q = (deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    clean_stream.run_available_now(q)
    keys = spark.read.parquet(out).select("user_id", "day")
    batch = events.select("user_id", F.to_date("ts").alias("day")).distinct()
    assert keys.count() == keys.distinct().count() == batch.count()

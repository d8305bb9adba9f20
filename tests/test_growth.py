"""Work that must grow no faster than the input: decodings, files, tasks, batches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.casts import safe_float
from marketlake.streaming import clean_stream


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("pick", [clean_stream.malformed_messages, clean_stream.well_formed])
def test_messages_are_decoded_once_under_a_filter_on_the_outcome(spark, pick):
    rows = [(1, '{"ingested_at": 5, "trade_date": "2024-01-02"}'), (2, '{"ingested_at": "soon"}'), (3, " "), (4, None), (5, '{"a"')]
    messages = spark.createDataFrame(rows, "id long, value string")
    out = pick(messages, schemas.EQUITY_RAW)
    assert optimized(out).count("from_json(") == 1
    assert {r.id for r in out.collect()} == ({1} if pick is clean_stream.well_formed else {2, 3, 4, 5})
    assert not {"_drawn", "_text", "_reason"} & set(out.columns)


def test_messages_are_read_to_their_end(spark):
    record, other = '{"ingested_at": 5, "trade_date": "d"}', '{"ingested_at": 6}'
    whole = [record, f" {record}\t\r", '{"ingested_at": 5, "symbol": "}{"}', '{"ingested_at": 5, "more": {"x": [1, NaN]}, "open": -Infinity}',
             '{"ingested_at": 5, "open": NaN} ', "{}"]
    more = [f"{record}x", f"{record} {other}", f"{record},{other}", f"{record}}}", f"{record}]", f"{record}] }}", f'{record},"======"] }}',
            f"[{record},{other}]", f"[{record}] }}", f"[{record}]", f'{record},"x":1', '{"ingested_at": 5, "more": {"x": 1}}}']
    messages = spark.createDataFrame(list(enumerate(whole + more)), "id long, value string")
    bad = {r.message: r.reject_reason for r in clean_stream.malformed_messages(messages, schemas.EQUITY_RAW).collect()}
    assert bad == {m: "malformed_message" for m in more}
    assert {r.id for r in clean_stream.well_formed(messages, schemas.EQUITY_RAW).collect()} == set(range(len(whole)))
    row = clean_stream.message_outcomes(messages, "macro").first()
    assert (row.input, row.accepted + row.rejected, row.malformed) == (len(whole + more), len(whole), len(more))


def test_quarantine_keeps_whole_texts(spark, monkeypatch):
    from marketlake.plans import catalog_tables

    texts = ['{"ingested_at":1,"symbol":"A \\":1.25","open":-0.0625,"close":1.0E7,"x":"1.5"', '{"ingested_at":"soon","open":1.0E-4}', " "]
    messages = spark.createDataFrame(list(enumerate(texts)), "id long, value string")
    monkeypatch.setattr(catalog_tables, "_messages", lambda *_: {"equity": ("equity_raw", messages)})
    out = catalog_tables.quarantined_messages(spark, "")
    assert optimized(out).count("regexp_extract_all(") == 1
    got = {r.id: (r.message, r.closed) for r in out.collect()}
    assert got == {0: ('{"ingested_at":1,"symbol":"A \\":1.25","open":-0.062500000000000,"close":10000000.000000000000000,"x":"1.5"', False),
                   1: ('{"ingested_at":"soon","open":0.000100000000000}', True), 2: (" ", False)}


def test_plain_numbers_are_told_by_all_of_their_characters(spark):
    texts = ["1.5", " 1.5 ", "1.5\n", "", "-", "1e3", "12d", "1_0", " 2", "1\n2", "+.5", "nan", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", safe_float("t").alias("x")).orderBy("i").collect()]

    def python(t):
        try:
            return None if t is None else float(t)
        except ValueError:
            return None
    assert [str(x) for x in got] == [str(python(t)) for t in texts]
    assert "translate(" not in optimized(df.select(safe_float("t")))


def test_every_cut_is_found_by_the_binary_search(spark):
    from marketlake.operators import maintain

    for n in (0, 1, 2, 3, 7, 8, 100):
        cuts = [f"k{i:03d}" for i in range(0, 2 * n, 2)]
        values = [*cuts, *[f"{c}x" for c in cuts], "", "a", "z"]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
        plan = df.select("v", maintain._text_bucket(F.col("v"), cuts).alias("b"))
        assert "named_struct" not in optimized(plan)
        assert all(r.b == (0 if r.v is None else sum(c <= r.v for c in cuts)) for r in plan.collect())


def test_the_row_hash_of_a_zorder_is_not_shuffled(spark):
    from marketlake.operators import maintain

    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    shuffled = [line for line in optimized(maintain.zorder(df, ["id", "k"], 4)).splitlines() if "_salt" in line]
    assert not shuffled


def _lineitem(spark, path, rows=4000):
    i = F.col("id")
    spark.range(rows).select(
        i.alias("l_orderkey"), (i % 50).alias("l_partkey"), (i % 9).alias("l_suppkey"), (i % 7 + 1).cast("int").alias("l_linenumber"),
        (i % 40 + 1).cast("double").alias("l_quantity"), (i + 1).cast("double").alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.1).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("cast(date_add(DATE'1993-01-01', cast(id % 2000 as int)) as timestamp)").alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _data_files(folder, ending):
    return [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.endswith(ending) and not f.startswith(".")]


def test_small_files_are_one_for_each_feed_and_year_and_share_no_task(spark, tmp_path):
    from marketlake.plans import catalog

    out = catalog._many_files(spark, _lineitem(spark, tmp_path))
    files = _data_files(out, ".parquet")
    # a task's number is in the name of what it writes: no task has two years or feeds
    tasks = [os.path.basename(f).split("-")[1] for f in files]
    assert len(set(tasks)) == len(tasks) == 4 * 4 + 2 * 12
    assert spark.read.parquet(out).count() == 4000


def test_a_delivery_is_many_files_with_each_symbols_day_in_one(spark, tmp_path):
    from marketlake.plans import catalog_tables

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = catalog_tables._delivered(spark, _lineitem(spark, tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = spark.read.json(path).select("TckrSymb", "trade_date", F.substring("ISIN", 4, 9).alias("part"),
                                        F.col("_metadata.file_path").alias("file"))
    delivery = F.expr("case when part % 10 < 1 then 0 when part % 10 < 3 then 1 when part % 10 < 6 then 2 else 3 end")
    files = rows.where("TckrSymb is not null").withColumn("d", delivery)
    assert files.groupBy("d").agg(F.count_distinct("file").alias("n")).where("n < 2").isEmpty()
    assert files.groupBy("d", "TckrSymb", "trade_date").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()


def test_micro_batches_do_not_grow_in_number_with_the_landing(spark, tmp_path):
    from marketlake.plans import catalog

    for n in (40_000, 400_000):
        path = str(tmp_path / str(n))
        per_batch = catalog._land_messages(spark.range(0, n, 1, 1), path)
        files = _data_files(path, ".json.gz")
        assert 2 <= -(-len(files) // per_batch) <= catalog.STREAM_BATCHES + 1
        assert spark.read.schema("id long").json(path).count() == n


def test_buckets_of_symbols_are_joined_without_sorts(spark, tmp_path):
    from marketlake.plans import catalog_tables

    spark.range(3000).select(F.concat(F.lit("S"), F.col("id") % 5).alias("symbol"), F.lit(1.0).alias("close_adj"), F.expr(
        "cast(date_add(DATE'1996-01-01', cast(id as int)) as string)").alias("trade_date")).createOrReplaceTempView("silver_rows")
    before = catalog_tables.served
    catalog_tables.served = lambda *_: "silver_rows"
    try:
        out = catalog_tables.silver_by_symbol(spark, str(tmp_path))
    finally:
        catalog_tables.served = before
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    got = {(r.symbol, r.last_date, r.n_days) for r in out.collect()}
    assert got == {(f"S{k}", f"2004-03-{14 + k}", 600) for k in range(5)}


def test_ttl_state_grows_with_buckets_of_keys_and_rows_stay_whole(spark):
    import time

    from marketlake.session import scratch_path
    from marketlake.streaming import ttl_dedup

    schema = "ingested_at long, symbol string, price double, big long, at timestamp"
    src = scratch_path(spark, "ttl-grow")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run(out, ckpt, **how):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = ttl_dedup.start_with_conf(spark, lambda: (
            ttl_dedup.dedup_with_ttl_rows(stream, ["symbol", "price"], **how).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start()), state_partitions=2)
        clean_stream.run_available_now(q, timeout_s=300)
        return q.lastProgress["stateOperators"][0]["numRowsTotal"]

    nan, big = float("nan"), 2**60 + 1
    out, ckpt = scratch_path(spark, "ttl-grow-out"), scratch_path(spark, "ttl-grow-ckpt")
    many = [(9, f"s{i}", 1.0, big, None) for i in range(300)]
    # a key comes again in its batch (earlier in order) and in the next one; nulls and numbers that are none are keys too
    arrive([*many, (5, "s7", 1.0, None, None), (1, None, nan, 1, None), (2, None, nan, 2, None), (3, None, None, 3, None)])
    assert run(out, ckpt, buckets=4) <= 4
    arrive([(1, "s7", 1.0, 0, None), (1, "new", 0.0, 0, None), (2, "new", -0.0, 1, None), (0, None, nan, 0, None), (0, None, None, 0, None)])
    assert run(out, ckpt, buckets=4) <= 8
    got = {(r.symbol, str(r.price)): (r.ingested_at, r.big) for r in spark.read.parquet(out).collect()}
    want = {(f"s{i}", "1.0"): (9, big) for i in range(300)} | {("s7", "1.0"): (5, None), (None, "nan"): (1, 1), (None, "None"): (3, 3),
                                                               ("new", "0.0"): (1, 0)}
    assert got == want and spark.read.parquet(out).count() == len(want)
    assert spark.read.parquet(out).schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    # a key is forgotten its time after it was first seen
    out, ckpt = scratch_path(spark, "ttl-short-out"), scratch_path(spark, "ttl-short-ckpt")
    run(out, ckpt, ttl_ms=500)
    time.sleep(1)
    arrive([(1, "s7", 1.0, 4, None)])
    run(out, ckpt, ttl_ms=500)
    assert 4 in [r.big for r in spark.read.parquet(out).where("symbol = 's7'").collect()]

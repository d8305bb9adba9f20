"""Delivered files, messages, streams with payload, named tables, journaled compaction, sketches, as-of factors."""

from __future__ import annotations

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from marketlake import jobs, schemas
from marketlake.operators import adjust, breadth, clean, maintain
from marketlake.plans import catalog, lake, tables
from marketlake.plans.serve import Lake
from marketlake.session import scratch_path
from marketlake.sources import fixtures, landing
from marketlake.streaming import clean_stream, first_arrival, metrics

ORDER = (*clean.ARRIVAL_ORDER, "tiebreak", "total_turnover")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- arrival of delivered files -----------------------------------------------------

def _item(symbol, price):
    return json.dumps({"ingested_at": 1, "trade_date": "2024-01-02", "TckrSymb": symbol, "SctySrs": "EQ", "ClsPric": price})


def test_delivery_order_against_file_sizes_and_over_runs(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    # the first file is small, the second one large: Spark packs the large one first
    (src / "b.json").write_text("\n".join(_item(f"S{i}", 1.0) for i in range(50)))
    (src / "a.json").write_text("\n".join(_item(f"S{i}", 2.0) for i in range(4000)))
    os.utime(src / "b.json", (1_700_000_000, 1_700_000_000))
    os.utime(src / "a.json", (1_700_000_100, 1_700_000_100))
    jobs.run(["land", "equity", "--source", str(src), "--out", out], spark)
    again = tmp_path / "again"
    again.mkdir()
    (again / "c.json").write_text("\n".join(_item(f"S{i}", 3.0) for i in range(4500)))
    jobs.run(["land", "equity", "--source", str(again), "--out", out], spark)
    landed = spark.read.parquet(out)
    assert landed.count() == landed.select("arrival_seq").distinct().count() == 8550
    close = {r.symbol: r.close for r in clean.equity_clean(landed, clean.ARRIVAL_ORDER).collect()}
    assert close == {f"S{i}": 1.0 if i < 50 else 2.0 if i < 4000 else 3.0 for i in range(4500)}
    # the place in a file is kept as well
    first = landed.where("close = 2.0").orderBy("arrival_seq").limit(5).collect()
    assert [r.symbol for r in first] == [f"S{i}" for i in range(5)]


def test_same_time_goes_by_path_and_exploded_payloads_keep_their_place(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    for name, value in (("2.json", "late"), ("1.json", "early")):
        (src / name).write_text(json.dumps({"ingested_at": 5, "trade_date": "2024-01-02", "data": [
            {"index": f"{value}{i}", "last": i + 1} for i in range(3)]}))
        os.utime(src / name, (1_700_000_000, 1_700_000_000))
    jobs.run(["land", "index", "--source", str(src), "--out", out], spark)
    rows = spark.read.parquet(out).orderBy("arrival_seq").collect()
    assert [r.index_name for r in rows] == ["early0", "early1", "early2", "late0", "late1", "late2"]


def test_macro_job_and_variant_fields(spark, tmp_path):
    src, out = tmp_path / "m.json", str(tmp_path / "out")
    src.write_text("\n".join([
        json.dumps({"record_type": "FII_DII", "trade_date": "2024-01-02", "ingested_at": 1, "data": {"category": "FII", "netValue": "12.5"}}),
        json.dumps({"trade_date": "2024-01-02", "ingested_at": 2, "data": {"marketState": [{"market": "CM", "open": True}]}})]))
    jobs.run(["land", "macro", "--source", str(src), "--out", out], spark)
    macro = spark.read.parquet(out)
    assert {"arrival_seq", "data"} < set(macro.columns)
    odd = spark.createDataFrame([(3, "2024-01-02", "MARKET_STATUS", "closed"), (4, None, "MARKET_STATUS", None)], "ingested_at long, trade_date string, record_type string, data string")
    got = {r.ingested_at: r for r in landing.macro_fields(landing.macro_variant(macro.drop("arrival_seq").unionByName(odd)), {
        "net": ("$.netValue", "double"), "open": ("$.marketState[0].open", "boolean"), "raw": ("$.raw", "string")}).collect()}
    assert (got[1].net, got[2].open, got[3].raw) == (12.5, True, "closed")
    assert got[1].open is None and got[4].raw is None


# --- messages -------------------------------------------------------------------------

def test_messages_are_accepted_rejected_or_quarantined(spark, tmp_path):
    good = {"ingested_at": 1, "trade_date": "d", "symbol": "A", "series": "EQ", "close": 1.5}
    lines = [json.dumps(good), json.dumps({**good, "symbol": None}), json.dumps(good)[:-3], "  ", "[1]", json.dumps({**good, "close": "x"}),
             json.dumps({**good, "more": 1})]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.json").write_text("\n".join(lines))
    messages = clean_stream.read_messages(spark, str(tmp_path / "m"), stream=False)
    accepted, rejected, malformed = clean_stream.split_messages(messages, "equity_raw")
    assert accepted.count() == 2 and [r.reject_reason for r in rejected.collect()] == ["missing_symbol"]
    bad = {r.message: (r.reject_reason, os.path.basename(r.source_file)) for r in malformed.collect()}
    assert set(bad) == {lines[2], lines[3], lines[4], lines[5]} and {f for _, f in bad.values()} == {"x.json"}
    assert bad["  "][0] == "empty_message" and bad[lines[2]][0] == "malformed_message"
    row = clean_stream.message_outcomes(messages, "equity_raw").first()
    assert (row.input, row.accepted, row.rejected, row.malformed) == (7, 2, 1, 4)
    jobs.run(["stream", "equity", "--source", str(tmp_path / "m"), "--out", str(tmp_path / "b"), "--checkpoint", str(tmp_path / "c"),
              "--quarantine", str(tmp_path / "q")], spark)
    assert {r.message for r in spark.read.parquet(str(tmp_path / "q")).collect()} == set(bad)


def test_listener_counts_in_flight(spark, sf_dir):
    src, out, ckpt = (scratch_path(spark, n) for n in ("metric-src", "metric-out", "metric-ckpt"))
    landed = landing.land_equity(fixtures.load(spark, sf_dir, "equity_landing"))
    landed.write.option("maxRecordsPerFile", 1500).json(src)
    totals = metrics.IngestTotals()
    spark.streams.addListener(totals)
    try:
        stream = clean_stream.read_stream(spark, src, schemas.EQUITY_RAW, max_files_per_trigger=1)
        clean_stream.run_available_now(clean_stream.write_bronze(
            metrics.counted(stream, "equity", "equity_raw"), out, ckpt, partition_by=()))
        want = landing.ingest_summary([("equity", landed)]).first()
        for _ in range(100):  # progress events arrive a little later
            if sum(totals.totals().get("equity", {}).values()) == landed.count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert totals.totals() == {"equity": {"records": want.records, "errors": want.errors}}


# --- first arrival on a stream ----------------------------------------------------------


def test_stream_keeps_the_first_arrival_over_restart_and_replay(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "equity_raw")
    top = raw.agg(F.max("ingested_at")).first()[0] + 1
    src, out, state, ckpt = (scratch_path(spark, f"fa-{n}") for n in ("src", "out", "state", "ckpt"))
    merge = {"keys": clean.EQUITY_KEY, "order": ORDER, "out": out, "state": state, "ttl_hours": 24, "partition_by": ("series",)}
    batches = {}

    def run(feeds):
        for i in feeds:
            part = F.least(F.floor(F.col("ingested_at") * 4 / top), F.lit(3)) == i
            raw.where(part).coalesce(1).write.mode("append").json(src)
        stream = clean_stream.read_stream(spark, src, raw.schema, max_files_per_trigger=1)
        valid = stream.transform(clean.equity_normalise).transform(clean.equity_valid)
        clean_stream.run_available_now(first_arrival.start(
            valid, ckpt, after_batch=lambda b: batches.setdefault(b, True), **merge))

    run([0, 1])
    run([2, 3])  # goes on from the checkpoint
    want = clean.equity_clean(raw, ORDER)
    got = first_arrival.read_bronze(spark, out, raw)
    assert sorted(batches) == [0, 1, 2, 3]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a replayed batch writes what it wrote before
    part = F.least(F.floor(F.col("ingested_at") * 4 / top), F.lit(3)) == 2
    batch = raw.where(part).transform(clean.equity_normalise).transform(clean.equity_valid)
    first_arrival.merge_batch(batch, 2, **merge)
    again = first_arrival.read_bronze(spark, out, raw)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


def test_a_key_is_forgotten_after_its_time_and_a_replay_sees_the_old_time(spark):
    schema = "symbol string, trade_date string, ingested_at long, arrival_seq long, close double"
    out, state = scratch_path(spark, "ttl-out"), scratch_path(spark, "ttl-state")
    one = lambda i, close: spark.createDataFrame([("A", "2024-01-02", i, i, close), (None, None, i, i, close)], schema)
    merge = {"keys": clean.EQUITY_KEY, "order": clean.ARRIVAL_ORDER, "out": out, "state": state}
    first_arrival.merge_batch(one(1, 1.0), 0, ttl_hours=24, **merge)
    first_arrival.merge_batch(one(2, 2.0), 1, ttl_hours=24, **merge)
    closes = lambda: sorted(r.close for r in spark.read.schema(schema).parquet(out).collect())
    assert closes() == [1.0, 1.0]
    time.sleep(0.2)
    first_arrival.merge_batch(one(3, 3.0), 2, ttl_hours=0.1 / 3600, **merge)
    assert closes() == [1.0, 1.0, 3.0, 3.0]
    time.sleep(0.3)
    first_arrival.merge_batch(one(4, 4.0), 1, ttl_hours=24, **merge)  # batch 1 again, at its own time
    assert closes() == [1.0, 1.0, 3.0, 3.0]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("symbol"),
                                     F.lit("d").alias("trade_date"), F.col("id").alias("ingested_at"), F.col("id").alias("arrival_seq"))
    plan = plan_of(clean.first_arrival(rows, clean.EQUITY_KEY, clean.ARRIVAL_ORDER))
    assert plan.index("partial_min") > plan.index("Exchange")  # below the exchange


def test_watermark_state_forgets_keys(spark, tmp_path):
    src, ckpt = tmp_path / "src", str(tmp_path / "ckpt")
    src.mkdir()
    schema = "k string, at timestamp"

    def run(name, rows):
        (src / name).write_text("\n".join(json.dumps({"k": k, "at": at}) for k, at in rows))
        stream = clean_stream.read_stream(spark, str(src), schema)
        deduped = clean_stream.first_per_key_stream(stream, ["k"], "at", "24 hours")
        query = clean_stream.start_query(spark, lambda: (
            deduped.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start()), state_partitions=2)
        clean_stream.run_available_now(query, timeout_s=120)
        return {r.key.k for r in spark.read.format("statestore").load(ckpt).select("key").collect()}

    assert run("1.json", [("A", "2024-01-01T00:00:00Z")]) == {"A"}
    assert run("2.json", [("B", "2024-01-02T12:00:00Z")]) >= {"B"}
    # the watermark is a day behind B; two days after A it has passed A's time
    assert run("3.json", [("C", "2024-01-04T00:00:00Z")]) >= {"C"}
    assert "A" not in run("4.json", [("D", "2024-01-04T01:00:00Z")])


def test_bronze_lies_by_day_and_series(spark, tmp_path):
    rows = [("A", "2024-01-02", "EQ", 1, 1, 5.0), ("B", "2024-01-02", "BE", 2, 2, 6.0), ("A", "2024-01-03", "EQ", 3, 3, 7.0)]
    raw = spark.createDataFrame(rows, "symbol string, trade_date string, series string, ingested_at long, arrival_seq long, close double")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    raw.write.json(src)
    clean_stream.run_available_now(first_arrival.start_equity(
        clean_stream.read_stream(spark, src, raw.schema), str(tmp_path / "c"), out, str(tmp_path / "s")))
    found = {os.path.relpath(d, out) for d, _, files in os.walk(out) if any(f.endswith(".parquet") for f in files)}
    assert found == {f"batch_id=0/trade_date={d}/series={s}" for d, s in (
        ("2024-01-02", "EQ"), ("2024-01-02", "BE"), ("2024-01-03", "EQ"))}
    day = spark.read.schema(raw.schema).parquet(out).where("trade_date = '2024-01-03'")
    assert "PartitionFilters: [isnotnull(trade_date" in plan_of(day) and day.count() == 1


# --- named tables, symbol layout --------------------------------------------------------

def test_named_table_prunes_partitions_and_recovers_new_ones(spark, sf_dir):
    path = scratch_path(spark, "named")
    silver = catalog._silver(spark, sf_dir)
    lake.write_silver(silver.where("trade_date < '1997-01-01'"), path)
    tables.register(spark, "named_silver", path, tables.Layout(("trade_year",)))
    assert spark.table("named_silver").agg(F.max("trade_year")).first()[0] == 1996
    lake.write_silver(silver.where("trade_date >= '1997-01-01'"), path)
    spark.catalog.recoverPartitions("named_silver")
    scan = spark.table("named_silver").where("trade_year = 1997")
    assert "PartitionFilters: [isnotnull(trade_year" in plan_of(scan)
    assert spark.table("named_silver").count() == silver.count()
    spark.sql("DROP TABLE named_silver")
    assert spark.read.parquet(path).count() == silver.count()  # external: the files stay


def test_symbol_layout_reads_one_bucket_and_joins_without_exchange(spark, sf_dir):
    path = scratch_path(spark, "by-symbol")
    silver = lake.with_trade_year(catalog._silver(spark, sf_dir))
    layout = tables.symbol_layout(8)
    tables.write(silver, "silver_buckets", path, layout)
    files = maintain.file_stats(spark.read.parquet(path))
    assert files.count() <= 8 * files.select("partition").distinct().count()
    lk = Lake.from_names(spark, silver="silver_buckets")
    # Spark prunes buckets either way, but names them only in a scan that keeps them apart
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    one = lk.get_ohlcv("sym7", "1996-01-01", "1997-12-31")
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(one) and "PartitionFilters" in plan_of(one)
    assert one.count() == silver.where("symbol = 'SYM7' AND trade_date BETWEEN '1996-01-01' AND '1997-12-31'").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.table("silver_buckets")
        both = t.join(t.groupBy("symbol").agg(F.max("trade_date").alias("last")), "symbol")
        assert "Exchange" not in plan_of(both)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a rebuild replaces the years it has, bucketed alike
    year = silver.where("trade_year = 1997").withColumn("close_adj", F.lit(-1.0))
    tables.overwrite_partitions(year, "silver_buckets", layout)
    assert spark.table("silver_buckets").count() == silver.count()
    assert spark.table("silver_buckets").where("close_adj = -1").count() == year.count()
    # named again in another session: from the path and the layout
    tables.register(spark, "silver_again", path, layout, schema=spark.table("silver_buckets").schema)
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(Lake.from_names(spark, silver="silver_again").get_ohlcv(
        "sym7", "1996-01-01", "1997-12-31"))
    assert spark.table("silver_again").count() == silver.count()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


# --- compaction -----------------------------------------------------------------------------

def _small_files(spark, root, years=(2020, 2021, 2022, 2023)):
    df = spark.range(800).select(F.col("id"), (F.col("id") % 7).cast("string").alias("symbol"),
                                 F.lit(years[0]).alias("a"), (F.col("id") % len(years) + years[0]).cast("int").alias("trade_year"))
    for i in range(12):
        (df.where((F.col("id") / 4).cast("int") % 12 == i).where((F.col("trade_year") != years[-1]) | (F.lit(i) < 2)).repartition(1)
         .write.mode("append").partitionBy("trade_year").parquet(root))


def test_partition_names_come_from_below_the_table(spark, tmp_path):
    src = str(tmp_path / "env=prod" / "t")
    _small_files(spark, src)
    maintain.rewrite(spark, src, str(tmp_path / "env=prod" / "out"), ["symbol"])
    out = spark.read.parquet(str(tmp_path / "env=prod" / "out"))
    assert out.exceptAll(spark.read.parquet(src)).count() == 0 and out.count() == spark.read.parquet(src).count()


@pytest.mark.parametrize("commit_bytes", [0, 1 << 30])
def test_a_stopped_compaction_goes_on_and_readers_see_no_mixture(spark, tmp_path, commit_bytes):
    table, journal, staging = (str(tmp_path / "env=prod" / n) for n in ("t", "journal", "files"))
    _small_files(spark, table)
    before = spark.read.parquet(table)
    tables.register(spark, "being_compacted", table, tables.Layout(("trade_year",)))
    rows = sorted(map(tuple, before.collect()))
    seen, commits = [], []

    class Killed(Exception):
        pass

    def check(names):
        # the table as its journal has it, and by name, is whole after every commit
        now = maintain.manifest(spark, table, journal)
        tables.swap_partitions(spark, "being_compacted", {n: now[n] for n in names})
        for df in (maintain.read_compacted(spark, table, journal), spark.table("being_compacted")):
            assert sorted(map(tuple, df.select(*before.columns).collect())) == rows
        commits.append(names)
        seen.extend(names)
        if len(commits) == 1 and not commit_bytes:
            raise Killed

    if not commit_bytes:
        with pytest.raises(Killed):
            maintain.compact_in_place(spark, table, journal, staging, ["symbol"], commit_bytes=0, after_commit=check)
    rest = maintain.compact_in_place(spark, table, journal, staging, ["symbol"], commit_bytes=commit_bytes, after_commit=check)
    # 2023 has too few files: its directory is not touched
    flagged = ["trade_year=2020", "trade_year=2021", "trade_year=2022"]
    assert sorted(seen) == flagged and len(commits) == (1 if commit_bytes else 3) and len(rest) == (3 if commit_bytes else 2)
    where = maintain.manifest(spark, table, journal)
    assert maintain.relative(where["trade_year=2023"], table) == "trade_year=2023"
    assert all(where[p].startswith(staging) for p in flagged)
    assert maintain.compact_in_place(spark, table, journal, staging, ["symbol"]) == []
    # registered from the journal, each partition is where it is now
    again = tables.register(spark, "compacted_again", table, tables.Layout(("trade_year",)), journal=journal)
    assert sorted(map(tuple, again.select(*before.columns).collect())) == rows
    assert not [f for f in again.inputFiles() if "/t/trade_year=2020" in f]


# --- aggregates and factors -------------------------------------------------------------------

def test_sketches_merge_within_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("symbol"), (F.col("id") % 10).cast("string").alias("trade_date"))
    sketches = breadth.symbol_sketches(df)
    assert sketches.count() == 10
    total = breadth.distinct_symbols(sketches).first()[0]
    assert abs(total - 50_000) <= 4 * 1.04 / 64 * 50_000
    some = breadth.distinct_symbols(sketches.where("trade_date < '3'")).first()[0]
    exact = df.where("trade_date < '3'").select("symbol").distinct().count()
    assert abs(some - exact) <= 4 * 1.04 / 64 * exact
    assert breadth.distinct_symbols(breadth.symbol_sketches(df.where("symbol IS NULL")).limit(0)).first()[0] in (None, 0)


def test_asof_factors_equal_the_interval_plan(spark):
    rnd = random.Random(6)
    day = lambda: f"{rnd.randrange(2018, 2025)}-{rnd.choice(['01-01', '06-15', '12-31', '03-07'])}"
    actions = [(s, day(), d, d) for s in "ABCDE" for d in rnd.choices(
        ["BONUS 1:1", "SPLIT FROM RS 10 TO RS 2", "bonus 3:2", "split RS 10 TO RS 0"], k=rnd.randrange(0, 9))]
    acts = spark.createDataFrame(actions, "symbol string, ex_date string, action_type string, details string")
    rows = [(day(), s, "EQ", *[float(i)] * 4, i, 1.0, 2.0) for i, s in enumerate("AAAABCDEF" * 60)] + [("no day", "A", "EQ", *[1.0] * 4, 1, 1.0, 2.0)] * 2
    names = "trade_date string, symbol string, series string, open double, high double, low double, close double, total_quantity int, total_turnover double, delivery_pct double"
    prices = spark.createDataFrame(rows, names)
    got, want = adjust.cumulative_factor_asof(prices, acts), adjust.cumulative_factor_interval(prices, acts, broadcast=True)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "Join" not in plan_of(got).split("Window")[0]
    assert adjust.cumulative_factor_asof(prices, acts.limit(0)).where("cumulative_adj_factor <> 1").count() == 0
    assert adjust.cumulative_factor_interval(prices, acts, broadcast=False).exceptAll(want).count() == 0

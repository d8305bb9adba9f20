"""Landing jobs on as-delivered JSON, parsing code size, and rebuilds after new actions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from marketlake import jobs
from marketlake.functions import casts
from marketlake.operators import clean
from marketlake.plans import lake
from marketlake.session import scratch_path
from marketlake.sources import fixtures, landing


def _write(tmp_path, name, items):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(x) for x in items))
    return str(path)


def test_land_index_explodes_the_payload_and_reads_typed_numbers(spark, tmp_path):
    src = _write(tmp_path, "index.json", [{"ingested_at": 5, "data": [
        {"index": "A", "last": 0, "indicativeClose": 12.5, "open": "1,000.5"},
        {"index": "B", "last": 7.25, "indicativeClose": 1.0, "open": "2"},
        {"indexSymbol": "C", "indicativeClose": 3.0}]}, {"ingested_at": 6, "data": []}])
    out = str(tmp_path / "out")
    jobs.run(["land", "index", "--source", src, "--out", out, "--trade-date", "2024-01-02"], spark)
    got = {r.index_name: r for r in spark.read.parquet(out).collect()}
    assert {n: r.close for n, r in got.items()} == {"A": 12.5, "B": 7.25, "C": 3.0}
    assert got["A"].open == 1000.5 and got["A"].trade_date == "2024-01-02"


def test_landed_records_keep_their_arrival_through_to_silver(spark, tmp_path):
    src = _write(tmp_path, "eq.json", [
        {"ingested_at": 1, "trade_date": "2024-01-02", "TckrSymb": "ABC", "SctySrs": "EQ", "ClsPric": str(p), "OpnPric": p}
        for p in (9.0, 1.0, 5.0)])
    out, corp = str(tmp_path / "eq"), str(tmp_path / "corp")
    jobs.run(["land", "equity", "--source", src, "--out", out], spark)
    spark.createDataFrame([], "symbol string, ex_date string, action_type string, details string").write.parquet(corp)
    jobs.run(["silver", "--equity", out, "--corporate", corp, "--out", str(tmp_path / "silver")], spark)
    assert [r.close_raw for r in spark.read.parquet(str(tmp_path / "silver")).collect()] == [9.0]


def test_parsing_method_stays_small_enough_to_be_compiled(spark, sf_dir):
    landed = landing.land_equity(fixtures.load(spark, sf_dir, "equity_landing"))
    plan = landed._jdf.queryExecution().executedPlan()
    seq = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenStringSeq(plan)
    sizes = [seq.apply(i)._3().maxMethodCodeSize() for i in range(seq.size())]
    assert sizes and max(sizes) < 8000


def test_python_float_text(spark):
    values = [0.0, 1.5, 12_500_000.0, 20_000_000.5, 1e15, 1e16, 1.25e-4, 0.001, -3e7, 123456789.125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(casts.python_float_text("x")).collect()]
    assert got[:5] + got[6:] == [repr(v) for v in values[:5] + values[6:]]


def test_rebuild_touches_only_the_years_a_new_action_changes(spark):
    rows = [(y * 10 + i, i, f"{y}-03-0{i + 1}", s, "EQ", 100.0) for y in (2020, 2021, 2022) for i, s in enumerate(("A", "B"))]
    eq = spark.createDataFrame(rows, "ingested_at long, arrival_seq long, trade_date string, symbol string, series string, close double")
    for c in ("open", "high", "low", "total_turnover", "delivery_pct"):
        eq = eq.withColumn(c, F.col("close"))
    eq = eq.withColumn("total_quantity", F.lit(1).cast("long"))
    schema = "symbol string, ex_date string, action_type string, details string"
    path = scratch_path(spark, "rebuild")
    lake.write_silver(lake.silver(eq, spark.createDataFrame([], schema), clean.ARRIVAL_ORDER), path)
    new = spark.createDataFrame([("A", "2021-06-01", "BONUS 1:1", "BONUS 1:1")], schema)
    assert lake.rebuild_silver(eq, new, new, path, clean.ARRIVAL_ORDER) == [2020, 2021]
    got = {(r.symbol, r.trade_year): r.close_adj for r in spark.read.parquet(path).collect()}
    assert got == {("A", 2020): 50.0, ("A", 2021): 50.0, ("A", 2022): 100.0,
                   ("B", 2020): 100.0, ("B", 2021): 100.0, ("B", 2022): 100.0}
    assert lake.rebuild_silver(eq, new, new.limit(0), path, clean.ARRIVAL_ORDER) == []

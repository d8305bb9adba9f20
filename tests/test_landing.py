"""Edge cases of the landing normalisers (Python semantics of the producers)."""

from __future__ import annotations

import json

from marketlake.sources import landing
from marketlake.sources.calendar import trading_weekdays


def test_index_close_truthiness_and_name_fallback(spark):
    items = spark.createDataFrame(
        [("1", "2024-01-02", None, "NIFTY", "0", "1,000.5"),
         ("2", "2024-01-02", "BANK", None, "", "2,000.25"),
         ("3", "2024-01-02", None, None, None, "-")],
        "ingested_at string, trade_date string, index string, indexSymbol string, "
        "last string, indicativeClose string")
    rows = {r["ingested_at"]: r for r in landing.land_index(items).collect()}
    assert rows[1]["index_name"] == "NIFTY" and rows[1]["close"] == 0.0  # '0' is truthy text
    assert rows[2]["index_name"] == "BANK" and rows[2]["close"] == 2000.25  # '' falls through
    assert rows[3]["index_name"] == "UNKNOWN" and rows[3]["close"] is None
    assert rows[1]["volume"] == 0 and rows[1]["turnover_cr"] == 0.0


def test_corporate_defaults(spark):
    items = spark.createDataFrame(
        [("1", " ABC ", None, None, " ", None), ("2", None, "Acme", " BONUS 1:1 ", "2024-01-05", "  ")],
        "ingested_at string, symbol string, comp string, subject string, exDate string, series string")
    rows = {r["ingested_at"]: r for r in landing.land_corporate(items).collect()}
    assert rows[1]["symbol"] == "ABC" and rows[1]["action_type"] == "UNKNOWN"
    assert rows[1]["details"] is None and rows[1]["ex_date"] is None and rows[1]["series"] == "EQ"
    assert rows[2]["symbol"] == "" and rows[2]["action_type"] == "BONUS 1:1"
    assert rows[2]["company_name"] == "Acme" and rows[2]["series"] is None
    assert rows[2]["record_date"] is None  # column absent from the file


def test_surveillance_key_fallback_and_empty_items(spark):
    upper = spark.createDataFrame(
        [("1", " X1 ", "INE1", "X Ltd", "3", None), ("2", None, None, None, None, None)],
        "ingested_at string, SYMBOL string, ISIN string, NAME string, stage string, reason string")
    camel = spark.createDataFrame([("3", "Y1", " ", "Y Ltd")],
                                  "ingested_at string, symbol string, isin string, companyName string")
    out = landing.land_surveillance({"GSM": upper, "FO_BAN": camel}, as_of_date="2024-01-02")
    rows = {r["ingested_at"]: r for r in out.collect()}
    assert set(rows) == {1, 3}  # the empty item is skipped
    assert rows[1]["symbol"] == "X1" and rows[1]["stage"] == 3 and rows[1]["list_type"] == "GSM"
    assert rows[3]["isin"] is None and rows[3]["company_name"] == "Y Ltd"
    assert rows[3]["as_of_date"] == "2024-01-02" and rows[3]["stage"] is None


def test_macro_status_wrapping(spark):
    fii = spark.createDataFrame([("1", json.dumps({"buy": 1.5}))], "ingested_at string, data string")
    status = spark.createDataFrame([("2", json.dumps({"open": True})), ("3", "CLOSED"), ("4", "[1, 2]")],
                                   "ingested_at string, data string")
    rows = {r["ingested_at"]: r for r in landing.land_macro(fii, status, trade_date="2024-01-02").collect()}
    assert rows[1]["record_type"] == "FII_DII" and json.loads(rows[1]["data"]) == {"buy": 1.5}
    assert json.loads(rows[2]["data"]) == {"open": True}
    assert json.loads(rows[3]["data"]) == {"raw": "CLOSED"}
    assert json.loads(rows[4]["data"]) == {"raw": "[1, 2]"}


def test_columnar_to_rows_renames(spark):
    df = spark.createDataFrame([(["A", "B"], [10, 20])], "` Symbol ` array<string>, `Deliv Qty` array<bigint>")
    out = landing.columnar_to_rows(df, [" Symbol ", "Deliv Qty"], trade_date="2024-01-02")
    assert out.columns[-2:] == ["symbol", "deliv_qty"]
    got = sorted((r["symbol"], r["deliv_qty"], r["source"]) for r in out.collect())
    assert got == [("A", 10, "deliverable"), ("B", 20, "deliverable")]


def test_enforce_schema_rejects_missing_required(spark):
    items = spark.createDataFrame([("1", "2024-01-02", None, "EQ", "10"), ("2", "2024-01-02", "S", None, "x")],
                                  "ingested_at string, trade_date string, TckrSymb string, SctySrs string, "
                                  "ClsPric string")
    accepted, rejected = landing.enforce_schema(landing.land_equity(items), "equity_raw")
    assert accepted.count() == 0 and rejected.count() == 2
    ok = spark.createDataFrame([("3", "2024-01-02", "S", "EQ", "10")],
                               "ingested_at string, trade_date string, TckrSymb string, SctySrs string, "
                               "ClsPric string")
    acc, _ = landing.enforce_schema(landing.land_equity(ok), "equity_raw")
    r = acc.first()
    assert r["close"] == 10.0 and r["source"] == "bhavcopy"


def test_trading_weekdays(spark):
    days = [r[0] for r in trading_weekdays(spark, "2024-01-01", "2024-01-08").collect()]
    assert days == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "2024-01-08"]


def test_ingest_totals_lists_failed_domains(spark):
    bad = landing.land_equity(spark.createDataFrame([("1", "2024-01-02", None, "EQ")],
                                                    "ingested_at string, trade_date string, TckrSymb string, "
                                                    "SctySrs string"))
    good = landing.land_corporate(spark.createDataFrame([("1", "ABC", "BONUS 1:1")],
                                                        "ingested_at string, symbol string, subject string"))
    summary = landing.ingest_summary([("equity", bad), ("corporate", good)])
    status = {r["domain"]: r["status"] for r in summary.collect()}
    assert status == {"equity": "error", "corporate": "ok"}
    totals = landing.ingest_totals(summary).first()
    assert (totals["total_records"], totals["total_errors"], totals["failed_domains"]) == (1, 1, "equity")

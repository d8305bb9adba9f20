"""Submit-able jobs: ``spark-submit -m marketlake.jobs <job> ...`` or
``python -m marketlake.jobs <job> ...``.

* ``land``    -- as-delivered JSON files of one domain -> typed records, numbered
  in arrival order, in a Parquet table
* ``rebuild`` -- rebuild the years of silver that new corporate actions change
* ``silver``  -- clean equity records and back-adjust them (writes silver)
* ``gold``    -- market breadth + put-call ratio from silver and FO bronze
* ``daily``   -- silver then gold (gold reads the written silver table)
* ``compact`` -- compact and z-order tables, one at a time, failures isolated
* ``stream``  -- run the equity or FO stream cleaner into a bronze table
* ``serve``   -- answer one serving query from written tables; prints
  ``{"data": [...], "count": n}`` as the serving API returns it

Tables are Parquet paths. Session settings come from the cluster
(``spark-submit --conf``); see ``session.cluster_conf`` for starting values.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import breadth, clean, maintain
from marketlake.plans import lake
from marketlake.session import exists
from marketlake.sources import landing
from marketlake.streaming import clean_stream, first_arrival


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marketlake.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    ld = sub.add_parser("land", help="as-delivered JSON lines -> typed records")
    ld.add_argument("domain", choices=["equity", "fo", "index", "corporate", "surveillance", "macro"])
    ld.add_argument("--source", required=True, help="JSON lines; index payloads hold a data array")
    ld.add_argument("--out", required=True)
    ld.add_argument("--trade-date", default=None)
    ld.add_argument("--list-type", default=None, help="surveillance list of the files")
    ld.add_argument("--as-of-date", default=None)

    rb = sub.add_parser("rebuild", help="new corporate actions -> rebuilt years of silver")
    rb.add_argument("--equity", required=True)
    rb.add_argument("--corporate", required=True, help="all actions, the new ones included")
    rb.add_argument("--new", required=True, help="the new actions")
    rb.add_argument("--silver", required=True)
    rb.add_argument("--order", default=",".join(clean.ARRIVAL_ORDER))

    s = sub.add_parser("silver", help="equity records + corporate actions -> silver")
    s.add_argument("--equity", required=True)
    s.add_argument("--corporate", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--start-date", default=None)
    s.add_argument("--order", default=",".join(clean.ARRIVAL_ORDER), help="columns of the arrival order")

    g = sub.add_parser("gold", help="silver + FO bronze -> gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--fo", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--fo-raw", action="store_true", help="FO input is raw records (clean it first)")
    g.add_argument("--order", default=",".join(clean.ARRIVAL_ORDER), help="arrival order of raw FO records")

    d = sub.add_parser("daily", help="silver then gold under one root")
    d.add_argument("--equity", required=True)
    d.add_argument("--corporate", required=True)
    d.add_argument("--fo", required=True)
    d.add_argument("--root", required=True)
    d.add_argument("--start-date", default=None)
    d.add_argument("--order", default=",".join(clean.ARRIVAL_ORDER), help="arrival order of equity records")
    d.add_argument("--fo-order", default=",".join(clean.ARRIVAL_ORDER), help="arrival order of FO records")

    c = sub.add_parser("compact", help="compact + z-order tables (src=dst pairs)")
    c.add_argument("tables", nargs="+", help="SRC=DST, or with --journal TABLE")
    c.add_argument("--journal", default=None, help="compact in place, partition by partition; a folder for the journals")
    c.add_argument("--zorder", default="symbol,trade_date")

    st = sub.add_parser("stream", help="stream cleaner into bronze")
    st.add_argument("domain", choices=["equity", "fo"])
    st.add_argument("--source", required=True, help="directory of JSON message files")
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--trigger", default="availableNow", help="availableNow or e.g. '60 seconds'")
    st.add_argument("--dead-letters", default=None, help="path for rejected records")
    st.add_argument("--quarantine", default=None, help="path for messages that do not decode, with their text and file")
    st.add_argument("--state", default=None, help="keep the first arrival of each key; remembered keys are stored here")
    st.add_argument("--order", default=",".join(clean.ARRIVAL_ORDER), help="arrival order, with --state")

    sv = sub.add_parser("serve", help="one serving query over written tables")
    sv.add_argument("query", choices=["ohlcv", "breadth", "fo", "surveillance"])
    sv.add_argument("--table", required=True, help="silver / gold / FO bronze / surveillance path")
    sv.add_argument("--symbol")
    sv.add_argument("--from-date")
    sv.add_argument("--to-date")
    sv.add_argument("--trade-date")
    sv.add_argument("--list-type")
    sv.add_argument("--as-of-date")
    sv.add_argument("--out", help="write the result as JSON instead of returning it")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"marketlake-{args.job}").getOrCreate()
    read = spark.read.parquet
    if args.job == "land":
        # delivered values keep their JSON types; the landing functions read either
        items = landing.read_delivered(spark, args.source)
        if args.domain == "index" and "data" in items.columns:
            items = landing.index_items(items)
        done = exists(spark, args.out)
        items = landing.with_arrival(items, landing.delivered_files(spark, args.source),
                                     landing.next_rank(read(args.out)) if done else 0)
        if args.domain in ("equity", "fo", "index"):
            landed = getattr(landing, f"land_{args.domain}")(items, args.trade_date)
        elif args.domain == "corporate":
            landed = landing.land_corporate(items)
        elif args.domain == "macro":
            # payloads as JSON text, whatever they hold; without a record type it is a status
            data = F.to_json("data") if isinstance(items.schema["data"].dataType, T.StructType) else F.col("data").cast("string")
            items = items.withColumn("data", data)
            kind = F.col("record_type") if "record_type" in items.columns else F.lit("MARKET_STATUS")
            items = items.withColumn("record_type", F.coalesce(kind, F.lit("MARKET_STATUS")))
            landed = landing.land_macro(items.where("record_type = 'FII_DII'"), items.where("record_type <> 'FII_DII'"),
                                        args.trade_date)
        else:
            for name, value in (("list_type", args.list_type), ("as_of_date", args.as_of_date)):
                if value is not None:
                    items = items.withColumn(name, F.lit(value))
            landed = landing.land_surveillance([items])
        landed.write.mode("append").parquet(args.out)
        return {args.domain: args.out}
    if args.job == "rebuild":
        return {"years": lake.rebuild_silver(read(args.equity), read(args.corporate), read(args.new), args.silver,
                                             args.order.split(","))}
    if args.job == "silver":
        df = lake.silver(read(args.equity), read(args.corporate), args.order.split(","), start_date=args.start_date)
        lake.write_silver(df, args.out)
        return {"silver": args.out}
    if args.job == "gold":
        fo = read(args.fo)
        fo = lake.fo_bronze_for_pcr(fo, args.order.split(",")) if args.fo_raw else fo
        silver = read(args.silver).drop("trade_year")
        # any silver table may be given, so symbols are counted, not assumed unique
        lake.write_gold(breadth.market_breadth(silver, fo), args.out)
        return {"gold": args.out}
    if args.job == "daily":
        return lake.run_lake(read(args.equity), read(args.corporate), read(args.fo), args.root,
                             order=args.order.split(","), fo_order=args.fo_order.split(","),
                             start_date=args.start_date)
    if args.job == "compact":
        cols = [c for c in args.zorder.split(",") if c]
        jobs = []
        for pair in args.tables if not args.journal else ():
            src, dst = pair.split("=", 1)
            jobs.append((src, lambda s=src, t=dst: maintain.rewrite(spark, s, t, zorder_by=cols)))
        for table in args.tables if args.journal else ():
            own = f"{args.journal}/{table.rstrip('/').rsplit('/', 1)[-1]}"
            jobs.append((table, lambda t=table, j=own: maintain.compact_in_place(
                spark, t, f"{j}/journal", f"{j}/files", zorder_by=cols)))
        return maintain.compact_tables(jobs)
    if args.job == "serve":
        from marketlake.plans.serve import Lake

        table = {"ohlcv": "silver", "breadth": "gold", "fo": "fo", "surveillance": "surveillance"}
        lk = Lake.from_tables(spark, **{table[args.query]: args.table})
        df = {
            "ohlcv": lambda: lk.get_ohlcv(args.symbol, args.from_date, args.to_date),
            "breadth": lambda: lk.get_market_breadth(args.from_date, args.to_date),
            "fo": lambda: lk.get_fo_bhavcopy(args.symbol, args.trade_date),
            "surveillance": lambda: lk.get_surveillance(args.list_type, args.as_of_date),
        }[args.query]()
        if args.out:
            df.write.mode("overwrite").json(args.out)
            return {"out": args.out, "count": spark.read.text(args.out).count()}
        # what the filters select goes back to the caller; a whole table only to a path
        if args.query == "surveillance" and not (args.list_type or args.as_of_date):
            raise SystemExit("surveillance without a filter returns the whole table: give --out")
        rows = [r.asDict() for r in df.toLocalIterator()]
        return {"data": rows, "count": len(rows)}
    # stream
    schema = clean_stream.RAW_SCHEMAS[args.domain]
    if args.state:
        schema = T.StructType([*schema.fields, T.StructField("arrival_seq", T.DecimalType(38, 0))])
    source = clean_stream.read_stream(spark, args.source, schema)
    cleaned = (clean_stream.equity_clean_stream(source) if args.domain == "equity"
               else clean_stream.fo_clean_stream(source))
    parts = ("trade_date", "series") if args.domain == "equity" else ("trade_date",)
    available = args.trigger == "availableNow"
    how = {"available_now": available, "processing_time": None if available else args.trigger}
    if args.state:
        begin = first_arrival.start_equity if args.domain == "equity" else first_arrival.start_fo
        query = begin(source, args.checkpoint, args.out, args.state, order=args.order.split(","), partition_by=parts, **how)
    else:
        query = clean_stream.write_bronze(cleaned, args.out, args.checkpoint, partition_by=parts, **how)
    queries = [query]
    if args.quarantine:
        bad = clean_stream.malformed_messages(clean_stream.read_messages(spark, args.source),
                                              clean_stream.RAW_SCHEMAS[args.domain])
        queries.append(clean_stream.write_bronze(bad, args.quarantine, f"{args.checkpoint}-quarantine", partition_by=(), **how))
    if args.dead_letters:
        dlq = clean_stream.rejects_stream(clean_stream.read_stream(spark, args.source, schema), args.domain)
        queries.append(clean_stream.write_bronze(
            dlq, args.dead_letters, f"{args.checkpoint}-dead-letters", partition_by=(), **how))
    for q in queries:
        if available:
            clean_stream.run_available_now(q)
        else:
            q.awaitTermination()
    return {"bronze": args.out, "dead_letters": args.dead_letters}


def main() -> None:
    print(json.dumps(run(sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()

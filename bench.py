"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 2). Each query is executed in full with
the ``noop`` sink (every row computed, nothing collected to the driver)
after one warm-up run of the flagship at the smallest scale factor; a
headline query's time is the best of BENCH_REPEAT runs, an extra query's
time is a single run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans import catalog  # noqa: E402
from marketlake.session import build_session  # noqa: E402

HEADLINE = ("market_breadth", "ohlcv_adjusted", "equity_clean", "put_call_ratio")
EXTRA = ("fo_clean", "cumulative_factor", "land_equity", "land_fo", "zorder_rewrite")


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="marketlake-bench",
                          shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g"})
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        run(spark, "market_breadth", warm)
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3) for name in HEADLINE}
    times.update({name: round(run(spark, name, sf_dir), 3) for name in EXTRA})
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

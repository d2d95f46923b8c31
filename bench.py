"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed ``BENCH_REPS`` times (median
reported).  Results are fully computed with the ``noop`` sink, so nothing is
collected to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticklake.plans.catalog import REGISTRY  # noqa: E402
from ticklake.session import build_session  # noqa: E402

HEADLINE = [
    "daily_bars", "enriched_prices", "market_pulse", "rsi_simple", "sector_momentum", "portfolio_risk",
    "stock_summary", "fact_prices", "integrity_report", "news_sentiment_7d", "enrich_news",
    "chunk_text", "cosine_topk", "bronze_valid", "market_hours", "quote_metrics", "live_overlay", "append_live_bar",
    "merge_prices", "price_contract", "rag_context", "stream_bronze",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app="ticklake-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        fn = REGISTRY[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()

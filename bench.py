"""Wall time of the headline queries. Prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times over the whole
tables; the median counts. Results go to Spark's no-op sink, so all rows and
columns are computed. The streams named in ``BENCH_STREAMS`` (``all``: every one, which
takes over four minutes at scale factor 0.1) then run once; their seconds include
writing their topics, where no stream before did, and don't count in the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from orderloom.plans import registry
from orderloom.streaming.replay import ended_queries, summary

HEADLINE = [
    "order_events",
    "order_events_history",
    "order_events_current",
    "trends_5m",
    "trends_daily",
    "trends_enriched",
    "inventory_events",
    "stock_current",
    "stock_quantity",
    "turnover",
    "turnover_from_partials",
    "stockout_risk_current",
    "stockout_risk_hourly",
    "lead_time_all_lines",
    "lead_time_enriched",
    "customer_360_current",
    "customer_history",
    "profile_full",
    "profile_masked",
    "contract_violations",
    "order_assembly",
    "json_lenient_stock",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    streams = {}
    named = os.environ.get("BENCH_STREAMS", "" if only else "stock_quantity_stream")
    if named == "all":
        named = ",".join(n for n in queries if n.endswith("_stream"))
    for name in filter(None, named.split(",")):
        start = time.perf_counter()
        with ended_queries() as ended:
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        streams[name] = {"sec": round(time.perf_counter() - start, 3), **summary(ended)}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median wall times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "streams": streams,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

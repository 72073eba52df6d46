"""Seconds per headline query, written to a no-op sink; prints one JSON line.

Queries run in order on one warehouse, so each table they share is built once, inside the first query that
needs it: the sum is the cost of the whole daily build and its reports, nothing left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bars", "stock_metrics", "signals_default", "alerts_flat", "alerts_hybrid", "alerts_per_stock",
    "sector_performance", "split_adjust", "staged_prices", "alert_outcomes", "surveillance_validation",
    "baseline_ablation", "event_study_5d", "event_pnl", "fact_fund_nav", "fund_performance", "portfolio_txn_asof",
    "portfolio_holdings", "portfolio_xirr", "sip_tracker", "stock_check", "resolve_names", "digest_lines",
    "triage_context", "price_rows_clean", "nav_text_parse", "upsert_idempotent",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.catalog.queries import QUERIES
    from tidemark.catalog.warehouse import Warehouse
    from tidemark.session import get_spark
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
                      spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    names = sys.argv[1:] or HEADLINE
    Warehouse.forget(spark)
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

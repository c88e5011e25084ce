"""Time the headline queries: one warm-up, then the median of three runs into the noop sink.

Prints one JSON line. Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names, default all table and stream queries).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import queries  # noqa: E402
from shopgrain.session import build_session  # noqa: E402

HEADLINE = [
    "daily_sales", "daily_sales_order_grain", "customer_rfm", "segment_distribution",
    "product_performance", "seller_analytics", "inventory_analytics", "geo_analytics",
    "order_lifecycle", "cross_selling_brand", "cross_selling_part", "orders_silver",
    "order_items_windows", "payments_validated", "payment_stats", "products_enriched",
    "customers_latest", "customers_scd2", "upsert_every", "upsert_conditional", "upsert_latest",
    "upsert_status", "scd2_close", "incremental_touched_keys", "payments_cleaned",
    "products_quarantine", "items_enriched", "audit_report",
]
STREAMS = ["stream_ingest_orders", "stream_ingest_items", "stream_dedup_customers"]
REPEATS = 3  # of the headline queries; the others run once after their warm-up


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = os.environ.get("BENCH_QUERIES")
    registered = queries()
    rest = [n for n in registered if n not in HEADLINE + STREAMS]
    names = chosen.split(",") if chosen else HEADLINE + STREAMS + rest
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g", spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        repeats = REPEATS if name in HEADLINE else 1
        timed(spark, registered[name], sf_dir)
        seconds[name] = round(
            statistics.median(timed(spark, registered[name], sf_dir) for _ in range(repeats)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

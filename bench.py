"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1) and BENCH_CPUS
the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "combined_fact", "order_totals", "clean_color_group", "price_bands", "cust_order_features",
    "cust_item_features", "prod_sales_features", "prod_rating", "writeback_segments", "rfm_base",
    "top5_categories", "top20_brand_per_category", "category_top50", "stock_effect",
    "cohort_retention", "daily_by_segment", "channel_region", "top20_orders", "summary_metrics",
    "monthly_amount", "union_models", "fc_ets", "fc_accuracy", "fc_future", "ts_local_trend",
    "silhouette_detail", "histogram", "box_stats", "qq_normal", "freq_poisson_nb",
    "kmeans_customers", "wss_by_k", "silhouette_by_k", "fc_gbt_small",
)


def main() -> None:
    from tillroll.plans import load
    from tillroll.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    queries["time_order"](spark, sf_dir).collect()  # starts the JVM's code paths

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()

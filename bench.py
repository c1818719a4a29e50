"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "g3_monthly_kpi", "g2_overall_kpi", "g4_channel_kpi", "g5_product_kpi", "g7_sales_by_month", "g10_return_refund_kpi",
    "g12_dashboard_metrics", "f5_sales_detail", "i1_top_products", "i5_top_promotions", "f3_promo_lookup", "h4_discount_allocation",
    "k1_payload_delta", "k4_record_delta", "b12_fact_merge", "k6_reconciled_facts", "e16_dispositions", "e38_column_profile",
    "e26_return_caps", "f18_quality_report",
)


def main() -> None:
    from salesloom.plans.catalogue import QUERIES
    from salesloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), os.environ.get("BENCH_MEMORY", "16g"))
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # session start is not a query
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

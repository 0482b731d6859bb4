"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from saltmarsh.plans import catalog
from saltmarsh.session import session

HEADLINE = [
    "rfm_monthly", "monthly_bv", "tenure", "sponsor_info", "revenue_restated", "click_daily_identity", "search_terms", "order_base", "order_base_strict",
    "order_stage", "award_class", "early_active_accounts", "demand_metrics", "minmax_scaled", "metrics_joined", "metrics_opt", "volume_reconciliation",
    "merge_newer", "merge_upsert", "coerced_append", "partial_refresh", "write_day_partition", "csv_roundtrip", "ingest_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    run = catalog.queries()
    run["rfm_monthly"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

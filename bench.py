"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up execution, then the median of
$BENCH_REPEATS (default 3) timed executions. Each execution runs the whole
plan through the no-op sink (nothing is collected to the driver). Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zonekit.plans import catalog  # noqa: E402
from zonekit.session import build_session  # noqa: E402

HEADLINE = ["kpi_table", "kpi_imputed", "kpi_imputed_constant", "dedup_listings",
            "latest_order_per_customer", "merge_lookup_neighborhood",
            "merge_lookup_district", "conform_listings", "explode_listings",
            "rename_nested_density", "array_mean_embeddings", "reconcile_listings",
            "reconcile_basic", "canon_documents", "filter_project_orders", "feature_table",
            "string_index_flags", "regression_metrics", "upsert_orders", "hash_split_counts",
            "kpi_stream", "zones_kpis"]
# Jobs that fit models or write several tables are timed once (after no warm-up of their own: the session is warm).
SINGLE_RUN = ["gbt_metrics", "fuzzy_names", "window_kpis", "keyed_orders", "rejected_values", "boosting_rounds", "predict_odd_listings"]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", app_name="zonekit-bench", shuffle_partitions=cpus * 2,
                          extra_conf={"spark.ui.showConsoleProgress": "false",
                                      "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = qs[name]
        run_once(spark, fn, sf_dir)
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 3)
    for name in SINGLE_RUN:
        times[name] = round(run_once(spark, qs[name], sf_dir), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()

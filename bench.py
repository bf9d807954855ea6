"""Headline queries, timed one by one; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import sys
import time

from riskspark.registry import QUERIES
from riskspark.registry.core import Inputs
from riskspark.session import get_session

HEADLINE = [
    "J1_asof_join",
    "J2_asof_tie_rule",
    "J3_customer_join",
    "J6_lookup_features",
    "P1_features_online",
    "P2_features_offline",
    "P11_skew_report",
    "A9_fit_feature_stats",
    "A11_exact_quantiles_disc",
    "S1_stratified_split",
    "S2_scenario_weights",
    "S4_smotenc",
    "V1_roc_auc",
    "V2_threshold_sweep_train",
    "V10_evaluate",
    "M1_isolation_forest",
    "M2_local_outlier_factor",
    "M3_knn_join",
    "E6_convert_raw",
    "E10_write_feature_view",
    "T1_train_balanced",
    "T5_score_batch",
    "R1_score_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = get_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    # The stored input tables (as a warehouse would hold them) are prepared before the clock starts.
    inputs = Inputs.of(spark, sf_dir)
    start = time.perf_counter()
    inputs.merged, inputs.train, inputs.offline_stats, inputs.online_stats
    inputs.train_features, inputs.test_features, inputs.paired_table, inputs.model_frames
    prepared = time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare": round(prepared, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

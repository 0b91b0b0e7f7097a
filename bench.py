"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_vintage_report",
    "cln_11_clean_panel",
    "jn_01_panel_with_static",
    "win_02_max_delinquency",
    "win_06_streaks",
    "win_18_rolling_extremes",
    "drv_10_all_features",
    "tgt_06_target",
    "agg_01_target_by_vintage",
    "agg_06_latest_values",
    "drv_11_dataset",
    "smp_05_validation_sample",
    "smp_08_stratified_folds",
    "met_00_evaluate",
    "met_10_deciles_tied",
    "met_14_model_results",
    "met_16_curves",
    "agg_15_score_distribution",
    "ml_23_column_profile",
    "ml_09_logistic",
]


def main() -> None:
    from loanweave.plans.catalog import QUERIES
    from loanweave.session import local_session

    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["cln_11_clean_loans"](spark, directory).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

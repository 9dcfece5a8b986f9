"""Time the headline queries; prints one JSON line.

Each query is built and its whole result is consumed by a ``noop`` write, so no rows pass the driver.
The first run warms the engine up; the reported time is the better of the two runs after it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "mart_01_merchant_daily_kpis", "mart_02_user_cohorts", "mart_03_settlement_reconciliation", "mart_05_risk_dashboard",
    "join_01_transaction_enriched", "join_03_user_credit_history", "join_10_as_of", "join_11_as_of_or_latest",
    "agg_04_quantiles_exact", "agg_05_partial_state_merge", "win_10_running_sum", "cdc_18_delete_audit",
    "cdc_21_apply_cdc", "scd_01_check_snapshot", "scd_04_from_log", "feat_11_compute_features",
    "feat_12_feature_history", "drift_02_scores", "drift_03_psi", "dq_14_declared_checks", "gt_08_exclusive_ranges",
    "ex_57_match_regex", "ex_66_within_n_moving_stdevs", "rpt_04_web_attribution", "rpt_06_calendar_kpis",
    "snk_02_upsert_latest", "str_09_sessionize",
]


def main() -> None:
    from tallyframe.catalog import QUERIES
    from tallyframe.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false", "spark.sql.files.maxPartitionBytes": "16m",
        },
    )
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    for name in names:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt:
                best = took if best is None else min(best, took)
        times[name] = round(best if best is not None else took, 3)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps({
            "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
            "queries": times, "sf": float(scale),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()

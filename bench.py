"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Results go to Spark's no-op sink, so every row is computed and none is fetched. Each query runs twice on the
same tables: ``cold_queries`` holds the first run (with code generation and JIT compilation), ``queries`` and
``value`` the second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lossgrid import get_session  # noqa: E402
from lossgrid.plans.catalog import all_queries  # noqa: E402

HEADLINE = (
    "ecl_by_stage",
    "ecl_by_segment_and_stage",
    "ecl_loan",
    "quality_report",
    "missing_profile",
    "dedup_loans",
    "cap_outliers",
    "prepare_loans",
    "impute_median",
    "impute_mode",
    "one_hot",
    "select_mutual_info",
    "correlation_matrix",
    "stratified_split",
    "performance_report",
    "roc_curve",
    "compare_models",
    "calibration_summary",
    "default_rate_by_bin",
    "psi_quantile",
    "ks_two_sample",
    "feature_drift",
    "drift_verdict",
    "alerts",
    "expected_loss",
    "raroc",
    "vasicek_capital_retail",
    "economic_capital_vasicek",
    "stress_pd",
    "scenario_loss_distribution",
    "loss_var_es",
    "lorenz_curve",
    "concentration_indices",
    "lgd_distribution",
    "return_var_es",
    "train_logistic",
    "fit_pipeline",
    "score_pd",
    "calibrate_isotonic",
    "calibrate_platt",
    "pd_calibration",
    "write_results",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = all_queries()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    cold: dict[str, float] = {}
    seconds: dict[str, float] = {}
    for name in wanted:
        for times in (cold, seconds):
            started = time.perf_counter()
            found[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_headline_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold_queries": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

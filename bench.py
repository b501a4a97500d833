"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.operators import models  # noqa: E402
from riskframe.plans import QUERIES  # noqa: E402
from riskframe.plans.learning import month_model  # noqa: E402
from riskframe.session import local_session  # noqa: E402

HEADLINE = [
    "io06_parquet_sink",
    "ct07_contract",
    "ct09_fingerprint",
    "ct10_strict_records",
    "pr05_derived_features",
    "ag02_duplicate_rows",
    "ag07_describe",
    "ag09_outlier_counts",
    "ag10_top_pearson",
    "ag11_top_spearman",
    "ag15_rate_by_group",
    "ag18_histograms",
    "ag25_macro_metrics",
    "ag27_roc_auc",
    "ag28_roc_curve",
    "ml01_stratified_split",
    "ml02_verify_splits",
    "ml04_stratified_folds",
    "ml08_preprocessor",
    "ml11_fisher_projection",
    "ml13_logistic_group_rates",
    "ml14_tree_group_rates",
    "ml16_gradient_boosting",
    "ml31_batch_scoring",
    "dr01_ks_drift",
    "dr02_chi2_drift",
    "dr03_data_drift",
    "io09_consolidated_runs",
    "se01_cascade_winner",
    "ss02_weekly_histograms",
]


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(df) -> None:
    # The noop sink runs the whole plan without moving rows to the driver.
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    # Untimed: starts the session and compiles common code.
    run(QUERIES["ag15_rate_by_group"](spark, sf_dir))
    for name in only or HEADLINE:
        times[name] = timed(lambda name=name: run(QUERIES[name](spark, sf_dir)))
    if not only:
        # Fitting and scoring apart, as published figures have them.
        fitted = []
        times["month_model_fit"] = timed(lambda: fitted.extend(month_model(spark, sf_dir)))
        times["month_model_score"] = timed(lambda: run(models.score_batch(*fitted, ["row_id"])))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

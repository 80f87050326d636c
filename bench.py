"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sumac.plans.catalogue import QUERIES  # noqa: E402
from sumac.session import local_session  # noqa: E402

HEADLINE = [
    "lrmfp",
    "lag_days_per_key",
    "describe_numeric",
    "iqr_mask",
    "winsorize",
    "impute_median",
    "impute_mode",
    "impute_knn",
    "scale_minmax",
    "scale_robust",
    "one_hot",
    "stratified_split",
    "chronological_split",
    "corr_matrix",
    "histogram",
    "boxplot_stats",
    "duplicate_count",
    "binary_metrics",
    "classification_report",
    "threshold_sweep",
    "calibration_curve",
    "permutation_importance",
    "partial_dependence",
    "shapley_local",
    "sorted_rank",
    "running_best",
    "knn_join",
    "kdist_elbow",
    "dbscan",
    "silhouette",
    "gbt_classifier",
    "rf_lr_dt_trainers",
    "stream_score",
    "backfill_monthly",
    "sink_ds_partitioned",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", spark__sql__shuffle__partitions=cpus)
    # Start the workers and the code generator before the clock runs.
    QUERIES["value_counts"](spark, folder).collect()
    spent = {}
    for name in wanted:
        start = time.perf_counter()
        # The noop sink runs the whole plan without moving rows to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {spent[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

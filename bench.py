"""Wall seconds of the headline queries.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) is read with ``local[$BENCH_CPUS]``
(default 8). Every query runs once on the smallest folder beside it to warm the
session and is then timed once, results counted by a no-op sink. ``BENCH_QUERIES``
may name a comma-separated subset, or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statweave.queries.catalog import QUERIES
from statweave.session import build_session

HEADLINE = [
    # the five jobs that time themselves: load, train, evaluate
    "tree_classifier",
    "kmeans",
    "naive_bayes_lifecycle",
    "forest_classifier",
    "linear_svm",
    # operators composed of DataFrame expressions
    "col_summary",
    "corr_matrix",
    "spearman",
    "corr_matrix_spearman",
    "chi2_independence",
    "chi2_by_feature",
    "ks_normal",
    "kde",
    "welch",
    "stratified_exact",
    "set_difference",
    "topk_per_user",
    "group_collect",
    "row_index",
    "precision_by_threshold",
    "area_under_roc",
    "confusion_matrix",
    "weighted_metrics",
    "multilabel_summary",
    "ranking_metrics",
    "regression_metrics",
    "kmeans_assign",
    "chi2_select",
    # estimators
    "pca",
    "svd",
    "logistic_binary",
    "linear_regression",
    "isotonic",
    "boosted_classifier",
    "als_recommend",
    "frequent_itemsets",
    "rules_from_itemsets",
    "prefixspan",
    "stream_welch",
]


def run(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), os.environ.get("BENCH_MEMORY", "12g"))
    warm = os.path.join(os.path.dirname(folder), "sf0.001")
    if not os.path.isdir(warm):
        warm = folder
    seconds = {}
    for name in names:
        run(spark, name, warm)
        seconds[name] = round(run(spark, name, folder), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default
8). Each query runs from scan to its last row; rows go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from labelbench.plans.analysis_queries import QUERIES as ANALYSIS_QUERIES
from labelbench.plans.queries import QUERIES
from labelbench.shared import release

HEADLINE = [
    "threshold_label",
    "parse_delimited",
    "csv_scan",
    "assembled_features",
    "label_index",
    "split_counts",
    "nb_predict",
    "nb_cross_validation",
    "gini_split_items",
    "gini_split_binned",
    "hard_roc_pr_items",
    "ranked_roc_items",
    "confusion_tolerance",
    "feature_correlation",
    "outlier_rows",
    "lr_holdout",
    "dt_holdout",
    "rf_holdout",
    "svm_holdout",
    "gbt_holdout",
    "nb_holdout",
    "rf_pipeline_override",
    "rf_staged_orders",
    "rf_vote_items",
    "fence_outliers",
    "rank_correlation_items",
    "class_split_orders",
    "rf_sweep",
    "rf_cross_validation",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("labelbench-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()  # start-up is not a query
    queries = {**QUERIES, **ANALYSIS_QUERIES}
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

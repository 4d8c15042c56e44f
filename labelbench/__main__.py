"""``python -m labelbench lines|table PATH`` (or spark-submit): run one workflow, show its results.

Master, memory and ``spark.checkpoint.dir`` come from the Spark configuration.
"""

import sys

from pyspark.sql import SparkSession

from labelbench.operators.classifiers import CLASSIFIERS
from labelbench.operators.tuning import DEPTHS, TREES
from labelbench.plans.workflows import classify_lines, classify_table
from labelbench.shared import scratch

WORKFLOWS = {"lines": classify_lines, "table": classify_table}


def main() -> None:
    if len(sys.argv) != 3 or sys.argv[1] not in WORKFLOWS:
        raise SystemExit(__doc__)
    spark = SparkSession.builder.appName("labelbench").getOrCreate()
    with scratch(spark):
        run = WORKFLOWS[sys.argv[1]](spark, sys.argv[2])
        for part in (run.preview, run.counts, run.reports):
            part.show(len(CLASSIFIERS) + len(TREES) * len(DEPTHS), truncate=False)  # the longest
    spark.stop()


if __name__ == "__main__":
    main()

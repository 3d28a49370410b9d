"""Physical-plan summary of every registered query (operator counts).

    python tests/plan_report.py [sf_dir]

For trainers the returned DataFrame reads the last checkpoint; their
per-iteration plans are exercised inside the call.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WATCH = ["FileScan", "Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Generate", "Window", "WindowGroupLimit",
         "TakeOrderedAndProject", "ArrowEvalPython", "MapInArrow", "BatchEvalPython", "Scan ExistingRDD"]


def summary(df) -> dict:
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    counts = {}
    for op in WATCH:
        n = len(re.findall(r"(?<![A-Za-z])" + re.escape(op) + r"(?![A-Za-z])", plan))
        if n:
            counts[op] = n
    return counts


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries
    from tallyho.session import build_session, checkpoint_dir
    spark = build_session("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark)
    for key, q in queries().items():
        df = q(spark, sf_dir)
        print(f"{key:24s} " + ", ".join(f"{k}={v}" for k, v in summary(df).items()))


if __name__ == "__main__":
    main(sys.argv)

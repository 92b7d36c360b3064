"""Print a registered query's formatted physical plan and a count of its key operators.

usage: python tools/explain.py <query> [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

WATCH = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "WindowGroupLimit", "HashAggregate",
         "SortAggregate", "Generate", "BatchEvalPython", "ArrowEvalPython"]


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from coursematch.config import build_session
    from coursematch.queries import QUERIES
    spark = build_session("local[8]", 8)
    df = QUERIES[name](spark, sf_dir)
    df.explain("formatted")
    plan = df._jdf.queryExecution().executedPlan().toString()
    print({k: len(re.findall(rf"\b{k}\b", plan)) for k in WATCH})
    spark.stop()


if __name__ == "__main__":
    main()

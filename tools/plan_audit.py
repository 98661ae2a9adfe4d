"""Summarise the physical plan of every registered batch query.

usage: python tools/plan_audit.py [--no-broadcast] [sf_dir] [name ...]
``--no-broadcast`` sets both broadcast thresholds to -1, which is what plans
look like once no side is small.
Per query: shuffles, scans (columns read), broadcasts, sort aggregates,
Python UDF stages, and red flags (cartesian / nested-loop joins, windows or
exchanges without partitioning keys).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if a != "--no-broadcast"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session(8)
    if "--no-broadcast" in sys.argv:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(key, "-1")
    for name in names:
        df = QUERIES[name](spark, sf)
        df.collect()  # the final adaptive plan shows reuse and runtime joins
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))
        single = len(re.findall(r"Exchange SinglePartition", plan))
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
        bcast = plan.count("BroadcastExchange")
        sortagg = plan.count("SortAggregate")
        py = len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan))
        flags = [f for f in ("CartesianProduct", "BroadcastNestedLoopJoin") if f in plan]
        reused = plan.count("ReusedExchange")
        if reused:
            flags.append(f"reused={reused}")
        if single:
            flags.append(f"SinglePartition x{single}")
        print(f"{name:28s} shuffles={shuffles} bcast={bcast} sortagg={sortagg} py={py} "
              f"scans={[s.count(',') + 1 for s in scans]} {' '.join(flags)}")


if __name__ == "__main__":
    main()

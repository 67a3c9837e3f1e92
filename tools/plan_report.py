"""Write PLANS.md: the shape of every registered query's final plan.

    python tools/plan_report.py [sf_dir]

For each query the plan is executed (so the adaptive plan is final) and the
physical operators are counted from ``executedPlan``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    final = plan.split("+- == Initial Plan ==")[0]
    return {
        "scans": len(re.findall(r"FileScan (parquet|json|csv)", final)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", final)),
        "partition_filters": len(re.findall(r"PartitionFilters: \[[^\]]", final)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                                   final)) - final.count("ReusedExchange"),
        "broadcasts": final.count("BroadcastExchange"),
        "reused": final.count("ReusedExchange"),
        "smj": final.count("SortMergeJoin"),
        "bhj": final.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "topk": final.count("TakeOrderedAndProject"),
        "python": len(re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", final)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from adlens.catalog import QUERIES
    from adlens.session import build_session
    spark = build_session()
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        rows.append((name, shape(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(rows[0][1])
    out = ["# Final plan shapes", "",
           f"Generated by `python tools/plan_report.py {sf_dir}`: operator counts in the final adaptive plan",
           "of each registered query (after execution). `shuffles` excludes reused exchanges; `python` counts",
           "Python evaluation nodes (all zero). For queries that first write documents or tables, the plan is",
           "the read-back query.", "",
           "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()

"""Summarise the physical plan of every registered query:
``python -m tributary.plans.plan_report /root/testdata/sf0.1 > PLANS.md``.

Counts exchanges by kind, join strategies, aggregate operators, Python nodes,
and whether filters reached the parquet scan.  Streaming queries are run to
completion when built, so the plan shown is that of the batch read of their
output; their streaming plans are covered by the stream tests.
"""

from __future__ import annotations

import re
import sys

from .catalog import all_queries

_PATTERNS = {
    "hash_exchange": r"Exchange hashpartitioning",
    "single_exchange": r"Exchange SinglePartition",
    "range_exchange": r"Exchange rangepartitioning",
    "broadcast": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "hash_agg": r"\bHashAggregate\(",
    "sort_agg": r"\bSortAggregate\(",
    "obj_agg": r"ObjectHashAggregate\(",
    "window": r"\bWindow \[",
    "python": r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow)",
    "topk": r"TakeOrderedAndProject",
}


def summarise(plan: str) -> dict[str, int | str]:
    out: dict[str, int | str] = {k: len(re.findall(p, plan)) for k, p in _PATTERNS.items()}
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    out["pushed"] = "yes" if any(p.strip() for p in pushed) else "-"
    return out


def main(sf_dir: str) -> None:
    from ..session import build_session
    spark = build_session("local[8]", app="tributary-plans", shuffle_partitions=16)
    cols = ["hash_exchange", "single_exchange", "broadcast", "bhj", "smj", "hash_agg",
            "sort_agg", "obj_agg", "window", "python", "topk", "pushed"]
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python -m tributary.plans.plan_report {sf_dir}` (initial AQE plans; "
          "AQE may still coalesce partitions or turn a sort-merge join into a broadcast at run time).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, q in sorted(all_queries().items()):
        try:
            plan = q.build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            s = summarise(plan)
            print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
        except Exception as e:  # noqa: BLE001 - report and continue
            print(f"| {name} | error: {type(e).__name__} |" + " |" * (len(cols) - 1))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")

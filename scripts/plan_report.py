"""Write PLANS.md: the final (post-AQE) physical plan shape of every query key.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Each key is executed once (so AQE settles), then its final plan is summarized.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.plans.queries import QUERIES  # noqa: E402
from tallyframe.session import get_spark  # noqa: E402


def _seq(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def nodes(plan) -> list:
    """Every node of the plan that ran: final plans of adaptive nodes, query stages and subqueries included."""
    out, todo, seen = [], [plan], set()
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ReusedExchangeExec":
            out.append((kind, node.simpleString(200)))
            continue
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            out.append((kind, node.simpleString(2000)))
            todo += _seq(node.children())
        for sub in _seq(node.subqueries()):
            if sub.id() not in seen:
                seen.add(sub.id())
                todo.append(sub)
    return out


def summarize(plan) -> dict:
    found = nodes(plan)

    def n(pattern):
        return sum(bool(re.match(pattern, kind)) for kind, _ in found)

    pushed = sorted({p for _, text in found for p in re.findall(r"PushedFilters: \[([^\]]+)\]", text)})
    return {
        "scans": n("FileSourceScanExec|BatchScanExec"),
        "shuffles": n("ShuffleExchangeExec"),
        "reused": n("ReusedExchangeExec"),
        "bhj": n("BroadcastHashJoinExec"),
        "smj": n("SortMergeJoinExec"),
        "shj": n("ShuffledHashJoinExec"),
        "nlj": n("BroadcastNestedLoopJoinExec|CartesianProductExec"),
        "hash_agg": n("HashAggregateExec"),
        "sort_agg": n("SortAggregateExec"),
        "obj_agg": n("ObjectHashAggregateExec"),
        "windows": n("WindowExec"),
        "wgl": n("WindowGroupLimitExec"),
        "python": n(".*(Python|Pandas|Arrow).*"),
        "pushed": "; ".join(p[:80] for p in pushed)[:160],
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    cols = ["scans", "shuffles", "reused", "bhj", "smj", "shj", "nlj", "hash_agg", "sort_agg", "obj_agg",
            "windows", "wgl", "python", "pushed"]
    print("# PLANS — final physical plan shape per query key\n")
    print(f"Generated by `scripts/plan_report.py` at `{sf}` on local mode after one execution "
          "(AQE final plans). bhj/smj/shj = broadcast-hash / sort-merge / shuffled-hash joins, "
          "nlj = nested-loop or cartesian (must be 0), wgl = WindowGroupLimit (partial top-k before "
          "the shuffle), python = Python evaluation operators (must be 0).  The whole tree is counted, subqueries and "
          "query stages included; jobs that a query runs before its last plan (checkpoints, landed files) are not.\n")
    print("| key | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for k, fn in QUERIES.items():
        if k in ("fit_lag_regressor", "compare_tree_models", "incremental_load", "incremental_corrections"):
            continue
        df = fn(spark, sf)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan())
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |")
    print("\n`fit_lag_regressor`, `compare_tree_models` (Spark ML fits), `incremental_load` and `incremental_corrections` (a stream "
          "with foreachBatch) run several jobs each and are not single plans.")
    spark.stop()


if __name__ == "__main__":
    main()

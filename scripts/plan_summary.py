"""Summarise the physical plan of every registered query (markdown table).

usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts come from the final adaptive plan after running the query once.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def nodes(plan, out=None):
    """Executed operators: unwraps adaptive/query stages, includes subqueries,
    stops at reused stages and at cached relations (their plan ran earlier)."""
    out = [] if out is None else out
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return nodes(plan.executedPlan(), out)
    if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage",
                "TableCacheQueryStage"):
        return nodes(plan.plan(), out)
    if name.startswith("Reused"):
        return out
    out.append((name, plan.simpleString(10)))
    it = plan.children().iterator()
    while it.hasNext():
        nodes(it.next(), out)
    subs = plan.subqueries().iterator()
    while subs.hasNext():
        nodes(subs.next(), out)
    return out


def summarise(plan) -> dict[str, int]:
    ns = nodes(plan)
    shuffles = [s for n, s in ns if n == "Exchange"]
    return {
        "hash/range shuffles": sum("SinglePartition" not in s for s in shuffles),
        "single-partition": sum("SinglePartition" in s for s in shuffles),
        "broadcasts": sum(n == "BroadcastExchange" for n, _ in ns),
        "BHJ": sum(n == "BroadcastHashJoin" for n, _ in ns),
        "SMJ": sum(n == "SortMergeJoin" for n, _ in ns),
        "NLJ/cartesian": sum(n in ("BroadcastNestedLoopJoin", "CartesianProduct") for n, _ in ns),
        "window-limit": sum(n == "WindowGroupLimit" for n, _ in ns),
        "python": sum(n in ("ArrowEvalPython", "BatchEvalPython") for n, _ in ns),
    }


def main():
    from mixtape.plans import registry
    from mixtape.session import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    sqls = registry.oracle_sql()
    print(f"# Physical plans of the library's queries ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Generated by `scripts/plan_summary.py`. Shuffles count hash/range/round-robin exchanges in the")
    print("final adaptive plan, walking the executed operator tree (reused stages and cached relations are")
    print("not counted again; scalar subqueries are). ALS top-k queries")
    print("include the blockwise factor cross of `recommendForUserSubset` (built in). Queries that return a")
    print("stored artefact (dictionary, model factors, stored vectors, streamed output) show the scan of it;")
    print("the work that built it ran before. Single-partition exchanges are global aggregates over")
    print("per-partition partial results (e.g. the largest-basket scalar subquery), never row data.")
    for title, threshold in (("As planned at this size", "10MB"),
                             ("Without automatic broadcasts, as for tables too large for them (hinted ones are "
                              "of bounded size)", "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        print(f"\n## {title}\n")
        for i, (name, fn) in enumerate(registry.queries().items()):
            qe = fn(spark, sf_dir)._jdf.queryExecution()
            qe.toRdd().count()
            row = summarise(qe.executedPlan())
            if not i:
                print("| query | check | " + " | ".join(row) + " |")
                print("| --- | --- | " + " | ".join("---" for _ in row) + " |")
            print(f"| {name} | {'SQL' if name in sqls else 'rows'} | " + " | ".join(map(str, row.values())) + " |")
    spark.stop()


if __name__ == "__main__":
    main()

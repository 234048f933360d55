"""Run one registered query and print its executed plan with SQL metrics
(rows and time per operator) - the local profiling aid.

usage: python scripts/plan_metrics.py sf_dir query_name
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def walk(plan, depth=0, out=None):
    out = [] if out is None else out
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return walk(plan.executedPlan(), depth, out)
    if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage",
                "ResultQueryStage"):
        return walk(plan.plan(), depth, out)
    metrics = plan.metrics()
    keys = metrics.keys().iterator()
    shown = []
    while keys.hasNext():
        k = keys.next()
        if any(s in k for s in ("numOutputRows", "time", "Time", "dataSize", "spill")):
            v = metrics.apply(k).value()
            if v:
                shown.append(f"{k}={v}")
    out.append("  " * depth + name + ("  [" + ", ".join(shown) + "]" if shown else ""))
    children = plan.children().iterator()
    while children.hasNext():
        walk(children.next(), depth + 1, out)
    return out


def main():
    from mixtape.plans import registry
    from mixtape.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    sf_dir, name = sys.argv[1], sys.argv[2]
    fn = registry.queries()[name]
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm
    t = time.time()
    df = fn(spark, sf_dir)
    built = time.time() - t
    qe = df._jdf.queryExecution()
    rows = qe.toRdd().count()  # runs this very plan, so its metrics fill in
    print(f"{name}: build {built:.2f}s total {time.time() - t:.2f}s rows {rows}")
    print("\n".join(walk(qe.executedPlan())))


if __name__ == "__main__":
    main()

"""Plan survey: the physical plan shape of every catalogue query as it would run on large
inputs (automatic broadcast off, so only size-proven broadcasts remain).

    python -m vialflow.plans.explain [data dir] [query ...]

Per query: jobs that ran while it was built (reads of Parquet schemas left out; work done by
eager steps such as checkpoints and model fits shows here and not in the plan), shuffle exchanges (hash / range / single-partition), join strategies, sort-based
aggregates (text or struct buffers) and whether a parquet scan reads every column.
"""

from __future__ import annotations

import re
import sys
import uuid


def _live_plan(text: str) -> str:
    """The plan without the subtrees of cached relations (they were computed once, when the
    cache was filled, and are not re-run by this query)."""
    out, skip_below = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_below is not None:
            if indent > skip_below:
                continue
            skip_below = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_below = indent
    return "\n".join(out)


def plan_shape(df) -> dict:
    full = df._jdf.queryExecution().executedPlan().toString()
    plan = _live_plan(full)
    return {
        "cached_input": int("InMemoryRelation" in full),
        "hash_exchanges": plan.count("Exchange hashpartitioning"),
        "range_exchanges": plan.count("Exchange rangepartitioning"),
        "single_exchanges": plan.count("Exchange SinglePartition"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_aggregates": plan.count("SortAggregate"),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
    }


def jobs_while_built(spark, build) -> tuple:
    """(result of ``build()``, jobs that it ran other than reads of Parquet schemas)."""
    sc = spark.sparkContext
    group = f"build-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "build")
    try:
        df = build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker, work = sc.statusTracker(), 0
    for j in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(j)
        names = [tracker.getStageInfo(s).name for s in info.stageIds if tracker.getStageInfo(s)] if info else []
        work += not (names and all(n.startswith("parquet at") for n in names))
    return df, work


def main(argv: list[str]) -> int:
    from ..session import get_session
    from .registry import all_queries
    root = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    q = all_queries()
    names = argv[2:] or [n for n in q if not n.startswith(("forest", "kmeans", "silhouette", "audit_contracts"))]
    cols = ["hash_exchanges", "range_exchanges", "single_exchanges", "sort_merge_joins", "broadcast_joins",
            "sort_aggregates", "python", "cached_input"]
    print("| query | jobs while built | " + " | ".join(c.replace("_", " ") for c in cols) + " |")
    print("|---" * (len(cols) + 2) + "|")
    for n in names:
        try:
            df, jobs = jobs_while_built(spark, lambda n=n: q[n](spark, root))
            s = plan_shape(df)
            print(f"| {n} | {jobs} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
        except Exception as e:  # report and continue
            print(f"| {n} | error: {repr(e)[:80]} |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

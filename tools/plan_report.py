"""Execution summary of every registered query -> PLANS.md.

Each query runs under its own job group; Spark's status tracker then gives
what was actually executed (jobs, stages, tasks — stages beyond one per job
are shuffle boundaries).  Join strategies and the filters pushed into the
Parquet scans are read from the final adaptive plan (initial-plan sections
are dropped).  Usage:  python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _indent(line: str) -> int:
    m = re.search(r"[A-Za-z=*]", line)
    return m.start() if m else 0


def final_sections(plan: str) -> str:
    """Drop the '== Initial Plan ==' sections of (nested) adaptive plans:
    a section covers the lines indented deeper than its marker."""
    out, marker = [], None
    for line in plan.splitlines():
        if marker is not None:
            if _indent(line) > marker:
                continue
            marker = None
        if "== Initial Plan ==" in line:
            marker = _indent(line)
            continue
        out.append(line)
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from perkline.queries import QUERIES, load_all
    from perkline.session import build_session

    load_all()
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    print("# Execution summary per query\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], shuffle partitions 8, AQE on). All queries run in one")
    print("session, in key order, as the driver runs them; nothing is kept between them.")
    print("`jobs`/`stages`/`tasks` are what Spark executed for the query (including the plan-time jobs of")
    print("materialised inputs, exports and scalar subqueries); `joins` are the strategies present in the final adaptive plan;")
    print("`pushed` are filters that reached a Parquet scan.\n")
    print("| query | jobs | stages | tasks | joins (final plan) | pushed scan filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    for key in sorted(QUERIES):
        group = f"plan-report-{key}"
        sc.setJobGroup(group, key)
        try:
            df = QUERIES[key](spark, sf_dir)
            df.collect()
            plan = final_sections(df._jdf.queryExecution().executedPlan().toString())
        except Exception as exc:  # noqa: BLE001
            print(f"| {key} | error: {type(exc).__name__} | | | | |")
            continue
        jobs = tracker.getJobIdsForGroup(group)
        stages, tasks = 0, 0
        for j in jobs:
            info = tracker.getJobInfo(j)
            if info is None:
                continue
            for sid in info.stageIds:
                st = tracker.getStageInfo(sid)
                if st is not None and st.numTasks > 0:
                    stages += 1
                    tasks += st.numTasks
        joins = []
        for name, label in (("BroadcastHashJoin", "BHJ"), ("SortMergeJoin", "SMJ"), ("BroadcastNestedLoopJoin", "BNLJ"),
                            ("ShuffledHashJoin", "SHJ"), ("CartesianProduct", "CARTESIAN")):
            if re.search(r"\b" + name + r"\b", plan):
                joins.append(label)
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
        pushed_txt = "; ".join(p[:80] for p in pushed)[:160]
        print(f"| {key} | {len(jobs)} | {stages} | {tasks} | {' '.join(joins)} | {pushed_txt} |")


if __name__ == "__main__":
    main(sys.argv)

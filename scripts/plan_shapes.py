"""Summarise the physical plan of every headline query (or the named ones).

    python scripts/plan_shapes.py [sf_dir] [name ...] > PLANS.md

For each query the plan is executed once (so adaptive execution has settled)
and the final plan is scanned for what matters at scale: shuffles, joins and
their strategy, top-k operators, windows, Python stages, columns read and
filters pushed into the scans.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE, materialise  # noqa: E402
from labelfold.plans.catalog import QUERIES  # noqa: E402
from labelfold.session import build_session  # noqa: E402

NODES = [
    ("shuffles", r"^[ +:|-]*Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
    ("reused exchanges", r"\bReusedExchange\b"),
    ("broadcast joins", r"\bBroadcastHashJoin\b"),
    ("sort-merge joins", r"\bSortMergeJoin\b"),
    ("nested-loop / cartesian", r"\b(BroadcastNestedLoopJoin|CartesianProduct)\b"),
    ("top-k", r"\bTakeOrderedAndProject\b"),
    ("window group limit", r"\bWindowGroupLimit\b"),
    ("windows", r"\bWindow \["),
    ("python stages", r"\b(MapInPandas|MapInArrow|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)\b"),
]


def final_plan(df) -> str:
    """The executed plan without the "Initial Plan" sections adaptive
    execution prints next to each final plan."""
    lines, skip_at = [], None
    for ln in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(ln) - len(ln.lstrip(" +-:|"))
        if skip_at is not None and depth >= skip_at:
            continue
        skip_at = None
        if "== Initial Plan ==" in ln:
            skip_at = depth
            continue
        lines.append(ln)
    return "\n".join(lines)


def summary(plan: str) -> dict:
    out = {name: len(re.findall(pat, plan, re.MULTILINE)) for name, pat in NODES}
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*)", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    out["scans"] = len(schemas)
    out["pushed filters"] = "; ".join(sorted(set(pushed))) or "-"
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if a in QUERIES] or HEADLINE
    spark = build_session("local[8]", app="labelfold-plans", shuffle_partitions=8)
    cols = [n for n, _ in NODES] + ["scans", "pushed filters"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in names:
        df = QUERIES[name](spark, sf)
        materialise(name, df)
        s = summary(final_plan(df))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

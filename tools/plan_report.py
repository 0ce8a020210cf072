"""Write PLANS.md: the physical plan shape of every registered query (shuffles, joins,
broadcasts, Python stages, scan columns and pushed filters) at a given scale factor.
Usage: python tools/plan_report.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from quarry.plans import REGISTRY  # noqa: E402
from quarry.session import local_session  # noqa: E402

NODES = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)"),
    ("broadcasts", r"BroadcastExchange"),
    ("bhj", r"BroadcastHashJoin"),
    ("smj", r"SortMergeJoin"),
    ("partial_aggs", r"(?:Hash|ObjectHash|Sort)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
    ("python", r"MapInArrow|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython"),
]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print(f"# Physical plans at {sf_dir.rsplit('/', 1)[-1]}\n")
    print("Generated by `tools/plan_report.py` from `df._jdf.queryExecution().executedPlan()` (the initial")
    print("adaptive plan; AQE may still coalesce partitions or switch a join at run time).\n")
    print("| query | shuffles | broadcasts | BHJ | SMJ | partial aggs | Python stages | scans (columns read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, reg in REGISTRY.items():
        try:
            df = reg.fn(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
        except Exception as exc:  # pragma: no cover
            print(f"| {name} | error: {type(exc).__name__} | | | | | | |")
            continue
        counts = [len(re.findall(p, plan)) for _, p in NODES]
        scans = []
        for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan):
            cols = [c.split("#")[0] for c in m.group(2).split(",") if c.strip()]
            loc = re.search(r"\[file:[^\]]*/([\w\-.]+?)(?:\.parquet)?[\],]", plan[m.start():])
            table = loc.group(1) if loc else m.group(1)
            pushed = m.group(3).replace("|", "/")
            scans.append(f"{table}: {len(cols)} cols" + (f"; {pushed[:60]}" if pushed else ""))
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + f" | {'<br>'.join(scans) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()

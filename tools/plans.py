"""Print the physical-plan shape of every pipeline table (lazy form, no materialisation).

Usage: python tools/plans.py [--materialized] [sf_dir] [table ...]
With --materialized each table is planned over the written copies of its
inputs (the production shape); otherwise over the whole lazy lineage.
For each table: shuffles (by partitioning), join strategies, aggregate
operators, windows, and what reaches each parquet scan (columns, pushed filters).
"""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
MATERIALIZED = "--materialized" in sys.argv
os.environ["PRODUCTLENS_MATERIALIZE"] = "1" if MATERIALIZED else "0"

from productlens.plans.catalog import marts_for  # noqa: E402
from productlens.plans.marts import TABLE_LAYERS  # noqa: E402
from productlens.session import build_session  # noqa: E402


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    ex = re.findall(r"Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|rangepartitioning)", plan)
    keys = [re.sub(r"#\d+L?", "", k or p.split("(")[0]) for p, k in ex]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r"[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)", plan)
    aggs = {a: plan.count(a + "(") for a in ("HashAggregate", "SortAggregate", "ObjectHashAggregate")}
    scans = re.findall(r"FileScan parquet [^\n]*?\[([^\]]*)\][^\n]*?Location: [^\n]*?\[file:([^\]]*)\]"
                       r"[^\n]*?PushedFilters: \[([^\]]*)\]", plan)
    lines = [f"  shuffles ({len(keys)}): " + "; ".join(keys),
             f"  joins: " + ", ".join(f"{j}/{t}" for j, t in joins),
             f"  aggregates: " + ", ".join(f"{k}={v}" for k, v in aggs.items() if v),
             f"  windows: {plan.count('Window [')}"]
    for cols, loc, pushed in scans:
        cols = re.sub(r"#\d+L?", "", cols)
        label = "written table" if "..." in loc or "productlens-marts" in loc else Path(loc).name
        lines.append(f"  scan {label}: [{cols}] pushed=[{re.sub(r'#[0-9]+L?', '', pushed)}]")
    return "\n".join(lines)


def main(argv):
    argv = [a for a in argv if a != "--materialized"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    names = argv[1:] or [n for n, _ in TABLE_LAYERS]
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what would run at scale
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # assume no dimension fits in memory
    m = marts_for(spark, sf_dir)
    for name in names:
        if MATERIALIZED:
            # plan the table's own job over its (written) inputs, as the pipeline runs it
            tables = {n for n, _ in TABLE_LAYERS} | {"monthly_revenue"}
            inputs = {k: v for k, v in m.__dict__.items() if k in tables and k != name}
            lazy = type(m)(m.base, rollout_days=m.rollout_days, derived=inputs)
            df = getattr(lazy, name)
            getattr(m, name)  # write it for the tables after it
        else:
            df = getattr(m, name)
        print(f"{name}\n{summary(df)}\n")


if __name__ == "__main__":
    main(sys.argv[1:])

"""Print the physical plans of headline queries over the written build.

usage: python -m checks.plans SF_DIR > docs/PLANS.md
Shows, per query: scans with pushed filters / partition filters, join
strategies, shuffles, and the formatted plan.
"""

from __future__ import annotations

import re
import sys

from truetally.plans.keys import Q, ctx
from truetally.session import local_session

KEYS = ["canonical_scorecard", "metrics_inventory", "metrics_po_lines", "bottom_suppliers_otd", "gap_waterfall",
        "apply_rules_inventory", "metric_under_role", "glossary_terms", "latest_per_key"]


def summary(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        s = m.group(0)
        loc = re.search(r"/(conformed|raw)/([a-z_]+)|testdata/[^/]+/([a-z_]+)\.parquet", s)
        name = next((g for g in (loc.groups() if loc else ()) if g and g not in ("conformed", "raw")), "?")
        pf = re.search(r"PartitionFilters: \[([^\]]*)\]", s)
        pu = re.search(r"PushedFilters: \[([^\]]*)\]", s)
        out.append(f"- scan `{name}`: partition filters [{pf.group(1) if pf else ''}], "
                   f"pushed [{pu.group(1) if pu else ''}]")
    ops = {k: len(re.findall(k, plan)) for k in ("Exchange hashpartitioning", "Exchange rangepartitioning",
                                                   "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin",
                                                   "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
                                                   "Window", "HashAggregate", "SortAggregate")}
    out.append("- operators: " + ", ".join(f"{k} x{v}" for k, v in ops.items() if v))
    return out


def main(argv):
    sf = argv[1]
    spark = local_session("8", 16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # show full filter lists
    x = ctx(spark, sf)
    print(f"# Physical plans of headline queries ({sf.rstrip('/').split('/')[-1]}, build written once)\n")
    print("Generated by `python -m checks.plans SF_DIR`. Plans are taken after execution (AQE final plans).\n")
    for k in KEYS:
        df = Q[k](x)
        df.write.format("noop").mode("overwrite").save()
        final = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {k}\n")
        print("\n".join(summary(final)))
        print("\n<details><summary>formatted plan</summary>\n\n```")
        print(df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n\n(1)")[0])
        print("```\n</details>\n")


if __name__ == "__main__":
    main(sys.argv)

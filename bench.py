"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Deployment shape: the RAW layer is materialised once (it stands for the
source tables), the conformed layer is built and written once (facts
partitioned by plant), and metric queries then read the written tables.
Each step is timed with a ``noop`` sink (full execution, nothing collected).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from truetally.operators.windows import trailing_window_sum, trailing_window_sum_join  # noqa: E402
from truetally.params import Params  # noqa: E402
from truetally.plans import conform  # noqa: E402
from truetally.plans.keys import AS_OF, Ctx, Q  # noqa: E402
from truetally.plans.semantic import SemanticModel  # noqa: E402
from truetally.session import checkpoint_dir, local_session  # noqa: E402
from truetally.sources import reference_data as ref  # noqa: E402
from truetally.sources.driver import raw_sources  # noqa: E402

HEADLINE = [
    "canonical_scorecard", "metrics_by_plant_po", "metrics_by_plant_orders", "doi_by_plant",
    "metric_supplier_otd_scope", "metrics_po_lines", "metrics_order_lines", "metrics_shipments",
    "metrics_inventory", "bottom_suppliers_otd", "legacy_fill_rate", "legacy_supplier_otd", "before_after",
    "gap_waterfall", "waterfall_check", "apply_rules_po_line", "apply_rules_inventory", "definition_change_effect",
    "row_scope_logistics", "metric_under_role", "visible_rows_by_plant", "dq_checks", "grade_behaviour",
    "grading_summary", "detect_metrics",
]


def run(df) -> float:
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="truetally-bench")
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"  # fresh folder in the shared dir
    times: dict[str, float] = {}

    t = time.time()
    raw = raw_sources(spark, sf_dir, AS_OF, stage_dir=f"{scratch}/stage").materialize(spark, f"{scratch}/raw")
    times["raw_adapter_materialize"] = round(time.time() - t, 3)

    t = time.time()
    conformed = conform.build_materialized(spark, raw, f"{scratch}/conformed", Params(), AS_OF)
    times["conformed_build"] = round(time.time() - t, 3)

    x = Ctx(spark, raw, conformed, SemanticModel(), ref.scope_df(spark))
    x.sf_dir = sf_dir
    for name in HEADLINE:
        times[name] = run(Q[name](x))
    # warm repeat of the flagship metric
    times["canonical_scorecard_warm"] = run(Q["canonical_scorecard"](x))

    # trailing-window operator: prefix-sum form vs simple range-join form
    inv = conformed.fct_inventory.select("snapshot_date", "plant_id", "part_id")
    shp = conformed.fct_shipment.select("plant_id", "part_id", "ship_date", "cogs_usd")
    args = (inv, shp, ["plant_id", "part_id"], "snapshot_date", "ship_date", "cogs_usd", 90, "c")
    times["trailing_window_prefix_sum"] = run(trailing_window_sum(*args))
    times["trailing_window_range_join"] = run(trailing_window_sum_join(*args))

    total = round(sum(v for k, v in times.items() if k not in ("trailing_window_range_join",)), 3)
    print(json.dumps({"metric": "total_sec_build_plus_headline_queries", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus}))


if __name__ == "__main__":
    main()

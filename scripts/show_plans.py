"""Print the physical plans of the main operators.

Usage: python scripts/show_plans.py [sf_dir] [--scale]

With ``--scale`` broadcasts are disabled, which is what the planner does once
the size estimates exceed the broadcast threshold (the 100 TB case); the
printout then shows the shuffle structure the cluster would run.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partwise.operators import checks as C  # noqa: E402
from partwise.plans import reports  # noqa: E402
from partwise.plans.layers import from_testdata  # noqa: E402
from partwise.session import build_session  # noqa: E402

KEEP = re.compile(r"(Join|Exchange|Aggregate|Scan|Sort |Window|Union|Expand|BroadcastExchange|Filter)")


def outline(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln.rstrip()[:150] for ln in plan.splitlines() if KEEP.search(ln)]
    return "\n".join(lines)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    scale = "--scale" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    extra = {}
    if scale:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", shuffle_partitions=16, extra=extra)
    layers = from_testdata(spark, sf_dir)
    limit = 0 if scale else None
    if scale:
        from partwise.plans.layers import build_layers

        layers = build_layers(layers.bronze, broadcast_limit=limit)
    shown = {
        "cmm_rollup": layers.cmm_quality,
        "part_quality_summary": layers.gold,
        "failing_dimensions": reports.failing_dimensions(layers.gold),
        "daily_defect_trend": reports.daily_defect_trend(layers.gold),
        "correlation_matrix": reports.correlation_matrix(layers.gold),
        "filter_options": reports.filter_options(layers.gold),
        "dq_suite": C.run_checks(layers.tables()),
        "dq_relationships": C.run_checks(layers.tables(), kinds=(C.RELATIONSHIPS,)),
        "dq_unique": C.run_checks(layers.tables(), kinds=(C.UNIQUE,)),
    }
    for name, df in shown.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"{name}: {plan.count('FileScan')} scans, {len(re.findall('Exchange (?:hash|range|Single)', plan))} exchanges, {plan.count('Join ')} joins")
    for name, df in shown.items():
        print(f"== {name} ({'scale: no broadcast' if scale else 'as planned'})")
        print(outline(df))
        print()
    spark.stop()


if __name__ == "__main__":
    main()

"""Wall seconds per headline query; prints one JSON line.

Every query is planned and run in full into a sink that discards the rows."""

from __future__ import annotations

import json
import os
import sys
import time

from assetops.catalog import QUERIES
from assetops.session import build_session
from assetops.storage import release

HEADLINE = [
    "executive_dashboard",
    "department_performance",
    "department_performance_corrected",
    "maintenance_analytics",
    "technician_analytics",
    "equipment_risk_assessment",
    "equipment_risk_assessment_corrected",
    "audit_compliance",
    "monthly_performance_report",
    "equipment_lifecycle_report",
    "predictive_maintenance_schedule",
    "equipment_health_score",
    "maintenance_cost_analysis",
    "technician_dashboard",
    "utilization_dashboard",
    "snapshot_daily_equipment_status",
    "snapshot_monthly_maintenance",
    "constraint_violations",
    "technician_cost_rank",
    "equipment_maintenance_ranking",
    "global_rank",
    "audit_changes",
    "split_changes_atomic",
    "decommission_guard",
    "completion_to_history",
    "automated_alerts",
    "append_with_keys",
    "mtbf",
    "kpis",
    "urgent_equipment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", 8, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["downtime_by_department"](spark, sf_dir).collect()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()

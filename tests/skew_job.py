"""Run reports over tables in which one key owns a third of all rows.

Started by test_skew in its own process, with an event log to read the number
of records every task took from a shuffle."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from datetime import datetime  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from assetops.clock import Clock  # noqa: E402
from assetops.functions.temporal import plus_days  # noqa: E402
from assetops.operators import intake, quality, relational, rules  # noqa: E402
from assetops.operators.ranking import RankBy, global_rank  # noqa: E402
from assetops.plans import metrics, reports, snapshots  # noqa: E402
from assetops.schema import SCHEMAS, Tables, conform  # noqa: E402
from assetops.session import build_session  # noqa: E402
from assetops.sources import feeds  # noqa: E402

JOBS, PIECES, LOG = 150_000, 6_000, 150_000
CLOCK = Clock(datetime(2025, 12, 10, 9))


def hot(key, other):
    """``1`` for every third row."""
    return F.when(key % 3 == 0, 1).otherwise(other)


def tables(spark):
    i = F.col("id")
    day = plus_days(CLOCK.now, -(i % 700))
    made = {
        "departments": spark.range(20).select(i.alias("DeptID"), F.concat(F.lit("D"), i.cast("string")).alias("DeptName")),
        "technicians": spark.range(300).select(
            i.alias("TechID"), F.lit("T").alias("FullName"), hot(i, i % 20).alias("DepartmentID"), F.lit("ACTIVE").alias("Status")
        ),
        "equipment": spark.range(PIECES).select(
            i.alias("EquipmentID"),
            F.lit("Pump").alias("Name"),
            F.lit("IMAGING").alias("Category"),
            day.alias("PurchaseDate"),
            (i % 50 * 100).cast("decimal(15,2)").alias("PurchasePrice"),
            F.lit("ACTIVE").alias("Status"),
            hot(i, i % 20).alias("DepartmentID"),
            hot(i, i % 8000).alias("UtilizationHours"),
        ),
        "maintenance": spark.range(0, JOBS, 1, 32).select(
            i.alias("MaintenanceID"),
            hot(i, i % PIECES).alias("EquipmentID"),
            hot(i, i % 300).alias("TechnicianID"),
            F.lit("EMERGENCY").alias("MaintenanceType"),
            day.alias("ScheduledDate"),
            day.alias("ActualDate"),
            day.alias("CompletionDate"),
            F.when(i % 10 == 1, "SCHEDULED").otherwise("COMPLETED").alias("Status"),
            hot(i, i % 977).cast("decimal(15,2)").alias("Cost"),
        ),
        "history": spark.range(0, JOBS, 1, 32).select(
            i.alias("HistoryID"),
            hot(i, i).alias("MaintenanceID"),
            hot(i, i % PIECES).alias("EquipmentID"),
            day.alias("DateFixed"),
            (i % 9).alias("DowntimeHours"),
        ),
        "alerts": spark.range(0, JOBS, 1, 32).select(
            i.alias("AlertID"),
            hot(i, i % PIECES).alias("EquipmentID"),
            F.lit("LOW_USAGE").alias("AlertType"),
            F.lit("CRITICAL").alias("Priority"),
            F.lit("PENDING").alias("Status"),
        ),
        "audit": spark.range(0, LOG, 1, 32).select(
            i.alias("LogID"),
            F.lit("EQUIPMENT").alias("TableName"),
            F.concat(F.lit("u"), hot(i, i % 50).cast("string")).alias("Username"),
            plus_days(CLOCK.now, -hot(i, i % 20)).alias("Timestamp"),
            F.lit("DENIED").alias("Status"),
        ),
    }
    empty = spark.range(0)
    return Tables(**{name: conform(made.get(name, empty), name) for name in SCHEMAS})


def reports_over(t):
    yield "risk", reports.equipment_risk_assessment(t, CLOCK)
    yield "departments", reports.department_performance(t, CLOCK)
    yield "month", reports.monthly_performance(t, CLOCK)
    yield "cost", reports.maintenance_cost(t, CLOCK)
    yield "analytics", reports.maintenance_analytics(t, CLOCK)
    yield "technicians", reports.technician_analytics(t, CLOCK)
    yield "lifecycle", reports.equipment_lifecycle(t, CLOCK)
    yield "schedule", reports.predictive_schedule(t, CLOCK)
    yield "health", reports.equipment_health(t, CLOCK)
    yield "summary", snapshots.monthly_maintenance_summary(t, CLOCK)
    yield "audit", reports.audit_compliance(t.audit, CLOCK)
    yield "mtbf", metrics.mtbf(t)
    yield "ranking", metrics.maintenance_ranking(t)
    yield "guard", rules.decommission_guard(feeds.decommission_requests(t), t.maintenance, t.alerts)
    yield "alerts", intake.automated_alerts(t, CLOCK)
    yield "totals", relational.total_maintenance_cost(t)
    yield "joined", relational.equipment_dept_maintenance(t)
    open_alerts = t.alerts.select("EquipmentID", "AlertID", "Status")
    yield "left_on", relational.left_on(t.equipment.select("EquipmentID"), open_alerts, "EquipmentID", F.col("Status") == "PENDING")
    yield "orphan_jobs", quality.orphan_maintenance(t)
    yield "keys", quality.fk_report(t)
    yield "complete", quality.completeness(t)
    yield "statements", rules.split_changes(changes(t), t.holidays, "statement_id")


def changes(t):
    """A third of all changes belongs to one statement."""
    return t.audit.select(
        F.col("LogID").alias("change_id"),
        hot(F.col("LogID"), F.col("LogID") % 2000).alias("statement_id"),
        F.lit("EQUIPMENT").alias("table_name"),
        F.lit("UPDATE").alias("op"),
        F.col("Timestamp").alias("event_ts"),
    )


def main(folder):
    spark = build_session(
        "local[8]",
        24,
        spark__driver__memory="6g",
        spark__checkpoint__dir=f"{folder}/shared",
        spark__eventLog__enabled="true",
        spark__eventLog__compress="false",
        spark__eventLog__rolling__enabled="false",
        spark__eventLog__dir=f"file:{folder}/log",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        # Skewed joins are split at this size instead of 256 MB.
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
    )
    t = tables(spark)
    for name, df in reports_over(t):
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    # The hot cost is one value of a third of all jobs.
    spark.sparkContext.setJobDescription("positions")
    ranked = global_rank(t.maintenance.select("MaintenanceID", "Cost"), [RankBy("Cost", "r")])
    top = ranked.agg(F.max("r"), F.count_if(F.col("Cost") == 1)).first()
    assert top[1] > JOBS // 3
    ranked.write.format("noop").mode("overwrite").save()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])

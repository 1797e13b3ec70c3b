"""Summary tables that are recomputed on demand and kept per date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.numeric import cents, count_if, or_zero, percent, rounded_ratio
from assetops.functions.temporal import month_label
from assetops.operators.facts import completed_since, with_health
from assetops.operators.relational import department_names
from assetops.plans.reports import MONTHLY_SUMS, _monthly_jobs, status_is
from assetops.schema import Tables


def daily_equipment_status(t: Tables, clock: Clock) -> DataFrame:
    """Status counts, health and value per department and category as of a day."""
    pieces = with_health(t.equipment, clock)
    per_id = pieces.groupBy("DepartmentID", "Category").agg(
        F.count("EquipmentID").alias("Total_Equipment"),
        count_if(status_is("ACTIVE")).alias("Active"),
        count_if(status_is("UNDER_MAINTENANCE")).alias("Under_Maintenance"),
        count_if(status_is("INACTIVE")).alias("Inactive"),
        count_if(status_is("DECOMMISSIONED")).alias("Decommissioned"),
        count_if(F.col("NextMaintenanceDate") < clock.now).alias("Overdue_Maintenance"),
        count_if(F.col("WarrantyExpiry") < clock.now).alias("Expired_Warranty"),
        F.sum("health_units").alias("health"),
        F.sum("PurchasePrice").alias("Total_Value"),
    )
    sums = [c for c in per_id.columns if c not in ("DepartmentID", "Category")]
    grouped = (
        per_id.join(department_names(t), "DepartmentID")
        .groupBy("DeptName", "Category")
        .agg(*(F.sum(c).alias(c) for c in sums))
    )
    return grouped.select(
        F.lit(clock.today.date()).alias("Snapshot_Date"),
        "DeptName",
        "Category",
        *(c for c in sums if c not in ("health", "Total_Value")),
        rounded_ratio(F.col("health"), F.col("Total_Equipment"), 1, 1).alias("Avg_Health_Score"),
        "Total_Value",
    )


def monthly_maintenance_summary(t: Tables, clock: Clock) -> DataFrame:
    """Completed jobs of 24 months per month, department and category."""
    known = t.technicians.select(F.col("TechID").alias("TechnicianID"), F.col("TechID").alias("known_tech"))
    grouped = (
        _monthly_jobs(t, completed_since(clock.months_ago(24)), "TechnicianID")
        .join(t.equipment.select("EquipmentID", "DepartmentID", "Category"), "EquipmentID")
        .join(department_names(t), "DepartmentID")
        .join(known, "TechnicianID", "left")
        .groupBy("month_start", "DeptName", "Category")
        .agg(*(F.sum(c).alias(c) for c in MONTHLY_SUMS), F.count_distinct("known_tech").alias("technicians"))
    )
    rows, cost, downtime = F.col("rows"), F.col("cost"), or_zero(F.col("downtime"))
    return grouped.select(
        month_label(F.col("month_start")).alias("Month"),
        "DeptName",
        "Category",
        rows.alias("Total_Maintenance"),
        F.col("preventive").alias("Preventive"),
        F.col("corrective").alias("Corrective"),
        F.col("emergency").alias("Emergency"),
        cost.alias("Total_Cost"),
        rounded_ratio(cents(cost), F.col("cost_n"), 2, 2).alias("Avg_Cost"),
        downtime.alias("Total_Downtime"),
        rounded_ratio(downtime, rows, 1).alias("Avg_Downtime"),
        F.col("technicians").alias("Technicians_Involved"),
        percent(rows, rows).alias("Completion_Rate"),
    )

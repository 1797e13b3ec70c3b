"""Key performance indicators and trend views.

Indicators that are declared without a query are computed as chosen here."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetops.clock import Clock, ntz
from assetops.functions import domain
from assetops.functions.numeric import cents, count_if, or_zero, percent, rounded_ratio, sum_if
from assetops.functions.temporal import month_label, month_start, whole_seconds
from assetops.operators.facts import type_is, with_age, with_health
from assetops.operators.ranking import RankBy, global_rank, row_numbers
from assetops.operators.relational import department_names
from assetops.plans.reports import n_rows, one_row, status_is, technician_analytics, technician_totals
from assetops.schema import ACTIVE, COMPLETED, Tables


def kpis(t: Tables, start: datetime, end: datetime) -> DataFrame:
    """Active equipment, cost, downtime and utilisation of a period (chosen)."""
    inside = lambda col: (F.col(col) >= ntz(start)) & (F.col(col) < ntz(end))
    pieces = t.equipment.filter(status_is(ACTIVE)).agg(
        n_rows().alias("Total_Equipment"),
        rounded_ratio(F.sum("UtilizationHours") * 100, F.count("UtilizationHours") * 8760, 1).alias(
            "Equipment_Utilization"
        ),
    )
    jobs = t.maintenance.filter(status_is(COMPLETED) & inside("ActualDate")).agg(
        or_zero(F.sum("Cost")).alias("Total_Maintenance_Cost")
    )
    repairs = t.history.filter(inside("DateFixed")).agg(
        rounded_ratio(F.sum("DowntimeHours"), F.count("DowntimeHours"), 1).alias("Avg_Downtime")
    )
    return one_row(pieces, jobs, repairs)


def maintenance_ranking(t: Tables) -> DataFrame:
    """Jobs and cost per equipment with positions inside the category (chosen)."""
    totals = t.maintenance.groupBy("EquipmentID").agg(n_rows().alias("n"), F.sum("Cost").alias("cost"))
    rows = (
        t.equipment.select("EquipmentID", "Name", "Category")
        .join(totals, "EquipmentID", "left")
        .select(
            "EquipmentID",
            "Name",
            "Category",
            or_zero(F.col("n")).alias("Maintenance_Count"),
            or_zero(F.col("cost")).alias("Total_Cost"),
        )
    )
    within = ("Category",)
    return row_numbers(
        rows,
        RankBy("Total_Cost", "Row_Num", within=within),
        "EquipmentID",
        [
            RankBy("Total_Cost", "Cost_Rank", within=within),
            RankBy("Total_Cost", "Cost_Dense_Rank", dense=True, within=within),
        ],
    )


def technician_performance(t: Tables) -> DataFrame:
    """All-time jobs, cost and repair time per technician, ranked (chosen)."""
    return global_rank(technician_totals(t, None), [RankBy("Total_Jobs", "Performance_Rank")])


def technician_cost_rank(t: Tables) -> DataFrame:
    totals = t.maintenance.groupBy("TechnicianID").agg(F.sum("Cost").alias("TotalCost"))
    return global_rank(totals, [RankBy("TotalCost", "Cost_Rank"), RankBy("TotalCost", "Dense_Cost_Rank", dense=True)])


def monthly_trends(t: Tables) -> DataFrame:
    """Jobs and cost per month beside both neighbours (chosen).  The window
    runs over one row per calendar month, a few hundred at most."""
    per_month = (
        t.maintenance.filter(F.col("ActualDate").isNotNull())
        .groupBy(month_start(F.col("ActualDate")).alias("month_start"))
        .agg(n_rows().alias("Job_Count"), F.sum("Cost").alias("Total_Cost"))
    )
    by_month = Window.orderBy("month_start")
    return (
        per_month.withColumn("Prev_Cost", F.lag("Total_Cost").over(by_month))
        .withColumn("Next_Cost", F.lead("Total_Cost").over(by_month))
        .select(
            month_label(F.col("month_start")).alias("Month"),
            "Job_Count",
            "Total_Cost",
            "Prev_Cost",
            "Next_Cost",
            (F.col("Total_Cost") - F.col("Prev_Cost")).alias("Cost_Change"),
        )
    )


def utilization_rates(t: Tables, clock: Clock) -> DataFrame:
    """The three utilisation percentages in use, side by side."""
    hours = F.col("UtilizationHours")
    return with_age(t.equipment.filter(status_is(ACTIVE)), clock).select(
        "EquipmentID",
        domain.utilization_of_month(hours).alias("Pct_Of_Month"),
        domain.utilization_of_year(hours).alias("Pct_Of_Year"),
        domain.utilization_of_life(hours, F.col("age_units")).alias("Pct_Of_Life"),
    )


def mtbf(t: Tables) -> DataFrame:
    """Mean days between completed repairs per equipment (chosen).

    The gaps between consecutive repairs add up to last minus first, so the
    mean needs three plain aggregates and no ordering of a piece's jobs."""
    repairs = t.maintenance.filter(
        status_is(COMPLETED) & F.col("MaintenanceType").isin("CORRECTIVE", "EMERGENCY") & F.col("ActualDate").isNotNull()
    )
    span = repairs.groupBy("EquipmentID").agg(
        n_rows().alias("Failures"), F.min("ActualDate").alias("first"), F.max("ActualDate").alias("last")
    )
    return span.select(
        "EquipmentID",
        "Failures",
        rounded_ratio(whole_seconds(F.col("last"), F.col("first")), (F.col("Failures") - 1) * 86400, 2).alias(
            "MTBF_Days"
        ),
    )


def mttr(t: Tables) -> DataFrame:
    return t.history.groupBy("EquipmentID").agg(
        F.count("DowntimeHours").alias("Repairs"),
        rounded_ratio(F.sum("DowntimeHours"), F.count("DowntimeHours"), 2).alias("MTTR_Hours"),
    )


def pm_compliance(t: Tables, clock: Clock, grace_days: int = 1) -> DataFrame:
    """Preventive jobs done within the grace period (chosen)."""
    limit = F.col("ScheduledDate") + F.make_dt_interval(days=F.lit(grace_days))
    in_time = status_is(COMPLETED) & (F.col("ActualDate") <= limit)
    return (
        t.maintenance.filter(type_is("PREVENTIVE") & (F.col("ScheduledDate") < clock.now))
        .agg(n_rows().alias("Planned_Jobs"), count_if(in_time).alias("Compliant_Jobs"))
        .withColumn("Compliance_Pct", percent(F.col("Compliant_Jobs"), F.col("Planned_Jobs")))
    )


def emergency_rate(t: Tables) -> DataFrame:
    return t.maintenance.agg(count_if(type_is("EMERGENCY")).alias("Emergency_Jobs"), n_rows().alias("Total_Jobs")).withColumn(
        "Emergency_Pct", percent(F.col("Emergency_Jobs"), F.col("Total_Jobs"))
    )


def technician_productivity(t: Tables, clock: Clock) -> DataFrame:
    return technician_analytics(t, clock).select(
        "TechID", "FullName", "Total_Maintenance_Assigned", "Completed_Maintenance", "Productivity_Rank"
    )


def cost_pct_of_value(t: Tables) -> DataFrame:
    """Completed cost in percent of the equipment value per department."""
    cost = t.maintenance.filter(status_is(COMPLETED)).groupBy("EquipmentID").agg(F.sum("Cost").alias("cost"))
    per_dept = (
        t.equipment.join(cost, "EquipmentID", "left")
        .groupBy("DepartmentID")
        .agg(F.sum("PurchasePrice").alias("value"), or_zero(F.sum("cost")).alias("cost"))
    )
    return (
        department_names(t)
        .join(per_dept, "DepartmentID", "left")
        .select(
            F.col("DepartmentID").alias("DeptID"),
            "DeptName",
            or_zero(F.col("value")).alias("Total_Value"),
            or_zero(F.col("cost")).alias("Total_Cost"),
            percent(cents(F.col("cost")), cents(F.col("value"))).alias("Cost_Pct_Of_Value"),
        )
    )


def warranty_coverage(t: Tables, clock: Clock) -> DataFrame:
    """ACTIVE equipment in warranty (chosen)."""
    return (
        t.equipment.filter(status_is(ACTIVE))
        .agg(n_rows().alias("Active_Equipment"), count_if(F.col("WarrantyExpiry") >= clock.now).alias("In_Warranty"))
        .withColumn("Coverage_Pct", percent(F.col("In_Warranty"), F.col("Active_Equipment")))
    )


def downtime_hours(t: Tables, by: str = "equipment") -> DataFrame:
    per_piece = t.history.groupBy("EquipmentID").agg(F.sum("DowntimeHours").alias("Downtime_Hours"))
    if by == "equipment":
        return per_piece
    return (
        t.equipment.select("EquipmentID", "DepartmentID")
        .join(per_piece, "EquipmentID")
        .groupBy("DepartmentID")
        .agg(F.sum("Downtime_Hours").alias("Downtime_Hours"))
        .join(department_names(t), "DepartmentID")
        .select("DeptName", "Downtime_Hours")
    )


def alert_resolution_time(t: Tables) -> DataFrame:
    """Mean hours from report to resolution per priority (chosen)."""
    seconds = whole_seconds(F.col("ResolutionDate"), F.col("DateReported"))
    return (
        t.alerts.filter(status_is("RESOLVED") & F.col("ResolutionDate").isNotNull())
        .groupBy("Priority")
        .agg(n_rows().alias("Resolved_Alerts"), F.sum(seconds).alias("seconds"))
        .select(
            "Priority",
            "Resolved_Alerts",
            rounded_ratio(F.col("seconds"), F.col("Resolved_Alerts") * 3600, 1).alias("Avg_Resolution_Hours"),
        )
    )


def department_health(t: Tables, clock: Clock) -> DataFrame:
    per_dept = with_health(t.equipment, clock).groupBy("DepartmentID").agg(n_rows().alias("n"), F.sum("health_units").alias("h"))
    return per_dept.join(department_names(t), "DepartmentID").select(
        F.col("DepartmentID").alias("DeptID"),
        "DeptName",
        F.col("n").alias("Equipment_Count"),
        rounded_ratio(F.col("h"), F.col("n"), 1, 1).alias("Avg_Health_Score"),
    )

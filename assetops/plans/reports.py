"""Dashboards and reports.

Each report groups facts by key before it joins a dimension, and computes the
row counts of many-way joins as weights instead of building the joined rows.
``fanout="as_written"`` gives the totals those joins would give, repeated rows
included; ``"corrected"`` counts every piece, job and alert once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetops.clock import Clock, month_bounds, ntz
from assetops.functions import domain
from assetops.functions.numeric import cents, count_if, or_zero, percent, plain_ratio, rounded_ratio, sum_if
from assetops.functions.temporal import month_label, month_start, quarter_label, weekday_name
from assetops.operators.facts import (
    completed_since,
    features,
    jobs_with_history,
    per_type,
    type_is,
    with_health,
)
from assetops.operators.ranking import RankBy, bounded_rank, global_rank
from assetops.operators.relational import department_names, top_k
from assetops.schema import ACTIVE, COMPLETED, DECOMMISSIONED, OPEN_ALERT, OPEN_JOB, Tables
from assetops.storage import cut


def n_rows() -> Column:
    return F.count(F.lit(1))


def one_row(*frames: DataFrame) -> DataFrame:
    """Single-row frames side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def status_is(*values: str) -> Column:
    return F.col("Status").isin(*values)


def _check(fanout: str) -> bool:
    if fanout not in ("as_written", "corrected"):
        raise ValueError(f"unknown fanout {fanout!r}")
    return fanout == "as_written"


def executive_dashboard(t: Tables, clock: Clock) -> DataFrame:
    """Fifteen headline figures in one row: one pass per table."""
    active = status_is(ACTIVE)
    pieces = with_health(t.equipment, clock).agg(
        count_if(active).alias("Active_Equipment"),
        count_if(status_is("UNDER_MAINTENANCE")).alias("Equipment_Under_Maintenance"),
        count_if(status_is(DECOMMISSIONED)).alias("Decommissioned_Equipment"),
        sum_if(active, F.col("PurchasePrice")).alias("Total_Equipment_Value"),
        count_if(active & (F.col("NextMaintenanceDate") < clock.now)).alias("Overdue_Maintenance"),
        count_if(active & (F.col("WarrantyExpiry") < clock.now)).alias("Expired_Warranties"),
        rounded_ratio(sum_if(active, F.col("health_units")), count_if(active), 1, 1).alias(
            "Avg_Equipment_Health_Score"
        ),
    )
    jobs = t.maintenance.agg(
        count_if(status_is("SCHEDULED")).alias("Scheduled_Maintenance"),
        count_if(status_is("IN_PROGRESS")).alias("Maintenance_In_Progress"),
        count_if(completed_since(clock.months_ago(1))).alias("Completed_Last_Month"),
        sum_if(completed_since(clock.months_ago(12)), F.col("Cost")).alias("Annual_Maintenance_Cost"),
    )
    warnings = t.alerts.agg(
        count_if(status_is("PENDING")).alias("Pending_Alerts"),
        count_if(status_is("IN_PROGRESS")).alias("Alerts_In_Progress"),
        count_if((F.col("Priority") == "CRITICAL") & status_is(*OPEN_ALERT)).alias("Critical_Alerts"),
    )
    repairs = t.history.filter(F.col("DateFixed") >= clock.months_ago(3)).agg(
        rounded_ratio(F.sum("DowntimeHours"), F.count("DowntimeHours"), 1).alias("Avg_Downtime_Hours")
    )
    return one_row(pieces, jobs, warnings, repairs)


def _department_totals(t: Tables, clock: Clock, keep: Column, as_written: bool) -> DataFrame:
    """Per department id: equipment figures weighted by the job rows of each
    piece (or by 1), plus job totals of the jobs that satisfy ``keep``."""
    weight = F.col("weight") if as_written else F.lit(1)
    jobs = (
        jobs_with_history(t, keep)
        .groupBy("EquipmentID")
        .agg(
            F.sum(weight).alias("jobs"),
            *per_type(weight),
            or_zero(sum_if(status_is(COMPLETED), weight)).alias("completed"),
            or_zero(F.sum(F.col("Cost") * weight)).alias("cost"),
            or_zero(F.sum("downtime")).alias("downtime"),
        )
    )
    pieces = with_health(t.equipment, clock).select(
        "EquipmentID", "DepartmentID", "Status", "NextMaintenanceDate", "PurchasePrice", "health_units"
    )
    rows = F.greatest(or_zero(F.col("jobs")), F.lit(1)) if as_written else F.lit(1)
    repeat = F.col("repeat")
    sums = ("jobs", "preventive", "corrective", "emergency", "completed", "cost", "downtime")
    return (
        pieces.join(jobs, "EquipmentID", "left")
        .withColumn("repeat", rows)
        .groupBy("DepartmentID")
        .agg(
            F.sum(repeat).alias("pieces"),
            or_zero(sum_if(status_is(ACTIVE), repeat)).alias("active"),
            or_zero(sum_if(status_is("UNDER_MAINTENANCE"), repeat)).alias("in_repair"),
            or_zero(sum_if(F.col("NextMaintenanceDate") < clock.now, repeat)).alias("overdue"),
            or_zero(F.sum(F.col("PurchasePrice") * repeat)).alias("value"),
            F.sum(F.col("health_units") * repeat).alias("health"),
            *(or_zero(F.sum(c)).alias(c) for c in sums),
        )
    )


def department_figures(t: Tables, clock: Clock, fanout: str = "as_written") -> DataFrame:
    """Equipment, cost, health and staff per department."""
    as_written = _check(fanout)
    totals = _department_totals(t, clock, completed_since(clock.months_ago(12)), as_written)
    staff = t.technicians.groupBy("DepartmentID").agg(F.count_distinct("TechID").alias("staff"))
    repeat = F.greatest(or_zero(F.col("staff")), F.lit(1)) if as_written else F.lit(1)
    downtime_den = F.col("pieces") if as_written else F.nullif(F.col("jobs"), F.lit(0))

    def times(col: str) -> Column:
        return or_zero(F.col(col)) * repeat

    return (
        t.departments.join(totals, F.col("DeptID") == totals["DepartmentID"], "left")
        .drop("DepartmentID")
        .join(staff, F.col("DeptID") == staff["DepartmentID"], "left")
        .select(
            "DeptID",
            "DeptName",
            "Location",
            "HeadOfDept",
            times("pieces").alias("Total_Equipment"),
            times("active").alias("Active_Equipment"),
            times("in_repair").alias("Under_Maintenance"),
            times("overdue").alias("Overdue_Maintenance"),
            times("value").alias("Total_Equipment_Value"),
            times("cost").alias("Maintenance_Cost_Last_Year"),
            or_zero(rounded_ratio(F.col("health"), F.col("pieces"), 1, 1)).alias("Avg_Health_Score"),
            or_zero(rounded_ratio(F.col("downtime"), downtime_den, 1)).alias("Avg_Downtime_Hours"),
            or_zero(F.col("staff")).alias("Assigned_Technicians"),
        )
    )


def department_performance(t: Tables, clock: Clock, fanout: str = "as_written") -> DataFrame:
    """Department figures, ranked by value and by cost, highest value first."""
    ranked = bounded_rank(
        department_figures(t, clock, fanout),
        [
            RankBy("Total_Equipment_Value", "Equipment_Value_Rank"),
            RankBy("Maintenance_Cost_Last_Year", "Maintenance_Cost_Rank"),
        ],
    )
    return ranked.orderBy(F.col("Total_Equipment_Value").desc(), "DeptID")


def top_departments_by_cost(t: Tables, clock: Clock, k: int = 5, fanout: str = "as_written") -> DataFrame:
    rows = department_figures(t, clock, fanout).select(
        "DeptName", "Total_Equipment", "Total_Equipment_Value", "Maintenance_Cost_Last_Year"
    )
    return top_k(rows, [F.col("Maintenance_Cost_Last_Year").desc_nulls_first()], "DeptName", k)


def _monthly_jobs(t: Tables, keep: Column, *extra_keys: str) -> DataFrame:
    """Job totals per (equipment, month): the rows that meet a dimension."""
    weight, cost = F.col("weight"), F.col("Cost")
    return (
        jobs_with_history(t, keep)
        .groupBy("EquipmentID", month_start(F.col("ActualDate")).alias("month_start"), *extra_keys)
        .agg(
            F.sum(weight).alias("rows"),
            *per_type(weight),
            F.sum(cost * weight).alias("cost"),
            or_zero(sum_if(cost.isNotNull(), weight)).alias("cost_n"),
            F.min(cost).alias("min_cost"),
            F.max(cost).alias("max_cost"),
            F.sum("downtime").alias("downtime"),
            or_zero(F.sum("downtime_n")).alias("downtime_n"),
        )
    )


MONTHLY_SUMS = ("rows", "preventive", "corrective", "emergency", "cost", "cost_n", "downtime", "downtime_n")


def _resum() -> list[Column]:
    return [
        *(F.sum(c).alias(c) for c in MONTHLY_SUMS),
        F.min("min_cost").alias("min_cost"),
        F.max("max_cost").alias("max_cost"),
    ]


def previous_month(value: Column, key: str) -> Column:
    """Value of the row before within ``key``; one row per month and key."""
    return F.lag(value).over(Window.partitionBy(key).orderBy("month_start"))


def maintenance_analytics(t: Tables, clock: Clock) -> DataFrame:
    """Completed jobs of 24 months per month and category, with the change
    against the month before."""
    per_piece = _monthly_jobs(t, completed_since(clock.months_ago(24)))
    grouped = (
        per_piece.join(t.equipment.select("EquipmentID", "Category"), "EquipmentID")
        .groupBy("month_start", "Category")
        .agg(*_resum())
        .withColumn("before", previous_month(F.col("rows"), "Category"))
    )
    day, rows, cost = F.col("month_start"), F.col("rows"), F.col("cost")
    return grouped.select(
        month_label(day).alias("Month"),
        quarter_label(day).alias("Quarter"),
        F.year(day).alias("Year"),
        "Category",
        rows.alias("Total_Maintenance"),
        F.col("preventive").alias("Preventive_Maintenance"),
        F.col("corrective").alias("Corrective_Maintenance"),
        F.col("emergency").alias("Emergency_Maintenance"),
        cost.alias("Total_Cost"),
        rounded_ratio(cents(cost), F.col("cost_n"), 2, 2).alias("Avg_Cost"),
        F.col("min_cost").alias("Min_Cost"),
        F.col("max_cost").alias("Max_Cost"),
        F.col("downtime").alias("Total_Downtime_Hours"),
        rounded_ratio(F.col("downtime"), F.col("downtime_n"), 1).alias("Avg_Downtime_Hours"),
        rounded_ratio(cents(cost), rows, 2, 2).alias("Cost_Per_Maintenance"),
        rounded_ratio(F.col("downtime"), rows, 1).alias("Downtime_Per_Maintenance"),
        F.col("before").alias("Prev_Month_Count"),
        percent(rows - F.col("before"), F.col("before")).alias("Month_Over_Month_Change_Pct"),
    ).orderBy(F.col("Month").desc(), "Category")


def category_month_trend(t: Tables, clock: Clock) -> DataFrame:
    """Completed jobs per category and month with the change in percent.  No
    history here, so the job table is the only fact scanned."""
    per_piece = (
        t.maintenance.filter(completed_since(clock.months_ago(24)))
        .groupBy("EquipmentID", month_start(F.col("ActualDate")).alias("month_start"))
        .agg(n_rows().alias("n"))
    )
    grouped = (
        per_piece.join(t.equipment.select("EquipmentID", "Category"), "EquipmentID")
        .groupBy("Category", "month_start")
        .agg(F.sum("n").alias("n"))
        .withColumn("before", previous_month(F.col("n"), "Category"))
    )
    return grouped.select(
        "Category",
        month_label(F.col("month_start")).alias("Month"),
        F.col("n").alias("Job_Count"),
        F.col("before").alias("Prev_Month_Count"),
        percent(F.col("n") - F.col("before"), F.col("before")).alias("Change_Pct"),
    )


def workload_scores(t: Tables) -> DataFrame:
    """Chosen: open jobs of a technician in percent of the busiest ACTIVE one."""
    open_jobs = t.maintenance.filter(status_is(*OPEN_JOB)).groupBy("TechnicianID").agg(n_rows().alias("open_jobs"))
    staff = t.technicians.join(open_jobs, F.col("TechID") == F.col("TechnicianID"), "left").select(
        "TechID", "Status", or_zero(F.col("open_jobs")).alias("open_jobs")
    )
    busiest = staff.filter(status_is(ACTIVE)).agg(F.max("open_jobs")).scalar()
    return staff.select(
        "TechID", "open_jobs", or_zero(percent(F.col("open_jobs"), busiest)).alias("Workload_Score")
    )


def technician_analytics(t: Tables, clock: Clock) -> DataFrame:
    """Workload, cost and downtime of every ACTIVE technician, three ranks."""
    weight = F.col("weight")

    def rows_if(condition: Column) -> Column:
        return or_zero(sum_if(condition, weight))

    totals = (
        jobs_with_history(t)
        .groupBy("TechnicianID")
        .agg(
            F.sum(weight).alias("assigned"),
            rows_if(status_is(COMPLETED)).alias("done"),
            rows_if(status_is("IN_PROGRESS")).alias("running"),
            rows_if(status_is("SCHEDULED")).alias("planned"),
            *(rows_if(F.col("ActualDate") >= clock.months_ago(m)).alias(f"last_{m}") for m in (1, 3, 12)),
            count_if(status_is(*OPEN_JOB)).alias("open_jobs"),
            F.sum(F.col("Cost") * weight).alias("cost"),
            F.sum("downtime").alias("downtime"),
            F.sum("downtime_n").alias("downtime_n"),
        )
    )
    sums = [c for c in totals.columns if c != "TechnicianID"]
    staff = (
        t.technicians.filter(status_is(ACTIVE))
        .join(totals, F.col("TechID") == F.col("TechnicianID"), "left")
        .join(department_names(t), "DepartmentID", "left")
        .withColumns({c: or_zero(F.col(c)) for c in sums})
        .withColumn("rows", F.greatest("assigned", F.lit(1)))
    )
    figures = staff.select(
        "TechID",
        "FullName",
        "Specialty",
        F.col("DeptName").alias("Department"),
        "CertificationLevel",
        F.col("assigned").alias("Total_Maintenance_Assigned"),
        F.col("done").alias("Completed_Maintenance"),
        F.col("running").alias("In_Progress_Maintenance"),
        F.col("planned").alias("Scheduled_Maintenance"),
        F.col("last_1").alias("Last_Month_Maintenance"),
        F.col("last_3").alias("Last_Quarter_Maintenance"),
        F.col("last_12").alias("Last_Year_Maintenance"),
        F.col("cost").alias("Total_Cost_Managed"),
        rounded_ratio(cents(F.col("cost")), F.col("rows"), 2, 2).alias("Avg_Cost_Per_Maintenance"),
        rounded_ratio(F.col("downtime"), F.col("rows"), 1).alias("Avg_Downtime_Hours"),
        F.col("downtime").alias("Total_Downtime_Hours"),
        "open_jobs",
        percent(F.col("done"), F.col("assigned")).alias("Completion_Rate_Pct"),
        plain_ratio(F.col("downtime") + (F.col("rows") - F.col("downtime_n")) * 999, F.col("rows")).alias("slowness"),
    )
    base = cut(figures)
    busiest = base.agg(F.max("open_jobs")).scalar()
    return (
        global_rank(
            base,
            [
                RankBy("Total_Maintenance_Assigned", "Productivity_Rank"),
                RankBy("slowness", "Efficiency_Rank", descending=False),
                RankBy("Total_Cost_Managed", "Cost_Management_Rank"),
            ],
            is_cut=True,
        )
        .withColumn("Workload_Score", or_zero(percent(F.col("open_jobs"), busiest)))
        .drop("slowness", "open_jobs")
        .orderBy("Productivity_Rank", "TechID")
    )


# The bounds and labels of recommendations.
def _recommendation(score: Column) -> Column:
    return domain.labelled(
        score,
        [(40, "CRITICAL - NEEDS REPLACEMENT"), (60, "POOR - SCHEDULE MAINTENANCE"), (80, "FAIR - MONITOR CLOSELY")],
        "GOOD - NORMAL OPERATION",
    )


def risk_rows(t: Tables, clock: Clock, fanout: str = "as_written", hourly_cents: int = 100) -> DataFrame:
    """Risk assessment of every piece that is not decommissioned, unsorted."""
    as_written = _check(fanout)
    open_alerts = (
        t.alerts.filter(status_is(*OPEN_ALERT))
        .groupBy("EquipmentID")
        .agg(n_rows().alias("alerts"), count_if(F.col("Priority") == "CRITICAL").alias("critical"))
    )
    pieces = (
        features(t, clock, F.col("Status") != DECOMMISSIONED, hourly_cents, with_history=True)
        .join(open_alerts, "EquipmentID", "left")  # still partitioned by EquipmentID
        .join(department_names(t), "DepartmentID")
    )
    alerts, critical = or_zero(F.col("alerts")), or_zero(F.col("critical"))
    job_rows = F.greatest("job_rows", F.lit(1))
    if as_written:
        alert_rows = F.greatest(alerts, F.lit(1))
        jobs, emergencies, cost = (F.col(c) * alert_rows for c in ("job_rows", "emergency_rows", "cost_rows"))
        alerts, critical = alerts * job_rows, critical * job_rows
    else:
        jobs, emergencies, cost = (F.col(c) for c in ("completed_jobs", "emergency_jobs", "completed_cost"))
    return pieces.select(
        "EquipmentID",
        "Name",
        "SerialNumber",
        "Category",
        "DeptName",
        "Age_Years",
        "UtilizationHours",
        domain.utilization_of_year(F.col("UtilizationHours")).alias("Utilization_Percentage"),
        jobs.alias("Total_Maintenance_Count"),
        emergencies.alias("Emergency_Maintenance_Count"),
        cost.alias("Total_Maintenance_Cost"),
        rounded_ratio(F.col("downtime"), job_rows, 1).alias("Avg_Downtime_Hours"),
        "Health_Score",
        "Failure_Risk",
        "ROI_Percentage",
        "Status",
        "Maintenance_Status",
        alerts.alias("Active_Alerts"),
        critical.alias("Critical_Alerts"),
        "PurchasePrice",
        "WarrantyExpiry",
        "Warranty_Status",
        _recommendation(F.col("Health_Score")).alias("Recommendation"),
    )


def equipment_risk_assessment(
    t: Tables, clock: Clock, fanout: str = "as_written", hourly_cents: int = 100
) -> DataFrame:
    # Sorts end with a unique column: equal scores then spread over tasks.
    return risk_rows(t, clock, fanout, hourly_cents).orderBy(
        "Health_Score", F.col("Failure_Risk").desc(), "EquipmentID"
    )


def _unhealthiest(t: Tables, clock: Clock, below: int, k: int) -> DataFrame:
    """Only health decides the selection, so it happens before any fact is
    read: risk is computed for the k selected pieces."""
    departments = department_names(t)
    candidates = (
        with_health(t.equipment.filter(F.col("Status") != DECOMMISSIONED), clock)
        .filter(F.col("health_units") < below * 10)
        .join(departments.select("DepartmentID"), "DepartmentID", "left_semi")
        .select(*t.equipment.columns, "health_units")
    )
    chosen = cut(top_k(candidates, [F.col("health_units").asc()], "EquipmentID", k).drop("health_units"))
    ids = chosen.select("EquipmentID")
    jobs = t.maintenance.join(ids, "EquipmentID", "left_semi")
    return (
        features(t.but(equipment=chosen, maintenance=jobs), clock)
        .join(departments, "DepartmentID")
        .withColumn("Recommendation", _recommendation(F.col("Health_Score")))
    )


def urgent_equipment(t: Tables, clock: Clock, threshold: int = 60, k: int = 5) -> DataFrame:
    return _unhealthiest(t, clock, threshold, k).select(
        "EquipmentID", "Name", "Category", "DeptName", "Health_Score", "Failure_Risk", "Recommendation"
    )


def predictive_top(t: Tables, clock: Clock, threshold: int = 70, k: int = 3) -> DataFrame:
    return _unhealthiest(t, clock, threshold, k).select("EquipmentID", "Name", "Health_Score", "Recommendation")


def audit_compliance(audit: DataFrame, clock: Clock) -> DataFrame:
    """Audited operations of 30 days per day and hour.

    Counts are first taken per (day, hour, table, user), so an hour that holds
    a third of the log is reduced map-side and the distinct counts run over
    users and tables, not over log rows."""
    when = F.col("Timestamp")
    message = F.col("ErrorMessage")
    first = (
        audit.filter(when >= clock.days_before_today(30))
        .groupBy(when.cast("date").alias("day"), F.hour(when).alias("hour"), "TableName", "Username")
        .agg(
            n_rows().alias("n"),
            count_if(status_is("DENIED")).alias("denied"),
            count_if(status_is("SUCCESS")).alias("success"),
            count_if(status_is("ERROR")).alias("error"),
            count_if(message.contains("weekday")).alias("weekday"),
            count_if(message.contains("holiday")).alias("holiday"),
            count_if(message.contains("not allowed")).alias("rule"),
        )
    )
    per_hour = first.groupBy("day", "hour").agg(
        *(F.sum(c).alias(c) for c in ("n", "denied", "success", "error", "weekday", "holiday", "rule")),
        F.count_distinct("TableName").alias("tables"),
        F.count_distinct("Username").alias("users"),
    )
    office = F.col("hour").between(8, 17)
    return per_hour.select(
        F.col("day").alias("Audit_Date"),
        weekday_name(F.col("day")).alias("Day_Of_Week"),
        F.col("n").alias("Total_Operations"),
        F.col("denied").alias("Denied_Operations"),
        F.col("success").alias("Successful_Operations"),
        F.col("error").alias("Error_Operations"),
        F.col("tables").alias("Tables_Modified"),
        F.col("users").alias("Active_Users"),
        F.col("weekday").alias("Weekday_Denials"),
        F.col("holiday").alias("Holiday_Denials"),
        F.col("rule").alias("Rule_Violation_Denials"),
        percent(F.col("success"), F.col("n")).alias("Success_Rate_Pct"),
        F.lpad(F.col("hour").cast("string"), 2, "0").alias("Hour_Of_Day"),
        F.when(office, F.col("n")).otherwise(0).alias("Business_Hours_Operations"),
        F.when(office, 0).otherwise(F.col("n")).alias("After_Hours_Operations"),
    ).orderBy(F.col("Audit_Date").desc(), "Hour_Of_Day")


def recent_audit_days(audit: DataFrame, clock: Clock, k: int = 5) -> DataFrame:
    return (
        audit_compliance(audit, clock)
        .orderBy(F.col("Audit_Date").desc(), F.col("Hour_Of_Day").asc())
        .limit(k)
        .select("Audit_Date", "Total_Operations", "Denied_Operations", "Success_Rate_Pct")
    )


def monthly_performance(
    t: Tables, clock: Clock, month: int | None = None, year: int | None = None, fanout: str = "as_written"
) -> DataFrame:
    """Departments in one calendar month (default: the month of ``as_of``).
    The month is a date range, which a scan can prune by."""
    as_written = _check(fanout)
    start, end = month_bounds(year or clock.as_of.year, month or clock.as_of.month)
    in_month = (F.col("ActualDate") >= ntz(start)) & (F.col("ActualDate") < ntz(end))
    totals = _department_totals(t, clock, in_month, as_written)
    sums = [c for c in totals.columns if c != "DepartmentID"]
    per_name = (
        department_names(t)
        .join(totals, "DepartmentID", "left")
        .groupBy("DeptName")
        .agg(*(or_zero(F.sum(c)).alias(c) for c in sums), count_if(F.col("pieces").isNull()).alias("empty"))
    )
    # A department without equipment is still one row of the left join.
    rows = F.col("pieces") + F.col("empty")
    jobs = rows if as_written else F.nullif(F.col("jobs"), F.lit(0))
    figures = per_name.select(
        "DeptName",
        F.col("pieces").alias("Equipment_Count"),
        F.col("active").alias("Active_Equipment"),
        F.col("in_repair").alias("Under_Maintenance"),
        F.col("jobs").alias("Maintenance_Count"),
        F.col("preventive").alias("Preventive_Maintenance"),
        F.col("corrective").alias("Corrective_Maintenance"),
        F.col("cost").alias("Total_Maintenance_Cost"),
        or_zero(rounded_ratio(cents(F.col("cost")), jobs, 2, 2)).alias("Avg_Maintenance_Cost"),
        F.col("downtime").alias("Total_Downtime_Hours"),
        or_zero(rounded_ratio(F.col("downtime"), jobs, 1)).alias("Avg_Downtime_Hours"),
        rounded_ratio(F.col("health"), rows, 1, 1).alias("Avg_Health_Score"),
        percent(F.col("completed"), F.col("jobs")).alias("Maintenance_Completion_Rate"),
    )
    return bounded_rank(
        figures,
        [
            RankBy("Total_Maintenance_Cost", "Cost_Rank"),
            RankBy("Avg_Downtime_Hours", "Downtime_Rank", descending=False),
            RankBy("Avg_Health_Score", "Health_Rank"),
        ],
    ).orderBy(F.col("Total_Maintenance_Cost").desc(), "DeptName")


def equipment_lifecycle(t: Tables, clock: Clock, hourly_cents: int = 100) -> DataFrame:
    """Age, cost and return of every ACTIVE piece."""
    pieces = features(t, clock, status_is(ACTIVE), hourly_cents).join(department_names(t), "DepartmentID")
    score, roi = F.col("Health_Score"), F.col("ROI_Percentage")
    return pieces.select(
        "EquipmentID",
        "Name",
        "Category",
        "DeptName",
        "Age_Years",
        domain.labelled(
            F.col("Age_Years"),
            # Age groups and lifecycle labels.
            [(3, "NEW (0-3 years)"), (7, "MID-LIFE (4-7 years)"), (10, "MATURE (8-10 years)")],
            "AGING (10+ years)",
        ).alias("Age_Category"),
        "PurchasePrice",
        F.col("completed_cost").alias("Total_Maintenance_Cost"),
        percent(cents(F.col("completed_cost")), cents(F.col("PurchasePrice"))).alias("Maintenance_Cost_Percentage"),
        "UtilizationHours",
        domain.utilization_of_life(F.col("UtilizationHours"), F.col("age_units")).alias("Annual_Utilization_Pct"),
        "Health_Score",
        "Failure_Risk",
        F.when((F.col("Age_Years") >= 10) & (score < 50), "HIGH PRIORITY FOR REPLACEMENT")
        .otherwise(
            domain.labelled(
                score,
                [(40, "SCHEDULE MAJOR MAINTENANCE OR REPLACEMENT"), (60, "MONITOR CLOSELY - CONSIDER UPGRADE")],
                "CONTINUE NORMAL OPERATION",
            )
        )
        .alias("Lifecycle_Recommendation"),
        "ROI_Percentage",
        domain.labelled(roi, [(5, "LOW ROI"), (15, "MODERATE ROI")], "HIGH ROI").alias("ROI_Category"),
    ).orderBy(F.col("Age_Years").desc(), "Health_Score", "EquipmentID")


# Priority bands of the predictive schedule as
# (lowest score, label, days ahead, estimated cost), highest band first.
PRIORITY_BANDS = [
    (80, "CRITICAL - SCHEDULE IMMEDIATELY", 7, 5000),
    (60, "HIGH - SCHEDULE WITHIN 2 WEEKS", 14, 3000),
    (40, "MEDIUM - SCHEDULE WITHIN 4 WEEKS", 28, 1500),
    (None, "LOW - SCHEDULE ROUTINE", 90, 800),
]

# Technician specialty asked for by equipment category.
SPECIALTY_BY_CATEGORY = {
    "IMAGING": "IMAGING EQUIPMENT SPECIALIST",
    "LIFE_SUPPORT": "LIFE SUPPORT SYSTEMS SPECIALIST",
    "SURGICAL": "SURGICAL EQUIPMENT SPECIALIST",
    "MONITORING": "MONITORING SYSTEMS SPECIALIST",
}


def _band(score: Column, field: int, clock: Clock) -> Column:
    out = None
    for band in reversed(PRIORITY_BANDS):
        value = clock.in_days(band[2]) if field == 2 else F.lit(band[field])
        out = value if out is None else F.when(score >= band[0], value).otherwise(out)
    return out


def predictive_schedule(t: Tables, clock: Clock, lookahead_days: int = 90) -> DataFrame:
    """ACTIVE pieces whose risk score reaches 30, most urgent first.
    ``lookahead_days`` is accepted for compatibility and has no effect."""
    points = (
        F.col("age_units") * 25
        + (F.lit(1000) - F.col("health_units")) * 100
        + domain.risk_points(F.col("Failure_Risk")) * 1000
    )  # thousandths
    score = F.col("Calculated_Risk_Score")
    specialty = F.lit("GENERAL BIOMEDICAL TECHNICIAN")
    for category, name in SPECIALTY_BY_CATEGORY.items():
        specialty = F.when(F.col("Category") == category, name).otherwise(specialty)
    return (
        features(t, clock, status_is(ACTIVE))
        .join(department_names(t), "DepartmentID")
        .withColumn("Calculated_Risk_Score", domain.scaled(points, 3))
        .filter(score >= 30)
        .select(
            "EquipmentID",
            "Name",
            "Category",
            "DeptName",
            "Age_Years",
            "UtilizationHours",
            "Health_Score",
            "Failure_Risk",
            F.col("last_completed").alias("Last_Maintenance_Date"),
            F.col("completed_jobs").alias("Total_Maintenance_Count"),
            F.col("emergency_jobs").alias("Emergency_Maintenance_Count"),
            score,
            _band(score, 1, clock).alias("Maintenance_Priority"),
            _band(score, 2, clock).alias("Recommended_Schedule_Date"),
            _band(score, 3, clock).alias("Estimated_Cost"),
            specialty.alias("Recommended_Specialty"),
        )
        .orderBy(score.desc(), F.col("Last_Maintenance_Date").asc_nulls_first(), "EquipmentID")
    )


def equipment_health(t: Tables, clock: Clock) -> DataFrame:
    """Health score and job totals (all statuses) of every ACTIVE piece."""
    weight, cost = F.col("weight"), F.col("Cost")
    totals = (
        jobs_with_history(t)
        .groupBy("EquipmentID")
        .agg(
            F.sum(weight).alias("rows"),
            F.sum(cost * weight).alias("cost"),
            sum_if(cost.isNotNull(), weight).alias("cost_n"),
            F.sum("downtime").alias("downtime"),
        )
    )
    score = domain.as_score(F.col("health_units"))
    return (
        with_health(t.equipment.filter(status_is(ACTIVE)), clock)
        .join(totals, "EquipmentID", "left")
        .join(department_names(t), "DepartmentID")
        .select(
            "EquipmentID",
            "Name",
            "DeptName",
            domain.as_years(F.col("age_units")).alias("Age_Years"),
            "UtilizationHours",
            or_zero(F.col("rows")).alias("Maintenance_Count"),
            rounded_ratio(cents(F.col("cost")), F.col("cost_n"), 2, 2).alias("Avg_Maintenance_Cost"),
            F.col("downtime").alias("Total_Downtime"),
            score.alias("Health_Score"),
            domain.health_label(score).alias("Health_Status"),
        )
        .orderBy(F.col("Health_Score").desc(), "EquipmentID")
    )


def maintenance_cost(t: Tables, clock: Clock) -> DataFrame:
    """Completed jobs of twelve months per month and department."""
    pieces = t.equipment.select("EquipmentID", "DepartmentID")
    grouped = (
        _monthly_jobs(t, completed_since(clock.months_ago(12)))
        .join(pieces, "EquipmentID")
        .join(department_names(t), "DepartmentID")
        .groupBy("month_start", "DeptName")
        .agg(*_resum())
    )
    return grouped.select(
        month_label(F.col("month_start")).alias("Month"),
        "DeptName",
        F.col("rows").alias("Maintenance_Count"),
        F.col("cost").alias("Total_Cost"),
        plain_ratio(F.col("cost"), F.col("cost_n")).alias("Avg_Cost"),
        F.col("downtime").alias("Total_Downtime"),
        rounded_ratio(cents(F.col("cost")), F.col("rows"), 2, 2).alias("Cost_Per_Maintenance"),
    ).orderBy(F.col("Month").desc(), F.col("Total_Cost").desc_nulls_first(), "DeptName")


def technician_totals(t: Tables, keep: Column | None) -> DataFrame:
    """Jobs, cost and repair time of the technicians that have any job."""
    weight, cost = F.col("weight"), F.col("Cost")
    totals = (
        jobs_with_history(t, keep)
        .groupBy("TechnicianID")
        .agg(
            F.sum(weight).alias("Total_Jobs"),
            or_zero(sum_if(status_is(COMPLETED), weight)).alias("Completed_Jobs"),
            plain_ratio(F.sum("downtime"), F.sum("downtime_n")).alias("Avg_Repair_Time"),
            F.sum(cost * weight).alias("Total_Cost_Handled"),
            rounded_ratio(cents(F.sum(cost * weight)), sum_if(cost.isNotNull(), weight), 2, 2).alias(
                "Avg_Cost_Per_Job"
            ),
        )
    )
    return (
        t.technicians.select("TechID", "FullName", "DepartmentID")
        .join(totals, F.col("TechID") == F.col("TechnicianID"))
        .join(department_names(t), "DepartmentID", "left")
        .select(
            "TechID",
            "FullName",
            F.col("DeptName").alias("Technician_Dept"),
            "Total_Jobs",
            "Completed_Jobs",
            "Avg_Repair_Time",
            "Total_Cost_Handled",
            "Avg_Cost_Per_Job",
        )
    )


def technician_dashboard(t: Tables, clock: Clock) -> DataFrame:
    """Technicians with jobs in the last three months, busiest first."""
    totals = technician_totals(t, F.col("ActualDate") >= clock.months_ago(3))
    return (
        global_rank(totals, [RankBy("Total_Jobs", "Performance_Rank")])
        .orderBy("Performance_Rank", "TechID")
        .drop("TechID")
    )


def utilization_dashboard(t: Tables) -> DataFrame:
    """ACTIVE equipment by utilisation of a 30-day month."""
    rows = (
        t.equipment.filter(status_is(ACTIVE))
        .join(department_names(t), "DepartmentID")
        .select(
            "EquipmentID",
            "Name",
            "DeptName",
            "UtilizationHours",
            "PurchasePrice",
            domain.utilization_of_month(F.col("UtilizationHours")).alias("Utilization_Percentage"),
        )
    )
    return (
        global_rank(rows, [RankBy("UtilizationHours", "Utilization_Rank")])
        .orderBy(F.col("Utilization_Percentage").desc(), "EquipmentID")
        .drop("EquipmentID")
    )

"""Generated sample tables of any size, and history derived from jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.temporal import plus_days
from assetops.functions.text import joined
from assetops.operators.ranking import dense_numbers
from assetops.schema import COMPLETED, Tables, conform
from assetops.sources.mapping import pick

FIRST_EQUIPMENT, FIRST_TECHNICIAN, FIRST_JOB, FIRST_ALERT = 1000, 100, 5000, 10000


def _between(low: float, high: float, seed: int) -> Column:
    return F.rand(seed) * (high - low) + low


def synth(
    spark: SparkSession,
    n_equipment: int,
    n_maint: int,
    seed: int,
    clock: Clock,
    n_departments: int = 10,
    n_technicians: int = 15,
    n_alerts: int = 35,
) -> Tables:
    """Tables driven by the row number: categories cycle, dates step by 14
    days, money is drawn at random with a seed."""
    i = F.col("id")
    departments = spark.range(1, n_departments + 1).select(
        i.alias("DeptID"),
        joined("Department ", i).alias("DeptName"),
        joined("Block ", F.char(i % 26 + 64)).alias("Location"),
        joined("Dr. Head ", i).alias("HeadOfDept"),
    )
    technicians = spark.range(n_technicians).select(
        (i + FIRST_TECHNICIAN).alias("TechID"),
        joined("Technician ", i + 1).alias("FullName"),
        joined("078", F.floor(_between(1_000_000, 9_999_999, seed))).alias("ContactPhone"),
        pick(i, "Electrical", "Mechanical", "Biomedical", "General").alias("Specialty"),
        (i % n_departments + 1).alias("DepartmentID"),
        F.lit("ACTIVE").alias("Status"),
    )
    # Names and cycles of the generated rows.
    equipment = spark.range(n_equipment).select(
        (i + FIRST_EQUIPMENT).alias("EquipmentID"),
        joined("EQ-", F.lpad((i % 10000).cast("string"), 4, "0"), "-", F.lpad(F.floor(i / 10000).cast("string"), 3, "0")).alias(
            "SerialNumber"
        ),
        joined("Equipment ", i + 1).alias("Name"),
        pick(i, "IMAGING", "LABORATORY", "MONITORING", "SURGICAL", "LIFE_SUPPORT").alias("Category"),
        plus_days(clock.now, -F.floor(_between(500, 2000, seed + 1))).alias("PurchaseDate"),
        _between(1000, 100000, seed + 2).cast("decimal(15,2)").alias("PurchasePrice"),
        plus_days(clock.now, F.floor(_between(30, 400, seed + 3))).alias("WarrantyExpiry"),
        pick(i, "ACTIVE", "UNDER_MAINTENANCE", "INACTIVE", "DECOMMISSIONED").alias("Status"),
        (F.floor(_between(0, n_departments, seed + 4)) + 1).alias("DepartmentID"),
        plus_days(clock.now, (i * 11 % 240 - 60)).alias("NextMaintenanceDate"),
        F.floor(_between(0, 8760, seed + 5)).alias("UtilizationHours"),
    )
    actual = plus_days(clock.months_ago(24), i * 14 + i % 3)
    maintenance = spark.range(1, n_maint + 1).select(
        (i + FIRST_JOB - 1).alias("MaintenanceID"),
        (i % n_equipment + FIRST_EQUIPMENT).alias("EquipmentID"),
        (i % n_technicians + FIRST_TECHNICIAN).alias("TechnicianID"),
        pick(i, "PREVENTIVE", "CORRECTIVE", "EMERGENCY").alias("MaintenanceType"),
        plus_days(clock.months_ago(24), i * 14).alias("ScheduledDate"),
        actual.alias("ActualDate"),
        plus_days(actual, i % 2 + 1).alias("CompletionDate"),
        pick(i, "CANCELLED", "IN_PROGRESS", "SCHEDULED", *["COMPLETED"] * 7).alias("Status"),
        _between(100, 5000, seed + 6).cast("decimal(15,2)").alias("Cost"),
        joined("Maintenance ", i).alias("Description"),
        pick(
            i, "Filter replacement", "Battery replacement", "Sensor calibration", "Circuit board repair", "No parts replaced"
        ).alias("PartsReplaced"),
        F.lit("admin").alias("CreatedBy"),
    )
    alerts = spark.range(1, n_alerts + 1).select(
        (i + FIRST_ALERT - 1).alias("AlertID"),
        (i % n_equipment + FIRST_EQUIPMENT).alias("EquipmentID"),
        pick(i, "MAINTENANCE_DUE", "WARRANTY_EXPIRY", "CRITICAL_ISSUE", "LOW_USAGE", "HIGH_USAGE").alias("AlertType"),
        joined("Alert ", i).alias("IssueDescription"),
        pick(i, "LOW", "MEDIUM", "HIGH", "CRITICAL").alias("Priority"),
        clock.now.alias("DateReported"),
        pick(i, "PENDING", "IN_PROGRESS", "ESCALATED", *["RESOLVED"] * 7).alias("Status"),
        F.when(i % 10 < 3, i % n_technicians + FIRST_TECHNICIAN).alias("AssignedTo"),
    )
    jobs = conform(maintenance, "maintenance")
    empty = spark.range(0)
    return Tables(
        departments=conform(departments, "departments"),
        technicians=conform(technicians, "technicians"),
        equipment=conform(equipment, "equipment"),
        users=conform(empty, "users"),
        maintenance=jobs,
        history=conform(seed_history(jobs), "history"),
        alerts=conform(alerts, "alerts"),
        audit=conform(empty, "audit"),
        holidays=conform(empty, "holidays"),
    )


def seed_history(maintenance: DataFrame, limit: int | None = None) -> DataFrame:
    """One history row per COMPLETED job, numbered in job order, fixed a day
    after the work; downtime runs through 2..48 hours with the job id."""
    done = maintenance.filter(F.col("Status") == COMPLETED)
    if limit is not None:
        done = done.orderBy("MaintenanceID").limit(limit)
    rows = done.select(
        "EquipmentID",
        "MaintenanceID",
        "TechnicianID",
        F.col("Description").alias("ActionTaken"),
        plus_days(F.col("ActualDate"), 1).alias("DateFixed"),
        "Cost",
        (F.col("MaintenanceID") % 47 + 2).alias("DowntimeHours"),
        joined("Maintenance completed successfully. ", F.col("PartsReplaced"), ".").alias("Notes"),
    )
    return dense_numbers(rows, "MaintenanceID", "HistoryID")

"""Shared fact frames: jobs with their history, and one row per equipment.

Reports that join a job to its history and then group are computed from
per-key totals and weights instead of the joined rows: ``weight`` is the
number of rows a job would occupy after the left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions import domain
from assetops.functions.numeric import count_if, or_zero, sum_if
from assetops.schema import COMPLETED, Tables


def history_per_job(history: DataFrame) -> DataFrame:
    return (
        history.filter(F.col("MaintenanceID").isNotNull())
        .groupBy("MaintenanceID")
        .agg(
            F.count(F.lit(1)).alias("history_rows"),
            F.sum("DowntimeHours").alias("downtime"),
            F.count("DowntimeHours").alias("downtime_n"),
        )
    )


def jobs_with_history(t: Tables, keep: Column | None = None) -> DataFrame:
    """Jobs (one row each) with ``weight``, ``downtime`` and ``downtime_n``.

    Both sides of the join are unique on MaintenanceID, so no key is hot."""
    jobs = t.maintenance if keep is None else t.maintenance.filter(keep)
    return (
        jobs.join(history_per_job(t.history), "MaintenanceID", "left")
        .withColumn("weight", or_zero(F.col("history_rows")))
        .withColumn("weight", F.greatest("weight", F.lit(1)))
        .drop("history_rows")
    )


def completed_since(moment: Column) -> Column:
    return (F.col("Status") == COMPLETED) & (F.col("ActualDate") >= moment)


def type_is(kind: str) -> Column:
    return F.col("MaintenanceType") == kind


def per_type(weight: Column) -> list[Column]:
    """Weighted job counts by maintenance type."""
    return [
        or_zero(sum_if(type_is(kind), weight)).alias(kind.lower())
        for kind in ("PREVENTIVE", "CORRECTIVE", "EMERGENCY")
    ]


def with_age(equipment: DataFrame, clock: Clock) -> DataFrame:
    """Adds ``age_units`` (hundredths of a year)."""
    return equipment.withColumn("age_units", domain.age_units(F.col("PurchaseDate"), clock))


def with_health(equipment: DataFrame, clock: Clock) -> DataFrame:
    """Adds ``age_units`` and ``health_units`` (tenths): a pure projection, so
    reports that need no more than health never touch the job table."""
    return with_age(equipment, clock).withColumn(
        "health_units",
        domain.health_units(F.col("NextMaintenanceDate"), F.col("WarrantyExpiry"), F.col("age_units"), clock),
    )


def completed_jobs_per_equipment(t: Tables, clock: Clock, with_history: bool = False) -> DataFrame:
    """One pass over the job table: totals of COMPLETED jobs and the number of
    emergencies in the last twelve months; with history also the totals a
    job x history join would give."""
    done = F.col("Status") == COMPLETED
    jobs = jobs_with_history(t, done) if with_history else t.maintenance.filter(done)
    emergency = type_is("EMERGENCY")
    recent = F.col("ActualDate").between(clock.months_ago(12), clock.now)
    totals = [
        F.count(F.lit(1)).alias("completed_jobs"),
        count_if(emergency).alias("emergency_jobs"),
        F.sum("Cost").alias("completed_cost"),
        F.max("ActualDate").alias("last_completed"),
        count_if(emergency & recent).alias("recent_emergencies"),
    ]
    if with_history:
        weight = F.col("weight")
        totals += [
            F.sum(weight).alias("job_rows"),
            or_zero(sum_if(emergency, weight)).alias("emergency_rows"),
            F.sum(F.col("Cost") * weight).alias("cost_rows"),
            F.sum("downtime").alias("downtime"),
        ]
    return jobs.groupBy("EquipmentID").agg(*totals)


def features(
    t: Tables,
    clock: Clock,
    keep: Column | None = None,
    hourly_cents: int = 100,
    with_history: bool = False,
) -> DataFrame:
    """Every equipment column plus age, health, due and warranty status, job
    totals, failure risk and ROI: computed once, used by all reports."""
    pieces = t.equipment if keep is None else t.equipment.filter(keep)
    totals = completed_jobs_per_equipment(t, clock, with_history)
    sums = [c for c in totals.columns if c not in ("EquipmentID", "last_completed")]
    df = with_health(pieces, clock).join(totals, "EquipmentID", "left")
    df = df.withColumns({name: or_zero(F.col(name)) for name in sums})
    score = domain.as_score(F.col("health_units"))
    return (
        df.withColumn("Age_Years", domain.as_years(F.col("age_units")))
        .withColumn("Health_Score", score)
        .withColumn("Failure_Risk", domain.failure_risk(score, F.col("recent_emergencies")))
        .withColumn(
            "ROI_Percentage",
            domain.roi(F.col("UtilizationHours"), F.col("completed_cost"), F.col("PurchasePrice"), hourly_cents),
        )
        .withColumn("Maintenance_Status", domain.due_status(F.col("NextMaintenanceDate"), clock))
        .withColumn("Warranty_Status", domain.warranty_status(F.col("WarrantyExpiry"), clock))
    )

"""New equipment, serial numbers and generated alerts.

The procedures behind these operators are called by name but published
nowhere; what they do is chosen here from their call sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions import domain
from assetops.functions.numeric import rounded_ratio
from assetops.functions.text import joined
from assetops.operators.facts import features
from assetops.operators.ranking import append_with_keys
from assetops.operators.rules import warranty_alert_rows
from assetops.schema import ACTIVE, OPEN_ALERT, Tables


def validate_serial(df: DataFrame, serial: str, equipment: DataFrame) -> DataFrame:
    """Adds ``verdict``: INVALID, DUPLICATE or VALID."""
    taken = equipment.select(F.col("SerialNumber").alias("_taken")).filter("_taken is not null").distinct()
    fits = F.coalesce(F.col(serial).rlike(domain.SERIAL_PATTERN), F.lit(False))
    return (
        df.join(taken, F.col(serial) == F.col("_taken"), "left")
        .withColumn(
            "verdict",
            F.when(~fits, "INVALID").when(F.col("_taken").isNotNull(), "DUPLICATE").otherwise("VALID"),
        )
        .drop("_taken")
    )


def screen_equipment(new: DataFrame, t: Tables) -> DataFrame:
    """Adds ``reason``, NULL for acceptable rows.  ``new`` has a unique
    ``request_id``; of several requests for one serial the first counts."""
    known = t.departments.select(F.col("DeptID").alias("_dept"))
    taken = t.equipment.select(F.col("SerialNumber").alias("_taken")).distinct()
    first = (
        new.filter(F.col("SerialNumber").isNotNull())
        .groupBy(F.col("SerialNumber").alias("_serial"))
        .agg(F.min("request_id").alias("_first"))
    )
    return (
        new.join(known, F.col("DepartmentID") == F.col("_dept"), "left")
        .join(taken, F.col("SerialNumber") == F.col("_taken"), "left")
        .join(first, F.col("SerialNumber") == F.col("_serial"), "left")
        .withColumn(
            "reason",
            F.when(F.col("SerialNumber").isNull(), "serial number missing")
            .when(F.col("_dept").isNull() & F.col("DepartmentID").isNotNull(), "unknown department")
            .when(F.col("_taken").isNotNull() | (F.col("_first") < F.col("request_id")), "duplicate serial number"),
        )
        .drop("_dept", "_taken", "_serial", "_first")
    )


def add_equipment(new: DataFrame, t: Tables) -> tuple[DataFrame, DataFrame]:
    """(accepted rows with new EquipmentIDs and status ACTIVE, rejects with a
    reason)."""
    screened = screen_equipment(new, t)
    accepted = screened.filter(F.col("reason").isNull()).drop("reason").withColumn("Status", F.lit(ACTIVE))
    return (
        append_with_keys(t.equipment, accepted, "EquipmentID", "request_id"),
        screened.filter(F.col("reason").isNotNull()),
    )


def automated_alerts(t: Tables, clock: Clock, low: int = 10, high: int = 90) -> DataFrame:
    """Alerts due now for ACTIVE equipment, one rule per alert type, without
    those that repeat an open alert.  All rules read one feature frame, so the
    job table is scanned once; a piece raises at most five alerts."""
    pieces = features(t, clock, F.col("Status") == ACTIVE)
    due, name = F.col("NextMaintenanceDate"), F.col("Name")
    usage = F.col("UtilizationHours") * 100

    def alert(kind: str, when, priority, text):
        return F.when(
            when,
            F.struct(F.lit(kind).alias("AlertType"), priority.alias("Priority"), text.alias("IssueDescription")),
        )

    rules = F.array(
        alert(
            "MAINTENANCE_DUE",
            due <= clock.in_days(7),
            F.when(due < clock.now, "CRITICAL").otherwise("HIGH"),
            joined("Maintenance due for ", name),
        ),
        alert(
            "CRITICAL_ISSUE",
            F.col("Failure_Risk") == "CRITICAL",
            F.lit("CRITICAL"),
            joined("Critical failure risk for ", name),
        ),
        alert("LOW_USAGE", usage < low * 8760, F.lit("LOW"), joined("Low usage of ", name)),
        alert("HIGH_USAGE", usage > high * 8760, F.lit("MEDIUM"), joined("High usage of ", name)),
    )
    raised = pieces.select("EquipmentID", F.inline(F.filter(rules, lambda r: r.isNotNull())))
    warranty = warranty_alert_rows(t.equipment, clock).select(
        "EquipmentID", "AlertType", "Priority", "IssueDescription"
    )
    still_open = t.alerts.filter(F.col("Status").isin(*OPEN_ALERT)).select("EquipmentID", "AlertType").distinct()
    return (
        raised.unionByName(warranty)
        .join(still_open, ["EquipmentID", "AlertType"], "left_anti")
        .withColumn("Status", F.lit("PENDING"))
        .withColumn("DateReported", clock.now)
    )


def failure_risks(t: Tables, clock: Clock) -> DataFrame:
    return features(t, clock).select("EquipmentID", "Health_Score", "recent_emergencies", "Failure_Risk")


def returns(t: Tables, clock: Clock, hourly_cents: int = 100) -> DataFrame:
    return features(t, clock, hourly_cents=hourly_cents).select("EquipmentID", "ROI_Percentage")

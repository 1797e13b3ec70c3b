"""Change feeds derived from the test data.

An audited event names a piece of equipment; joining it with the row it
touches gives the old and new images.  ``events`` may be a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.functions.temporal import plus_days
from assetops.schema import Tables
from assetops.sources.mapping import pick

EQUIPMENT_IMAGE = ("EquipmentID", "Name", "Status", "WarrantyExpiry")
JOB_IMAGE = (
    "MaintenanceID",
    "EquipmentID",
    "TechnicianID",
    "ScheduledDate",
    "ActualDate",
    "CompletionDate",
    "Status",
    "Cost",
    "Description",
    "PartsReplaced",
)


def image(columns: tuple[str, ...], **changed: Column) -> Column:
    return F.struct(*((changed[c] if c in changed else F.col(c)).alias(c) for c in columns))


def _with_images(df: DataFrame, old: Column, new: Column) -> DataFrame:
    """Inserts have no old image, deletes no new one."""
    return df.select(
        "change_id",
        "statement_id",
        "table_name",
        "op",
        F.when(F.col("op") != "INSERT", old).alias("old"),
        F.when(F.col("op") != "DELETE", new).alias("new"),
        "username",
        "event_ts",
    )


def equipment_changes(events: DataFrame, t: Tables) -> DataFrame:
    """Changes of equipment: the status cycles with the event, every fifth
    event moves the warranty by 30 days."""
    key = F.col("change_id")
    rows = (
        events.filter(F.col("table_name") == "EQUIPMENT")
        .join(t.equipment.select(*EQUIPMENT_IMAGE), F.col("row_key") == F.col("EquipmentID"))
    )
    expiry = F.when(key % 5 == 0, plus_days(F.col("WarrantyExpiry"), 30)).otherwise(F.col("WarrantyExpiry"))
    status = F.when(F.col("op") == "INSERT", F.col("Status")).otherwise(
        pick(key, "UNDER_MAINTENANCE", "INACTIVE", "ACTIVE")
    )
    return _with_images(rows, image(EQUIPMENT_IMAGE), image(EQUIPMENT_IMAGE, Status=status, WarrantyExpiry=expiry))


def maintenance_changes(events: DataFrame, t: Tables) -> DataFrame:
    """Changes of jobs: each event touches the first job of its equipment."""
    first_job = t.maintenance.groupBy("EquipmentID").agg(
        F.min("MaintenanceID").alias("MaintenanceID"), F.min_by("Status", "MaintenanceID").alias("Status")
    )
    rows = (
        events.filter(F.col("table_name") == "MAINTENANCE")
        .join(first_job, F.col("row_key") == F.col("EquipmentID"))
    )
    columns = ("MaintenanceID", "EquipmentID", "Status")
    return _with_images(rows, image(columns), image(columns, Status=F.lit("CANCELLED")))


def decommission_requests(t: Tables) -> DataFrame:
    """One update per piece of equipment that sets its status to DECOMMISSIONED."""
    return t.equipment.select(
        F.col("EquipmentID").alias("change_id"),
        F.lit("UPDATE").alias("op"),
        image(EQUIPMENT_IMAGE).alias("old"),
        image(EQUIPMENT_IMAGE, Status=F.lit("DECOMMISSIONED")).alias("new"),
    )


def job_updates(jobs: DataFrame) -> DataFrame:
    """One status update per job: the old status cycles through open, closed
    and unknown ones."""
    key = F.col("MaintenanceID")
    before = F.when(key % 4 == 0, "IN_PROGRESS").when(key % 4 == 1, "SCHEDULED").when(key % 4 == 2, "COMPLETED")
    return jobs.select(
        key.alias("change_id"),
        F.lit("UPDATE").alias("op"),
        image(JOB_IMAGE, Status=before).alias("old"),
        image(JOB_IMAGE).alias("new"),
        F.concat(F.lit("tech"), F.col("TechnicianID").cast("string")).alias("username"),
        F.col("CompletionDate").alias("event_ts"),
    )


def warranty_updates(t: Tables) -> DataFrame:
    """Odd pieces are inserted, even ones updated; every third update leaves
    the warranty date as it was."""
    key = F.col("EquipmentID")
    old = F.when(key % 6 == 0, F.col("WarrantyExpiry")).otherwise(plus_days(F.col("WarrantyExpiry"), -365))
    op = F.when(key % 2 == 1, "INSERT").otherwise("UPDATE")
    return t.equipment.select(
        key.alias("change_id"),
        op.alias("op"),
        F.when(op == "UPDATE", image(EQUIPMENT_IMAGE, WarrantyExpiry=old)).alias("old"),
        image(EQUIPMENT_IMAGE).alias("new"),
        F.col("PurchaseDate").alias("event_ts"),
    )

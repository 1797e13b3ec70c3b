"""Adapter from the first-generation schema (six tables, mixed-case values)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.functions.temporal import is_weekend
from assetops.operators.quality import ParentRule, Rule, UniqueRule, max_length, not_null, one_of
from assetops.schema import Tables, conform
from assetops.sources import mapping

# First-generation statuses and what they become.
EQUIPMENT_STATUS = {
    "Working": "ACTIVE",
    "Faulty": "INACTIVE",
    "Under Maintenance": "UNDER_MAINTENANCE",
    "Decommissioned": "DECOMMISSIONED",
}
ALERT_STATUS = {"Open": "PENDING", "Pending": "PENDING", "In Progress": "RESOLVED", "Resolved": "RESOLVED"}


@dataclass(frozen=True)
class Gen1Tables:
    departments: DataFrame
    technicians: DataFrame
    equipment: DataFrame
    maintenance: DataFrame
    history: DataFrame
    alerts: DataFrame
    audit: DataFrame
    holidays: DataFrame


def translated(col: Column, table: dict[str, str], default: Column) -> Column:
    out = default
    for old, new in table.items():
        out = F.when(F.trim(col) == old, new).otherwise(out)
    return out


def adapt_alert_status(status: Column) -> Column:
    return F.when(status.isNull(), "PENDING").otherwise(translated(status, ALERT_STATUS, F.upper(F.trim(status))))


def adapt_gen1(g: Gen1Tables) -> Tables:
    """Second-generation shape: columns renamed, statuses harmonised, columns
    that did not exist yet are NULL.  A first-generation job is a finished one."""
    spark = g.departments.sparkSession
    day = F.col("MaintenanceDate")
    denied = F.col("ALLOWED") == "N"
    return Tables(
        departments=conform(g.departments, "departments"),
        technicians=conform(
            g.technicians.withColumnRenamed("Contact", "ContactPhone").withColumn("Status", F.lit("ACTIVE")),
            "technicians",
        ),
        equipment=conform(
            g.equipment.withColumn("Category", F.upper("Category")).withColumn(
                "Status", translated(F.col("Status"), EQUIPMENT_STATUS, F.upper(F.trim("Status")))
            ),
            "equipment",
        ),
        users=conform(spark.createDataFrame([], "UserID BIGINT"), "users"),
        maintenance=conform(
            g.maintenance.withColumns(
                {"ScheduledDate": day, "ActualDate": day, "CompletionDate": day, "Status": F.lit("COMPLETED")}
            ),
            "maintenance",
        ),
        history=conform(g.history, "history"),
        alerts=conform(g.alerts.withColumn("Status", adapt_alert_status(F.col("Status"))), "alerts"),
        audit=conform(
            g.audit.select(
                F.col("AUDIT_ID").alias("LogID"),
                F.upper("TABLE_NAME").alias("TableName"),
                F.col("OPERATION").alias("Operation"),
                F.regexp_replace("ROW_ID_VALUE", "^ID=", "").alias("PrimaryKeyValue"),
                F.col("USERNAME").alias("Username"),
                F.col("ATTEMPT_TIME").alias("Timestamp"),
                F.when(denied, "DENIED").otherwise("SUCCESS").alias("Status"),
                F.when(denied, F.col("REASON")).alias("ErrorMessage"),
            ),
            "audit",
        ),
        holidays=conform(
            g.holidays.select(
                F.col("DESCRIPTION").alias("HolidayName"),
                F.col("HOLIDAY_DATE").cast("date").alias("HolidayDate"),
                F.year("HOLIDAY_DATE").alias("Year"),
            ),
            "holidays",
        ),
    )


def gen1_rules() -> list[Rule]:
    """The constraints of the first-generation schema."""
    return [
        *not_null("departments", "DeptID", "DeptName"),
        UniqueRule("departments", "DeptName"),
        *not_null("technicians", "TechID", "FullName"),
        UniqueRule("technicians", "Contact"),
        *not_null("equipment", "EquipmentID", "Name", "Category", "Status"),
        one_of("equipment", "Status", "Working", "Faulty", "Under Maintenance", "Decommissioned"),
        one_of("equipment", "Category", "Imaging", "Laboratory", "Monitoring", "Surgical", "General"),
        ParentRule("equipment", "DepartmentID", "departments", "DeptID"),
        *not_null("maintenance", "EquipmentID", "TechnicianID", "MaintenanceDate"),
        ParentRule("maintenance", "EquipmentID", "equipment", "EquipmentID"),
        ParentRule("maintenance", "TechnicianID", "technicians", "TechID"),
        *not_null("history", "EquipmentID", "TechnicianID", "ActionTaken"),
        *not_null("alerts", "EquipmentID", "IssueDescription", "DateReported"),
        one_of("alerts", "Status", "Pending", "Resolved"),
        *max_length("alerts", IssueDescription=200, Status=20),
        *max_length("technicians", Contact=20),
    ]


def gen1_testdata(spark: SparkSession, sf_dir: str) -> Gen1Tables:
    """First-generation tables from the test data, dirty alert statuses included."""
    t = mapping.map_testdata(spark, sf_dir)
    part = mapping.raw(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    events = mapping.raw(spark, sf_dir, "events")
    event = F.col("event_id")
    open_day = is_weekend(F.col("ts"))
    alert_status = F.when(event % 6 != 4, mapping.pick(event, "Pending", "Resolved", " Open ", "In Progress", "", "Pending"))
    return Gen1Tables(
        departments=t.departments.select("DeptID", "DeptName", "Location", "HeadOfDept"),
        technicians=t.technicians.select(
            "TechID",
            "FullName",
            F.concat(F.lit("078"), F.lpad((F.col("TechID") % 997).cast("string"), 7, "0")).alias("Contact"),
            "Specialty",
        ),
        equipment=part.select(
            key.alias("EquipmentID"),
            F.col("p_name").alias("Name"),
            mapping.pick(size, "Imaging", "Laboratory", "Monitoring", "Surgical", "General").alias("Category"),
            mapping.pick(key + size, "Working", "Under Maintenance", "Faulty", "Decommissioned").alias("Status"),
            (key % 25).alias("DepartmentID"),
        ),
        maintenance=t.maintenance.select(
            "MaintenanceID",
            "EquipmentID",
            "TechnicianID",
            F.col("ActualDate").alias("MaintenanceDate"),
            "Cost",
            "Description",
        ),
        history=t.history.select("HistoryID", "EquipmentID", "TechnicianID", "ActionTaken", "DateFixed", "Cost"),
        alerts=events.filter(F.col("event_type") == "error").select(
            event.alias("AlertID"),
            F.col("user_id").alias("EquipmentID"),
            F.concat(F.lit("Issue reported for equipment "), F.col("user_id").cast("string")).alias(
                "IssueDescription"
            ),
            F.col("ts").alias("DateReported"),
            alert_status.alias("Status"),
        ),
        audit=events.filter(F.col("event_type") != "error").select(
            event.alias("AUDIT_ID"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("USERNAME"),
            F.when(F.col("event_type") == "signup", "INSERT")
            .when(F.col("event_type") == "click", "DELETE")
            .otherwise("UPDATE")
            .alias("OPERATION"),
            F.lit("Equipment").alias("TABLE_NAME"),
            F.concat(F.lit("ID="), F.col("user_id").cast("string")).alias("ROW_ID_VALUE"),
            F.col("ts").alias("ATTEMPT_TIME"),
            F.when(open_day, "Y").otherwise("N").alias("ALLOWED"),
            F.when(open_day, "Allowed").otherwise("Operation disallowed: Weekday (Mon-Fri)").alias("REASON"),
        ),
        holidays=t.holidays.select(
            F.col("HolidayDate").cast("timestamp_ntz").alias("HOLIDAY_DATE"), F.col("HolidayName").alias("DESCRIPTION")
        ),
    )

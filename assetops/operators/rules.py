"""Business rules over change events.

A change feed is a DataFrame ``change_id, statement_id, table_name, op, old,
new, username, event_ts`` with ``old``/``new`` structs holding the row images.
Every rule is a pure DataFrame function, so it serves batch and streaming.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.numeric import rounded_ratio
from assetops.functions.temporal import day_label, is_weekend, weekday_name, whole_days, whole_seconds
from assetops.functions.text import described, joined
from assetops.schema import ACTIVE, COMPLETED, DECOMMISSIONED, OPEN_ALERT, OPEN_JOB


@dataclass(frozen=True)
class TableSpec:
    """How a table's changes are audited."""

    name: str
    key: str
    text: tuple[str, ...]
    error_code: int


# Audited tables, their text columns and error codes.
EQUIPMENT_SPEC = TableSpec("EQUIPMENT", "EquipmentID", ("EquipmentID", "Name", "Status"), -20001)
MAINTENANCE_SPEC = TableSpec("MAINTENANCE", "MaintenanceID", ("MaintenanceID", "EquipmentID", "Status"), -20002)


def holiday_days(holidays: DataFrame) -> DataFrame:
    """One row per holiday: a calendar may list a day more than once, and a
    join with it must not multiply changes.  At most one row per calendar day
    remains, which is what makes the broadcast below safe at any data size."""
    return holidays.groupBy(F.col("HolidayDate").alias("holiday_day")).agg(
        F.min_by("HolidayName", "HolidayID").alias("holiday_name")
    )


def with_holiday(df: DataFrame, ts_col: str, holidays: DataFrame) -> DataFrame:
    """Adds ``is_holiday`` and ``holiday_name`` for the day of ``ts_col``."""
    days = F.broadcast(holiday_days(holidays))
    return (
        df.join(days, F.col(ts_col).cast("date") == F.col("holiday_day"), "left")
        .withColumn("is_holiday", F.col("holiday_day").isNotNull())
        .drop("holiday_day")
    )


def calendar_gate(df: DataFrame, ts_col: str, holidays: DataFrame, policy: str = "weekend_first") -> DataFrame:
    """Adds ``allowed`` and ``reason``.

    ``weekend_first``: weekends are open even on a holiday.
    ``weekday_first``: weekdays are closed, and so is a holiday on a weekend.
    """
    weekend = is_weekend(F.col(ts_col))
    gated = with_holiday(df, ts_col, holidays)
    if policy == "weekend_first":
        return gated.withColumn("allowed", weekend).withColumn(
            "reason", F.when(weekend, "weekend").when(F.col("is_holiday"), "public holiday").otherwise("weekday")
        )
    if policy == "weekday_first":
        return gated.withColumn("allowed", weekend & ~F.col("is_holiday")).withColumn(
            "reason",
            F.when(~weekend, "Operation disallowed: Weekday (Mon-Fri)")
            .when(F.col("is_holiday"), joined("Operation disallowed: Public holiday (", F.col("holiday_name"), ")"))
            .otherwise("Allowed"),
        )
    raise ValueError(f"unknown policy {policy!r}")


def yes_no(flag: Column) -> Column:
    return F.when(flag, "YES").otherwise("NO")


def day_info(df: DataFrame, date_col: str, holidays: DataFrame) -> DataFrame:
    """One descriptive line per date."""
    day = F.col(date_col)
    weekend = is_weekend(day)
    return with_holiday(df, date_col, holidays).select(
        day,
        joined(
            "Date: ",
            day_label(day),
            ", Day: ",
            weekday_name(day),
            ", Weekend: ",
            yes_no(weekend),
            ", Holiday: ",
            yes_no(F.col("is_holiday")),
            ", Allowed: ",
            yes_no(weekend),
        ).alias("day_info"),
    )


# The texts of denials, guards, completions and warranty alerts.
def denial_text(op: Column, table: Column, is_holiday: Column, day_name: Column) -> Column:
    return joined(
        "Operation ",
        op,
        " on ",
        table,
        " table is not allowed on ",
        F.when(is_holiday, joined("public holiday (", day_name, ")")).otherwise("weekdays (Monday-Friday)"),
        ". Allowed only on weekends (Saturday and Sunday).",
    )


def _images(spec: TableSpec) -> tuple[Column, Column, Column]:
    """(key as text, old text, new text); images absent for the op are NULL."""
    text = list(spec.text)
    return (
        F.coalesce(F.col(f"new.{spec.key}"), F.col(f"old.{spec.key}")).cast("string"),
        F.when(F.col("op") != "INSERT", described("old", text)),
        F.when(F.col("op") != "DELETE", described("new", text)),
    )


def audit_changes(changes: DataFrame, spec: TableSpec, holidays: DataFrame) -> DataFrame:
    """One audit row per change, accepted or denied."""
    key, old_text, new_text = _images(spec)
    gated = calendar_gate(changes, "event_ts", holidays)
    return gated.select(
        F.col("change_id").alias("LogID"),
        F.lit(spec.name).alias("TableName"),
        F.col("op").alias("Operation"),
        key.alias("PrimaryKeyValue"),
        old_text.alias("OldValue"),
        new_text.alias("NewValue"),
        F.col("username").alias("Username"),
        F.col("event_ts").alias("Timestamp"),
        F.when(F.col("allowed"), "SUCCESS").otherwise("DENIED").alias("Status"),
        F.when(
            ~F.col("allowed"),
            denial_text(F.col("op"), F.lit(spec.name), F.col("is_holiday"), weekday_name(F.col("event_ts"))),
        ).alias("ErrorMessage"),
    )


def statement_audit(changes: DataFrame, spec: TableSpec, holidays: DataFrame) -> DataFrame:
    """Denied rows as collected per statement and written in one append."""
    key, old_text, new_text = _images(spec)
    return (
        calendar_gate(changes, "event_ts", holidays)
        .filter(~F.col("allowed"))
        .select(
            "statement_id",
            "change_id",
            F.lit(spec.name).alias("TableName"),
            F.col("op").alias("Operation"),
            key.alias("PrimaryKeyValue"),
            old_text.alias("OldValue"),
            new_text.alias("NewValue"),
            F.col("username").alias("Username"),
            F.lit("DENIED").alias("Status"),
            statement_text(F.col("op"), F.lit(spec.name)).alias("ErrorMessage"),
        )
    )


# The error of a denied statement and its text.
STATEMENT_ERROR = -20003
HOT_SHARE = 1024  # a statement with a 1024th of all changes is hot: at most so many are
STATEMENT_SALTS = 64  # tasks that a hot statement's changes are spread over


def statement_text(op: Column, table: Column) -> Column:
    return joined("Operation ", op, " on ", table, " table is not allowed on weekdays or holidays.")


def gate_changes(changes: DataFrame, holidays: DataFrame, atomic_by: str | None = None) -> DataFrame:
    """Adds ``accepted``, ``error_code`` and ``message`` in one flagged frame, so
    that a caller who stores both sides writes it once, partitioned by side.

    Row by row a denied change carries its table's error.  With ``atomic_by``
    one denied change denies its whole statement, and every change of it carries
    the statement's first error: one row per denied statement, reduced map-side
    and joined back, so no task ever holds all changes of a statement."""
    gated = calendar_gate(changes, "event_ts", holidays)
    denied, op, table = ~F.col("allowed"), F.col("op"), F.col("table_name")
    if atomic_by is None:
        code = F.lit(None).cast("int")
        for spec in (EQUIPMENT_SPEC, MAINTENANCE_SPEC):
            code = F.when(table == spec.name, spec.error_code).otherwise(code)
        text = denial_text(op, table, F.col("is_holiday"), weekday_name(F.col("event_ts")))
        return gated.withColumns(
            {"accepted": F.col("allowed"), "error_code": F.when(denied, code), "message": F.when(denied, text)}
        )
    failed = gated.filter(denied).groupBy(F.col(atomic_by).alias("failed_id")).agg(
        F.min_by(statement_text(op, table), "change_id").alias("message")
    )
    # Adaptive execution does not split a side that meets an aggregate, so hot
    # statements are spread by a salt; only they are repeated on the other side.
    total = changes.count()
    sizes = changes.groupBy(F.col(atomic_by).alias("hot_id")).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(sizes.where(F.col("n") * HOT_SHARE >= total).select("hot_id"))
    is_hot = F.col("hot_id").isNotNull()
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(STATEMENT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    failed = failed.join(hot, F.col("failed_id") == F.col("hot_id"), "left").select(
        "failed_id", "message", F.explode(salts).alias("failed_salt")
    )
    own = F.when(is_hot, F.pmod(F.xxhash64("change_id"), F.lit(STATEMENT_SALTS)).cast("int")).otherwise(0)
    gated = gated.join(hot, F.col(atomic_by) == F.col("hot_id"), "left").withColumn("own_salt", own).drop("hot_id")
    hit = F.col("failed_id").isNotNull()
    return (
        gated.join(failed, (F.col(atomic_by) == F.col("failed_id")) & (F.col("own_salt") == F.col("failed_salt")), "left")
        .withColumns({"accepted": ~hit & F.col("allowed"), "error_code": F.when(hit, STATEMENT_ERROR)})
        .drop("failed_id", "failed_salt", "own_salt")
    )


def split_changes(changes: DataFrame, holidays: DataFrame, atomic_by: str | None = None) -> DataFrame:
    """The changes with ``side``: accepted, or rejected with error and message."""
    gated = gate_changes(changes, holidays, atomic_by)
    return gated.withColumn("side", F.when(F.col("accepted"), "accepted").otherwise("rejected")).drop("accepted")


def decommission_guard(changes: DataFrame, maintenance: DataFrame, alerts: DataFrame) -> DataFrame:
    """Verdict for every UPDATE that sets a status of DECOMMISSIONED."""
    asked = changes.filter((F.col("op") == "UPDATE") & (F.col("new.Status") == DECOMMISSIONED)).withColumn(
        "EquipmentID", F.col("old.EquipmentID")
    )
    busy = (
        maintenance.filter(F.col("Status").isin(*OPEN_JOB))
        .groupBy("EquipmentID")
        .agg(F.count(F.lit(1)).alias("open_jobs"))
    )
    warned = (
        alerts.filter(F.col("Status").isin(*OPEN_ALERT))
        .groupBy("EquipmentID")
        .agg(F.count(F.lit(1)).alias("open_alerts"))
    )
    return guard_verdict(
        asked.join(busy, "EquipmentID", "left").join(warned, "EquipmentID", "left"),
        F.col("open_jobs").isNotNull(),
        F.col("open_alerts").isNotNull(),
        F.col("old.Status"),
        F.col("new.Status"),
    )


def guard_verdict(
    asked: DataFrame, has_jobs: Column, has_alerts: Column, old: Column, new: Column, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Verdict, error and texts of decommission requests, by what is open."""
    subject = joined("Cannot decommission equipment ID ", F.col("EquipmentID"))
    return asked.select(
        "change_id",
        "EquipmentID",
        F.when(has_jobs | has_alerts, "DENIED").otherwise("ALLOWED").alias("verdict"),
        F.when(has_jobs, -20004).when(has_alerts, -20005).alias("error_code"),
        F.when(
            has_jobs,
            joined(subject, " with active maintenance. Complete or cancel all maintenance first."),
        )
        .when(has_alerts, joined(subject, " with pending alerts. Resolve all alerts first."))
        .alias("message"),
        F.when(~has_jobs & ~has_alerts, joined("Status: ", old)).alias("OldValue"),
        F.when(~has_jobs & ~has_alerts, joined("Status: ", new, " (DECOMMISSIONED)")).alias("NewValue"),
        *carry,
    )


def completions(changes: DataFrame) -> DataFrame:
    """Updates that move a job to COMPLETED; an unknown old status never fires."""
    return changes.filter(
        (F.col("op") == "UPDATE") & (F.col("new.Status") == COMPLETED) & (F.col("old.Status") != COMPLETED)
    )


def completion_history(changes: DataFrame) -> DataFrame:
    done = completions(changes)
    tenths = rounded_ratio(whole_seconds(F.col("new.ActualDate"), F.col("new.ScheduledDate")), F.lit(3600), 1)
    return done.select(
        "change_id",
        "new.EquipmentID",
        "new.MaintenanceID",
        "new.TechnicianID",
        F.col("new.Description").alias("ActionTaken"),
        F.col("new.CompletionDate").alias("DateFixed"),
        "new.Cost",
        F.coalesce(tenths, F.lit(0)).alias("DowntimeHours"),
        joined("Maintenance completed. Parts: ", F.coalesce(F.col("new.PartsReplaced"), F.lit("None"))).alias("Notes"),
    )


def completion_equipment_updates(changes: DataFrame, clock: Clock) -> DataFrame:
    """Last maintenance date and time of change per equipment: of several
    completions in one batch the latest change wins, as it would row by row.
    ``change_id`` names the winner, so updates of several batches merge."""
    return (
        completions(changes)
        .groupBy(F.col("new.EquipmentID").alias("EquipmentID"))
        .agg(
            F.max_by("new.CompletionDate", "change_id").alias("LastMaintenanceDate"),
            F.max("change_id").alias("change_id"),
        )
        .withColumn("ModifiedDate", clock.now)
    )


def completion_audit(changes: DataFrame) -> DataFrame:
    return completions(changes).select(
        "change_id",
        F.lit("MAINTENANCE").alias("TableName"),
        F.lit("UPDATE").alias("Operation"),
        F.col("new.MaintenanceID").cast("string").alias("PrimaryKeyValue"),
        joined("Status: ", F.col("old.Status")).alias("OldValue"),
        joined("Status: ", F.col("new.Status"), ", Completed: ", day_label(F.col("new.CompletionDate"))).alias(
            "NewValue"
        ),
        F.col("username").alias("Username"),
        F.lit("SUCCESS").alias("Status"),
    )


def completion_effects(changes: DataFrame, clock: Clock) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(history rows, equipment updates, audit rows) of completed jobs."""
    return completion_history(changes), completion_equipment_updates(changes, clock), completion_audit(changes)


def warranty_alert_rows(df: DataFrame, clock: Clock, carry: tuple[str, ...] = ()) -> DataFrame:
    """Alerts for ACTIVE equipment (columns of the equipment table) whose
    warranty ends in 1 to 90 days; ``carry`` columns are passed through."""
    expiry, name = F.col("WarrantyExpiry"), F.col("Name")
    due = (
        (F.col("Status") == ACTIVE)
        & (expiry >= clock.in_days(1))
        & (expiry <= clock.in_days(90))
    )
    return df.filter(due).select(
        *carry,
        "EquipmentID",
        F.lit("WARRANTY_EXPIRY").alias("AlertType"),
        joined(
            "Warranty for ", name, " expires in ", whole_days(expiry, clock.now), " days (on ", day_label(expiry), ")"
        ).alias("IssueDescription"),
        F.when(expiry <= clock.in_days(30), "HIGH")
        .when(expiry <= clock.in_days(60), "MEDIUM")
        .otherwise("LOW")
        .alias("Priority"),
        F.lit("PENDING").alias("Status"),
        clock.now.alias("DateReported"),
    )


def warranty_alerts(changes: DataFrame, clock: Clock, carry: tuple[str, ...] = ("change_id",)) -> DataFrame:
    """Alerts raised by inserts and by changes of the warranty date."""
    fired = changes.filter(
        (F.col("op") == "INSERT")
        | ((F.col("op") == "UPDATE") & ~F.col("new.WarrantyExpiry").eqNullSafe(F.col("old.WarrantyExpiry")))
    )
    flat = fired.select(*carry, "new.EquipmentID", "new.Name", "new.Status", "new.WarrantyExpiry")
    return warranty_alert_rows(flat, clock, carry)


def holiday_calendar(base: DataFrame, extra: DataFrame, clock: Clock | None = None) -> DataFrame:
    """``base`` without its test holidays, plus ``extra`` and, with a clock,
    this week's Monday and Tuesday; one row per date, the base row first."""
    kept = base.filter(~F.col("HolidayName").like("Test Holiday%")).select("HolidayName", "HolidayDate")
    added = kept.withColumn("rank", F.lit(0)).unionByName(
        extra.select("HolidayName", "HolidayDate").withColumn("rank", F.lit(1))
    )
    if clock is not None:
        added = added.unionByName(this_week_holidays(base, clock).withColumn("rank", F.lit(2)))
    return (
        added.groupBy("HolidayDate")
        .agg(F.min(F.struct("rank", "HolidayName")).getField("HolidayName").alias("HolidayName"))
        .select("HolidayName", "HolidayDate", F.year("HolidayDate").alias("Year"))
    )


def this_week_holidays(like: DataFrame, clock: Clock) -> DataFrame:
    from datetime import timedelta

    number = clock.as_of.isoweekday() % 7 + 1  # 1 = Sunday
    rows = []
    for target, label in ((2, "Monday"), (3, "Tuesday")):
        offset = number - target  # the remainder keeps the sign of the dividend
        back = offset % 7 if offset >= 0 else -((-offset) % 7)
        rows.append((f"Test Holiday - {label}", (clock.today - timedelta(days=back)).date()))
    return like.sparkSession.createDataFrame(rows, "HolidayName STRING, HolidayDate DATE")


def purge(df: DataFrame, date_col: str, clock: Clock, days: int = 180) -> DataFrame:
    """The rows with ``side``: purged if older than ``days``, else kept, undated
    rows too.  One frame, to be written partitioned by side."""
    old = F.col(date_col) < clock.in_days(-days)
    return df.withColumn("side", F.when(old, "purged").otherwise("kept"))


def apply_updates(base: DataFrame, updates: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Overwrite the columns named in ``updates`` for its keys; unknown keys
    change nothing, as in an UPDATE statement.  ``updates`` has one row per
    key, or names in ``order_by`` the column whose highest value wins."""
    columns = [c for c in updates.columns if c not in (key, order_by)]
    patch = F.struct(*columns)
    if order_by is None:
        patches = updates.select(key, patch.alias("_patch"))
    else:
        patches = updates.groupBy(key).agg(F.max_by(patch, F.col(order_by)).alias("_patch"))
    hit = F.col("_patch").isNotNull()
    return base.join(patches, key, "left").select(
        *(
            F.when(hit, F.col(f"_patch.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in base.columns
        )
    )

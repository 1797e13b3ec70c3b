"""Every query by name, over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions import domain
from assetops.functions.numeric import count_if
from assetops.functions.portable import portable
from assetops.functions.temporal import clock_label, day_label
from assetops.operators import asof, constraint_state, intake, quality, relational, rules
from assetops.operators.facts import with_age
from assetops.operators.ranking import RankBy, append_with_keys, global_rank, random_parents
from assetops.plans import due, metrics, refresh, reports, snapshots
from assetops.schema import ACTIVE, KEYS, SCHEMAS, Tables
from assetops.sources import feeds, gen1, synth, versioned
from assetops.sources import tables as store
from assetops.sources.mapping import (
    AS_OF,
    AUDIT_AS_OF,
    RAW,
    as_changes,
    audit_rows,
    audited_events,
    map_testdata,
    order_holidays,
    raw,
)
from assetops.streaming import jobs as streams
from assetops.streaming import stateful
from assetops.storage import cut, run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOURLY_CENTS = 12_000  # value of an hour of use in the test data


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return add


def on_tables(name: str, fn: Callable[[Tables], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(map_testdata(spark, sf_dir)))


# Sources, sinks and snapshots

# Columns the mapping leaves NULL; PasswordHash is filled with a constant.
NOT_MAPPED = {
    "departments": "ContactEmail Budget CreatedDate ModifiedDate",
    "technicians": "ContactPhone Email HireDate CreatedDate",
    "equipment": "Manufacturer Model LastMaintenanceDate CreatedDate ModifiedDate",
    "users": "Email LastLogin CreatedDate PasswordHash",
    "maintenance": "CreatedBy CreatedDate",
    "history": "Notes CreatedDate",
    "alerts": "AssignedTo ResolutionNotes CreatedDate",
    "audit": "OldValue NewValue",
    "holidays": "CreatedDate",
}
MAPPED_COLUMNS = {
    name: [c for c in schema.names if c not in NOT_MAPPED[name].split()] for name, schema in SCHEMAS.items()
}
for _name, _columns in MAPPED_COLUMNS.items():
    on_tables(f"map_{_name}", lambda t, n=_name, c=_columns: getattr(t, n).select(*c))


def _stored(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Store the canonical tables, load them again and sum up every column that has values."""
    folder = run_folder(spark, "tables")
    store.write_tables(map_testdata(spark, sf_dir, staged=True), folder, fmt)
    return store.column_totals(store.load_tables(spark, folder, fmt)).where("n > 0")


query("load_tables")(lambda spark, sf_dir: _stored(spark, sf_dir, "parquet"))
query("load_tables_csv")(lambda spark, sf_dir: _stored(spark, sf_dir, "csv"))


@query("adapt_gen1_equipment")
def _adapt_equipment(spark, sf_dir):
    t = gen1.adapt_gen1(gen1.gen1_testdata(spark, sf_dir))
    return t.equipment.select("EquipmentID", "Name", "Category", "Status", "DepartmentID")


@query("adapt_gen1_maintenance")
def _adapt_maintenance(spark, sf_dir):
    t = gen1.adapt_gen1(gen1.gen1_testdata(spark, sf_dir))
    return t.maintenance.select("MaintenanceID", "EquipmentID", "ScheduledDate", "ActualDate", "Status", "Cost")


@query("adapt_gen1_alerts")
def _adapt_alerts(spark, sf_dir):
    t = gen1.adapt_gen1(gen1.gen1_testdata(spark, sf_dir))
    return t.alerts.select("AlertID", "EquipmentID", "IssueDescription", "DateReported", "Status")


@query("adapt_gen1_audit")
def _adapt_audit(spark, sf_dir):
    t = gen1.adapt_gen1(gen1.gen1_testdata(spark, sf_dir))
    return t.audit.select("LogID", "TableName", "Operation", "PrimaryKeyValue", "Username", "Status", "ErrorMessage")


@query("complete_to_history_seed")
def _seed(spark, sf_dir):
    return synth.seed_history(map_testdata(spark, sf_dir).maintenance)


on_tables("sample_rows", lambda t: relational.sample_rows(t.equipment.select("EquipmentID", "Name"), 20, 7, "EquipmentID"))


def _random_parents(t: Tables) -> DataFrame:
    """Every alert with a piece and a technician drawn from the active ones."""
    active = F.col("Status") == ACTIVE
    parents = {
        "Drawn_Equipment": t.equipment.where(active).select("EquipmentID"),
        "Drawn_Technician": t.technicians.where(active).select("TechID"),
    }
    return random_parents(t.alerts.select("AlertID", "EquipmentID"), "AlertID", parents, seed=7)


on_tables("random_parents", _random_parents)
on_tables("snapshot_daily_equipment_status", lambda t: snapshots.daily_equipment_status(t, AS_OF))
on_tables("snapshot_monthly_maintenance", lambda t: snapshots.monthly_maintenance_summary(t, AS_OF))


@query("report_sink")
def _report_sink(spark, sf_dir):
    """Store the cost report for its month and read the stored period."""
    report = reports.maintenance_cost(map_testdata(spark, sf_dir), AS_OF)
    path = store.write_report(report, "maintenance_cost", AS_OF.as_of, run_folder(spark, "reports"), "monthly")
    return spark.read.parquet(path).select("report_date", "Month", "DeptName", "Maintenance_Count", "Total_Cost")


# Projections, filters and predicates

on_tables(
    "sample_equipment",
    lambda t: relational.top_k(
        t.equipment.select("EquipmentID", "SerialNumber", "Name", "Category", "Status", "DepartmentID"),
        [],
        "EquipmentID",
        10,
    ),
)


def holiday_list(holidays: DataFrame) -> DataFrame:
    return holidays.select(
        "HolidayID", "HolidayName", day_label(F.col("HolidayDate")).alias("Holiday_Day"), "Year"
    ).orderBy("HolidayDate")


@query("holiday_list")
def _holiday_list(spark, sf_dir):
    return holiday_list(order_holidays(spark, sf_dir))


def recent_audit(audit: DataFrame, n: int) -> DataFrame:
    when = F.col("Timestamp")
    return (
        audit.orderBy(F.col("LogID").desc())
        .limit(n)
        .select(
            "LogID",
            "TableName",
            "Operation",
            "PrimaryKeyValue",
            "Username",
            F.concat_ws(" ", day_label(when), clock_label(when)).alias("Time"),
            "Status",
            F.substring("ErrorMessage", 1, 50).alias("Error"),
        )
    )


on_tables("recent_audit", lambda t: recent_audit(t.audit, 50))


def pending_alerts(t: Tables) -> DataFrame:
    return t.alerts.filter(F.col("Status") == "PENDING").select("AlertID", "EquipmentID", "IssueDescription")


on_tables("pending_alerts", pending_alerts)


def audit_counts(audit: DataFrame, clock) -> DataFrame:
    """Audited and denied operations, in all and in the last 24 hours."""
    denied, recent = F.col("Status") == "DENIED", F.col("Timestamp") >= clock.in_days(-1)
    return audit.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(denied).alias("denied"),
        count_if(recent).alias("total_24h"),
        count_if(recent & denied).alias("denied_24h"),
    )


on_tables("denied_audit_count", lambda t: audit_counts(t.audit, AUDIT_AS_OF))
on_tables(
    "maintenance_due_soon",
    lambda t: t.equipment.filter((F.col("Status") == ACTIVE) & F.col("NextMaintenanceDate").isNotNull()).select(
        "EquipmentID",
        "Name",
        "NextMaintenanceDate",
        domain.due_status(F.col("NextMaintenanceDate"), AS_OF).alias("Maintenance_Status"),
    ),
)
on_tables(
    "warranty_expiring",
    lambda t: t.equipment.filter(F.col("WarrantyExpiry").isNotNull()).select(
        "EquipmentID",
        "Name",
        "WarrantyExpiry",
        domain.warranty_window(F.col("WarrantyExpiry"), AS_OF).alias("Warranty_Status"),
    ),
)
on_tables(
    "warranty_status",
    lambda t: t.equipment.select(
        "EquipmentID", domain.warranty_status(F.col("WarrantyExpiry"), AS_OF).alias("Warranty_Status")
    ),
)
on_tables("distinct_status", lambda t: relational.distinct_values(t.alerts, "Status"))
on_tables("urgent_equipment", lambda t: reports.urgent_equipment(t, AS_OF))
on_tables("predictive_top", lambda t: reports.predictive_top(t, AS_OF))
on_tables("recent_audit_days", lambda t: reports.recent_audit_days(t.audit, AUDIT_AS_OF))

# Data quality

on_tables("row_counts", quality.row_counts)
on_tables("data_statistics", quality.data_statistics)


PAST = 1_000_000_000  # beyond every key of the test data


def dirty_keys(t: Tables) -> Tables:
    """The whole tables with dirty foreign keys: department 3 is written past
    the range of departments, every fifth piece's key past that of pieces and
    every seventh technician's past that of technicians, some keys are NULL."""
    dept, piece, tech, job = (F.col(c) for c in ("DepartmentID", "EquipmentID", "TechnicianID", "MaintenanceID"))
    return t.but(
        equipment=t.equipment.withColumn(
            "DepartmentID", F.when(dept == 3, dept + PAST).when(piece % 30 != 11, dept)
        ),
        maintenance=t.maintenance.withColumns(
            {
                "EquipmentID": F.when(piece % 5 == 0, piece + PAST).when(job % 40 != 7, piece),
                "TechnicianID": F.when(tech % 7 == 3, tech + PAST).when(job % 50 != 9, tech),
            }
        ),
    )


on_tables(
    "orphan_equipment", lambda t: quality.orphan_equipment(dirty_keys(t)).select("EquipmentID", "DepartmentID")
)
on_tables(
    "orphan_maintenance",
    lambda t: quality.orphan_maintenance(dirty_keys(t)).select("MaintenanceID", "EquipmentID", "TechnicianID"),
)
on_tables("fk_verification", lambda t: quality.fk_report(dirty_keys(t)))
on_tables("fk_verification_clean", quality.fk_report)
on_tables("completeness", lambda t: quality.completeness(dirty_keys(t)))
on_tables("status_distribution", quality.status_distribution)


def staged(t: Tables) -> Tables:
    """Jobs and history written out once: a query that reads them many times
    should not derive them as often."""
    return t.but(maintenance=cut(t.maintenance), history=cut(t.history))


on_tables("constraint_violations", lambda t: quality.violations(dict(staged(t).items()), quality.canonical_rules()))


on_tables(
    "constraint_rejects",
    lambda t: quality.rejects(dict(staged(dirty_keys(t)).items()), quality.canonical_rules(), KEYS),
)


@query("constraint_violations_incremental")
def _violations_incremental(spark, sf_dir):
    """The counts of tables with dirty keys, and without some jobs, after the feed
    that cleans the keys, brings the jobs and deletes doubled pieces."""
    t = map_testdata(spark, sf_dir, staged=True)
    dirty = dirty_keys(t)
    doubles = t.equipment.where(F.col("EquipmentID") % 9 == 4).withColumn("EquipmentID", F.col("EquipmentID") + PAST)
    earlier = t.but(
        equipment=cut(dirty.equipment.unionByName(doubles)), maintenance=dirty.maintenance.where(F.col("MaintenanceID") % 11 != 5)
    )
    state = constraint_state.ConstraintState(spark, run_folder(spark, "constraints"), quality.canonical_rules())
    state.apply({name: constraint_state.whole(df) for name, df in earlier.items()}, batch=0)
    feed = {
        name: cut(refresh.changes_between(getattr(earlier, name), getattr(t, name), KEYS[name]).select("old", "new"))
        for name in ("equipment", "maintenance")
    }
    for _ in range(2):  # the feed comes twice
        state.apply(feed, batch=1)
    return state.violations()


def _feature_feed(pieces: DataFrame, day: int) -> DataFrame:
    """What happens on one of ten days: some due dates move by 20 days, on the
    fifth day new pieces come, on the eighth doubled ones go."""
    key, date = F.col("EquipmentID"), F.col("NextMaintenanceDate")
    shown = ["EquipmentID", *due.DATES]
    none = F.lit(None).cast(pieces.select(*shown).schema)
    earlier = F.struct("EquipmentID", (date - F.make_dt_interval(days=F.lit(20))).alias("NextMaintenanceDate"), *due.DATES[1:])
    moved = pieces.where(key % 40 == day - 1).select(earlier.alias("old"), F.struct(*shown).alias("new"))
    come = pieces.where((key % 40 == 20) & F.lit(day == 5)).select(none.alias("old"), F.struct(*shown).alias("new"))
    double = pieces.where((key % 40 == 30) & F.lit(day == 8)).withColumn("EquipmentID", key + PAST)
    return moved.unionByName(come).unionByName(double.select(F.struct(*shown).alias("old"), none.alias("new")))


@query("features_due")
def _features_due(spark, sf_dir):
    """Feature rows of ten days ago after ten daily runs over changed and due pieces."""
    pieces = cut(map_testdata(spark, sf_dir).equipment.select("EquipmentID", *due.DATES))
    clocks = [Clock(AS_OF.as_of - timedelta(days=10 - n)) for n in range(11)]
    key, date = F.col("EquipmentID"), F.col("NextMaintenanceDate")
    before = F.when(key % 40 < 10, date - F.make_dt_interval(days=F.lit(20))).otherwise(date)
    first = pieces.where(key % 40 != 20).withColumn("NextMaintenanceDate", before)
    doubles = pieces.where(key % 40 == 30).withColumn("EquipmentID", key + PAST)
    kept = due.DueFeatures(spark, run_folder(spark, "features"))
    kept.start(first.unionByName(doubles), clocks[0])
    for day in range(1, 11):
        kept.run(clocks[day], clocks[day - 1], _feature_feed(pieces, day))
    return kept.load()


@query("constraint_violations_gen1")
def _violations_gen1(spark, sf_dir):
    g = gen1.gen1_testdata(spark, sf_dir)
    return quality.violations(vars(g), gen1.gen1_rules())


on_tables("max_ids", quality.max_ids)

# Joins

on_tables("equipment_department", relational.equipment_department)
on_tables("maintenance_detail", relational.maintenance_detail)
on_tables("equipment_dept_maintenance", relational.equipment_dept_maintenance)
on_tables(
    "left_join_on_condition",
    lambda t: relational.left_on(
        t.equipment.select("EquipmentID"),
        t.alerts.select("EquipmentID", "AlertID", "Priority", "Status"),
        "EquipmentID",
        F.col("Status").isin("PENDING", "IN_PROGRESS"),
    ).select("EquipmentID", "AlertID", "Priority"),
)
on_tables("equipment_with_open_alerts", relational.equipment_with_open_alerts)
on_tables(
    "maintenance_without_equipment",
    lambda t: relational.orphans(dirty_keys(t).maintenance, "EquipmentID", t.equipment, "EquipmentID", include_null=True).select(
        "MaintenanceID", "EquipmentID"
    ),
)
on_tables("maintenance_count_top10", relational.maintenance_count_top)


@query("holiday_lookup")
def _holiday_lookup(spark, sf_dir):
    days = raw(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return rules.with_holiday(days, "o_orderdate", order_holidays(spark, sf_dir)).select(
        "o_orderkey", "is_holiday", "holiday_name"
    )


# Aggregations and windows

on_tables("equipment_by_category", relational.equipment_by_category)
on_tables("equipment_by_department", relational.equipment_by_department)
on_tables("department_value", relational.department_value)
on_tables("top_cost_equipment", relational.top_cost_equipment)
on_tables("total_maintenance_cost", relational.total_maintenance_cost)
on_tables("technician_cost_rank", metrics.technician_cost_rank)
on_tables("utilization_rank", reports.utilization_dashboard)
on_tables("utilization_dashboard", lambda t: reports.utilization_dashboard(t))
on_tables("category_month_trend", lambda t: reports.category_month_trend(t, AS_OF))
on_tables(
    "global_rank",
    lambda t: global_rank(
        t.maintenance.select("MaintenanceID", "Cost", "ActualDate"),
        [RankBy("Cost", "Cost_Rank"), RankBy("Cost", "Cost_Dense_Rank", descending=False, dense=True)],
    ).drop("ActualDate"),
)
on_tables("top_departments_by_cost", lambda t: reports.top_departments_by_cost(t, AS_OF))


def _first_rows(t: Tables) -> DataFrame:
    """Any 20 rows are right, so one row tells what must hold of them: their
    number, how many are distinct, and how many are in the table."""
    pieces = t.equipment.select("EquipmentID", "Name")
    first = cut(pieces.limit(20))
    known = pieces.join(first.select("EquipmentID").distinct(), "EquipmentID", "left_semi").distinct()
    members = first.join(known, ["EquipmentID", "Name"], "left_semi").agg(F.count("*").alias("members"))
    return reports.one_row(
        first.agg(F.count("*").alias("rows")), first.distinct().agg(F.count("*").alias("distinct_rows")), members
    )


on_tables("first_rows", _first_rows)

# Reports

on_tables("executive_dashboard", lambda t: reports.executive_dashboard(t, AS_OF))
on_tables("department_performance", lambda t: reports.department_performance(t, AS_OF))
on_tables("department_performance_corrected", lambda t: reports.department_performance(t, AS_OF, "corrected"))
on_tables("maintenance_analytics", lambda t: reports.maintenance_analytics(t, AS_OF))
on_tables("technician_analytics", lambda t: reports.technician_analytics(t, AS_OF))
on_tables(
    "equipment_risk_assessment", lambda t: reports.equipment_risk_assessment(t, AS_OF, hourly_cents=HOURLY_CENTS)
)
on_tables(
    "equipment_risk_assessment_corrected",
    lambda t: reports.equipment_risk_assessment(t, AS_OF, "corrected", HOURLY_CENTS),
)
on_tables("audit_compliance", lambda t: reports.audit_compliance(t.audit, AUDIT_AS_OF))
on_tables("monthly_performance_report", lambda t: reports.monthly_performance(t, AS_OF, 3, 2001))
on_tables(
    "monthly_performance_report_corrected", lambda t: reports.monthly_performance(t, AS_OF, 3, 2001, "corrected")
)
on_tables("equipment_lifecycle_report", lambda t: reports.equipment_lifecycle(t, AS_OF, HOURLY_CENTS))
on_tables("predictive_maintenance_schedule", lambda t: reports.predictive_schedule(t, AS_OF))
on_tables("equipment_health_score", lambda t: reports.equipment_health(t, AS_OF))
on_tables("maintenance_cost_analysis", lambda t: reports.maintenance_cost(t, AS_OF))
on_tables("technician_dashboard", lambda t: reports.technician_dashboard(t, AS_OF))

# Rules over change events


def equipment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.equipment_changes(audited_events(spark, sf_dir), map_testdata(spark, sf_dir))


def maintenance_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.maintenance_changes(audited_events(spark, sf_dir), map_testdata(spark, sf_dir))


def holidays_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_testdata(spark, sf_dir).holidays


@query("calendar_gate")
def _gate(spark, sf_dir):
    events = audited_events(spark, sf_dir)
    return rules.calendar_gate(events, "event_ts", holidays_of(spark, sf_dir)).select(
        "change_id", "is_holiday", "allowed", "reason"
    )


@query("calendar_gate_strict")
def _gate_strict(spark, sf_dir):
    events = audited_events(spark, sf_dir)
    return rules.calendar_gate(events, "event_ts", holidays_of(spark, sf_dir), "weekday_first").select(
        "change_id", "is_holiday", "allowed", "reason"
    )


@query("day_info")
def _day_info(spark, sf_dir):
    days = raw(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return rules.day_info(days, "day", order_holidays(spark, sf_dir))


@query("audit_changes")
def _audit_changes(spark, sf_dir):
    holidays = holidays_of(spark, sf_dir)
    pieces = rules.audit_changes(equipment_feed(spark, sf_dir), rules.EQUIPMENT_SPEC, holidays)
    jobs = rules.audit_changes(maintenance_feed(spark, sf_dir), rules.MAINTENANCE_SPEC, holidays)
    return pieces.unionByName(jobs)


def _gated(spark: SparkSession, sf_dir: str, atomic_by: str | None) -> DataFrame:
    return rules.split_changes(audited_events(spark, sf_dir), holidays_of(spark, sf_dir), atomic_by).select(
        "change_id", "statement_id", "side", "error_code", "message"
    )


query("split_changes")(lambda spark, sf_dir: _gated(spark, sf_dir, None))
query("split_changes_atomic")(lambda spark, sf_dir: _gated(spark, sf_dir, "statement_id"))


@query("statement_audit")
def _statement_audit(spark, sf_dir):
    return rules.statement_audit(
        equipment_feed(spark, sf_dir), rules.EQUIPMENT_SPEC, holidays_of(spark, sf_dir)
    )


on_tables(
    "decommission_guard",
    lambda t: rules.decommission_guard(feeds.decommission_requests(t), t.maintenance, t.alerts),
)


def _requests(t: Tables) -> DataFrame:
    """Requests to decommission at times when jobs and alerts come and go: at the
    end of every fifth job, and 36 hours after every third alert."""
    job, alert = F.col("MaintenanceID"), F.col("AlertID")
    later = F.col("DateReported") + F.make_dt_interval(hours=F.lit(36))
    jobs = t.maintenance.where(job % 5 == 0).select((job * 2).alias("change_id"), "EquipmentID", F.col("CompletionDate").alias("event_ts"))
    alerts = t.alerts.where(alert % 3 == 0).select((alert * 2 + 1).alias("change_id"), "EquipmentID", later.alias("event_ts"))
    return jobs.unionByName(alerts).withColumn("old_status", F.lit(ACTIVE))


def _guard_asof(t: Tables) -> DataFrame:
    t = t.but(maintenance=cut(t.maintenance))
    return asof.decommission_guard_asof(_requests(t), asof.job_spans(t.maintenance), asof.alert_spans(t.alerts))


on_tables("decommission_guard_asof", _guard_asof)
on_tables("completion_to_history", lambda t: rules.completion_history(feeds.job_updates(t.maintenance)))
on_tables(
    "completion_equipment_updates",
    lambda t: rules.completion_equipment_updates(feeds.job_updates(t.maintenance), AS_OF).drop("change_id"),
)


def _completed_equipment(t: Tables) -> DataFrame:
    updates = rules.completion_equipment_updates(feeds.job_updates(t.maintenance), AS_OF).drop("change_id")
    pieces = rules.apply_updates(t.equipment, updates, "EquipmentID")
    return pieces.select("EquipmentID", "Name", "LastMaintenanceDate", "ModifiedDate")


on_tables("completion_applied", _completed_equipment)
on_tables("completion_audit", lambda t: rules.completion_audit(feeds.job_updates(t.maintenance)))
on_tables("warranty_alerts", lambda t: rules.warranty_alerts(feeds.warranty_updates(t), AS_OF))


on_tables(
    "purge_old_maintenance",
    lambda t: rules.purge(t.maintenance, "ActualDate", AS_OF).select("MaintenanceID", "side"),
)


@query("purge_monthly")
def _purge_monthly(spark, sf_dir):
    """Jobs stored by month, old months dropped; what is left."""
    months = versioned.MonthTable(spark, "maintenance", run_folder(spark, "months"))
    months.write(map_testdata(spark, sf_dir).maintenance)
    months.purge(AS_OF)
    return months.load().select("MaintenanceID", "EquipmentID", "Status")


def _earlier_jobs(jobs: DataFrame) -> DataFrame:
    """The jobs before the last three months' work: of those, every fourth is not
    there yet, every fourth cost twice as much and was 40 days earlier, and every
    seventh has a double that is deleted later."""
    key, day = F.col("MaintenanceID"), F.col("ActualDate")
    recent = (day >= AS_OF.in_days(-90)) & (day < AS_OF.now)
    moved = F.coalesce(recent, F.lit(False)) & (key % 4 == 1)
    before = jobs.where(~F.coalesce(recent, F.lit(False)) | (key % 4 != 0)).withColumns(
        {
            "Cost": F.when(moved, (F.col("Cost") * 2).cast("decimal(15,2)")).otherwise(F.col("Cost")),
            "ActualDate": F.when(moved, day - F.make_dt_interval(days=F.lit(40))).otherwise(day),
        }
    )
    doubles = jobs.where(recent & (key % 7 == 0)).withColumn("MaintenanceID", key + PAST)
    return before.unionByName(doubles)


@query("snapshot_monthly_refreshed")
def _snapshot_refreshed(spark, sf_dir):
    """The stored monthly summary of the earlier jobs after the feed up to now."""
    t = staged(map_testdata(spark, sf_dir))
    kept = refresh.MonthlySummary(spark, run_folder(spark, "summary"), t)
    earlier = cut(_earlier_jobs(t.maintenance))
    kept.start(earlier, t.history, AS_OF)
    kept.apply(cut(refresh.changes_between(earlier, t.maintenance)), AS_OF)
    return kept.summary.load()


@query("upsert_equipment")
def _upsert(spark, sf_dir):
    """The updates of ``apply_updates`` in three deliveries beside the stored
    table, some buckets compacted in between."""
    t = map_testdata(spark, sf_dir)
    base, updates = t.equipment.select("EquipmentID", "Name", "Status"), cut(_status_updates(t))
    table = versioned.UpsertTable(spark, run_folder(spark, "upserts"), base.schema, "EquipmentID", updates.schema, "AlertID", 8)
    table.write(base)
    for third in range(3):
        table.upsert(updates.where(F.col("AlertID") % 3 == third))
        if third == 1:
            table.compact(least_files=2)
    return table.load()


def _status_updates(t: Tables) -> DataFrame:
    """One update per alert: an escalated alert takes its equipment out of
    service; ids beyond the table are unknown keys."""
    return t.alerts.filter(F.col("Status").isin("ESCALATED", "IN_PROGRESS")).select(
        (F.col("EquipmentID") * 3).alias("EquipmentID"),
        F.when(F.col("Status") == "ESCALATED", "INACTIVE").otherwise("UNDER_MAINTENANCE").alias("Status"),
        "AlertID",
    )


on_tables(
    "apply_updates",
    lambda t: rules.apply_updates(
        t.equipment.select("EquipmentID", "Name", "Status"), _status_updates(t), "EquipmentID", "AlertID"
    ),
)


@query("append_with_keys")
def _append(spark, sf_dir):
    t = map_testdata(spark, sf_dir)
    requests = audited_events(spark, sf_dir).select(
        "change_id", F.col("row_key").alias("EquipmentID"), F.lit("SCHEDULED").alias("Status")
    )
    return append_with_keys(t.maintenance, requests, "MaintenanceID", "change_id")


@query("stream_append_with_keys")
def _stream_append(spark, sf_dir):
    """The requests of ``append_with_keys`` as a stream in three deliveries, the
    second of which is taken in once more after the third."""
    t = map_testdata(spark, sf_dir)
    folder = run_folder(spark, "stream-append")
    requests = audited_events(spark, sf_dir).select(
        "change_id", F.col("row_key").alias("EquipmentID"), F.lit("SCHEDULED").alias("Status")
    )
    ends = requests.agg(F.min("change_id").alias("a"), F.max("change_id").alias("b")).first()
    width = ((ends["b"] or 0) - (ends["a"] or 0)) // 3 + 1
    parts = cut(requests.withColumn("third", F.call_function("div", F.col("change_id") - (ends["a"] or 0), F.lit(width)) + 1))
    top, ledger = versioned.highest(t.maintenance, "MaintenanceID"), versioned.KeyLedger(spark, f"{folder}/ledger")
    for third in (1, 2, 3):
        parts.where(F.col("third") == third).drop("third").write.mode("append").parquet(f"{folder}/in")
        requested = streams.file_stream(spark, f"{folder}/in", requests.schema)
        streams.stream_append(requested, ledger, "MaintenanceID", "change_id", top, f"{folder}/out", f"{folder}/state")
    again = parts.where(F.col("third") == 2).drop("third")
    versioned.append_batch(ledger, "1", again, "MaintenanceID", "change_id", top, f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("log_alert")
def _log_alert(spark, sf_dir):
    """New alerts for denied deletes, pending by default."""
    t = map_testdata(spark, sf_dir)
    new = audited_events(spark, sf_dir).filter(F.col("op") == "DELETE").select(
        "change_id",
        F.col("row_key").alias("EquipmentID"),
        F.lit("Delete attempted").alias("IssueDescription"),
        F.col("event_ts").alias("DateReported"),
        F.lit("PENDING").alias("Status"),
    )
    return append_with_keys(t.alerts, new, "AlertID", "change_id")


@query("equipment_exists")
def _exists(spark, sf_dir):
    t = map_testdata(spark, sf_dir)
    ids = raw(spark, sf_dir, "orders").select("o_orderkey")
    return relational.exists_flag(ids, "o_orderkey", t.equipment)


@query("technician_specialty")
def _specialty(spark, sf_dir):
    t = map_testdata(spark, sf_dir)
    ids = t.equipment.select("EquipmentID")
    return relational.lookup_specialty(ids, "EquipmentID", t.technicians)


@query("holiday_upsert")
def _holiday_upsert(spark, sf_dir):
    return rules.holiday_calendar(order_holidays(spark, sf_dir), holidays_of(spark, sf_dir), AUDIT_AS_OF)


# Functions, procedures and views known by name only

on_tables(
    "equipment_age",
    lambda t: with_age(t.equipment, AS_OF).select("EquipmentID", domain.as_years(F.col("age_units")).alias("Age_Years")),
)
on_tables(
    "maintenance_due_status",
    lambda t: t.equipment.select(
        "EquipmentID", domain.due_status(F.col("NextMaintenanceDate"), AS_OF).alias("Maintenance_Status")
    ),
)


def _new_equipment(t: Tables) -> DataFrame:
    """One request per piece: a known serial, a new one, a badly formed one or
    none; some repeat the serial of an earlier request, some ask for a
    department that does not exist."""
    key = F.col("EquipmentID")
    fresh = F.concat(F.lit("NEW-2001-"), F.lpad((F.call_function("div", key, F.lit(8)) % 1000).cast("string"), 3, "0"))
    return t.equipment.select(
        key.alias("request_id"),
        F.when(key % 4 == 0, F.col("SerialNumber"))
        .when(key % 4 == 1, fresh)
        .when(key % 4 == 2, F.concat(F.lit("serial "), key.cast("string")))
        .alias("SerialNumber"),
        "Name",
        (key % 30).alias("DepartmentID"),
    )


on_tables("validate_serial", lambda t: intake.validate_serial(_new_equipment(t), "SerialNumber", t.equipment))
on_tables("add_equipment", lambda t: intake.add_equipment(_new_equipment(t), t)[0])
on_tables("add_equipment_rejects", lambda t: intake.add_equipment(_new_equipment(t), t)[1])
on_tables("technician_workload", lambda t: reports.workload_scores(t))
on_tables("failure_risk", lambda t: intake.failure_risks(t, AS_OF))
on_tables("equipment_roi", lambda t: intake.returns(t, AS_OF, HOURLY_CENTS))
on_tables("kpis", lambda t: metrics.kpis(t, datetime(2000, 7, 1), datetime(2001, 7, 1)))
on_tables("automated_alerts", lambda t: intake.automated_alerts(t, AS_OF))
on_tables("equipment_maintenance_ranking", lambda t: metrics.maintenance_ranking(t))
on_tables("technician_performance", metrics.technician_performance)
on_tables("monthly_maintenance_trends", metrics.monthly_trends)

# Indicators

on_tables("utilization_rates", lambda t: metrics.utilization_rates(t, AS_OF))
on_tables("mtbf", metrics.mtbf)
on_tables("mttr", metrics.mttr)
on_tables("pm_compliance", lambda t: metrics.pm_compliance(t, AS_OF))
on_tables("emergency_rate", metrics.emergency_rate)
on_tables("cost_per_equipment", relational.total_maintenance_cost)
on_tables("technician_productivity", lambda t: metrics.technician_productivity(t, AS_OF))
on_tables("value_by_department", relational.department_value)
on_tables("cost_pct_of_value", metrics.cost_pct_of_value)
on_tables("warranty_coverage", lambda t: metrics.warranty_coverage(t, AS_OF))
on_tables("downtime_hours", metrics.downtime_hours)
on_tables("downtime_by_department", lambda t: metrics.downtime_hours(t, "department"))
on_tables("alert_resolution_time", metrics.alert_resolution_time)
on_tables("department_health", lambda t: metrics.department_health(t, AS_OF))

# Streams


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.file_stream(spark, sf_dir, RAW["events"], "events.parquet")


@query("stream_audit")
def _stream_audit(spark, sf_dir):
    t = map_testdata(spark, sf_dir)
    folder = run_folder(spark, "stream-audit")
    changes = feeds.equipment_changes(as_changes(event_stream(spark, sf_dir)), t)
    streams.stream_audit(changes, rules.EQUIPMENT_SPEC, t.holidays, f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out")


def _completed(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Runs the completion stream; its sinks by name."""
    t = map_testdata(spark, sf_dir)
    folder = run_folder(spark, "stream-completion")
    feed = feeds.job_updates(t.maintenance)
    feed.repartition(3).write.parquet(f"{folder}/feed")
    out = {name: f"{folder}/{name}" for name in ("history", "equipment", "audit")}
    changes = streams.file_stream(spark, f"{folder}/feed", feed.schema, files_per_batch=1)
    streams.stream_completion(changes, AS_OF, out, f"{folder}/state")
    return out


@query("stream_completion")
def _stream_completion(spark, sf_dir):
    return spark.read.parquet(_completed(spark, sf_dir)["history"]).drop("batch_id")


@query("stream_completion_equipment")
def _stream_completion_equipment(spark, sf_dir):
    return streams.latest_updates(spark, _completed(spark, sf_dir)["equipment"]).drop("change_id")


@query("stream_completion_audit")
def _stream_completion_audit(spark, sf_dir):
    return spark.read.parquet(_completed(spark, sf_dir)["audit"]).drop("batch_id")


@query("stream_warranty_alerts")
def _stream_warranty(spark, sf_dir):
    t = map_testdata(spark, sf_dir)
    folder = run_folder(spark, "stream-warranty")
    changes = feeds.equipment_changes(as_changes(event_stream(spark, sf_dir)), t)
    streams.stream_warranty_alerts(changes, AS_OF, f"{folder}/out", f"{folder}/state", "60 days")
    return spark.read.parquet(f"{folder}/out")


def _after_last_event(spark: SparkSession, sf_dir: str, days: int) -> datetime:
    last = raw(spark, sf_dir, "events").agg(F.max("ts").alias("last")).first()["last"]
    return (last or datetime(1970, 1, 1)) + timedelta(days=days)


@query("stream_audit_hourly")
def _stream_hourly(spark, sf_dir):
    """Reads what is there, then closes the last hours with a beat."""
    calendar = map_testdata(spark, sf_dir).holidays
    folder = run_folder(spark, "stream-hourly")
    for closing in (False, True):
        if closing:
            stateful.write_beat(spark, f"{folder}/beats", _after_last_event(spark, sf_dir, 3))
        audit = audit_rows(as_changes(event_stream(spark, sf_dir)), calendar)
        beat = stateful.beats(spark, f"{folder}/beats")
        stateful.stream_hourly_distinct(audit, f"{folder}/out", f"{folder}/state", "1 day", beat)
    return spark.read.parquet(f"{folder}/out")


@query("stream_split_changes")
def _stream_split(spark, sf_dir):
    """Statements of up to a day, decided when they are over."""
    calendar = map_testdata(spark, sf_dir).holidays
    folder = run_folder(spark, "stream-split")
    for closing in (False, True):
        if closing:
            stateful.write_beat(spark, f"{folder}/beats", _after_last_event(spark, sf_dir, 5))
        changes = as_changes(event_stream(spark, sf_dir))
        beat = stateful.beats(spark, f"{folder}/beats")
        stateful.stream_split_changes(changes, calendar, f"{folder}/out", f"{folder}/state", "1 day", "1 day", beat)
    return spark.read.parquet(f"{folder}/out")

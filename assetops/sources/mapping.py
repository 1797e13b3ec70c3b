"""Canonical tables derived from the star-schema test data.

One lineitem (orderkey, linenumber) becomes one maintenance job, a part a
piece of equipment, a supplier a technician, a nation a department, an
``error`` event an alert and every other event an audited change.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.temporal import is_weekend, weekday_name
from assetops.operators.rules import denial_text, with_holiday
from assetops.schema import Tables, conform
from assetops.storage import cut

AS_OF = Clock(datetime(2001, 7, 1, 12))
AUDIT_AS_OF = Clock(datetime(2024, 1, 31))

RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}

# Observed holidays by month and day.
HOLIDAY_NAMES = {
    (1, 1): "New Year's Day",
    (1, 6): "Epiphany",
    (7, 4): "Liberation Day",
    (12, 25): "Christmas Day",
    (12, 26): "Boxing Day",
    (12, 31): "Test Holiday - Year End",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(key: Column, *values: str) -> Column:
    """``values[key % n]``."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


def cycle(key: str, *values: str) -> str:
    """``values[key % n]`` as SQL text."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), int(({key}) % {len(values)} + 1))"


def days(count: str) -> str:
    return f"make_dt_interval(int({count}))"


NOW = f"timestamp_ntz'{AS_OF.as_of}'"


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = raw(spark, sf_dir, "nation"), raw(spark, sf_dir, "region")
    df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey AS DeptID", "n_name AS DeptName", "r_name AS Location", "'Head ' || n_name AS HeadOfDept"
    )
    return conform(df, "departments")


def technicians(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS TechID",
        "s_name AS FullName",
        cycle("s_suppkey", "Electrical", "Mechanical", "Biomedical", "General") + " AS Specialty",
        "s_nationkey AS DepartmentID",
        "if(s_acctbal >= 0, 'ACTIVE', 'INACTIVE') AS Status",
        "'CERTIFIED LEVEL ' || (s_suppkey % 5 + 1) AS CertificationLevel",
    )
    return conform(df, "technicians")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS UserID",
        "'user' || c_custkey AS Username",
        "'*' AS PasswordHash",
        "c_name AS FullName",
        cycle("c_custkey", "ADMIN", "TECHNICIAN", "MANAGER", "VIEWER") + " AS Role",
        "c_nationkey AS DepartmentID",
        "'ACTIVE' AS Status",
    )
    return conform(df, "users")


def equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = cycle("p_size + p_partkey", "INACTIVE", "UNDER_MAINTENANCE", "DECOMMISSIONED", *["ACTIVE"] * 7)
    df = raw(spark, sf_dir, "part").selectExpr(
        "p_partkey AS EquipmentID",
        """concat_ws('-', upper(left(p_type, 4)), string(p_partkey % 11 + 1990), lpad(string(p_partkey % 1000), 3, '0'))
            AS SerialNumber""",
        "p_name AS Name",
        cycle("p_size", "IMAGING", "LABORATORY", "MONITORING", "SURGICAL", "LIFE_SUPPORT") + " AS Category",
        f"{NOW} - {days('p_partkey * 13 % 5000')} AS PurchaseDate",
        "cast(p_retailprice AS decimal(15,2)) * 1000 AS PurchasePrice",
        f"if(p_partkey % 11 <> 0, {NOW} + {days('p_partkey * 7 % 900 - 300')}, NULL) AS WarrantyExpiry",
        f"{status} AS Status",
        "p_partkey % 25 AS DepartmentID",
        f"if(p_partkey % 17 <> 0, {NOW} + {days('p_partkey * 11 % 240 - 60')}, NULL) AS NextMaintenanceDate",
        "p_partkey * 37 % 8760 AS UtilizationHours",
    )
    return conform(df, "equipment")


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (orderkey, linenumber).  Line numbers are below 10, so the
    job id identifies the pair; grouping by the id itself leaves the rows
    partitioned the way joins on MaintenanceID need them.  The flag is one
    letter: taken as a number, every buffer has a fixed width and the
    aggregation hashes instead of sorting."""
    return (
        raw(spark, sf_dir, "lineitem")
        .withColumn("MaintenanceID", F.expr("l_orderkey * 10 + l_linenumber"))
        .groupBy("MaintenanceID")
        .agg(
            F.expr("min(l_partkey) AS EquipmentID"),
            F.expr("min(l_suppkey) AS TechnicianID"),
            F.expr("max(l_shipdate) AS ActualDate"),
            F.expr("min(ascii(l_returnflag)) AS flag"),
            F.expr("sum(cast(l_extendedprice AS decimal(15,2))) AS Cost"),
            F.expr("bigint(min(l_quantity)) AS DowntimeHours"),
        )
        .withColumn(
            "Status",
            F.expr(f"""CASE WHEN MaintenanceID div 10 % 10 = 0 THEN 'CANCELLED' WHEN ActualDate < {NOW} THEN 'COMPLETED'
                WHEN MaintenanceID div 10 % 10 = 1 THEN 'IN_PROGRESS' ELSE 'SCHEDULED' END"""),
        )
    )


def maintenance(jobs: Callable[[], DataFrame]) -> DataFrame:
    df = jobs().selectExpr(
        "MaintenanceID",
        "EquipmentID",
        "TechnicianID",
        "CASE char(flag) WHEN 'A' THEN 'PREVENTIVE' WHEN 'N' THEN 'CORRECTIVE' ELSE 'EMERGENCY' END AS MaintenanceType",
        f"ActualDate - {days('MaintenanceID % 3')} AS ScheduledDate",
        "ActualDate",
        f"ActualDate + {days('MaintenanceID % 2 + 1')} AS CompletionDate",
        "Status",
        "Cost",
        "'Maintenance ' || MaintenanceID AS Description",
        "CASE MaintenanceID % 5 WHEN 0 THEN 'Filter replacement' WHEN 1 THEN 'Battery replacement' END AS PartsReplaced",
    )
    return conform(df, "maintenance")


def history(jobs: Callable[[], DataFrame]) -> DataFrame:
    df = (
        jobs()
        .where("Status = 'COMPLETED' AND MaintenanceID % 7 <> 0")
        .selectExpr(
            "MaintenanceID AS HistoryID",
            "EquipmentID",
            "MaintenanceID",
            "TechnicianID",
            "'Maintenance ' || MaintenanceID AS ActionTaken",
            f"ActualDate + {days('1')} AS DateFixed",
            "Cost",
            "DowntimeHours",
        )
    )
    return conform(df, "history")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = ("MAINTENANCE_DUE", "WARRANTY_EXPIRY", "CRITICAL_ISSUE", "LOW_USAGE", "HIGH_USAGE")
    df = (
        raw(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .selectExpr(
            "event_id AS AlertID",
            "user_id AS EquipmentID",
            cycle("event_id", *types) + " AS AlertType",
            "'Alert ' || event_id AS IssueDescription",
            cycle("event_id", "LOW", "MEDIUM", "HIGH", "CRITICAL") + " AS Priority",
            "ts AS DateReported",
            cycle("event_id", "PENDING", "IN_PROGRESS", "ESCALATED", *["RESOLVED"] * 7) + " AS Status",
            "if(event_id % 10 > 2, ts + make_dt_interval(0, int(event_id % 72)), NULL) AS ResolutionDate",
        )
    )
    return conform(df, "alerts")


def as_changes(events: DataFrame) -> DataFrame:
    """Events (a table or a stream) that stand for changes: all but ``error``."""
    return events.where("event_type <> 'error'").selectExpr(
        "event_id AS change_id",
        "event_id div 4 AS statement_id",
        "if(event_id % 2 = 0, 'EQUIPMENT', 'MAINTENANCE') AS table_name",
        "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'DELETE' ELSE 'UPDATE' END AS op",
        "'user' || user_id AS username",
        "ts AS event_ts",
        "user_id AS row_key",
    )


def audited_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_changes(raw(spark, sf_dir, "events"))


def audit_rows(changes: DataFrame, calendar: DataFrame) -> DataFrame:
    gated = with_holiday(changes, "event_ts", calendar)
    denied = ~is_weekend(F.col("event_ts"))
    df = gated.select(
        F.col("change_id").alias("LogID"),
        F.col("table_name").alias("TableName"),
        F.col("op").alias("Operation"),
        F.col("row_key").cast("string").alias("PrimaryKeyValue"),
        F.col("username").alias("Username"),
        F.col("event_ts").alias("Timestamp"),
        F.when(denied, "DENIED").otherwise("SUCCESS").alias("Status"),
        F.when(
            denied, denial_text(F.col("op"), F.col("table_name"), F.col("is_holiday"), weekday_name(F.col("event_ts")))
        ).alias("ErrorMessage"),
    )
    return conform(df, "audit")


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_rows(audited_events(spark, sf_dir), holidays(spark, sf_dir))


def observed_holidays(df: DataFrame, ts_col: str) -> DataFrame:
    """Days present in ``df`` that fall on a known holiday.  The distinct days
    are found map-side from one column, so the shuffle carries days, not rows."""
    day = F.col("HolidayDate")
    name = F.lit(None).cast("string")
    for (month, dom), label in HOLIDAY_NAMES.items():
        name = F.when((F.month(day) == month) & (F.dayofmonth(day) == dom), label).otherwise(name)
    found = (
        df.select(F.col(ts_col).cast("date").alias("HolidayDate"))
        .withColumn("HolidayName", name)
        .filter(F.col("HolidayName").isNotNull())
        .distinct()
    )
    return conform(
        found.select(
            (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("HolidayID"),
            "HolidayName",
            "HolidayDate",
            F.year(day).alias("Year"),
        ),
        "holidays",
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_holidays(raw(spark, sf_dir, "events"), "ts")


def order_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_holidays(raw(spark, sf_dir, "orders"), "o_orderdate")


def map_testdata(spark: SparkSession, sf_dir: str, staged: bool = False) -> Tables:
    """The canonical tables.  ``staged``: what jobs and history are both derived
    from is grouped and written out once, for queries that read both whole or
    one of them many times."""
    jobs = cache(lambda: cut(_jobs(spark, sf_dir))) if staged else partial(_jobs, spark, sf_dir)
    builders = {
        "departments": departments,
        "technicians": technicians,
        "equipment": equipment,
        "users": users,
        "alerts": alerts,
        "audit": audit,
        "holidays": holidays,
    }
    tables = {name: partial(build, spark, sf_dir) for name, build in builders.items()}
    return Tables(maintenance=partial(maintenance, jobs), history=partial(history, jobs), **tables)

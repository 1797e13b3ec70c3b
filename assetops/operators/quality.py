"""Data quality: counts, orphans, distributions and constraint rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.functions.numeric import count_if
from assetops.operators.relational import count_by, orphans
from assetops.schema import ACTIVE, KEYS, REPORT_NAMES, Tables


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


CORE_TABLES = ("equipment", "maintenance", "alerts", "technicians", "departments")


def row_counts(t: Tables, names: tuple[str, ...] | None = None) -> DataFrame:
    return stacked(
        [
            df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(REPORT_NAMES[name]).alias("table_name"), "cnt")
            for name, df in ((n, getattr(t, n)) for n in names or REPORT_NAMES)
        ]
    )


def data_statistics(t: Tables) -> DataFrame:
    return row_counts(t, CORE_TABLES)


def orphan_equipment(t: Tables) -> DataFrame:
    return orphans(t.equipment, "DepartmentID", t.departments, "DeptID")


def orphan_maintenance(t: Tables) -> DataFrame:
    """Jobs without equipment or without technician; a NULL key counts too."""
    pieces = t.equipment.select(F.col("EquipmentID").alias("_piece"))
    techs = t.technicians.select(F.col("TechID").alias("_tech"))
    return (
        t.maintenance.join(pieces, F.col("EquipmentID") == F.col("_piece"), "left")
        .join(techs, F.col("TechnicianID") == F.col("_tech"), "left")
        .filter(F.col("_piece").isNull() | F.col("_tech").isNull())
        .drop("_piece", "_tech")
    )


def counted(df: DataFrame, label: str, alias: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias)).select(F.lit(label).alias("check"), alias)


def fk_report(t: Tables) -> DataFrame:
    """PASS/FAIL per foreign key; one missing parent is enough to fail."""

    def verdict(label: str, child: DataFrame, fk: str, parent: DataFrame, pk: str, include_null: bool) -> DataFrame:
        # Each used key is looked up once, however often it is used.
        missing = orphans(child.select(fk).distinct(), fk, parent, pk, include_null)
        return missing.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(label).alias("check"), F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("result")
        )

    jobs = t.maintenance
    return stacked(
        [
            verdict("All equipment has valid department", t.equipment, "DepartmentID", t.departments, "DeptID", False),
            verdict("All maintenance has valid equipment", jobs, "EquipmentID", t.equipment, "EquipmentID", True),
            verdict("All maintenance has valid technician", jobs, "TechnicianID", t.technicians, "TechID", True),
        ]
    )


def completeness(t: Tables) -> DataFrame:
    pieces, jobs = t.equipment, t.maintenance
    active = pieces.filter(F.col("Status") == ACTIVE)
    return stacked(
        [
            counted(
                orphans(t.departments, "DeptID", pieces, "DepartmentID", include_null=True),
                "Departments with no equipment",
            ),
            counted(
                orphans(active, "EquipmentID", jobs, "EquipmentID", include_null=True),
                "Equipment with no maintenance",
            ),
            counted(
                orphans(t.technicians, "TechID", jobs, "TechnicianID", include_null=True),
                "Technicians with no assigned maintenance",
            ),
        ]
    )


def status_distribution(t: Tables) -> DataFrame:
    return stacked(
        [
            count_by(getattr(t, name), "Status", "cnt").select(
                F.lit(REPORT_NAMES[name]).alias("table_name"), "Status", "cnt"
            )
            for name in ("equipment", "maintenance", "alerts")
        ]
    )


def max_id(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("max_id"))


def max_ids(t: Tables) -> DataFrame:
    return stacked(
        [
            max_id(df, KEYS[name]).select(F.lit(REPORT_NAMES[name]).alias("table_name"), "max_id")
            for name, df in t.items()
        ]
    )


@dataclass(frozen=True)
class RowRule:
    """A rule one row can break on its own."""

    table: str
    name: str
    broken: Column


@dataclass(frozen=True)
class UniqueRule:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} unique"


@dataclass(frozen=True)
class ParentRule:
    table: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.column} in {self.parent}"


Rule = RowRule | UniqueRule | ParentRule


def not_null(table: str, *columns: str) -> list[Rule]:
    return [RowRule(table, f"{c} not null", F.col(c).isNull()) for c in columns]


def one_of(table: str, column: str, *values: str) -> Rule:
    """Like CHECK, a NULL passes."""
    return RowRule(table, f"{column} domain", ~F.coalesce(F.col(column).isin(*values), F.lit(True)))


def max_length(table: str, **limits: int) -> list[Rule]:
    return [
        RowRule(table, f"{c} length", F.coalesce(F.length(c) > limit, F.lit(False))) for c, limit in limits.items()
    ]


def canonical_rules() -> list[Rule]:
    """The constraints of the canonical model."""
    rules: list[Rule] = []
    for table, key in KEYS.items():
        rules += [*not_null(table, key), UniqueRule(table, key)]
    rules += not_null("departments", "DeptName")
    rules += not_null("technicians", "FullName")
    rules += not_null("equipment", "SerialNumber", "Name", "Category", "PurchaseDate")
    rules += not_null("users", "Username", "PasswordHash", "FullName")
    rules += not_null("holidays", "HolidayName", "HolidayDate")
    rules += [
        UniqueRule("equipment", "SerialNumber"),
        UniqueRule("users", "Username"),
        one_of("equipment", "Status", "ACTIVE", "INACTIVE", "UNDER_MAINTENANCE", "DECOMMISSIONED"),
        one_of("users", "Role", "ADMIN", "TECHNICIAN", "MANAGER", "VIEWER"),
        one_of("maintenance", "MaintenanceType", "PREVENTIVE", "CORRECTIVE", "EMERGENCY"),
        one_of("maintenance", "Status", "SCHEDULED", "IN_PROGRESS", "COMPLETED", "CANCELLED"),
        one_of(
            "alerts", "AlertType", "MAINTENANCE_DUE", "WARRANTY_EXPIRY", "CRITICAL_ISSUE", "LOW_USAGE", "HIGH_USAGE"
        ),
        one_of("alerts", "Priority", "LOW", "MEDIUM", "HIGH", "CRITICAL"),
        one_of("alerts", "Status", "PENDING", "IN_PROGRESS", "RESOLVED", "ESCALATED"),
        one_of("audit", "Operation", "INSERT", "UPDATE", "DELETE"),
        one_of("audit", "Status", "SUCCESS", "DENIED", "ERROR"),
        ParentRule("technicians", "DepartmentID", "departments", "DeptID"),
        ParentRule("equipment", "DepartmentID", "departments", "DeptID"),
        ParentRule("users", "DepartmentID", "departments", "DeptID"),
        ParentRule("maintenance", "EquipmentID", "equipment", "EquipmentID"),
        ParentRule("maintenance", "TechnicianID", "technicians", "TechID"),
        ParentRule("history", "EquipmentID", "equipment", "EquipmentID"),
        ParentRule("history", "MaintenanceID", "maintenance", "MaintenanceID"),
        ParentRule("history", "TechnicianID", "technicians", "TechID"),
        ParentRule("alerts", "EquipmentID", "equipment", "EquipmentID"),
        ParentRule("alerts", "AssignedTo", "technicians", "TechID"),
    ]
    rules += max_length("departments", DeptName=100, Location=200, HeadOfDept=100, ContactEmail=100)
    rules += max_length(
        "technicians", FullName=100, ContactPhone=20, Email=100, Specialty=100, Status=20, CertificationLevel=50
    )
    rules += max_length(
        "equipment", SerialNumber=50, Name=200, Category=50, Manufacturer=100, Model=50, Status=20
    )
    rules += max_length("users", Username=50, PasswordHash=200, FullName=100, Email=100, Role=30, Status=20)
    rules += max_length("maintenance", MaintenanceType=30, Status=20, PartsReplaced=500, CreatedBy=100)
    rules += max_length("history", Notes=1000)
    rules += max_length(
        "alerts", AlertType=30, IssueDescription=500, Priority=20, Status=20, ResolutionNotes=1000
    )
    rules += max_length(
        "audit", TableName=50, Operation=10, PrimaryKeyValue=100, Username=100, Status=20, ErrorMessage=1000
    )
    rules += max_length("holidays", HolidayName=100)
    return rules


def _values(df: DataFrame, table: str, rules: list[UniqueRule | ParentRule]) -> DataFrame:
    """(table_name, rule, parent, value, n): how often every value is used, for
    all key rules of a table in one pass and one grouped shuffle."""
    pairs = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.parent if isinstance(r, ParentRule) else None).cast("string").alias("parent"),
                F.col(r.column).cast("string").alias("value"),
            )
            for r in rules
        )
    )
    return (
        df.select(F.inline(pairs))
        .where("value is not null")
        .groupBy("rule", "parent", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("table_name"), "rule", "parent", "value", "n")
    )


def by_table(rules: list[Rule], *kinds: type) -> dict[str, list]:
    found: dict[str, list] = {}
    for r in rules:
        if isinstance(r, kinds):
            found.setdefault(r.table, []).append(r)
    return found


def _without_parent(values: DataFrame, tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """The used values that no parent has."""
    parents = {(r.parent, r.key) for r in rules if isinstance(r, ParentRule)}
    keys = stacked(
        [
            tables[name].select(F.lit(name).alias("parent"), F.col(key).cast("string").alias("value")).distinct()
            for name, key in sorted(parents)
        ]
    )
    return values.where("parent is not null").join(keys, ["parent", "value"], "left_anti")


def violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table, rule, violations).  A table is read once for its row rules and
    once for all its unique and foreign keys, every parent once; a foreign key
    is counted per value, so the anti-join sees a value once however often it
    is used."""
    frames = [
        _unpivoted(tables[table].agg(*(count_if(r.broken).alias(f"r{i}") for i, r in enumerate(mine))), table, mine)
        for table, mine in by_table(rules, RowRule).items()
    ]
    keyed = by_table(rules, UniqueRule, ParentRule)
    if keyed:
        values = stacked([_values(tables[table], table, mine) for table, mine in keyed.items()])
        per_rule = [values.where("parent is null").groupBy("table_name", "rule").agg(F.sum(F.col("n") - 1).alias("violations"))]
        if any(isinstance(r, ParentRule) for r in rules):
            missing = _without_parent(values, tables, rules)
            per_rule.append(missing.groupBy("table_name", "rule").agg(F.sum("n").alias("violations")))
        # Rules that nothing breaks are rows too.
        names = F.array(*(F.struct(F.lit(r.table), F.lit(r.name)) for mine in keyed.values() for r in mine))
        spark = values.sparkSession
        none = spark.range(1).select(F.inline(names)).toDF("table_name", "rule").withColumn("violations", F.lit(0))
        frames.append(stacked([none, *per_rule]).groupBy("table_name", "rule").agg(F.sum("violations").alias("violations")))
    return stacked(frames)


def rejects(tables: dict[str, DataFrame], rules: list[Rule], keys: dict[str, str]) -> DataFrame:
    """(table_name, rule, row_key, value) of every row that breaks a rule: row
    rules, values without a parent, and of rows that share a unique value all
    but the one with the smallest key."""
    frames = []
    for table, mine in by_table(rules, RowRule, UniqueRule, ParentRule).items():
        df, key = tables[table], F.col(keys[table]).cast("string")
        row_rules = [r for r in mine if isinstance(r, RowRule)]
        key_rules = [r for r in mine if not isinstance(r, RowRule)]
        if row_rules:
            broken = F.filter(F.array(*(F.when(r.broken, r.name) for r in row_rules)), lambda x: x.isNotNull())
            found = df.select(key.alias("row_key"), F.explode(broken).alias("rule"))
            frames.append(found.withColumns({"value": F.lit(None).cast("string"), "table_name": F.lit(table)}))
        if not key_rules:
            continue
        values = _values(df, table, key_rules)
        bad = values.where("parent is null and n > 1")
        if any(isinstance(r, ParentRule) for r in key_rules):
            bad = bad.unionByName(_without_parent(values, tables, key_rules))
        pairs = F.array(
            *(F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value")) for r in key_rules)
        )
        uses = df.select(F.col(keys[table]).alias("_key"), F.inline(pairs)).where("value is not null")
        hit = uses.join(bad.select("rule", "parent", "value"), ["rule", "value"])
        first = hit.where("parent is null").groupBy("rule", "value").agg(F.min("_key").alias("first"), F.count("*").alias("n"))
        later = hit.where("parent is null").join(first, ["rule", "value"]).where(~F.col("_key").eqNullSafe(F.col("first")))
        for found in (hit.where("parent is not null"), later):
            frames.append(found.select(F.col("_key").cast("string").alias("row_key"), "rule", "value", F.lit(table).alias("table_name")))
    return stacked(frames).select("table_name", "rule", "row_key", "value")


def _unpivoted(counts: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
    pairs = F.array(
        *(F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules))
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs))


def validate(df: DataFrame, rules: list[RowRule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the names of the rules they break)."""
    failed = F.filter(F.array(*(F.when(r.broken, r.name) for r in rules)), lambda x: x.isNotNull())
    checked = df.withColumn("broken_rules", failed)
    return (
        checked.filter(F.size("broken_rules") == 0).drop("broken_rules"),
        checked.filter(F.size("broken_rules") > 0),
    )

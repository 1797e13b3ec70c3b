"""Joins, projections, top-k and simple aggregates of the data model.

Dimensions carry no broadcast hint: the optimizer and adaptive execution
broadcast a side when its measured size allows and shuffle it otherwise.
Fact tables are aggregated on their key before they meet a dimension, so a key
that owns a third of all rows is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.functions.numeric import or_zero
from assetops.schema import Tables


def top_k(df: DataFrame, order: list[Column], tiebreak: str, k: int) -> DataFrame:
    """Deterministic top rows: each partition keeps k, no full sort."""
    return df.orderBy(*order, F.col(tiebreak).asc_nulls_last()).limit(k)


def left_join_facts(df: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """``df`` LEFT JOIN ``facts`` where one key may own much of ``facts``.

    An outer join cannot split or broadcast around a hot key on its right
    side; the inner join can.  The rows without a partner are added by an
    anti-join on the distinct keys, which are found map-side."""
    keys = facts.select(on).distinct()
    return df.join(facts, on).unionByName(df.join(keys, on, "left_anti"), allowMissingColumns=True)


def left_on(df: DataFrame, other: DataFrame, on: str, keep: Column) -> DataFrame:
    """Left join whose extra condition belongs to ON: it prunes the right
    side before the join and never drops a left row."""
    return left_join_facts(df, other.filter(keep), on)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, include_null: bool = False) -> DataFrame:
    """Child rows whose parent is missing.  The right side of an anti-join is
    never split, so the parent's keys are made distinct map-side first."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    if not include_null:
        child = child.filter(F.col(fk).isNotNull())
    return child.join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def count_by(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def department_names(t: Tables) -> DataFrame:
    return t.departments.select(F.col("DeptID").alias("DepartmentID"), "DeptName")


def equipment_department(t: Tables) -> DataFrame:
    return t.equipment.join(department_names(t), "DepartmentID").select("Name", "Category", "Status", "DeptName")


def maintenance_detail(t: Tables, n: int = 10) -> DataFrame:
    names = t.equipment.select("EquipmentID", F.col("Name").alias("Equipment"))
    techs = t.technicians.select(F.col("TechID").alias("TechnicianID"), F.col("FullName").alias("Technician"))
    rows = (
        t.maintenance.join(names, "EquipmentID")
        .join(techs, "TechnicianID")
        .select("MaintenanceID", "Equipment", "Technician", "MaintenanceType", "Status", "Cost")
    )
    return top_k(rows, [], "MaintenanceID", n)


def equipment_dept_maintenance(t: Tables) -> DataFrame:
    jobs = t.maintenance.select("EquipmentID", "ActualDate", "Cost")
    pieces = t.equipment.join(department_names(t), "DepartmentID").select(
        "EquipmentID", "Name", "Category", "DeptName"
    )
    return left_join_facts(pieces, jobs, "EquipmentID").select(
        "Name", "Category", "DeptName", F.col("ActualDate").alias("MaintenanceDate"), "Cost"
    )


def equipment_with_open_alerts(t: Tables) -> DataFrame:
    open_ids = t.alerts.filter(F.col("Status") == "PENDING").select("EquipmentID").distinct()
    return t.equipment.join(open_ids, "EquipmentID", "left_semi").select("EquipmentID", "Name")


def maintenance_counts(t: Tables) -> DataFrame:
    return t.maintenance.groupBy("EquipmentID").agg(F.count(F.lit(1)).alias("MaintenanceCount"))


def maintenance_count_top(t: Tables, k: int = 10) -> DataFrame:
    counted = t.equipment.join(maintenance_counts(t), "EquipmentID", "left").select(
        "EquipmentID", "Name", or_zero(F.col("MaintenanceCount")).alias("MaintenanceCount")
    )
    return top_k(counted, [F.col("MaintenanceCount").desc()], "EquipmentID", k)


def equipment_by_category(t: Tables) -> DataFrame:
    return count_by(t.equipment, "Category", "TotalEquipment")


def equipment_by_department(t: Tables) -> DataFrame:
    per_dept = count_by(t.equipment, "DepartmentID", "n")
    return per_dept.join(department_names(t), "DepartmentID").groupBy("DeptName").agg(
        F.sum("n").alias("EquipmentCount")
    )


def department_value(t: Tables) -> DataFrame:
    """Equipment count and value of every department, empty ones included;
    the value of a department without priced equipment is NULL."""
    per_dept = t.equipment.groupBy("DepartmentID").agg(
        F.count("EquipmentID").alias("n"), F.sum("PurchasePrice").alias("value")
    )
    return (
        department_names(t)
        .join(per_dept, "DepartmentID", "left")
        .groupBy("DeptName")
        .agg(F.sum(or_zero(F.col("n"))).alias("Equipment_Count"), F.sum("value").alias("Total_Value"))
    )


def top_cost_equipment(t: Tables, k: int = 10) -> DataFrame:
    """Cost by equipment name; pieces that share a name share a row."""
    per_piece = t.maintenance.groupBy("EquipmentID").agg(F.sum("Cost").alias("cost"))
    per_name = (
        t.equipment.select("EquipmentID", "Name")
        .join(per_piece, "EquipmentID")
        .groupBy("Name")
        .agg(F.sum("cost").alias("TotalMaintenanceCost"))
    )
    return top_k(per_name, [F.col("TotalMaintenanceCost").desc_nulls_first()], "Name", k)


def total_maintenance_cost(t: Tables) -> DataFrame:
    per_piece = t.maintenance.groupBy("EquipmentID").agg(F.sum("Cost").alias("cost"))
    return t.equipment.join(per_piece, "EquipmentID", "left").select(
        "EquipmentID", or_zero(F.col("cost")).alias("Total_Maintenance_Cost")
    )


def exists_flag(ids: DataFrame, id_col: str, equipment: DataFrame) -> DataFrame:
    keys = equipment.select(F.col("EquipmentID").alias("_pk")).distinct()
    return ids.join(keys, F.col(id_col) == F.col("_pk"), "left").select(
        id_col, F.col("_pk").isNotNull().alias("equipment_exists")
    )


def lookup_specialty(ids: DataFrame, id_col: str, technicians: DataFrame) -> DataFrame:
    """Specialty per id; ``Unknown`` only for ids that do not exist."""
    known = technicians.select(F.col("TechID").alias("_pk"), "Specialty")
    return ids.join(known, F.col(id_col) == F.col("_pk"), "left").select(
        id_col, F.when(F.col("_pk").isNull(), "Unknown").otherwise(F.col("Specialty")).alias("Specialty")
    )


def sample_rows(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """k rows drawn by a hash of (key, seed), which any engine can repeat and a
    retried task draws again; every partition keeps only its k smallest draws,
    so ``k`` rows meet in one task."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    return df.orderBy(draw, F.col(key)).limit(k)

"""The canonical data model: nine tables, their types, keys and domains."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
MOMENT, DAY, MONEY = T.TimestampNTZType(), T.DateType(), T.DecimalType(15, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the canonical model.
SCHEMAS = {
    "departments": _table(
        DeptID=LONG,
        DeptName=TEXT,
        Location=TEXT,
        HeadOfDept=TEXT,
        ContactEmail=TEXT,
        Budget=MONEY,
        CreatedDate=MOMENT,
        ModifiedDate=MOMENT,
    ),
    "technicians": _table(
        TechID=LONG,
        FullName=TEXT,
        ContactPhone=TEXT,
        Email=TEXT,
        Specialty=TEXT,
        DepartmentID=LONG,
        HireDate=MOMENT,
        Status=TEXT,
        CertificationLevel=TEXT,
        CreatedDate=MOMENT,
    ),
    "equipment": _table(
        EquipmentID=LONG,
        SerialNumber=TEXT,
        Name=TEXT,
        Category=TEXT,
        Manufacturer=TEXT,
        Model=TEXT,
        PurchaseDate=MOMENT,
        PurchasePrice=MONEY,
        WarrantyExpiry=MOMENT,
        Status=TEXT,
        DepartmentID=LONG,
        LastMaintenanceDate=MOMENT,
        NextMaintenanceDate=MOMENT,
        UtilizationHours=LONG,
        CreatedDate=MOMENT,
        ModifiedDate=MOMENT,
    ),
    "users": _table(
        UserID=LONG,
        Username=TEXT,
        PasswordHash=TEXT,
        FullName=TEXT,
        Email=TEXT,
        Role=TEXT,
        DepartmentID=LONG,
        LastLogin=MOMENT,
        Status=TEXT,
        CreatedDate=MOMENT,
    ),
    "maintenance": _table(
        MaintenanceID=LONG,
        EquipmentID=LONG,
        TechnicianID=LONG,
        MaintenanceType=TEXT,
        ScheduledDate=MOMENT,
        ActualDate=MOMENT,
        CompletionDate=MOMENT,
        Status=TEXT,
        Cost=MONEY,
        Description=TEXT,
        PartsReplaced=TEXT,
        CreatedBy=TEXT,
        CreatedDate=MOMENT,
    ),
    "history": _table(
        HistoryID=LONG,
        EquipmentID=LONG,
        MaintenanceID=LONG,
        TechnicianID=LONG,
        ActionTaken=TEXT,
        DateFixed=MOMENT,
        Cost=MONEY,
        DowntimeHours=LONG,
        Notes=TEXT,
        CreatedDate=MOMENT,
    ),
    "alerts": _table(
        AlertID=LONG,
        EquipmentID=LONG,
        AlertType=TEXT,
        IssueDescription=TEXT,
        Priority=TEXT,
        DateReported=MOMENT,
        Status=TEXT,
        AssignedTo=LONG,
        ResolutionDate=MOMENT,
        ResolutionNotes=TEXT,
        CreatedDate=MOMENT,
    ),
    "audit": _table(
        LogID=LONG,
        TableName=TEXT,
        Operation=TEXT,
        PrimaryKeyValue=TEXT,
        OldValue=TEXT,
        NewValue=TEXT,
        Username=TEXT,
        Timestamp=MOMENT,
        Status=TEXT,
        ErrorMessage=TEXT,
    ),
    "holidays": _table(
        HolidayID=LONG,
        HolidayName=TEXT,
        HolidayDate=DAY,
        Year=INT,
        CreatedDate=MOMENT,
    ),
}

KEYS = {
    "departments": "DeptID",
    "technicians": "TechID",
    "equipment": "EquipmentID",
    "users": "UserID",
    "maintenance": "MaintenanceID",
    "history": "HistoryID",
    "alerts": "AlertID",
    "audit": "LogID",
    "holidays": "HolidayID",
}

# The names under which tables are reported.
REPORT_NAMES = {
    "departments": "DEPARTMENTS",
    "technicians": "TECHNICIANS",
    "equipment": "EQUIPMENT",
    "users": "USERS",
    "maintenance": "MAINTENANCE",
    "history": "MAINTENANCE_HISTORY",
    "alerts": "ALERTS",
    "audit": "AUDIT_LOG",
    "holidays": "HOLIDAYS",
}

# Status vocabulary.
ACTIVE = "ACTIVE"
COMPLETED = "COMPLETED"
DECOMMISSIONED = "DECOMMISSIONED"
OPEN_JOB = ("SCHEDULED", "IN_PROGRESS")
OPEN_ALERT = ("PENDING", "IN_PROGRESS")


class Tables:
    """The nine canonical tables as lazy DataFrames.

    A table may be given as a function: it is called when the table is first
    used, so a query analyses only the tables it reads."""

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        if set(sources) != set(SCHEMAS):
            raise ValueError(f"expected the tables {sorted(SCHEMAS)}")
        self._sources = sources

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(name)
        source = self._sources[name]
        if not isinstance(source, DataFrame):
            source = self._sources[name] = source()
        return source

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for name in SCHEMAS:
            yield name, getattr(self, name)

    def but(self, **changed: DataFrame) -> "Tables":
        return Tables(**{**self._sources, **changed})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` on the canonical columns; absent columns become NULL.
    A fraction for a whole-number column is rounded half away from zero, as a
    column of scale 0 does on a write."""
    present = {f.name.lower(): f.dataType for f in df.schema.fields}
    columns = []
    for field in SCHEMAS[table].fields:
        kind, whole = present.get(field.name.lower()), isinstance(field.dataType, T.IntegralType)
        value = field.name if kind else "NULL"
        if whole and isinstance(kind, T.FractionalType):
            value = f"ROUND({value}, 0)"
        if kind != field.dataType:
            value = f"CAST({value} AS {field.dataType.simpleString()})"
        columns.append(f"{value} AS {field.name}")
    return df.selectExpr(*columns)

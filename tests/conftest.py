import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from assetops.clock import Clock  # noqa: E402
from assetops.schema import SCHEMAS, Tables, conform  # noqa: E402
from assetops.session import build_session  # noqa: E402
from assetops.storage import release  # noqa: E402

SF = "/root/testdata/sf0.001"
NOW = datetime(2025, 12, 10, 9, 30)


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def clock():
    return Clock(NOW)


def table(spark, name, rows):
    """A canonical table from dicts; missing columns are NULL."""
    schema = SCHEMAS[name]
    full = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
    return spark.createDataFrame(full, schema)


def piece(i, dept=1, status="ACTIVE", **more):
    row = dict(
        EquipmentID=i,
        SerialNumber=f"EQ-2023-{i:03d}",
        Name=f"Piece {i}",
        Category="IMAGING",
        PurchaseDate=datetime(2020, 1, 1),
        PurchasePrice=Decimal("1000.00"),
        Status=status,
        DepartmentID=dept,
        UtilizationHours=100,
    )
    return {**row, **more}


def job(i, eq, tech=100, status="COMPLETED", cost="10.00", day=datetime(2025, 11, 20), kind="PREVENTIVE", **more):
    row = dict(
        MaintenanceID=i,
        EquipmentID=eq,
        TechnicianID=tech,
        MaintenanceType=kind,
        ScheduledDate=day,
        ActualDate=day,
        CompletionDate=day,
        Status=status,
        Cost=None if cost is None else Decimal(cost),
    )
    return {**row, **more}


def hist(i, eq, maintenance, hours, day=datetime(2025, 11, 21)):
    return dict(HistoryID=i, EquipmentID=eq, MaintenanceID=maintenance, DateFixed=day, DowntimeHours=hours)


def warn(i, eq, priority="LOW", status="PENDING", kind="LOW_USAGE"):
    return dict(AlertID=i, EquipmentID=eq, AlertType=kind, Priority=priority, Status=status, DateReported=NOW)


@pytest.fixture(scope="session")
def small(spark):
    """Few rows with every irregularity: several history rows per job, jobs
    without history or cost, an empty department, technicians without jobs,
    equipment without department."""
    t = {name: table(spark, name, []) for name in SCHEMAS}
    t["departments"] = table(
        spark,
        "departments",
        [dict(DeptID=1, DeptName="A"), dict(DeptID=2, DeptName="B"), dict(DeptID=3, DeptName="Empty")],
    )
    t["technicians"] = table(
        spark,
        "technicians",
        [
            dict(TechID=100, FullName="T100", DepartmentID=1, Status="ACTIVE", Specialty="General"),
            dict(TechID=101, FullName="T101", DepartmentID=1, Status="ACTIVE"),
            dict(TechID=102, FullName="T102", DepartmentID=2, Status="INACTIVE"),
            dict(TechID=103, FullName="T103", DepartmentID=None, Status="ACTIVE"),
        ],
    )
    t["equipment"] = table(
        spark,
        "equipment",
        [
            piece(1, NextMaintenanceDate=datetime(2025, 12, 1), WarrantyExpiry=datetime(2026, 1, 1)),
            piece(2, status="UNDER_MAINTENANCE", PurchasePrice=None, PurchaseDate=datetime(2010, 1, 1)),
            piece(3, dept=2, Category="SURGICAL", NextMaintenanceDate=datetime(2025, 12, 15)),
            piece(4, dept=2, status="DECOMMISSIONED"),
            piece(5, dept=None),
            piece(6, dept=2, Category="SURGICAL", PurchaseDate=datetime(2025, 12, 10), UtilizationHours=None),
        ],
    )
    t["maintenance"] = table(
        spark,
        "maintenance",
        [
            job(10, 1, kind="EMERGENCY", cost="100.05"),
            job(11, 1, tech=101, cost="50.00", day=datetime(2025, 10, 5)),
            job(12, 1, status="SCHEDULED", day=datetime(2025, 12, 20)),
            job(13, 2, kind="CORRECTIVE", cost=None),
            job(14, 3, tech=102, kind="EMERGENCY", cost="0.01", day=datetime(2025, 9, 1)),
            job(15, 3, tech=100, status="CANCELLED"),
            job(16, 5, cost="7.00"),
            job(17, 3, status="IN_PROGRESS", cost="1.00"),
            job(18, 1, kind="CORRECTIVE", cost="3.00", day=datetime(2022, 1, 1)),
        ],
    )
    t["history"] = table(
        spark,
        "history",
        [hist(1, 1, 10, 5), hist(2, 1, 10, 8), hist(3, 1, 11, None), hist(4, 3, 14, 3), hist(5, 3, None, 99)],
    )
    t["alerts"] = table(
        spark,
        "alerts",
        [
            warn(1, 1, "CRITICAL"),
            warn(2, 1, "LOW", "IN_PROGRESS"),
            warn(3, 1, "HIGH", "RESOLVED"),
            warn(4, 3, "CRITICAL", "ESCALATED"),
            warn(5, 6, "MEDIUM"),
        ],
    )
    t["holidays"] = table(
        spark,
        "holidays",
        [
            dict(HolidayID=1, HolidayName="Christmas Day", HolidayDate=date(2025, 12, 25), Year=2025),
            dict(HolidayID=2, HolidayName="Christmas", HolidayDate=date(2025, 12, 25), Year=2025),
            dict(HolidayID=3, HolidayName="Epiphany", HolidayDate=date(2024, 1, 6), Year=2024),
        ],
    )
    return Tables(**{name: conform(df, name) for name, df in t.items()})


@pytest.fixture(scope="session")
def sql(spark, small, clock):
    """Run SQL over the small tables; ``:now`` is the clock."""
    from assetops.operators.facts import with_health

    for name, df in small.items():
        df.createOrReplaceTempView(name)
    with_health(small.equipment, clock).createOrReplaceTempView("equipment")

    def run(text):
        return spark.sql(text.replace(":now", f"timestamp_ntz'{NOW}'"))

    return run


def rows(df):
    """Rows as sorted tuples of plain text, for comparison."""
    columns = sorted(df.columns, key=str.lower)
    return sorted(
        tuple(str(v.normalize() if isinstance(v, Decimal) and v else 0 if isinstance(v, Decimal) else v) for v in r)
        for r in df.select(*columns).collect()
    )

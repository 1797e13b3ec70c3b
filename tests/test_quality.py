"""Quality rules, joins, intake and sources."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import NOW, SF, job, piece, rows, table, warn
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.portable import portable
from assetops.operators import intake, quality, relational
from assetops.plans import reports, snapshots
from assetops.schema import KEYS
from assetops.sources import gen1, synth
from assetops.sources import tables as store
from assetops.sources.mapping import AS_OF, map_testdata


def test_row_counts(small):
    got = {r.table_name: r.cnt for r in quality.row_counts(small).collect()}
    assert len(got) == 9 and got["MAINTENANCE"] == 9 and got["USERS"] == 0
    assert {r.table_name for r in quality.data_statistics(small).collect()} == {
        "DEPARTMENTS",
        "TECHNICIANS",
        "EQUIPMENT",
        "MAINTENANCE",
        "ALERTS",
    }


def test_null_keys(spark, small):
    assert quality.orphan_equipment(small).count() == 0  # no department is no orphan
    jobs = small.maintenance.unionByName(table(spark, "maintenance", [job(99, None), job(98, 1, tech=None)]))
    broken = quality.orphan_maintenance(small.but(maintenance=jobs))
    assert {r.MaintenanceID for r in broken.collect()} == {98, 99}  # a missing key counts
    verdicts = [r.result for r in quality.fk_report(small.but(maintenance=jobs)).collect()]
    assert verdicts == ["PASS", "FAIL", "FAIL"]


def test_completeness(small):
    got = {r.check: r["count"] for r in quality.completeness(small).collect()}
    assert list(got.values()) == [1, 1, 1]  # empty department, piece 6, technician 103


def test_violations_and_rejects(spark, small):
    bad = small.equipment.unionByName(
        table(
            spark,
            "equipment",
            [piece(1, status="BROKEN"), piece(7, dept=77, Name=None, SerialNumber="x" * 51), piece(8, status=None)],
        )
    )
    got = {
        (r.table_name, r.rule): r.violations
        for r in quality.violations(dict(small.but(equipment=bad).items()), quality.canonical_rules()).collect()
        if r.violations
    }
    assert got == {
        ("equipment", "EquipmentID unique"): 1,
        ("equipment", "SerialNumber unique"): 1,
        ("equipment", "Name not null"): 1,
        ("equipment", "Status domain"): 1,
        ("equipment", "SerialNumber length"): 1,
        ("equipment", "DepartmentID in departments"): 1,
    }
    own = [r for r in quality.canonical_rules() if isinstance(r, quality.RowRule) and r.table == "equipment"]
    good, rejected = quality.validate(bad, own)
    assert good.count() + rejected.count() == bad.count()
    assert {tuple(r.broken_rules) for r in rejected.collect()} == {
        ("Status domain",),
        ("Name not null", "SerialNumber length"),
    }


def test_left_join_with_condition_keeps_every_left_row(small):
    got = relational.left_on(
        small.equipment.select("EquipmentID"),
        small.alerts.select("EquipmentID", "AlertID", "Status"),
        "EquipmentID",
        F.col("Status") == "PENDING",
    )
    assert sorted((r.EquipmentID, r.AlertID) for r in got.fillna(0).collect()) == [
        (1, 1),
        (2, 0),
        (3, 0),
        (4, 0),
        (5, 0),
        (6, 5),
    ]


def test_hot_facts_left_join_equals_the_plain_one(spark):
    left = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), "id")
    assert rows(relational.left_join_facts(left, facts, "k")) == rows(left.join(facts, "k", "left"))


def test_department_value_of_an_empty_department_is_null(small):
    got = {r.DeptName: (r.Equipment_Count, r.Total_Value) for r in relational.department_value(small).collect()}
    assert got["Empty"] == (0, None) and got["A"] == (2, Decimal("1000.00"))


def test_specialty_and_existence(spark, small):
    ids = spark.createDataFrame([(100,), (101,), (5,), (None,)], "id bigint")
    got = {r.id: r.Specialty for r in relational.lookup_specialty(ids, "id", small.technicians).collect()}
    assert got == {100: "General", 101: None, 5: "Unknown", None: "Unknown"}
    seen = {r.id: r.equipment_exists for r in relational.exists_flag(ids, "id", small.equipment).collect()}
    assert seen == {100: False, 101: False, 5: True, None: False}


def test_serials_and_intake(spark, small):
    new = spark.createDataFrame(
        [
            (1, "CT-2023-001", 1),
            (2, None, 999),
            (3, "CT-2023-002", 999),
            (4, "CT-2023-001", 1),
            (5, "EQ-2023-001", 1),
            (6, "anything", None),
        ],
        "request_id bigint, SerialNumber string, DepartmentID bigint",
    )
    ok, rejects = intake.add_equipment(new, small)
    assert {r.request_id: r.EquipmentID for r in ok.collect()} == {1: 7, 6: 8}
    assert {r.request_id: r.reason for r in rejects.collect()} == {
        2: "serial number missing",
        3: "unknown department",
        4: "duplicate serial number",
        5: "duplicate serial number",
    }
    verdict = {r.request_id: r.verdict for r in intake.validate_serial(new, "SerialNumber", small.equipment).collect()}
    assert verdict == {1: "VALID", 2: "INVALID", 3: "VALID", 4: "VALID", 5: "DUPLICATE", 6: "INVALID"}


def test_automated_alerts_skip_open_ones(spark, small, clock):
    got = {(r.EquipmentID, r.AlertType): r.Priority for r in intake.automated_alerts(small, clock).collect()}
    assert got[(1, "MAINTENANCE_DUE")] == "CRITICAL" and got[(3, "MAINTENANCE_DUE")] == "HIGH"
    assert got[(1, "WARRANTY_EXPIRY")] == "HIGH"
    assert (1, "LOW_USAGE") not in got and (3, "LOW_USAGE") in got  # 1 has that alert already
    again = small.but(
        alerts=small.alerts.unionByName(
            table(spark, "alerts", [warn(i, eq, kind=kind) for i, (eq, kind) in enumerate(got)])
        )
    )
    assert intake.automated_alerts(again, clock).count() == 0


def test_tables_round_trip(spark, small, tmp_path):
    for fmt in ("parquet", "csv", "json", "orc"):
        folder = str(tmp_path / fmt)
        store.write_tables(small, folder, fmt)
        again = store.load_tables(spark, folder, fmt)
        for name in ("equipment", "maintenance", "alerts", "holidays"):
            assert rows(getattr(again, name)) == rows(getattr(small, name)), (fmt, name)


def test_snapshot_rewrites_only_its_partitions(spark, small, tmp_path):
    path = str(tmp_path / "daily")
    for day in (10, 11, 11):
        snapshot = snapshots.daily_equipment_status(small, Clock(datetime(2025, 12, day, 8)))
        store.write_snapshot(snapshot, path, "Snapshot_Date")
    stored = spark.read.parquet(path)
    per_day = {str(r.Snapshot_Date): r["count"] for r in stored.groupBy("Snapshot_Date").count().collect()}
    n = snapshot.count()
    assert per_day == {"2025-12-10": n, "2025-12-11": n}


@pytest.mark.parametrize(
    "cadence, day",
    [
        ("daily", "2025-12-10"),
        ("weekly", "2025-12-08"),
        ("monthly", "2025-12-01"),
        ("quarterly", "2025-10-01"),
        ("annual", "2025-01-01"),
    ],
)
def test_report_period(cadence, day):
    assert str(store.period_start(NOW, cadence).date()) == day


def test_gen1_statuses(spark):
    values = ["Pending", "Resolved", " Open ", "In Progress", None, "Escalated"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(gen1.adapt_alert_status(F.col("s"))).collect()]
    assert got == ["PENDING", "RESOLVED", "PENDING", "RESOLVED", "PENDING", "ESCALATED"]


def test_gen1_data_feeds_the_reports(spark):
    t = gen1.adapt_gen1(gen1.gen1_testdata(spark, SF))
    assert reports.executive_dashboard(t, AS_OF).first().Active_Equipment > 0
    assert quality.violations(dict(t.items()), [r for r in quality.canonical_rules() if "domain" in r.name and r.table == "alerts"]).agg(F.sum("violations")).first()[0] == 0


def test_synth_is_valid_and_repeatable(spark, clock):
    t = synth.synth(spark, 40, 60, 7, clock)
    broken = quality.violations(dict(t.items()), quality.canonical_rules()).filter(
        "violations > 0 and table_name not in ('users', 'audit', 'holidays')"
    )
    assert broken.collect() == []
    assert rows(t.maintenance) == rows(synth.synth(spark, 40, 60, 7, clock).maintenance)
    done = t.maintenance.filter("Status = 'COMPLETED'").count()
    assert t.history.count() == done and synth.seed_history(t.maintenance, 5).count() == 5
    assert reports.equipment_lifecycle(t, clock).count() == 10


def test_sample_is_seeded(small):
    a = relational.sample_rows(small.maintenance, 4, 3, "MaintenanceID")
    assert a.count() == 4 and rows(a) == rows(relational.sample_rows(small.maintenance, 4, 3, "MaintenanceID"))


def test_tables_are_built_on_first_use(spark):
    built = []
    sources = {name: (lambda n=name: built.append(n) or spark.range(1)) for name in dict(map_testdata(spark, SF).items())}
    from assetops.schema import Tables

    t = Tables(**sources)
    t.alerts, t.alerts
    assert built == ["alerts"]


def test_portable_types(spark):
    df = spark.sql("select 1 as A, cast(1.5 as decimal(5,2)) as B, date'2025-01-02' as C, true as D")
    assert portable(df).dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "boolean")]


def test_text_dates_have_a_format_and_bad_fields_are_errors(spark, small, tmp_path):
    from assetops.sources import tables as store

    store.write_tables(small, str(tmp_path), "csv")
    text = "".join(p.read_text() for p in (tmp_path / "maintenance").glob("*.csv"))
    assert "20-11-2025 00:00:00" in text
    loaded = store.load_tables(spark, str(tmp_path), "csv")
    assert rows(loaded.maintenance.select("MaintenanceID", "ActualDate")) == rows(small.maintenance.select("MaintenanceID", "ActualDate"))
    next((tmp_path / "holidays").glob("*.csv")).write_text("HolidayID,HolidayName,HolidayDate,Year,CreatedDate\n1,x,2025-31-12,2025,\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        store.load_tables(spark, str(tmp_path), "csv").holidays.collect()


def test_rejects_name_every_broken_row(small):
    from conftest import piece, table

    spark = small.equipment.sparkSession
    bad = table(spark, "equipment", [piece(1), {**piece(2), "SerialNumber": piece(1)["SerialNumber"]}, piece(3, dept=99), {**piece(4), "Name": None}])
    got = quality.rejects({**dict(small.items()), "equipment": bad}, quality.canonical_rules(), KEYS)
    found = {(r.rule, r.row_key, r.value) for r in got.where("table_name = 'equipment'").collect()}
    assert found == {
        ("SerialNumber unique", "2", piece(1)["SerialNumber"]),
        ("DepartmentID in departments", "3", "99"),
        ("Name not null", "4", None),
    }


def test_column_totals_of_odd_values(spark, small):
    """NULLs, empty texts, equal values in two columns, tables without rows, and
    whole numbers whose sums of halves would overflow."""
    from calendar import timegm

    from assetops.schema import SCHEMAS

    big = 2**62
    jobs = [job(big, -big, day=datetime(1969, 12, 31, 23, 59, 59)), job(big - 1, -big, cost="-0.07", Description=""), job(1, 3 - big, cost=None, Description="")]
    jobs += [job(-big, 2 * (big - 1), tech=None, Description="ACTIVE", CreatedDate=datetime(2025, 1, 1, 0, 0, 0, 1))]
    t = small.but(maintenance=table(spark, "maintenance", jobs))
    got = {(r.table_name, r.column_name): (r.n, r.distinct_n, r.total) for r in store.column_totals(t).collect()}
    assert got["maintenance", "MaintenanceID"] == (4, 4, big)
    assert got["maintenance", "EquipmentID"] == (4, 3, 1 - big)
    assert got["maintenance", "TechnicianID"] == (3, 1, 300)
    assert got["maintenance", "Cost"] == (3, 2, 1993)
    assert got["maintenance", "Description"] == (3, 2, 6)
    assert got["maintenance", "CreatedDate"] == (1, 1, 1735689600)
    day = timegm((2025, 11, 20, 0, 0, 0))
    assert got["maintenance", "ActualDate"] == (4, 2, 3 * day - 1)
    assert got["users", "UserID"] == (0, 0, 0) and got["maintenance", "CreatedBy"] == (0, 0, 0)
    assert len(got) == sum(len(s.fields) for s in SCHEMAS.values())

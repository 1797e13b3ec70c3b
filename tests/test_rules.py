"""Calendar gate, audit, guard, completion, warranty and upkeep rules."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import NOW, job, piece, rows, table
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.operators import rules
from assetops.sources import feeds

# day -> (verdict and reason when weekends come first, ... when weekdays come first)
WEEKDAY = "Operation disallowed: Weekday (Mon-Fri)"
CALENDAR = {
    datetime(2025, 12, 4): ((False, "weekday"), (False, WEEKDAY)),
    datetime(2025, 12, 6): ((True, "weekend"), (True, "Allowed")),
    datetime(2025, 12, 25, 23, 59): ((False, "public holiday"), (False, WEEKDAY)),
    datetime(2025, 12, 27): ((True, "weekend"), (True, "Allowed")),
    datetime(2024, 1, 6, 8): (
        (True, "weekend"),
        (False, "Operation disallowed: Public holiday (Epiphany)"),
    ),
}


@pytest.fixture(scope="module")
def days(spark):
    return spark.createDataFrame([(d,) for d in CALENDAR], "ts timestamp_ntz")


@pytest.mark.parametrize("i, policy", [(0, "weekend_first"), (1, "weekday_first")])
def test_calendar(days, small, i, policy):
    gated = rules.calendar_gate(days, "ts", small.holidays, policy).collect()
    assert {r.ts: (r.allowed, r.reason) for r in gated} == {d: v[i] for d, v in CALENDAR.items()}
    assert len(gated) == len(CALENDAR)  # a day listed twice multiplies nothing


def test_unknown_policy(days, small):
    with pytest.raises(ValueError):
        rules.calendar_gate(days, "ts", small.holidays, "x")


def test_day_info(spark, small):
    df = spark.createDataFrame([(date(2025, 12, 27),), (date(2025, 12, 25),)], "d date")
    got = {r.d: r.day_info for r in rules.day_info(df, "d", small.holidays).collect()}
    assert got[date(2025, 12, 27)] == (
        "Date: 27-DEC-2025, Day: Saturday, Weekend: YES, Holiday: NO, Allowed: YES"
    )
    assert got[date(2025, 12, 25)] == (
        "Date: 25-DEC-2025, Day: Thursday, Weekend: NO, Holiday: YES, Allowed: NO"
    )


IMAGE = "struct<EquipmentID:bigint,Name:string,Status:string,WarrantyExpiry:timestamp_ntz>"
FEED = f"change_id bigint, statement_id bigint, table_name string, op string, old {IMAGE}, new {IMAGE}, username string, event_ts timestamp_ntz"


def change(i, op, old, new, ts, statement=0):
    return (i, statement, "EQUIPMENT", op, old, new, "eve", ts)


THU, SAT, XMAS = datetime(2025, 12, 4, 10), datetime(2025, 12, 6, 10), datetime(2025, 12, 25, 10)


@pytest.fixture(scope="module")
def feed(spark):
    a, b = (1, "Pump", "ACTIVE", None), (1, None, "INACTIVE", None)
    return spark.createDataFrame(
        [
            change(1, "INSERT", None, a, THU, 1),
            change(2, "UPDATE", a, b, SAT, 1),
            change(3, "DELETE", a, None, XMAS, 2),
            change(4, "DELETE", a, None, SAT, 3),
        ],
        FEED,
    )


def test_audit_rows(feed, small):
    got = {r.LogID: r for r in rules.audit_changes(feed, rules.EQUIPMENT_SPEC, small.holidays).collect()}
    assert got[1].OldValue is None and got[1].NewValue == "EquipmentID: 1, Name: Pump, Status: ACTIVE"
    assert got[1].Status == "DENIED" and got[1].ErrorMessage == (
        "Operation INSERT on EQUIPMENT table is not allowed on weekdays (Monday-Friday). "
        "Allowed only on weekends (Saturday and Sunday)."
    )
    assert got[2].Status == "SUCCESS" and got[2].ErrorMessage is None
    assert got[2].NewValue == "EquipmentID: 1, Name: , Status: INACTIVE"  # absent text is empty
    assert "public holiday (Thursday). " in got[3].ErrorMessage
    assert got[3].PrimaryKeyValue == "1" and got[3].NewValue is None


def test_split_and_atomic_split(feed, small):
    got = {r.change_id: r for r in rules.split_changes(feed, small.holidays).collect()}
    assert {i: r.side for i, r in got.items()} == {1: "rejected", 2: "accepted", 3: "rejected", 4: "accepted"}
    assert {i: r.error_code for i, r in got.items()} == {1: -20001, 2: None, 3: -20001, 4: None}
    assert got[1].message.startswith("Operation ") and got[2].message is None
    atomic = {r.change_id: r for r in rules.split_changes(feed, small.holidays, "statement_id").collect()}
    assert {i for i, r in atomic.items() if r.side == "accepted"} == {4}
    assert {r.error_code for i, r in atomic.items() if i != 4} == {-20003} and atomic[4].error_code is None
    # A change that is allowed itself carries its statement's first error.
    assert atomic[2].message.endswith("is not allowed on weekdays or holidays.")


def test_statement_audit_keeps_denied_rows(feed, small):
    got = rules.statement_audit(feed, rules.EQUIPMENT_SPEC, small.holidays).collect()
    assert {r.change_id for r in got} == {1, 3}
    assert all(r.ErrorMessage.endswith("is not allowed on weekdays or holidays.") for r in got)


def test_decommission_guard(small):
    got = {
        r.EquipmentID: (r.verdict, r.error_code)
        for r in rules.decommission_guard(feeds.decommission_requests(small), small.maintenance, small.alerts).collect()
    }
    assert got[1] == ("DENIED", -20004)  # jobs are looked at before alerts
    assert got[3] == ("DENIED", -20004)
    assert got[6] == ("DENIED", -20005)
    assert got[4] == ("ALLOWED", None)


def test_completion(spark):
    day = datetime(2025, 11, 20, 6)
    done = [
        job(1, 1, day=day, ScheduledDate=day - timedelta(hours=5, minutes=3), Description="fix"),
        job(2, 1, day=day, ScheduledDate=None),
        job(3, 2, day=day, ScheduledDate=day + timedelta(hours=2, minutes=15), PartsReplaced="Fan"),
    ]
    jobs = table(spark, "maintenance", done)
    changes = jobs.select(
        F.col("MaintenanceID").alias("change_id"),
        F.lit("UPDATE").alias("op"),
        feeds.image(feeds.JOB_IMAGE, Status=F.lit("IN_PROGRESS")).alias("old"),
        feeds.image(feeds.JOB_IMAGE).alias("new"),
        F.lit("eve").alias("username"),
    )
    history, updates, audit = rules.completion_effects(changes, Clock(NOW))
    got = {r.MaintenanceID: (r.DowntimeHours, r.Notes) for r in history.collect()}
    assert got == {
        1: (Decimal("5.1"), "Maintenance completed. Parts: None"),
        2: (Decimal("0.0"), "Maintenance completed. Parts: None"),
        3: (Decimal("-2.3"), "Maintenance completed. Parts: Fan"),
    }
    assert updates.count() == 2 and audit.count() == 3
    assert audit.first().NewValue.endswith("Completed: 20-NOV-2025")


def test_completion_needs_a_known_other_status(spark):
    jobs = table(spark, "maintenance", [job(i, 1) for i in range(8)])
    fired = rules.completions(feeds.job_updates(jobs))
    assert {r.change_id for r in fired.collect()} == {0, 1, 4, 5}


def test_warranty_bounds(spark, clock):
    def at(i, days, status="ACTIVE"):
        return piece(i, status=status, WarrantyExpiry=None if days is None else NOW + timedelta(days=days))

    pieces = table(
        spark,
        "equipment",
        [at(1, 0.9), at(2, 1), at(3, 30), at(4, 30.5), at(5, 60), at(6, 61), at(7, 90), at(8, 90.1), at(9, None)]
        + [at(10, 45, "INACTIVE")],
    )
    got = {r.EquipmentID: r.Priority for r in rules.warranty_alert_rows(pieces, clock).collect()}
    assert got == {2: "HIGH", 3: "HIGH", 4: "MEDIUM", 5: "MEDIUM", 6: "LOW", 7: "LOW"}
    text = {r.EquipmentID: r.IssueDescription for r in rules.warranty_alert_rows(pieces, clock).collect()}
    assert text[4] == "Warranty for Piece 4 expires in 30 days (on 09-JAN-2026)"


def test_warranty_fires_on_insert_and_on_a_changed_date(spark, clock):
    near = NOW + timedelta(days=45)
    old, new = (1, "P", "ACTIVE", NOW), (1, "P", "ACTIVE", near)
    changes = spark.createDataFrame(
        [
            change(1, "INSERT", None, new, NOW),
            change(2, "UPDATE", old, new, NOW),
            change(3, "UPDATE", new, new, NOW),
            change(4, "UPDATE", (1, "P", "ACTIVE", None), new, NOW),
            change(5, "DELETE", new, None, NOW),
        ],
        FEED,
    )
    got = rules.warranty_alerts(changes, clock).collect()
    assert {r.change_id for r in got} == {1, 2, 4}
    assert {(r.Priority, r.Status) for r in got} == {("MEDIUM", "PENDING")}


def test_purge_keeps_undated_rows(spark, clock):
    df = spark.createDataFrame(
        [(1, NOW - timedelta(days=180)), (2, NOW - timedelta(days=181)), (3, None)], "id int, d timestamp_ntz"
    )
    sides = {r.id: r.side for r in rules.purge(df, "d", clock).collect()}
    assert sides == {1: "kept", 2: "purged", 3: "kept"}


def test_updates(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, s string, x int")
    patch = spark.createDataFrame([(2, None), (9, "z")], "id int, s string")
    assert rows(rules.apply_updates(base, patch, "id")) == [("1", "a", "1"), ("2", "None", "2")]
    twice = spark.createDataFrame([(2, "old", 1), (2, "new", 2)], "id int, s string, n int")
    assert rows(rules.apply_updates(base, twice, "id", "n")) == [("1", "a", "1"), ("2", "new", "2")]


def test_holiday_calendar(spark, small):
    extra = spark.createDataFrame(
        [("New Year's Day", date(2026, 1, 1)), ("Again", date(2025, 12, 25))], "HolidayName string, HolidayDate date"
    )
    base = small.holidays.select("HolidayID", "HolidayName", "HolidayDate").unionByName(
        spark.createDataFrame([(9, "Test Holiday - x", date(2025, 1, 1))], "HolidayID bigint, HolidayName string, HolidayDate date")
    )
    got = {r.HolidayDate: r.HolidayName for r in rules.holiday_calendar(base, extra, Clock(NOW)).collect()}
    assert got == {
        date(2025, 12, 25): "Christmas",
        date(2024, 1, 6): "Epiphany",
        date(2026, 1, 1): "New Year's Day",
        date(2025, 12, 8): "Test Holiday - Monday",
        date(2025, 12, 9): "Test Holiday - Tuesday",
    }


def test_sunday_keeps_the_sign_of_the_remainder(spark, small):
    got = rules.this_week_holidays(small.holidays, Clock(datetime(2025, 12, 7, 5))).collect()
    assert [r.HolidayDate for r in got] == [date(2025, 12, 8), date(2025, 12, 9)]

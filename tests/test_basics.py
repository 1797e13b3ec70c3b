"""Clock, exact rounding and domain expressions."""

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import NOW, piece, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetops.clock import Clock, month_bounds, ntz
from assetops.functions import domain
from assetops.functions.numeric import percent, rounded_ratio
from assetops.functions.temporal import as_instant, from_instant, plus_days, whole_days, whole_seconds
from assetops.functions.text import joined
from assetops.operators.facts import features, with_health


@pytest.mark.parametrize(
    "start, months, expected",
    [
        (datetime(2025, 2, 28, 7), 1, datetime(2025, 3, 31, 7)),
        (datetime(2025, 3, 31), -1, datetime(2025, 2, 28)),
        (datetime(2024, 2, 29), -12, datetime(2023, 2, 28)),
        (datetime(2025, 3, 30), -1, datetime(2025, 2, 28)),
        (datetime(2025, 1, 15, 23, 59), -24, datetime(2023, 1, 15, 23, 59)),
        (datetime(2025, 12, 10), 1, datetime(2026, 1, 10)),
    ],
)
def test_month_arithmetic(start, months, expected):
    assert Clock(start).shifted_months(months) == expected


def test_month_bounds():
    assert month_bounds(2025, 12) == (datetime(2025, 12, 1), datetime(2026, 1, 1))
    assert month_bounds(2025, 1) == (datetime(2025, 1, 1), datetime(2025, 2, 1))


ratios = st.lists(
    st.tuples(st.integers(-(10**12), 10**12), st.integers(0, 10**6)), min_size=1, max_size=200
)


@settings(max_examples=8, deadline=None)
@given(ratios, st.sampled_from([(1, 0), (2, 0), (2, 2), (1, 2), (1, 1), (0, 0)]))
def test_rounded_ratio_is_exact(spark, pairs, scale):
    digits, num_digits = scale
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select("n", "d", rounded_ratio(F.col("n"), F.col("d"), digits, num_digits).alias("r")).collect()
    for n, d, r in got:
        if d == 0:
            assert r is None
            continue
        # Exact: numerator and denominator are integers, compare doubled.
        top, bottom = abs(n) * 10 ** max(digits - num_digits, 0), d * 10 ** max(num_digits - digits, 0)
        units = (2 * top + bottom) // (2 * bottom) * (1 if n >= 0 else -1)
        assert r == Decimal(units).scaleb(-digits)


def test_rounding_goes_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (0, 3)], "n bigint, d bigint")
    got = [r[0] for r in df.select(percent(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("12.5"), Decimal("-12.5"), 0]
    assert Decimal("0.285").quantize(Decimal("0.01"), ROUND_HALF_UP) == Decimal("0.29")


def test_durations(spark):
    df = spark.range(1).select(
        whole_days(ntz(NOW), ntz(NOW - timedelta(days=3, hours=23))).alias("a"),
        whole_days(ntz(NOW), ntz(NOW + timedelta(days=1, hours=1))).alias("b"),
        whole_seconds(ntz(NOW), ntz(NOW - timedelta(days=2, seconds=61))).alias("c"),
        plus_days(ntz(NOW), 2).alias("d"),
    )
    assert tuple(df.first()) == (3, -1, 2 * 86400 + 61, NOW + timedelta(days=2))


def test_instants_ignore_daylight_saving(spark):
    moments = [datetime(2025, 3, 9, 2, 30), datetime(2025, 11, 2, 1, 30, 0, 250001), datetime(1969, 12, 31, 23)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
        got = df.select("m", from_instant(as_instant(F.col("m"))), F.unix_seconds(as_instant(F.col("m")))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(r[0] == r[1] for r in got)
    assert [r[2] for r in got] == [1741487400, 1762047000, -3600]


def test_absent_text_vanishes(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(joined("<", F.col("x"), F.col("y"), ">")).first()[0] == "<a>"


@pytest.mark.parametrize(
    "days, due, window, status",
    [
        (-1, "OVERDUE", "EXPIRED", "EXPIRED"),
        (0, "DUE IN 7 DAYS", "EXPIRES IN 30 DAYS", "EXPIRING SOON"),
        (7, "DUE IN 7 DAYS", "EXPIRES IN 30 DAYS", "EXPIRING SOON"),
        (8, "DUE IN 30 DAYS", "EXPIRES IN 30 DAYS", "EXPIRING SOON"),
        (30, "DUE IN 30 DAYS", "EXPIRES IN 30 DAYS", "EXPIRING SOON"),
        (31, "ON SCHEDULE", "EXPIRES IN 90 DAYS", "ACTIVE"),
        (90, "ON SCHEDULE", "EXPIRES IN 90 DAYS", "ACTIVE"),
        (91, "ON SCHEDULE", "VALID", "ACTIVE"),
        (None, "ON SCHEDULE", "VALID", "NO WARRANTY"),
    ],
)
def test_due_and_warranty_bounds(spark, clock, days, due, window, status):
    moment = None if days is None else NOW + timedelta(days=days)
    df = spark.createDataFrame([(moment,)], "d timestamp_ntz")
    got = df.select(
        domain.due_status(F.col("d"), clock),
        domain.warranty_window(F.col("d"), clock),
        domain.warranty_status(F.col("d"), clock),
    ).first()
    assert tuple(got) == (due, window, status)


def test_midnight_today_is_overdue_in_the_morning(spark, clock):
    df = spark.createDataFrame([(datetime(2025, 12, 10),)], "d timestamp_ntz")
    assert df.select(domain.due_status(F.col("d"), clock)).first()[0] == "OVERDUE"


@pytest.mark.parametrize(
    "next_due, warranty, years, score, label",
    [
        (None, None, 1, "85.0", "EXCELLENT"),
        (10, 10, 1, "100.0", "EXCELLENT"),
        (7, 10, 1, "84.0", "EXCELLENT"),
        (-1, 10, 1, "72.0", "GOOD"),
        (-1, -1, 6, "48.0", "FAIR"),
        (-1, None, 11, "39.0", "POOR"),
        (10, -1, 11, "67.0", "GOOD"),
    ],
)
def test_health_by_hand(spark, clock, next_due, warranty, years, score, label):
    at = lambda d: None if d is None else NOW + timedelta(days=d)
    df = table(
        spark,
        "equipment",
        [
            piece(
                1,
                NextMaintenanceDate=at(next_due),
                WarrantyExpiry=at(warranty),
                PurchaseDate=NOW - timedelta(days=int(365.25 * years) + 1),
            )
        ],
    )
    value = domain.as_score(F.col("health_units"))
    got = with_health(df, clock).select(value, domain.health_label(value)).first()
    assert (str(got[0]), got[1]) == (score, label)


def test_age_is_rounded_to_hundredths(spark, clock):
    df = spark.createDataFrame([(NOW - timedelta(days=d),) for d in (0, 1, 2, 365, 366, 1461)], "p timestamp_ntz")
    got = [r[0] for r in df.select(domain.as_years(domain.age_units(F.col("p"), clock))).collect()]
    assert [str(v) for v in got] == ["0.00", "0.00", "0.01", "1.00", "1.00", "4.00"]


@pytest.mark.parametrize(
    "health, recent, risk",
    [
        (49, 0, "CRITICAL"),
        (100, 3, "CRITICAL"),
        (64, 0, "HIGH"),
        (100, 2, "HIGH"),
        (79, 0, "MEDIUM"),
        (100, 1, "MEDIUM"),
        (80, 0, "LOW"),
    ],
)
def test_failure_risk(spark, health, recent, risk):
    df = spark.createDataFrame([(health, recent)], "h int, n int")
    assert df.select(domain.failure_risk(F.col("h"), F.col("n"))).first()[0] == risk


def test_features_keep_pieces_without_jobs(spark, small, clock):
    got = {r["EquipmentID"]: r for r in features(small, clock).collect()}
    assert len(got) == small.equipment.count()
    assert got[6]["completed_jobs"] == 0 and got[6]["completed_cost"] == 0
    assert got[1]["completed_jobs"] == 3 and got[1]["recent_emergencies"] == 1
    assert got[1]["completed_cost"] == Decimal("153.05")
    assert got[2]["ROI_Percentage"] is None  # no price
    assert got[6]["Age_Years"] == 0


def test_ratios_of_huge_amounts(spark):
    """Amounts of 1e15 in cents, scaled and rounded, pass 64 bits on the way."""
    from assetops.functions.numeric import cents

    df = spark.createDataFrame([(Decimal("1000000000000000.00"), Decimal("3.00")), (Decimal("-2000000000000000.00"), Decimal("3000000000000000.00"))], "a decimal(20,2), b decimal(20,2)")
    got = [r[0] for r in df.select(percent(cents(F.col("a")), cents(F.col("b")), 1)).collect()]
    assert got == [Decimal("33333333333333333.3"), Decimal("-66.7")]
    roi = df.select(domain.roi(F.lit(0), -F.col("a"), F.col("b"), 100), domain.roi(F.lit(5), F.col("a"), F.col("a"), 0)).collect()
    assert roi[0][0] == Decimal("33333333333333333.3") and roi[0][1] == Decimal("-100.0")


def test_whole_number_columns_round(spark):
    from assetops.schema import conform

    df = spark.createDataFrame([(Decimal("71.9"),), (Decimal("-0.5"),), (Decimal("0.4"),), (None,)], "DowntimeHours decimal(10,1)")
    assert [r.DowntimeHours for r in conform(df, "history").collect()] == [72, -1, 0, None]

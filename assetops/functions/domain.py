"""Column expressions of the maintenance domain.

``health_units`` follows the one published health formula.  ``age_units``,
``failure_risk``, ``roi`` and the serial-number pattern stand in for functions
that are called by name elsewhere but published nowhere: their formulas are
chosen here, not taken from a source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetops.clock import Clock
from assetops.functions.numeric import cents, percent, rounded_ratio, scaled
from assetops.functions.temporal import whole_days

# Weights and steps of the health score, in tenths of a percent.
MAINTENANCE_WEIGHT, WARRANTY_WEIGHT, AGE_WEIGHT = 4, 3, 3

SERIAL_PATTERN = "^[A-Z]{2,5}-[0-9]{4}-[0-9]{3}$"


def labelled(value: Column, steps: list[tuple[object, str]], otherwise: str) -> Column:
    """First label whose bound lies above ``value``; ``otherwise`` beyond the
    last bound and for NULL."""
    out = F.lit(otherwise)
    for bound, label in reversed(steps):
        out = F.when(value < bound, label).otherwise(out)
    return out


def age_units(purchased: Column, clock: Clock) -> Column:
    """Age in hundredths of a year of 365.25 days (chosen)."""
    return cents(rounded_ratio(whole_days(clock.now, purchased) * 100, F.lit(36525), 2))


def health_units(next_due: Column, warranty: Column, age: Column, clock: Clock) -> Column:
    """Health score in tenths, 390..1000; ``age`` in hundredths of a year."""
    maintenance = F.when(next_due < clock.now, 30).when(next_due <= clock.in_days(7), 60).otherwise(100)
    cover = F.when(warranty >= clock.now, 100).otherwise(50)
    youth = F.when(age < 500, 100).when(age < 1000, 70).otherwise(40)
    return (maintenance * MAINTENANCE_WEIGHT + cover * WARRANTY_WEIGHT + youth * AGE_WEIGHT).cast("bigint")


# Labels of health, due dates and warranties with their bounds.
def health_label(score: Column) -> Column:
    return labelled(score, [(40, "POOR"), (60, "FAIR"), (80, "GOOD")], "EXCELLENT")


def due_status(next_due: Column, clock: Clock) -> Column:
    return (
        F.when(next_due < clock.now, "OVERDUE")
        .when(next_due <= clock.in_days(7), "DUE IN 7 DAYS")
        .when(next_due <= clock.in_days(30), "DUE IN 30 DAYS")
        .otherwise("ON SCHEDULE")
    )


def warranty_window(expiry: Column, clock: Clock) -> Column:
    return (
        F.when(expiry < clock.now, "EXPIRED")
        .when(expiry <= clock.in_days(30), "EXPIRES IN 30 DAYS")
        .when(expiry <= clock.in_days(90), "EXPIRES IN 90 DAYS")
        .otherwise("VALID")
    )


def warranty_status(expiry: Column, clock: Clock) -> Column:
    return (
        F.when(expiry.isNull(), "NO WARRANTY")
        .when(expiry < clock.now, "EXPIRED")
        .when(expiry <= clock.in_days(30), "EXPIRING SOON")
        .otherwise("ACTIVE")
    )


def failure_risk(score: Column, emergencies: Column) -> Column:
    """Chosen: health and emergency jobs of the last year."""
    return (
        F.when((score < 50) | (emergencies >= 3), "CRITICAL")
        .when((score < 65) | (emergencies == 2), "HIGH")
        .when((score < 80) | (emergencies == 1), "MEDIUM")
        .otherwise("LOW")
    )


# Points by risk label.
RISK_POINTS = {"CRITICAL": 40, "HIGH": 30, "MEDIUM": 20, "LOW": 10}


def risk_points(risk: Column) -> Column:
    out = F.lit(0)
    for label, points in RISK_POINTS.items():
        out = F.when(risk == label, points).otherwise(out)
    return out


def roi(hours: Column, cost: Column, price: Column, hourly_cents: int) -> Column:
    """Chosen: (value of use - completed cost) in percent of the price."""
    gained = F.coalesce(hours, F.lit(0)) * hourly_cents - cents(cost)
    return percent(gained, cents(price))


def utilization_of_year(hours: Column, digits: int = 1) -> Column:
    return rounded_ratio(hours * 100, F.lit(8760), digits)


def utilization_of_month(hours: Column) -> Column:
    return rounded_ratio(hours * 100, F.lit(24 * 30), 2)


def utilization_of_life(hours: Column, age: Column) -> Column:
    """Percent of all hours since purchase; NULL at age 0."""
    return rounded_ratio(hours * 10000, age * 8760, 1)


def as_years(age: Column) -> Column:
    return scaled(age, 2)


def as_score(health: Column) -> Column:
    return scaled(health, 1)

"""Durations, labels and calendar parts of zone-less timestamps."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetops.clock import ntz


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days from ``earlier`` to ``later``, cut towards zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def whole_seconds(later: Column, earlier: Column) -> Column:
    span = later - earlier
    part = lambda unit: F.extract(F.lit(unit), span).cast("bigint")
    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def as_instant(moment: Column) -> Column:
    """The zoned timestamp that shows ``moment`` in UTC, whatever the zone of
    the session: no hour is skipped or repeated by daylight saving."""
    span = moment - ntz(datetime(1970, 1, 1))
    micros = (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")
    for unit, length in (("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000)):
        micros = micros + F.extract(F.lit(unit), span).cast("bigint") * F.lit(length).cast("bigint")
    return F.timestamp_micros(micros)


def from_instant(instant: Column) -> Column:
    """Inverse of ``as_instant``."""
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") * F.lit(Decimal("0.000001"))).cast("decimal(18,6)")
    return ntz(datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds)


def plus_days(moment: Column, days: Column | int) -> Column:
    days = days if isinstance(days, Column) else F.lit(days)
    return moment + F.make_dt_interval(days=days.cast("int"))


def month_start(moment: Column) -> Column:
    """First day of the month as DATE: a compact grouping key."""
    return F.trunc(moment.cast("date"), "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def quarter_label(day: Column) -> Column:
    return F.concat_ws("-", F.year(day), F.quarter(day))


def day_label(moment: Column) -> Column:
    """``25-DEC-2025``"""
    return F.upper(F.date_format(moment.cast("date"), "dd-MMM-yyyy"))


def clock_label(moment: Column) -> Column:
    """``13:05:59``"""
    return F.concat_ws(":", *(F.lpad(f(moment).cast("string"), 2, "0") for f in (F.hour, F.minute, F.second)))


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment.cast("date"), "EEEE")


def is_weekend(moment: Column) -> Column:
    return F.dayofweek(moment.cast("date")).isin(1, 7)

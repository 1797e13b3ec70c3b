"""The explicit "now" of every operator.

Nothing in the package reads the wall clock: a job that is re-run for a past
day, or a task that is retried after an executor is lost, sees the same
instant.  Bounds are computed once on the driver and enter plans as literals,
so a scan can push them down.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal (``F.lit(datetime)`` would be zone-dependent)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Clock:
    as_of: datetime

    @property
    def now(self) -> Column:
        return ntz(self.as_of)

    @property
    def today(self) -> datetime:
        return self.as_of.replace(hour=0, minute=0, second=0, microsecond=0)

    def shifted_months(self, months: int) -> datetime:
        """Month arithmetic that sends the last day of a month to the last day
        of the target month and keeps the time of day."""
        index = self.as_of.year * 12 + self.as_of.month - 1 + months
        year, month = index // 12, index % 12 + 1
        last_here = calendar.monthrange(self.as_of.year, self.as_of.month)[1]
        last_there = calendar.monthrange(year, month)[1]
        day = last_there if self.as_of.day == last_here else min(self.as_of.day, last_there)
        return self.as_of.replace(year=year, month=month, day=day)

    def months_ago(self, months: int) -> Column:
        return ntz(self.shifted_months(-months))

    def in_days(self, days: int) -> Column:
        return ntz(self.as_of + timedelta(days=days))

    def days_before_today(self, days: int) -> Column:
        return ntz(self.today - timedelta(days=days))


def month_bounds(year: int, month: int) -> tuple[datetime, datetime]:
    """First instant of a month and of the month after it."""
    start = datetime(year, month, 1)
    return start, datetime(year + month // 12, month % 12 + 1, 1)

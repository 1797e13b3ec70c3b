"""The monthly summary, kept up to date by a change feed.

Jobs are stored by month, history by the month of its job, the summary by month.
A feed names the months it touches by the old and new images of its rows; only
those months of the three tables are read and replaced.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetops.clock import Clock
from assetops.plans.snapshots import monthly_maintenance_summary
from assetops.schema import SCHEMAS, Tables, conform
from assetops.sources.versioned import NO_MONTH, MonthTable, VersionedTable, month_of

JOB_MONTH = "job_month"


class MonthlySummary:
    """``tables`` holds what is not stored here: equipment, technicians, departments."""

    def __init__(self, spark: SparkSession, path: str, tables: Tables):
        self.tables = tables
        self.jobs = MonthTable(spark, "maintenance", path)
        schema = T.StructType([*SCHEMAS["history"].fields, T.StructField(JOB_MONTH, T.StringType())])
        self.history = VersionedTable(spark, f"{path}/history", schema, F.col(JOB_MONTH), ("MaintenanceID",))
        shape = monthly_maintenance_summary(tables, Clock(datetime(2000, 1, 1))).schema
        self.summary = VersionedTable(spark, f"{path}/summary", shape, F.col("Month"), ("DeptName", "Category"))

    def start(self, maintenance: DataFrame, history: DataFrame, clock: Clock) -> None:
        """Stores both tables and their full summary."""
        self.jobs.write(maintenance)
        months = self.jobs.load().select("MaintenanceID", month_of(F.col("ActualDate")).alias(JOB_MONTH))
        placed = conform(history, "history").join(months, "MaintenanceID", "left").fillna({JOB_MONTH: NO_MONTH})
        self.history.write(placed.select(*self.history.schema.names))
        self.summary.write(self._computed(clock, None))

    def _computed(self, clock: Clock, months: list[str] | None) -> DataFrame:
        stored = self.tables.but(maintenance=self.jobs.load(months), history=self.history.load(months).drop(JOB_MONTH))
        return monthly_maintenance_summary(stored, clock)

    def apply(self, changes: DataFrame, clock: Clock, before: Clock | None = None) -> list[str]:
        """Takes in a feed (change_id, op, old, new; whole jobs as images) and
        returns the months read and replaced.  A job's latest change wins.  With
        ``before``, the clock of the stored summary, the month that the summary's
        range begins in is replaced too if the clock has moved on."""
        images = F.array(F.col("old.ActualDate"), F.col("new.ActualDate"))
        there = F.array(F.col("old").isNotNull(), F.col("new").isNotNull())
        dates = changes.select(F.explode(F.arrays_zip(images.alias("date"), there.alias("there"))).alias("image"))
        # As many rows as there are months.
        named = dates.where("image.there").select(month_of(F.col("image.date")).alias("m")).distinct().collect()
        months = sorted(r.m for r in named)
        key = F.coalesce("new.MaintenanceID", "old.MaintenanceID").alias("MaintenanceID")
        last = changes.groupBy(key).agg(F.max_by(F.struct("op", "new"), "change_id").alias("last"))
        rows = last.where("last.op <> 'DELETE'").select("last.new.*")
        moved = rows.select("MaintenanceID", month_of(F.col("ActualDate")).alias("to_month"))

        def jobs(entry: dict) -> DataFrame:
            kept = self.jobs.read(entry, months).join(last.select("MaintenanceID"), "MaintenanceID", "left_anti")
            return conform(kept, "maintenance").unionByName(conform(rows, "maintenance"))

        def history(entry: dict) -> DataFrame:
            placed = self.history.read(entry, places).join(moved, "MaintenanceID", "left")
            month = F.coalesce("to_month", JOB_MONTH)
            return placed.withColumn(JOB_MONTH, month).select(*self.history.schema.names)

        self.jobs.replace(jobs, months)
        # Rows without a month wait for their job, which this feed may bring.
        places = sorted({*months, NO_MONTH})
        self.history.replace(history, places)
        border = clock.shifted_months(-24).strftime("%Y-%m")
        due = set(months)
        if before is not None and before.as_of != clock.as_of:
            due |= {border, *(m for m in self.summary.parts() if m < border)}
        due = sorted(due)
        made = self._computed(clock, due)
        self.summary.replace(lambda entry: made, due)
        return due


def changes_between(old: DataFrame, new: DataFrame, key: str = "MaintenanceID") -> DataFrame:
    """The feed (change_id, op, old, new) that turns one state of a table into
    another.  Rows that are equal are no change."""
    columns = old.columns
    a = old.select(F.col(key), F.struct(*columns).alias("old"))
    b = new.select(F.col(key), F.struct(*columns).alias("new"))
    op = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    both = a.join(b, key, "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return both.select(F.col(key).alias("change_id"), op.alias("op"), "old", "new")

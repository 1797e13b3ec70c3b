"""State as of an instant, without a range join.

What is open is a running total: every event raises or lowers it, every question
reads it.  Events and questions of a group are put in one order, range-partitioned
by group and time, added up inside each partition and shifted by what the
partitions before it hold of the same group.  A group, however large, spreads over
as many partitions as its rows fill; only the first and last group of a partition
can lie in two, so the shifts are two rows per partition at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetops.operators.rules import guard_verdict
from assetops.schema import OPEN_ALERT, OPEN_JOB
from assetops.storage import cut


def running_totals(df: DataFrame, within: str, order: list[str], totals: dict[str, str]) -> DataFrame:
    """``df`` with each total ``out: measure`` over the rows of the same ``within``
    up to and including the row, in ``order``, which is unique inside a group.
    Rows without a group have none."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (within, *order)]
    dealt = df.where(F.col(within).isNotNull()).repartitionByRange(parts, *keys)
    # Written out: a retried task must find the same borders.
    held = cut(dealt.withColumn("_bucket", F.spark_partition_id()))
    inside = Window.partitionBy("_bucket", within).orderBy(*(F.col(c).asc_nulls_first() for c in order))
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = held.withColumns({out: F.coalesce(F.sum(m).over(inside), F.lit(0)) for out, m in totals.items()})
    # One row per partition, then at most two groups of each.
    ends = held.groupBy("_bucket").agg(F.min(within).alias("_first"), F.max(within).alias("_last"))
    border = ends.select("_bucket", F.explode(F.array_distinct(F.array("_first", "_last"))).alias(within))
    sums = held.join(F.broadcast(border), ["_bucket", within]).groupBy("_bucket", within).agg(
        *(F.coalesce(F.sum(m), F.lit(0)).alias(f"_sum_{out}") for out, m in totals.items())
    )
    before = Window.partitionBy(within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("_bucket", within, *(F.sum(f"_sum_{out}").over(before).alias(f"_before_{out}") for out in totals))
    out = summed.join(F.broadcast(shifts), ["_bucket", within], "left")
    return out.withColumns({c: F.col(c) + F.coalesce(F.col(f"_before_{c}"), F.lit(0)) for c in totals}).select(
        *df.columns, *totals
    )


def open_spans(df: DataFrame, group: str, opened: Column, closed: Column, is_open: Column) -> DataFrame:
    """(group, at, delta): +1 where a row's state opens and -1 where it closes.  A
    row that is open now never closes; one without a start is open from the first
    instant; one that is not open and has no end never counts."""
    counted = df.where(is_open | closed.isNotNull())
    up = counted.select(F.col(group), opened.alias("at"), F.lit(1).alias("delta"))
    down = counted.where(~is_open).select(F.col(group), F.greatest(closed, opened).alias("at"), F.lit(-1).alias("delta"))
    return up.unionByName(down)


def job_spans(maintenance: DataFrame) -> DataFrame:
    """Jobs are open from their scheduled date until they are completed, or until
    the date of the visit if they were cancelled."""
    status = F.col("Status")
    closed = F.when(status == "COMPLETED", F.col("CompletionDate")).otherwise(F.col("ActualDate"))
    return open_spans(maintenance, "EquipmentID", F.col("ScheduledDate"), closed, status.isin(*OPEN_JOB))


def alert_spans(alerts: DataFrame) -> DataFrame:
    """Alerts are open from their report until their resolution."""
    return open_spans(
        alerts, "EquipmentID", F.col("DateReported"), F.col("ResolutionDate"), F.col("Status").isin(*OPEN_ALERT)
    )


def decommission_guard_asof(requests: DataFrame, jobs: DataFrame, alerts: DataFrame) -> DataFrame:
    """``rules.decommission_guard`` against the state at each request's time.

    ``requests``: (change_id, EquipmentID, event_ts, old_status); ``jobs`` and
    ``alerts``: (EquipmentID, at, delta).  Changes at the very instant of a request
    count.  Requests without a piece find nothing open; requests without a time
    come before everything that has one."""
    moves = [
        spans.groupBy("EquipmentID", "at").agg(F.sum(F.col("delta") if here else F.lit(0)).alias("_job"), F.sum(F.lit(0) if here else F.col("delta")).alias("_alert"))
        for spans, here in ((jobs, True), (alerts, False))
    ]
    # Moves of one instant are one row, so they meet without an order among them.
    moved = reduce(DataFrame.unionByName, moves).groupBy("EquipmentID", "at").agg(F.sum("_job").alias("_job"), F.sum("_alert").alias("_alert"))
    asked = requests.select("EquipmentID", F.col("event_ts").alias("at"), "change_id", "old_status", F.lit(1).alias("_ask"))
    line = moved.withColumn("_ask", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    totals = running_totals(line, "EquipmentID", ["at", "_ask", "change_id"], {"open_jobs": "_job", "open_alerts": "_alert"})
    found = totals.where(F.col("_ask") == 1)
    lost = asked.where(F.col("EquipmentID").isNull()).withColumns({"open_jobs": F.lit(0).cast("bigint"), "open_alerts": F.lit(0).cast("bigint")})
    columns = ["change_id", "EquipmentID", "old_status", "open_jobs", "open_alerts"]
    return guard_verdict(
        found.select(*columns).unionByName(lost.select(*columns)),
        F.col("open_jobs") > 0,
        F.col("open_alerts") > 0,
        F.col("old_status"),
        F.lit("DECOMMISSIONED"),
        ("open_jobs", "open_alerts"),
    )

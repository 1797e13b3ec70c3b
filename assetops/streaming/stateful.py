"""Stateful jobs: exact distinct counts per hour, and atomic statements.

Both emit a result when the watermark says that it is final, in append mode, and
drop its state then.  What lies behind the last event plus the lateness is still
open when the input ends; a *beat*, a row that holds nothing but a later time,
moves the watermark on and closes it.  Beats come from a folder of their own and
never reach a result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.functions.numeric import count_if
from assetops.functions.temporal import as_instant, from_instant
from assetops.operators.rules import STATEMENT_ERROR, calendar_gate, statement_text
from assetops.streaming.jobs import append, event_time, file_stream

BEAT = "_beat"


def write_beat(spark: SparkSession, path: str, at: datetime) -> None:
    """Adds one beat to the folder ``path``; the streams that read it close what
    ended before ``at`` less their lateness."""
    spark.sql("SELECT :at AS beat", {"at": at.isoformat(sep=" ")}).selectExpr("CAST(beat AS timestamp_ntz) AS beat").write.mode(
        "append"
    ).parquet(path)


def beats(spark: SparkSession, path: str) -> DataFrame:
    """The beats of a folder as a stream; the folder may still be empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return file_stream(spark, path, "beat TIMESTAMP_NTZ")


def with_watermark(df: DataFrame, at: str, lateness: str, beat: DataFrame | None) -> DataFrame:
    """``df`` with a watermark on the zoned column ``at``, which beats move too."""
    if beat is None:
        return df.withWatermark(at, lateness)
    both = df.withColumn(BEAT, F.lit(False)).unionByName(
        beat.select(as_instant(F.col("beat")).alias(at), F.lit(True).alias(BEAT)), allowMissingColumns=True
    )
    # A condition that names the time column stays above the watermark.
    return both.withWatermark(at, lateness).where(~F.col(BEAT) | F.col(at).isNull()).drop(BEAT)


def hourly_distinct(audit: DataFrame, lateness: str, beat: DataFrame | None = None) -> DataFrame:
    """Audited operations, users and tables per tumbling hour, all of them exact.

    A row counts once under its user and once under its table.  The first
    aggregation has one row of state per hour and user or table, combined
    map-side, so a user with a third of all rows is one row; the second counts
    those rows when the hour is closed.  NULL users and tables are not counted."""
    status = F.col("Status")
    timed = with_watermark(event_time(audit, "Timestamp"), "Timestamp", lateness, beat)
    sides = F.array(
        F.struct(F.lit("user").alias("side"), F.col("Username").alias("name")),
        F.struct(F.lit("table").alias("side"), F.col("TableName").alias("name")),
    )
    named = timed.select("Timestamp", "Status", F.inline(sides))
    first = named.groupBy(F.window("Timestamp", "1 hour").alias("hour"), "side", "name").agg(
        F.count(F.lit(1)).alias("total"),
        count_if(status == "DENIED").alias("denied"),
        count_if(status == "SUCCESS").alias("success"),
        count_if(status == "ERROR").alias("error"),
    )
    user, there = F.col("side") == "user", F.col("name").isNotNull()

    def once(col: str) -> Column:
        return F.sum(F.when(user, F.col(col)).otherwise(0))

    return (
        first.groupBy(F.window(F.window_time("hour"), "1 hour"))
        .agg(
            once("total").alias("Total_Operations"),
            once("denied").alias("Denied_Operations"),
            once("success").alias("Successful_Operations"),
            once("error").alias("Error_Operations"),
            count_if(user & there).alias("Active_Users"),
            count_if(~user & there).alias("Tables_Modified"),
        )
        .select(from_instant(F.col("window.start")).alias("Hour_Start"), "*")
        .drop("window")
    )


def stream_hourly_distinct(audit: DataFrame, out_path: str, ckpt: str, lateness: str, beat: DataFrame | None = None) -> None:
    append(hourly_distinct(audit, lateness, beat), out_path, ckpt)


def split_statements(
    changes: DataFrame, holidays: DataFrame, span: str, lateness: str, beat: DataFrame | None = None, salts: int = 8
) -> DataFrame:
    """``rules.split_changes`` by statement, for a stream: (change_id,
    statement_id, side, error_code, message).

    All changes of a statement lie within ``span``.  Its denied changes form one
    session, which is closed ``span`` after the last of them, with the message of
    the first by ``change_id``; every change waits for the session of its statement
    in a stream-stream left join, bounded in time on both sides.  A statement with
    many changes spreads over ``salts`` keys of the join; the session is one row
    by then and is repeated for each."""
    at = "_at"
    gated = calendar_gate(changes.withColumn(at, as_instant(F.col("event_ts"))), "event_ts", holidays).select(
        "change_id", "statement_id", "allowed", statement_text(F.col("op"), F.col("table_name")).alias("_text"), at
    )
    gated = with_watermark(gated, at, lateness, beat)
    failed = (
        gated.where(~F.col("allowed"))
        .groupBy(F.col("statement_id").alias("failed_id"), F.session_window(at, span).alias("session"))
        .agg(F.min_by("_text", "change_id").alias("message"))
        .select("failed_id", "message", F.window_time("session").alias("until"))
        .withColumn("failed_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salt = F.pmod(F.xxhash64("change_id"), F.lit(salts)).cast("int")
    mine = (F.col("statement_id") == F.col("failed_id")) & (salt == F.col("failed_salt"))
    # The session ends within two spans after any change of its statement, and not before it.
    near = F.expr(f"until >= {at} AND until <= {at} + interval {span} + interval {span}")
    hit = F.col("failed_id").isNotNull()
    return gated.join(failed, mine & near, "left").select(
        "change_id",
        "statement_id",
        F.when(hit, "rejected").otherwise("accepted").alias("side"),
        F.when(hit, STATEMENT_ERROR).alias("error_code"),
        "message",
    )


#: A session's rows are merged where they are read, before they meet.
LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def stream_split_changes(
    changes: DataFrame, holidays: DataFrame, out_path: str, ckpt: str, span: str, lateness: str, beat: DataFrame | None = None
) -> None:
    conf = changes.sparkSession.conf
    before = conf.get(LOCAL_SESSIONS)
    conf.set(LOCAL_SESSIONS, "true")
    try:
        append(split_statements(changes, holidays, span, lateness, beat), out_path, ckpt)
    finally:
        conf.set(LOCAL_SESSIONS, before)

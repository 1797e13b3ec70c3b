"""The change-event rules as Structured Streaming jobs.

Each job runs a batch operator on a stream and stops when the available input
is used up.  Sinks that are written per micro-batch use one directory per
batch id and overwrite it, so a batch that is repeated after a failure leaves
the same files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetops.clock import Clock
from assetops.functions.numeric import count_if
from assetops.functions.temporal import as_instant, from_instant
from assetops.operators.rules import TableSpec, audit_changes, completion_effects, warranty_alerts
from assetops.sources.versioned import KeyLedger, append_batch


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, glob: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks accept zoned timestamps only."""
    return df.withColumn(col, as_instant(F.col(col)))


def _run(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def append(df: DataFrame, out_path: str, ckpt: str) -> None:
    _run(df.writeStream.outputMode("append").option("checkpointLocation", ckpt).format("parquet").option("path", out_path))


def stream_audit(changes: DataFrame, spec: TableSpec, holidays: DataFrame, out_path: str, ckpt: str) -> None:
    """Audit rows of a change stream, joined with the static calendar."""
    append(audit_changes(changes, spec, holidays), out_path, ckpt)


def stream_warranty_alerts(changes: DataFrame, clock: Clock, out_path: str, ckpt: str, lateness: str) -> None:
    """Warranty alerts, once per change even if the feed repeats it.  Only ids
    inside the watermark are kept, so ``lateness`` must cover the disorder of
    the feed and bounds the state."""
    timed = event_time(changes, "event_ts").withWatermark("event_ts", lateness)
    alerts = warranty_alerts(timed, clock, ("change_id", "event_ts")).dropDuplicatesWithinWatermark(["change_id"])
    append(alerts.drop("event_ts"), out_path, ckpt)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_completion(changes: DataFrame, clock: Clock, out_dirs: dict[str, str], ckpt: str) -> None:
    """History rows, equipment updates and audit rows of completed jobs.
    Needs the old and new image of a change and nothing else: no state.
    ``latest_updates`` merges the updates of all batches."""

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in zip(("history", "equipment", "audit"), completion_effects(batch, clock)):
                write_batch(rows, out_dirs[name], batch_id)
        finally:
            batch.unpersist()

    _run(changes.writeStream.foreachBatch(fan_out).option("checkpointLocation", ckpt))


def stream_append(new: DataFrame, ledger: KeyLedger, key: str, order_by: str, floor: int, out_path: str, ckpt: str) -> None:
    """New rows with consecutive keys above ``floor``.  A micro-batch that is
    repeated finds its range in the ledger and overwrites its own rows."""

    def take_in(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_batch(ledger, str(batch_id), batch, key, order_by, floor, out_path)
        finally:
            batch.unpersist()

    _run(new.writeStream.foreachBatch(take_in).option("checkpointLocation", ckpt))


def latest_updates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: the update of its latest change over all batches."""
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in ("EquipmentID", "batch_id")]
    return stored.groupBy("EquipmentID").agg(F.max_by(F.struct(*columns), "change_id").alias("u")).select("EquipmentID", "u.*")


def hourly_counts(audit: DataFrame, lateness: str | None = None) -> DataFrame:
    """Audited operations per tumbling hour.  Users are not counted: exact
    distinct counts do not exist in streaming aggregation.

    The state is one row per hour, small enough to keep: without ``lateness``
    a late row still counts.  With it hours behind the watermark are closed."""
    status = F.col("Status")
    timed = event_time(audit, "Timestamp")
    if lateness is not None:
        timed = timed.withWatermark("Timestamp", lateness)
    return (
        timed.groupBy(F.window("Timestamp", "1 hour"))
        .agg(
            F.count(F.lit(1)).alias("Total_Operations"),
            count_if(status == "DENIED").alias("Denied_Operations"),
            count_if(status == "SUCCESS").alias("Successful_Operations"),
            count_if(status == "ERROR").alias("Error_Operations"),
        )
        .select(from_instant(F.col("window.start")).alias("Hour_Start"), "*")
        .drop("window")
    )


def stream_audit_hourly(audit: DataFrame, out_path: str, ckpt: str, lateness: str | None = None) -> None:
    """Hourly counts in update mode: every batch stores the hours it changed,
    so the hours that are still open are in the result too."""
    _run(
        hourly_counts(audit, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, out_path, batch_id))
        .option("checkpointLocation", ckpt)
    )


def latest_hours(spark: SparkSession, path: str) -> DataFrame:
    """The last stored state of every hour."""
    stored = spark.read.parquet(path)
    figures = [c for c in stored.columns if c not in ("Hour_Start", "batch_id")]
    return (
        stored.groupBy("Hour_Start")
        .agg(F.max_by(F.struct(*figures), "batch_id").alias("last"))
        .select("Hour_Start", "last.*")
    )

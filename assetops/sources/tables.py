"""Canonical tables, snapshots and reports in parquet."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetops.schema import KEYS, SCHEMAS, Tables, conform

# The date a table is filtered by: rows are clustered on it, so a scan skips
# files and row groups by their min/max statistics.
CLUSTER_BY = {
    "maintenance": "ActualDate",
    "history": "DateFixed",
    "alerts": "DateReported",
    "audit": "Timestamp",
}


#: How the source system writes dates and times in text files.
TEXT_FORMATS = {"dateFormat": "dd-MM-yyyy", "timestampNTZFormat": "dd-MM-yyyy HH:mm:ss"}


def load_tables(spark: SparkSession, path: str, fmt: str = "parquet", formats: dict[str, str] = TEXT_FORMATS) -> Tables:
    """Typed tables from ``path/<table>``; nothing is inferred.  ``fmt`` may
    also be ``csv`` (with a header) or another built-in format.  Text files are
    read by ``formats``, and a field that does not parse is an error."""
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        reader = reader.options(header=True, mode="FAILFAST", **formats)
    return Tables(**{name: reader.schema(schema).load(f"{path}/{name}") for name, schema in SCHEMAS.items()})


def _value(name: str, kind: T.DataType) -> dict[str, Column]:
    """A column's value in the field that holds values of its type: numbers,
    money in cents and days since 1970 as whole numbers, times, texts."""
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return {"text": c}
    if isinstance(kind, T.TimestampNTZType):
        return {"moment": c}
    if isinstance(kind, T.DecimalType):
        c = c * 10**kind.scale
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    return {"whole": c.cast("bigint")}


_PIECE = 22  # bits


def column_totals(t: Tables) -> DataFrame:
    """(table_name, column_name, n, distinct_n, total) of every column: values
    that are there, different values, and a sum over them: numbers as they are,
    money in cents, times in seconds, days since 1970, lengths of texts.  One
    pass per table: equal values of a column are counted map-side and meet once,
    and the sums are taken over the different values and their counts."""
    frames = []
    none = {"whole": F.lit(None).cast("bigint"), "moment": F.lit(None).cast("timestamp_ntz"), "text": F.lit(None).cast("string")}
    for name, df in t.items():
        fields = SCHEMAS[name].fields
        entries = []
        for i, f in enumerate(fields):
            value = {**none, **_value(f.name, f.dataType)}
            entries.append(F.struct(F.lit(i).alias("i"), *(value[k].alias(k) for k in none)))
        values = df.select(F.inline(F.array(*entries))).where("whole is not null or moment is not null or text is not null")
        counted = values.groupBy("i", *none).agg(F.count(F.lit(1)).alias("n"))
        measure = F.coalesce("whole", F.unix_seconds(F.col("moment").cast("timestamp")), F.length("text").cast("bigint"))
        # Sums of whole numbers in three pieces: no sum of pieces overflows.
        mask = F.lit(2**_PIECE - 1).cast("bigint")
        v = F.col("v")
        pieces = [v.bitwiseAND(mask), F.shiftright(v, _PIECE).bitwiseAND(mask), F.shiftright(v, 2 * _PIECE)]
        sums = [F.sum(F.col("n") * p).alias(f"s{k}") for k, p in enumerate(pieces)]
        found = counted.select("i", "n", measure.alias("v")).groupBy("i").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_n"), *sums)
        total = sum(F.col(f"s{k}").cast("decimal(19,0)") * F.lit(2 ** (_PIECE * k)).cast("decimal(14,0)") for k in range(len(pieces)))
        # Columns without values are rows too.
        names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(f.name).alias("column_name")) for i, f in enumerate(fields)))
        columns = df.sparkSession.range(1, numPartitions=1).select(F.inline(names))
        frames.append(
            columns.join(F.broadcast(found), "i", "left").select(
                F.lit(name).alias("table_name"),
                "column_name",
                *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "distinct_n")),
                F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def write_tables(t: Tables, path: str, fmt: str = "parquet") -> None:
    for name, df in t.items():
        df = conform(df, name)
        if name in CLUSTER_BY:
            # The key splits a date that holds much of the table.
            order = (CLUSTER_BY[name], KEYS[name])
            df = df.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order)
        writer = df.write.mode("overwrite").format(fmt)
        if fmt in ("csv", "json"):
            writer = writer.options(header=True, **TEXT_FORMATS)
        writer.save(f"{path}/{name}")


# Tables that are joined on a job, and the column they are bucketed by.
BUCKET_BY = {"maintenance": "MaintenanceID", "history": "MaintenanceID"}


def save_bucketed(t: Tables, path: str, buckets: int, prefix: str = "assetops_") -> None:
    """Catalog tables over ``path``; jobs and history share their buckets, so
    the join every report starts with shuffles neither side."""
    for name, df in t.items():
        df = conform(df, name)
        if name in BUCKET_BY:
            # One file per bucket instead of one per task and bucket.
            df = df.repartition(buckets, BUCKET_BY[name])
        writer = df.write.mode("overwrite").option("path", f"{path}/{name}")
        if name in BUCKET_BY:
            writer = writer.bucketBy(buckets, BUCKET_BY[name]).sortBy(BUCKET_BY[name])
        writer.saveAsTable(prefix + name)


def load_bucketed(spark: SparkSession, prefix: str = "assetops_") -> Tables:
    return Tables(**{name: spark.table(prefix + name) for name in SCHEMAS})


def write_snapshot(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace only the partitions present in ``df``: re-running a day or a
    month rewrites it and leaves the others alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


# How often reports are produced, with their period label.
CADENCES = ("daily", "weekly", "monthly", "quarterly", "annual")


def period_start(as_of: datetime, cadence: str) -> datetime:
    """First day of the period that ``as_of`` falls in."""
    from datetime import timedelta

    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    if cadence == "daily":
        return day
    if cadence == "weekly":
        return day - timedelta(days=day.weekday())
    if cadence == "monthly":
        return day.replace(day=1)
    if cadence == "quarterly":
        return day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1)
    if cadence == "annual":
        return day.replace(month=1, day=1)
    raise ValueError(f"unknown cadence {cadence!r}")


def write_report(df: DataFrame, name: str, as_of: datetime, path: str, cadence: str = "daily") -> str:
    """Store a report under ``path/name/report_date=...``; one per period."""
    target = f"{path}/{name}"
    dated = df.withColumn("report_date", F.lit(period_start(as_of, cadence).date()))
    write_snapshot(dated, target, "report_date")
    return target

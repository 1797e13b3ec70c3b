"""Stateful streams equal their batch reports, drop their state, and survive restarts."""

import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from assetops.operators import rules
from assetops.sources.mapping import RAW, as_changes, audit_rows, audited_events, map_testdata
from assetops.streaming import jobs as streams
from assetops.streaming import stateful


@pytest.fixture(scope="module")
def t(spark):
    return map_testdata(spark, SF)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.schema(RAW["events"]).parquet(f"{SF}/events.parquet")


def in_order(folder):
    """File times in the order of the parts, so that the stream reads them in it."""
    for i, part in enumerate(sorted(Path(folder).glob("part-*"))):
        os.utime(part, (10**9 + i, 10**9 + i))


@pytest.fixture(scope="module")
def event_files(events, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("ordered"))
    events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.mode("overwrite").parquet(folder)
    in_order(folder)
    return folder


@pytest.fixture(scope="module")
def last(events):
    return events.agg(F.max("ts")).first()[0]


def stream(spark, folder):
    return as_changes(streams.file_stream(spark, folder, RAW["events"], files_per_batch=1))


def state_rows(spark, ckpt, operators):
    read = spark.read.format("statestore")
    return [read.option("operatorId", i).load(ckpt).count() for i in range(operators)]


def hourly(audit):
    hour = F.date_trunc("hour", "Timestamp").cast("timestamp_ntz").alias("Hour_Start")
    return audit.groupBy(hour).agg(
        F.count(F.lit(1)).alias("Total_Operations"),
        F.count(F.when(F.col("Status") == "DENIED", 1)).alias("Denied_Operations"),
        F.count(F.when(F.col("Status") == "SUCCESS", 1)).alias("Successful_Operations"),
        F.count(F.when(F.col("Status") == "ERROR", 1)).alias("Error_Operations"),
        F.count_distinct("Username").alias("Active_Users"),
        F.count_distinct("TableName").alias("Tables_Modified"),
    )


def test_hours_close_and_their_state_goes(spark, t, event_files, last, tmp_path):
    out, ckpt, beats = (str(tmp_path / name) for name in ("out", "ckpt", "beats"))

    def run():
        audit = audit_rows(stream(spark, event_files), t.holidays)
        stateful.stream_hourly_distinct(audit, out, ckpt, "1 day", stateful.beats(spark, beats))
        return spark.read.parquet(out)

    batch = hourly(t.audit)
    closed = run()
    # What ended a day before the last event is there, and no more state than the last day's.
    assert rows(closed) == rows(batch.where(F.col("Hour_Start") <= F.lit(last - timedelta(days=1, hours=1))))
    kept = sum(state_rows(spark, ckpt, 2))
    users_and_tables = t.audit.where(F.col("Timestamp") > F.lit(last - timedelta(days=1, hours=1)))
    assert 0 < kept <= 2 * users_and_tables.count() < t.audit.count()
    stateful.write_beat(spark, beats, last + timedelta(days=3))
    assert rows(run()) == rows(batch)
    assert state_rows(spark, ckpt, 2) == [0, 0]
    assert rows(run()) == rows(batch)  # a restart adds nothing


def test_distinct_counts_of_repeated_null_and_hot_users(spark, tmp_path):
    day = datetime(2024, 5, 1)
    found = [(i, "T1", "hot", day + timedelta(seconds=i % 7200), "DENIED") for i in range(3000)]
    found += [(9000, None, None, day, "SUCCESS"), (9001, "T2", None, day, "ERROR"), (9002, "T2", "other", day, "SUCCESS")]
    schema = "LogID bigint, TableName string, Username string, Timestamp timestamp_ntz, Status string"
    spark.createDataFrame(found, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    stateful.write_beat(spark, str(tmp_path / "beats"), day + timedelta(days=9))
    audit = streams.file_stream(spark, str(tmp_path / "in"), schema)
    for _ in range(2):
        beat = stateful.beats(spark, str(tmp_path / "beats"))
        stateful.stream_hourly_distinct(audit, str(tmp_path / "out"), str(tmp_path / "ckpt"), "1 day", beat)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got) == rows(hourly(spark.createDataFrame(found, schema)))
    first = got.orderBy("Hour_Start").first()
    assert (first.Active_Users, first.Tables_Modified, first.Error_Operations) == (2, 2, 1)


def split_job(spark, folder, t, tmp_path, span="1 day"):
    def run():
        beat = stateful.beats(spark, str(tmp_path / "beats"))
        changes = stream(spark, folder) if isinstance(folder, str) else folder()
        stateful.stream_split_changes(changes, t.holidays, str(tmp_path / "out"), str(tmp_path / "ckpt"), span, "1 day", beat)
        return spark.read.parquet(str(tmp_path / "out"))

    return run


def test_statements_that_span_files(spark, t, event_files, last, tmp_path):
    """Four files in time order cut statements; whole ones come out, once each."""
    parts = spark.read.schema(RAW["events"]).parquet(event_files).withColumn("file", F.input_file_name())
    files = parts.groupBy(F.expr("event_id div 4").alias("s")).agg(F.count_distinct("file").alias("n"))
    assert files.where("n > 1").count() > 0
    run = split_job(spark, event_files, t, tmp_path)
    early = run()
    stateful.write_beat(spark, str(tmp_path / "beats"), last + timedelta(days=5))
    batch = rules.split_changes(audited_events(spark, SF), t.holidays, "statement_id").select(*early.columns)
    assert 0 < early.count() < batch.count() and early.exceptAll(batch).count() == 0
    assert rows(run()) == rows(batch)
    waiting = spark.read.format("statestore").option("operatorId", 0).option("joinSide", "left")
    assert waiting.load(str(tmp_path / "ckpt")).count() == 0


def test_a_hot_statement(spark, t, tmp_path):
    """A third of all changes in one statement, denied by its very last one."""
    saturday = datetime(2024, 5, 4, 12)
    schema = "change_id bigint, statement_id bigint, table_name string, op string, username string, event_ts timestamp_ntz"
    hot = [(i, 1, "EQUIPMENT", "UPDATE", "u", saturday + timedelta(seconds=i)) for i in range(1500)]
    hot.append((1500, 1, "EQUIPMENT", "DELETE", "u", datetime(2024, 5, 6, 0, 0, 1)))  # Monday
    rest = [(2000 + i, 2 + i // 3, "MAINTENANCE", "INSERT", "u", saturday + timedelta(minutes=i % 700)) for i in range(3000)]
    frame = spark.createDataFrame(hot + rest, schema)
    frame.repartitionByRange(3, "event_ts").write.parquet(str(tmp_path / "in"))
    in_order(tmp_path / "in")
    stateful.write_beat(spark, str(tmp_path / "later"), datetime(2024, 6, 1))
    run = split_job(spark, lambda: streams.file_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1), t, tmp_path, "2 days")
    run()
    spark.read.parquet(str(tmp_path / "later")).write.mode("append").parquet(str(tmp_path / "beats"))
    got = run()
    batch = rules.split_changes(frame, t.holidays, "statement_id").select(*got.columns)
    assert rows(got) == rows(batch) and got.where("side = 'rejected'").count() == 1501

"""Streams equal batches, also over several files, replays and restarts."""

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from assetops.operators import rules
from assetops.sources import feeds
from assetops.sources.mapping import AS_OF, RAW, as_changes, audit_rows, audited_events, map_testdata
from assetops.streaming import jobs as streams


@pytest.fixture(scope="module")
def t(spark):
    return map_testdata(spark, SF)


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    """The events as four files, in time order."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = spark.read.schema(RAW["events"]).parquet(f"{SF}/events.parquet")
    events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.mode("overwrite").parquet(folder)
    return folder


def stream(spark, folder):
    return streams.file_stream(spark, folder, RAW["events"], files_per_batch=1)


def test_audit(spark, t, event_files, tmp_path):
    out = str(tmp_path / "out")
    changes = feeds.equipment_changes(as_changes(stream(spark, event_files)), t)
    for _ in range(2):  # a restart finds nothing new
        streams.stream_audit(changes, rules.EQUIPMENT_SPEC, t.holidays, out, str(tmp_path / "state"))
    batch = rules.audit_changes(
        feeds.equipment_changes(audited_events(spark, SF), t), rules.EQUIPMENT_SPEC, t.holidays
    )
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_completion_is_idempotent_per_batch(spark, t, tmp_path):
    feed = feeds.job_updates(t.maintenance)
    feed.repartition(3).write.parquet(str(tmp_path / "feed"))
    out = {name: str(tmp_path / name) for name in ("history", "equipment", "audit")}
    changes = streams.file_stream(spark, str(tmp_path / "feed"), feed.schema, files_per_batch=1)
    streams.stream_completion(changes, AS_OF, out, str(tmp_path / "state"))
    history, updates, audit = rules.completion_effects(feed, AS_OF)
    assert rows(streams.latest_updates(spark, out["equipment"])) == rows(updates)
    stored = spark.read.parquet(out["history"])
    assert stored.select("batch_id").distinct().count() == 3
    assert rows(stored.drop("batch_id")) == rows(history)
    assert rows(spark.read.parquet(out["audit"]).drop("batch_id")) == rows(audit)
    before = stored.count()
    again = spark.read.parquet(out["history"]).filter("batch_id = 1").drop("batch_id").cache()
    again.count()
    streams.write_batch(again, out["history"], 1)  # the same batch once more
    assert spark.read.parquet(out["history"]).count() == before


def test_warranty_alerts_drop_replays(spark, t, event_files, tmp_path):
    near = t.equipment.withColumn("Status", F.lit("ACTIVE")).withColumn(
        "WarrantyExpiry", AS_OF.in_days(3) + F.make_dt_interval(days=(F.col("EquipmentID") % 100).cast("int"))
    )
    lively = t.but(equipment=near)
    events = spark.read.parquet(event_files)
    twice = str(tmp_path / "twice")
    events.unionByName(events).repartitionByRange(2, "ts").write.parquet(twice)
    changes = feeds.equipment_changes(as_changes(stream(spark, twice)), lively)
    streams.stream_warranty_alerts(changes, AS_OF, str(tmp_path / "out"), str(tmp_path / "state"), "60 days")
    batch = rules.warranty_alerts(feeds.equipment_changes(audited_events(spark, SF), lively), AS_OF)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 100 and rows(got) == rows(batch)


@pytest.mark.parametrize("lateness", [None, "60 days"])
def test_hourly_counts_include_open_and_late_hours(spark, t, event_files, tmp_path, lateness):
    """The files arrive in any order."""
    audit = audit_rows(as_changes(stream(spark, event_files)), t.holidays)
    streams.stream_audit_hourly(audit, str(tmp_path / "out"), str(tmp_path / "state"), lateness)
    got = streams.latest_hours(spark, str(tmp_path / "out")).select(
        "Hour_Start", "Total_Operations", "Denied_Operations"
    )
    batch = t.audit.groupBy(F.date_trunc("hour", "Timestamp").cast("timestamp_ntz").alias("Hour_Start")).agg(
        F.count(F.lit(1)).alias("Total_Operations"),
        F.count(F.when(F.col("Status") == "DENIED", 1)).alias("Denied_Operations"),
    )
    assert rows(got) == rows(batch)

"""Stored tables that change safely: stops at every step, rivals, months, updates, keys, refresh."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from assetops import catalog
from assetops.clock import Clock
from assetops.operators import constraint_state, quality, rules
from assetops.plans import due, refresh, snapshots
from assetops.sources import versioned
from assetops.sources.mapping import AS_OF, map_testdata
from assetops.sources.versioned import CommitLog, KeyLedger, MonthTable, UpsertTable


@pytest.fixture(scope="module")
def t(spark):
    from assetops.storage import cut

    t = map_testdata(spark, SF)
    return t.but(maintenance=cut(t.maintenance), history=cut(t.history))


def test_an_entry_is_taken_once(spark, tmp_path):
    a, b = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    assert a.latest() == (-1, None)
    assert a.commit(0, {"x": 1}) and not b.commit(0, {"x": 2})
    assert b.latest() == (0, {"x": 1}) and b.commit(1, {"x": 3}) and a.numbers() == [0, 1]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


class Stop(Exception):
    pass


def stopped_after(monkeypatch, steps):
    """Every write, commit and delete counts as a step; the next one is a stop."""
    left = [steps]

    def counted(real):
        def call(*args, **kwargs):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return real(*args, **kwargs)

        return call

    monkeypatch.setattr(versioned.VersionedTable, "_written", counted(versioned.VersionedTable._written))
    monkeypatch.setattr(CommitLog, "commit", counted(CommitLog.commit))


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_a_stop_during_a_purge_loses_nothing(spark, t, tmp_path, monkeypatch, steps):
    """Before, between and after its two steps the table is the old or the new one."""
    months = MonthTable(spark, "maintenance", str(tmp_path))
    months.write(t.maintenance)
    whole = t.maintenance.count()
    kept = rules.purge(t.maintenance, "ActualDate", AS_OF).where("side = 'kept'").count()
    assert kept < whole
    stopped_after(monkeypatch, steps)
    if steps < 2:
        with pytest.raises(Stop):
            months.purge(AS_OF)
        assert months.load().count() == whole
    else:
        assert months.purge(AS_OF)
        assert months.load().count() == kept
    monkeypatch.undo()
    months.purge(AS_OF)  # the job runs again
    left = months.load()
    assert left.count() == kept
    assert months.vacuum() > 0 and left.count() == kept
    assert months.vacuum() == 0 and rows(left.select("MaintenanceID")) == rows(MonthTable(spark, "maintenance", str(tmp_path)).load().select("MaintenanceID"))


def test_readers_of_the_old_entry_finish(spark, t, tmp_path):
    months = MonthTable(spark, "maintenance", str(tmp_path))
    months.write(t.maintenance)
    before = months.load()
    months.purge(AS_OF)
    assert before.count() == t.maintenance.count() > months.load().count()


def test_two_writers(spark, small, tmp_path):
    """A rival commits between another's reading and its entry: both changes last."""
    mine, theirs = (MonthTable(spark, "maintenance", str(tmp_path)) for _ in range(2))
    mine.write(small.maintenance)
    tries = []

    def step(entry):
        if not tries:
            theirs.replace(lambda e: theirs.read(e, ["2025-09"]).limit(0), ["2025-09"])
        tries.append(sorted(entry["parts"]))
        entry["parts"].pop("2025-10")
        return entry

    mine.change(step)
    assert len(tries) == 2 and "2025-09" in tries[0] and "2025-09" not in tries[1]
    assert mine.parts() == ["2022-01", "2025-11", "2025-12"]


def test_months_are_read_alone(spark, small, tmp_path):
    months = MonthTable(spark, "maintenance", str(tmp_path))
    undated = small.maintenance.withColumn("ActualDate", F.when(F.col("MaintenanceID") != 17, F.col("ActualDate")))
    months.write(undated)
    some = months.between("2025-10", "2025-11")
    assert all("2025-10" in f or "2025-11" in f for f in some.inputFiles()) and some.inputFiles()
    assert {r.MaintenanceID for r in some.collect()} == {10, 11, 13, 15, 16}
    assert rows(months.load()) == rows(undated)
    with pytest.raises(ValueError, match="not replaced"):
        months.replace(lambda e: months.read(e), ["2025-10"])
    months.purge(Clock(datetime(2026, 9, 1)))
    assert [r.MaintenanceID for r in months.load().collect()] == [17]


def test_empty_tables(spark, small, tmp_path):
    months = MonthTable(spark, "maintenance", str(tmp_path))
    assert months.load().count() == 0 and months.purge(AS_OF) == []
    months.write(small.maintenance.limit(0))
    assert months.load().count() == 0 and months.purge(AS_OF) == [] and months.between("2000-01", "2030-01").count() == 0


def files(table, part):
    return sorted(table.read(table.entry(), [part]).inputFiles())


@pytest.mark.parametrize("delivered", [(0, 1, 2), (2, 0, 1)])
def test_upserts_equal_a_rewrite(spark, tmp_path, delivered):
    base = spark.createDataFrame([(i, f"n{i}", "A") for i in range(200)], "k int, name string, state string")
    found = [(i * 3 % 260, f"s{i}" if i % 7 else None, i) for i in range(300)]
    updates = spark.createDataFrame(found, "k int, state string, change int")
    table = UpsertTable(spark, str(tmp_path), base.schema, "k", updates.schema, "change", 8)
    table.write(base)
    wanted = rows(rules.apply_updates(base, updates, "k", "change"))
    for n, third in enumerate(delivered):
        table.upsert(updates.where(F.col("change") % 3 == third))
        if n == 1:
            assert table.compact(least_files=2) == [str(i) for i in range(8)]
            assert table.entry()["changes"] == {}
    assert rows(table.load()) == wanted
    table.compact()
    assert rows(table.load()) == wanted and table.load().columns == ["k", "name", "state"]


def test_compaction_leaves_untouched_buckets(spark, tmp_path):
    base = spark.createDataFrame([(i, "A") for i in range(400)], "k int, state string")
    one = spark.createDataFrame([(5, "B", 1), (900, "C", 2)], "k int, state string, change int")
    table = UpsertTable(spark, str(tmp_path), base.schema, "k", one.schema, "change", 8)
    table.write(base)
    before = {p: files(table, p) for p in table.parts()}
    table.upsert(one)
    bucket = next(p for p in table.parts() if table.read(table.entry(), [p]).where("k = 5").count())
    changed = table.compact()
    assert bucket in changed and len(changed) <= 2
    after = {p: files(table, p) for p in table.parts()}
    assert {p for p in before if before[p] != after[p]} <= set(changed)
    assert table.load().where("state = 'B'").count() == 1 and table.load().count() == 400


def test_a_batch_gets_its_keys_once(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "ledger"))
    first = ledger.claim("0", 10, 100)
    assert first == 101 and ledger.claim("1", 5, 100) == 111
    assert ledger.claim("0", 10, 100) == 101  # again
    assert KeyLedger(spark, str(tmp_path / "ledger")).claim("2", 1, 100) == 116
    assert ledger.claim("3", 2, 5000) == 5001 and ledger.claim("4", 1, 0) == 5003
    with pytest.raises(ValueError, match="comes again"):
        ledger.claim("1", 6, 100)


def test_rivals_never_share_keys(spark, tmp_path, monkeypatch):
    mine, theirs = (KeyLedger(spark, str(tmp_path)) for _ in range(2))
    real, once = CommitLog.commit, []

    def commit(self, number, entry):
        if not once:
            once.append(theirs.claim("rival", 7, 0) if not once.append(None) else None)
        return real(self, number, entry)

    monkeypatch.setattr(CommitLog, "commit", commit)
    assert mine.claim("me", 3, 0) == 8 and theirs.claim("rival", 7, 0) == 1


def test_a_stopped_append_comes_again(spark, tmp_path):
    """The range is noted, the rows are not written; a later batch, then the first again."""
    ledger, out = KeyLedger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")
    batches = {str(n): spark.range(n * 10, n * 10 + 4 + n).withColumnRenamed("id", "change") for n in range(3)}
    ledger.claim("0", 4, 50)
    for n in ("1", "2", "0", "1"):
        versioned.append_batch(ledger, n, batches[n].repartition(3), "key", "change", 50, out)
    got = {r.change: r.key for r in spark.read.parquet(out).collect()}
    assert got == {**{i: 51 + i for i in range(4)}, **{10 + i: 55 + i for i in range(5)}, **{20 + i: 60 + i for i in range(6)}}


def test_refresh_equals_a_full_run(spark, t, tmp_path):
    earlier = catalog._earlier_jobs(t.maintenance)
    kept = refresh.MonthlySummary(spark, str(tmp_path), t)
    kept.start(earlier, t.history, AS_OF)
    stored = {p: f for p, f in kept.summary.entry()["parts"].items()}
    feed = refresh.changes_between(earlier, t.maintenance)
    assert {r.op for r in feed.select("op").distinct().collect()} == {"INSERT", "UPDATE", "DELETE"}
    touched = kept.apply(feed, AS_OF)
    assert rows(kept.summary.load()) == rows(snapshots.monthly_maintenance_summary(t, AS_OF))
    assert rows(kept.jobs.load()) == rows(t.maintenance)
    # A few months of many were read and replaced; the others' files stay.
    assert 3 <= len(touched) <= 6 < len(kept.summary.parts()) < len(kept.jobs.parts())
    after = kept.summary.entry()["parts"]
    assert {p for p in stored if after.get(p) != stored[p]} <= set(touched)
    scans = kept._computed(AS_OF, touched).inputFiles()
    mine = [f for f in scans if str(tmp_path) in f]
    assert mine and all(any(f"_part={m}" in f for m in touched) for f in mine)


def test_refresh_when_the_clock_moves(spark, t, tmp_path):
    before = Clock(AS_OF.as_of - timedelta(days=75))
    kept = refresh.MonthlySummary(spark, str(tmp_path), t)
    kept.start(t.maintenance, t.history, before)
    same = t.maintenance.where("MaintenanceID % 1000 = 0")
    feed = same.select(
        F.col("MaintenanceID").alias("change_id"), F.lit("UPDATE").alias("op"), F.struct("*").alias("old"), F.struct("*").alias("new")
    ).where(F.col("new.ActualDate") > AS_OF.in_days(-200))
    kept.apply(feed, AS_OF, before)
    assert rows(kept.summary.load()) == rows(snapshots.monthly_maintenance_summary(t, AS_OF))


def test_nothing_but_named_folders_is_read(spark, small, tmp_path):
    months = MonthTable(spark, "maintenance", str(tmp_path))
    months.write(small.maintenance)
    torn = Path(tmp_path) / "maintenance" / "data-torn" / "_part=2025-11"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_text("torn")
    assert rows(months.load()) == rows(small.maintenance) and months.vacuum() == 1 and not torn.exists()


def test_violations_after_feeds_equal_a_full_run(spark, small, tmp_path):
    """Keys that lose and regain their parent, values shared and freed, rows that go."""
    rules_ = quality.canonical_rules()
    names = ("departments", "technicians", "equipment", "maintenance", "alerts", "history")
    now = {name: getattr(small, name) for name in names}
    every = {name: df for name, df in small.items()}
    state = constraint_state.ConstraintState(spark, str(tmp_path), rules_)
    state.apply({name: constraint_state.whole(df) for name, df in every.items()}, batch=0)
    assert rows(state.violations()) == rows(quality.violations(every, rules_))
    key = F.col("EquipmentID")
    steps = [
        {"departments": small.departments.where("DeptID <> 1")},  # its pieces and people are orphans
        {"equipment": small.equipment.withColumn("SerialNumber", F.when(key <= 3, F.lit("S")).otherwise(F.col("SerialNumber")))},
        {"equipment": small.equipment.where("EquipmentID not in (1, 3)"), "departments": small.departments},
        {"maintenance": small.maintenance.withColumns({"Status": F.lit("ODD"), "TechnicianID": F.lit(999).cast("bigint")})},
        {"equipment": now["equipment"].unionByName(now["equipment"].where("EquipmentID = 2")), "maintenance": small.maintenance.limit(0)},
        dict(every),
    ]
    seen = set()
    for batch, step in enumerate(steps, 1):
        # Tables with repeated keys are deleted and inserted as a whole.
        feed = {}
        for name, after in step.items():
            gone = constraint_state.whole(every[name]).select(F.col("new").alias("old"), F.col("old").alias("new"))
            feed[name] = gone.unionByName(constraint_state.whole(after))
            every[name] = after
        state.apply(feed, batch)
        state.apply(feed, batch)  # again
        full = rows(quality.violations(every, rules_))
        assert rows(state.violations()) == full, batch
        seen.add(sum(int(r.violations) for r in state.violations().collect()))
        if batch == 3:
            assert state.state.compact()
            assert rows(state.violations()) == full
    assert len(seen) > 3
    # Only the sums are read for a report, and zeros are not kept.
    assert all("_part=sum" in f for f in state.violations().inputFiles())
    assert state.state.load().where("n = 0").count() == 0


def test_only_changed_keys_are_looked_up(spark, small, tmp_path):
    state = constraint_state.ConstraintState(spark, str(tmp_path), quality.canonical_rules())
    state.apply({name: constraint_state.whole(df) for name, df in small.items()}, batch=0)
    before = {p: len(f) for p, f in state.state.entry()["changes"].items()}
    one = small.equipment.where("EquipmentID = 5")
    feed = one.select(F.struct("*").alias("old"), F.struct(*(F.lit(3).cast("bigint").alias(c) if c == "DepartmentID" else F.col(c) for c in one.columns)).alias("new"))
    state.apply({"equipment": feed}, batch=1)
    after = {p: len(f) for p, f in state.state.entry()["changes"].items()}
    assert len([p for p in after if after[p] != before.get(p)]) <= 2  # the value 3; no violation changed
    assert rows(state.violations()) == rows(quality.violations({**dict(small.items()), "equipment": small.equipment.where("EquipmentID <> 5").unionByName(feed.select("new.*"))}, quality.canonical_rules()))


def test_features_after_daily_runs_equal_a_full_run(spark, tmp_path):
    """Every hour of 40 days a date flips somewhere; runs at odd hours, some days left out."""
    start = datetime(2025, 3, 1, 7)
    found = []
    for i in range(400):
        at = start + timedelta(hours=i * 3 - 300)
        bought = start - timedelta(days=1825 + (i % 3) * 1826 - i % 30)
        found.append((i, at if i % 9 else None, at + timedelta(days=i % 60) if i % 7 else None, bought if i % 11 else None))
    # Dates at the very instant of a run, and its limits.
    for n, offset in enumerate([0, 7, 30, 90]):
        found += [(1000 + n, start + timedelta(days=10 + offset), start + timedelta(days=10 + offset), start)]
    schema = "EquipmentID bigint, NextMaintenanceDate timestamp_ntz, WarrantyExpiry timestamp_ntz, PurchaseDate timestamp_ntz"
    pieces = spark.createDataFrame(found, schema)
    kept = due.DueFeatures(spark, str(tmp_path))
    kept.start(pieces, Clock(start))
    last, total = Clock(start), len(kept.table.parts())
    for n, day in enumerate([1, 2, 2.5, 5, 10, 10, 11, 40]):
        clock, feed = Clock(start + timedelta(days=day)), None
        if n in (2, 4):
            ids = F.col("EquipmentID")
            new = pieces.where(ids % 13 == n).withColumn("NextMaintenanceDate", F.lit(clock.as_of).cast("timestamp_ntz"))
            come = spark.createDataFrame([(5000 + n, start, None, start)], schema)
            gone = pieces.where(ids % 17 == n)
            old = pieces.select(F.struct("*").alias("old"), "EquipmentID")
            after = pieces.join(gone, "EquipmentID", "left_anti").join(new.select("EquipmentID"), "EquipmentID", "left_anti")
            after = after.unionByName(new.join(gone, "EquipmentID", "left_anti")).unionByName(come)
            both = old.join(after.select(F.struct("*").alias("new"), "EquipmentID"), "EquipmentID", "full")
            feed = both.where(~F.col("old").eqNullSafe(F.col("new"))).select("old", "new").cache()
            pieces = spark.createDataFrame(after.collect(), schema)
        read = kept.run(clock, last, feed)
        if feed is None:
            # Days and months that have come, and what they held is dealt anew.
            today = clock.as_of.strftime("%Y-%m-%d")
            assert all(folder <= today for folder in read) and len(read) < total
            assert all(len(f) == 10 or f > today[:7] for f in kept.table.parts() if f != due.NEVER)
        last = clock
        assert rows(kept.load()) == rows(due.features(pieces, clock).select("EquipmentID", *due.BANDS)), day
    assert kept.run(last, last) == kept.due(last)


def test_days_of_age():
    for units in due.AGE_STEPS:
        d = due.days_of_age(units)
        assert [(200 * 100 * x + 36525) // 73050 >= units for x in (d - 1, d)] == [False, True]


def test_counts_of_a_feed_are_written_once_and_meet_in_one_grouping(spark, small, tmp_path):
    """A feed's counts go straight to the state: they are written and read once, and
    uses and parents are not joined but summed together."""
    from assetops import storage

    state = constraint_state.ConstraintState(spark, str(tmp_path), quality.canonical_rules())
    before = len(storage._written)
    state.apply({name: constraint_state.whole(df) for name, df in small.items()}, batch=0)
    assert len(storage._written) == before
    entry = state.state.entry()
    one = small.equipment.where("EquipmentID = 5")
    found, moved = state.state.stored(state._key_counts(state._images(constraint_state.whole(one)), "equipment", [], ["EquipmentID"]))
    assert [tuple(r) for r in moved.collect()] == [("key", None, None, "equipment", "5", 1)]
    assert state.state.entry() == entry and len(found) == 1  # not named yet
    text = state._moved_sums(entry, sorted(found), moved)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "Window" not in text and text.count("Exchange hashpartitioning(i#") == 2

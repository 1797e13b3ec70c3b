"""Running totals and as-of verdicts against brute force; random parents."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import table
from pyspark.sql import functions as F

from assetops.operators import asof
from assetops.operators.ranking import random_parents

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("parts", [1, 8, 31])
def test_running_totals_across_partitions(spark, parts, monkeypatch):
    """One group holds half of the rows, so it crosses many borders."""
    draw = random.Random(3)
    data = [(None if i % 50 == 7 else 0 if i % 2 else draw.randrange(40), draw.randrange(300), i, draw.choice([1, -1, None])) for i in range(2000)]
    df = spark.createDataFrame(data, "g int, at int, id int, delta int").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.id: (r.total, r.twice) for r in asof.running_totals(df, "g", ["at", "id"], {"total": "delta", "twice": "delta"}).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    wanted, sums = {}, {}
    for g, at, i, delta in sorted((r for r in data if r[0] is not None), key=lambda r: (r[0], r[1], r[2])):
        sums[g] = sums.get(g, 0) + (delta or 0)
        wanted[i] = (sums[g], sums[g])
    assert got == wanted


def moment(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


def brute(requests, jobs, alerts):
    def held(spans, piece, at):
        return sum(1 for p, a, b, is_open in spans if p == piece and (a or T0) <= at and (is_open or (b is not None and max(a or T0, b) > at)))

    out = []
    for change, piece, at, _ in requests:
        when = at or T0
        n, m = (held(s, piece, when) if piece is not None else 0 for s in (jobs, alerts))
        out.append((change, piece, n, m, -20004 if n else -20005 if m else None))
    return sorted(out, key=str)


def test_guard_as_of_the_request(spark):
    draw = random.Random(8)
    pieces = [1] * 20 + list(range(2, 30))

    def spans(n):
        out = []
        for _ in range(n):
            a = draw.randrange(400)
            kind = draw.random()
            out.append((draw.choice(pieces), moment(a), moment(a + draw.randrange(-3, 60)) if kind < 0.9 else None, kind > 0.6))
        return out

    jobs, alerts = spans(900), spans(700)
    jobs += [(1, moment(5), moment(9), False), (None, moment(5), None, True)]
    requests = [(i, draw.choice(pieces), moment(draw.randrange(420)), "ACTIVE") for i in range(800)]
    requests += [(5, 1, moment(9), "ACTIVE"), (5, 1, moment(9), "ACTIVE"), (9001, None, moment(7), "ACTIVE"), (9002, 777, moment(7), None)]

    def frame(rows):
        df = spark.createDataFrame(rows, "EquipmentID bigint, opened timestamp_ntz, closed timestamp_ntz, is_open boolean")
        return asof.open_spans(df, "EquipmentID", F.col("opened"), F.col("closed"), F.col("is_open"))

    asked = spark.createDataFrame(requests, "change_id bigint, EquipmentID bigint, event_ts timestamp_ntz, old_status string")
    got = asof.decommission_guard_asof(asked, frame(jobs), frame(alerts)).collect()
    seen = sorted(((r.change_id, r.EquipmentID, r.open_jobs, r.open_alerts, r.error_code) for r in got), key=str)
    assert seen == brute(requests, jobs, alerts)
    assert {r.verdict for r in got} == {"ALLOWED", "DENIED"} and {r.error_code for r in got} == {None, -20004, -20005}


def test_the_order_of_events_decides(spark):
    jobs = table(spark, "maintenance", [dict(MaintenanceID=1, EquipmentID=7, Status="COMPLETED", ScheduledDate=moment(10), CompletionDate=moment(20))])
    alerts = table(spark, "alerts", [dict(AlertID=1, EquipmentID=7, Status="PENDING", DateReported=moment(30))])
    hours = [5, 10, 15, 20, 25, 30, 99]
    asked = spark.createDataFrame([(h, 7, moment(h), "ACTIVE") for h in hours], "change_id bigint, EquipmentID bigint, event_ts timestamp_ntz, old_status string")
    got = asof.decommission_guard_asof(asked, asof.job_spans(jobs), asof.alert_spans(alerts)).collect()
    codes = {r.change_id: r.error_code for r in got}
    assert [codes[h] for h in hours] == [None, -20004, -20004, None, None, -20005, -20005]


def test_no_requests_no_events(spark):
    none = spark.createDataFrame([], "EquipmentID bigint, at timestamp_ntz, delta int")
    asked = spark.createDataFrame([(1, 2, T0, "ACTIVE")], "change_id bigint, EquipmentID bigint, event_ts timestamp_ntz, old_status string")
    assert [r.verdict for r in asof.decommission_guard_asof(asked, none, none).collect()] == ["ALLOWED"]
    assert asof.decommission_guard_asof(asked.limit(0), none, none).count() == 0


def test_no_range_join_in_the_guard(spark):
    asked = spark.createDataFrame([(1, 2, T0, "ACTIVE")], "change_id bigint, EquipmentID bigint, event_ts timestamp_ntz, old_status string")
    moves = spark.createDataFrame([(2, T0, 1)], "EquipmentID bigint, at timestamp_ntz, delta int")
    plan = asof.decommission_guard_asof(asked, moves, moves)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_random_parents(spark):
    children = spark.range(4000).withColumnRenamed("id", "row").withColumn("Parent", F.lit(1))
    keys = spark.createDataFrame([(k,) for k in [*range(10, 1000, 37), 10, 47, None]], "k int")
    got = random_parents(children, "row", {"a": keys, "b": keys, "none": keys.limit(0)}, seed=3)
    assert got.columns == ["row", "Parent", "a", "b", "none"] and got.count() == 4000
    known = set(range(10, 1000, 37))
    rows = got.collect()
    assert {r.a for r in rows} == known and {r.b for r in rows} == known and all(r.none is None for r in rows)
    per = got.groupBy("a").count().collect()
    assert all(80 < r["count"] < 260 for r in per)  # even, about 148 each
    assert 0.01 < sum(r.a == r.b for r in rows) / 4000 < 0.09  # columns are drawn apart
    again = random_parents(children.repartition(3), "row", {"a": keys.repartition(4)}, seed=3)
    assert sorted((r.row, r.a) for r in again.collect()) == sorted((r.row, r.a) for r in rows)
    other = random_parents(children, "row", {"a": keys}, seed=4)
    assert sum(a != b for a, b in zip(sorted((r.row, r.a) for r in other.collect()), sorted((r.row, r.a) for r in rows))) > 3000


def test_random_parent_of_a_row_without_key(spark):
    children = spark.createDataFrame([(None,), (None,), (1,)], "row int")
    keys = spark.createDataFrame([(5,), (9,)], "k int")
    got = random_parents(children, "row", {"p": keys}).collect()
    assert len(got) == 3 and all(r.p in (5, 9) for r in got)

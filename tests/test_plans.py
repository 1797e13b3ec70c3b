"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SF

from assetops.catalog import QUERIES
from assetops.operators import quality, rules
from assetops.plans import metrics, reports, snapshots
from assetops.sources import feeds
from assetops.sources import tables as store
from assetops.sources.mapping import AS_OF, AUDIT_AS_OF, map_testdata


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """(pushed filters, read schema) of every scan, in full."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"PushedFilters: (.*)\nReadSchema: (.*)", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    store.write_tables(map_testdata(spark, SF), folder)
    return store.load_tables(spark, folder)


@pytest.fixture
def no_auto_broadcast(spark):
    """Dimensions too large to broadcast: only proven bounds remain."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


SLOW = ("load_tables", "load_tables_csv", "purge_monthly", "constraint_rejects", "report_sink", "constraint_violations", "constraint_violations_gen1")
# Many written steps, whose last plan reads a stored table.
SLOW += ("features_due", "constraint_violations_incremental", "snapshot_monthly_refreshed", "upsert_equipment")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream") and n not in SLOW))
def test_no_product_and_no_python(spark, no_auto_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(stored):
    df = reports.maintenance_cost(stored, AS_OF)
    filters, schema = next(scan for scan in scans(df) if "ActualDate" in scan[1])
    assert "EqualTo(Status,COMPLETED)" in filters
    assert "GreaterThanOrEqual(ActualDate,2000-07-01T12:00)" in filters
    assert not re.search("Description|PartsReplaced|ScheduledDate|TechnicianID", schema)


def test_month_is_a_pushed_range(stored):
    from assetops.clock import month_bounds, ntz
    from assetops.operators.facts import jobs_with_history
    from pyspark.sql import functions as F

    start, end = month_bounds(2001, 3)
    inside = (F.col("ActualDate") >= ntz(start)) & (F.col("ActualDate") < ntz(end))
    filters = next(f for f, schema in scans(jobs_with_history(stored, inside)) if "ActualDate" in schema)
    assert "GreaterThanOrEqual(ActualDate,2001-03-01T00:00)" in filters
    assert "LessThan(ActualDate,2001-04-01T00:00)" in filters


def test_recent_audit_is_pruned(stored):
    filters, schema = scans(reports.audit_compliance(stored.audit, AUDIT_AS_OF))[0]
    assert "GreaterThanOrEqual(Timestamp,2024-01-01T00:00)" in filters
    assert "OldValue" not in schema and "PrimaryKeyValue" not in schema


@pytest.mark.parametrize(
    "build",
    [
        lambda t: reports.equipment_risk_assessment(t, AS_OF),
        lambda t: reports.equipment_lifecycle(t, AS_OF),
        lambda t: reports.equipment_health(t, AS_OF),
        lambda t: reports.maintenance_cost(t, AS_OF),
        lambda t: reports.maintenance_analytics(t, AS_OF),
        lambda t: snapshots.monthly_maintenance_summary(t, AS_OF),
        lambda t: metrics.mtbf(t),
        lambda t: metrics.cost_pct_of_value(t),
        lambda t: rules.decommission_guard(feeds.decommission_requests(t), t.maintenance, t.alerts),
        lambda t: quality.violations(dict(t.items()), quality.canonical_rules()),
    ],
)
def test_facts_are_combined_before_they_shuffle_on_equipment(stored, no_auto_broadcast, build):
    """Jobs, history and alerts meet an equipment key as partial aggregates;
    only the equipment table itself is shuffled row by row."""
    text = plan(build(stored))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(EquipmentID#" not in line:
            continue
        below = lines[i + 1]
        if "HashAggregate" in below:
            continue
        # Otherwise the rows come from the scan of the equipment table.
        scan = next(line for line in lines[i:] if "FileScan" in line)
        assert "PurchaseDate#" in scan or "DepartmentID#" in scan or "FileScan parquet [EquipmentID#" in scan, scan
        assert "MaintenanceID#" not in scan and "AlertID#" not in scan, scan


def test_health_only_reports_do_not_read_jobs(stored):
    for df in (snapshots.daily_equipment_status(stored, AS_OF), metrics.department_health(stored, AS_OF)):
        assert "MaintenanceID" not in plan(df)


def test_bucketed_tables_join_without_a_shuffle(spark, no_auto_broadcast, tmp_path):
    from assetops.operators.facts import jobs_with_history

    store.save_bucketed(map_testdata(spark, SF), str(tmp_path), 4, "plan_test_")
    joined = jobs_with_history(store.load_bucketed(spark, "plan_test_"))
    assert "Exchange" not in plan(joined) and joined.count() == map_testdata(spark, SF).maintenance.count()


def test_column_totals_do_not_multiply_whole_rows(stored):
    """Every value is counted by itself, map-side, instead of one row of all
    columns per column; and tables are scanned once."""
    text = plan(store.column_totals(stored))
    assert "Expand" not in text and text.count("FileScan") == 9


def test_staged_jobs_are_derived_once(spark):
    t, plain = map_testdata(spark, SF, staged=True), map_testdata(spark, SF)
    assert t.maintenance.inputFiles() == t.history.inputFiles()
    assert not any("lineitem" in f for f in t.history.inputFiles())
    for name in ("maintenance", "history"):
        mine, theirs = getattr(t, name), getattr(plain, name)
        assert mine.dtypes == theirs.dtypes
        assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()

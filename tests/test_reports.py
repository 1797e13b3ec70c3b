"""Weights against brute force: the joins as written, on few rows."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from assetops.plans import metrics, reports, snapshots
from assetops.sources.mapping import AS_OF


def test_department_performance_counts_the_product(small, clock, sql):
    brute = sql(
        """
        with done as (select * from maintenance
            where Status = 'COMPLETED' and ActualDate >= :now - interval 12 month),
        product as (select d.DeptID, e.EquipmentID eq, e.Status st, e.PurchasePrice price, e.NextMaintenanceDate nx,
                e.health_units hu, m.Cost cost, h.DowntimeHours hrs, t.TechID tech
            from departments d left join equipment e on e.DepartmentID = d.DeptID
            left join done m on m.EquipmentID = e.EquipmentID
            left join history h on h.MaintenanceID = m.MaintenanceID
            left join technicians t on t.DepartmentID = d.DeptID)
        select DeptID, count(eq) Total_Equipment, count_if(st = 'ACTIVE') Active_Equipment,
            count_if(st = 'UNDER_MAINTENANCE') Under_Maintenance, count_if(nx < :now) Overdue_Maintenance,
            sum(coalesce(price, 0)) Total_Equipment_Value, sum(coalesce(cost, 0)) Maintenance_Cost_Last_Year,
            round(avg(cast(coalesce(hu, 0) as decimal(12,4)) / 10), 1) Avg_Health_Score,
            round(avg(cast(coalesce(hrs, 0) as decimal(12,4))), 1) Avg_Downtime_Hours,
            count(distinct tech) Assigned_Technicians,
            rank() over (order by sum(coalesce(price, 0)) desc) Equipment_Value_Rank,
            rank() over (order by sum(coalesce(cost, 0)) desc) Maintenance_Cost_Rank
        from product group by DeptID"""
    )
    got = reports.department_performance(small, clock).drop("DeptName", "Location", "HeadOfDept")
    assert rows(got) == rows(brute)


def test_department_performance_corrected_totals_are_base_totals(small, clock):
    got = reports.department_performance(small, clock, "corrected")
    totals = got.agg(F.sum("Total_Equipment"), F.sum("Total_Equipment_Value")).first()
    assert tuple(totals) == (5, Decimal("4000.00"))


def test_risk_counts_the_product(small, clock, sql):
    brute = sql(
        """
        select e.EquipmentID, count(m.MaintenanceID) Total_Maintenance_Count,
            count_if(m.MaintenanceType = 'EMERGENCY') Emergency_Maintenance_Count,
            sum(coalesce(m.Cost, 0)) Total_Maintenance_Cost,
            round(avg(cast(coalesce(h.DowntimeHours, 0) as decimal(12,4))), 1) Avg_Downtime_Hours,
            count(a.AlertID) Active_Alerts, count_if(a.Priority = 'CRITICAL') Critical_Alerts
        from equipment e join departments d on d.DeptID = e.DepartmentID
        left join maintenance m on m.EquipmentID = e.EquipmentID and m.Status = 'COMPLETED'
        left join history h on h.MaintenanceID = m.MaintenanceID
        left join alerts a on a.EquipmentID = e.EquipmentID and a.Status in ('PENDING', 'IN_PROGRESS')
        where e.Status != 'DECOMMISSIONED' group by e.EquipmentID"""
    )
    got = reports.equipment_risk_assessment(small, clock).select(*brute.columns)
    assert rows(got) == rows(brute)


def test_risk_corrected_counts_each_job_and_alert_once(small, clock):
    got = {r.EquipmentID: r for r in reports.equipment_risk_assessment(small, clock, "corrected").collect()}
    assert (got[1].Total_Maintenance_Count, got[1].Active_Alerts, got[1].Critical_Alerts) == (3, 2, 1)
    assert got[1].Total_Maintenance_Cost == Decimal("153.05")
    assert set(got) == {1, 2, 3, 6}


def test_monthly_performance_counts_the_product(small, clock, sql):
    brute = sql(
        """
        with inside as (select * from maintenance where year(ActualDate) = 2025 and month(ActualDate) = 11)
        select d.DeptName, count(e.EquipmentID) Equipment_Count, count_if(e.Status = 'ACTIVE') Active_Equipment,
            count(m.MaintenanceID) Maintenance_Count, sum(coalesce(m.Cost, 0)) Total_Maintenance_Cost,
            round(avg(cast(coalesce(m.Cost, 0) as decimal(12,4))), 2) Avg_Maintenance_Cost,
            sum(coalesce(h.DowntimeHours, 0)) Total_Downtime_Hours,
            round(avg(cast(coalesce(h.DowntimeHours, 0) as decimal(12,4))), 1) Avg_Downtime_Hours,
            round(avg(cast(coalesce(e.health_units, 0) as decimal(12,4)) / 10), 1) Avg_Health_Score,
            round(100 * cast(count_if(m.Status = 'COMPLETED') as decimal(12,4)) / nullif(count(m.MaintenanceID), 0), 1)
                Maintenance_Completion_Rate
        from departments d left join equipment e on e.DepartmentID = d.DeptID
        left join inside m on m.EquipmentID = e.EquipmentID
        left join history h on h.MaintenanceID = m.MaintenanceID group by d.DeptName"""
    )
    got = reports.monthly_performance(small, clock, 11, 2025).select(*brute.columns)
    assert rows(got) == rows(brute)


def test_month_defaults_to_the_clock(small, clock):
    assert rows(reports.monthly_performance(small, clock)) == rows(reports.monthly_performance(small, clock, 12, 2025))


def test_technician_analytics_counts_the_product(small, clock, sql):
    brute = sql(
        """
        select t.TechID, count(m.MaintenanceID) Total_Maintenance_Assigned,
            count_if(m.Status = 'COMPLETED') Completed_Maintenance, sum(coalesce(m.Cost, 0)) Total_Cost_Managed,
            round(avg(cast(coalesce(m.Cost, 0) as decimal(12,4))), 2) Avg_Cost_Per_Maintenance,
            round(avg(cast(coalesce(h.DowntimeHours, 0) as decimal(12,4))), 1) Avg_Downtime_Hours,
            sum(coalesce(h.DowntimeHours, 0)) Total_Downtime_Hours,
            rank() over (order by count(m.MaintenanceID) desc) Productivity_Rank,
            rank() over (order by avg(coalesce(h.DowntimeHours, 999))) Efficiency_Rank,
            rank() over (order by sum(coalesce(m.Cost, 0)) desc) Cost_Management_Rank
        from technicians t left join maintenance m on m.TechnicianID = t.TechID
        left join history h on h.MaintenanceID = m.MaintenanceID where t.Status = 'ACTIVE' group by t.TechID"""
    )
    got = reports.technician_analytics(small, clock)
    assert rows(got.select(*brute.columns)) == rows(brute)
    scores = {r.TechID: r.Workload_Score for r in got.collect()}
    assert scores == {100: Decimal("100.0"), 101: 0, 103: 0}


def test_analytics_and_cost_count_the_product(small, clock, sql):
    brute = sql(
        """
        select date_format(m.ActualDate, 'yyyy-MM') Month, e.Category, count(*) Total_Maintenance,
            sum(m.Cost) Total_Cost, round(avg(m.Cost), 2) Avg_Cost, sum(h.DowntimeHours) Total_Downtime_Hours,
            round(avg(cast(h.DowntimeHours as decimal(12,4))), 1) Avg_Downtime_Hours
        from maintenance m join equipment e on e.EquipmentID = m.EquipmentID
        left join history h on h.MaintenanceID = m.MaintenanceID
        where m.Status = 'COMPLETED' and m.ActualDate >= :now - interval 24 month group by 1, 2"""
    )
    assert rows(reports.maintenance_analytics(small, clock).select(*brute.columns)) == rows(brute)
    cost = sql(
        """
        select date_format(m.ActualDate, 'yyyy-MM') Month, d.DeptName, count(*) Maintenance_Count,
            sum(m.Cost) Total_Cost, sum(h.DowntimeHours) Total_Downtime
        from maintenance m join equipment e on e.EquipmentID = m.EquipmentID
        join departments d on d.DeptID = e.DepartmentID left join history h on h.MaintenanceID = m.MaintenanceID
        where m.Status = 'COMPLETED' and m.ActualDate >= :now - interval 12 month group by 1, 2"""
    )
    assert rows(reports.maintenance_cost(small, clock).select(*cost.columns)) == rows(cost)


def test_monthly_summary_counts_the_product(small, clock, sql):
    brute = sql(
        """
        select date_format(m.ActualDate, 'yyyy-MM') Month, d.DeptName, e.Category, count(*) Total_Maintenance,
            sum(m.Cost) Total_Cost, sum(coalesce(h.DowntimeHours, 0)) Total_Downtime,
            count(distinct t.TechID) Technicians_Involved
        from maintenance m join equipment e on e.EquipmentID = m.EquipmentID
        join departments d on d.DeptID = e.DepartmentID left join history h on h.MaintenanceID = m.MaintenanceID
        left join technicians t on t.TechID = m.TechnicianID
        where m.Status = 'COMPLETED' and m.ActualDate >= :now - interval 24 month group by 1, 2, 3"""
    )
    got = snapshots.monthly_maintenance_summary(small, clock)
    assert rows(got.select(*brute.columns)) == rows(brute)
    assert {r.Completion_Rate for r in got.collect()} == {Decimal("100.0")}


def test_health_report_counts_the_product(small, clock, sql):
    brute = sql(
        """
        select e.EquipmentID, count(m.MaintenanceID) Maintenance_Count, round(avg(m.Cost), 2) Avg_Maintenance_Cost,
            sum(h.DowntimeHours) Total_Downtime
        from equipment e join departments d on d.DeptID = e.DepartmentID
        left join maintenance m on m.EquipmentID = e.EquipmentID
        left join history h on h.MaintenanceID = m.MaintenanceID where e.Status = 'ACTIVE' group by e.EquipmentID"""
    )
    assert rows(reports.equipment_health(small, clock).select(*brute.columns)) == rows(brute)


def test_technician_dashboard_drops_the_idle(small, clock):
    got = reports.technician_dashboard(small, clock).collect()
    assert [r.FullName for r in got] == ["T100", "T101"]
    assert got[0].Total_Jobs == 7 and got[0].Performance_Rank == 1  # job 10 has two history rows


def test_lifecycle_at_age_zero(small, clock):
    got = {r.EquipmentID: r for r in reports.equipment_lifecycle(small, clock).collect()}
    assert set(got) == {1, 3, 6}
    assert got[6].Annual_Utilization_Pct is None and got[6].Age_Category == "NEW (0-3 years)"


def test_schedule_ignores_lookahead_and_keeps_scores_from_30(small, clock):
    a, b = (reports.predictive_schedule(small, clock, days) for days in (1, 365))
    assert rows(a) == rows(b)
    assert a.filter("Calculated_Risk_Score < 30").count() == 0


def test_mtbf_is_the_mean_gap(small):
    got = {r.EquipmentID: r for r in metrics.mtbf(small).collect()}
    assert got[3].MTBF_Days is None and got[3].Failures == 1
    assert got[1].Failures == 2 and got[1].MTBF_Days == Decimal("1419.00")


def test_unknown_fanout_is_refused(small, clock):
    with pytest.raises(ValueError):
        reports.equipment_risk_assessment(small, clock, "other")


def test_urgent_equipment_equals_the_filtered_risk_report(spark):
    from conftest import SF

    from assetops.sources.mapping import map_testdata

    t = map_testdata(spark, SF)
    risk = reports.equipment_risk_assessment(t, AS_OF)
    expected = (
        risk.filter("Health_Score < 60")
        .orderBy("Health_Score", "EquipmentID")
        .limit(5)
        .select("EquipmentID", "Name", "Category", "DeptName", "Health_Score", "Failure_Risk", "Recommendation")
    )
    assert rows(reports.urgent_equipment(t, AS_OF)) == rows(expected)

"""One SQL statement per query that SQL can express."""

from __future__ import annotations

from oracle.base import AUDIT_NOW, NOW, cents, cycle, pct, rounded, with_tables

ORACLE: dict[str, str] = {}


def add(name: str, tables: str, body: str, **extra: str) -> None:
    if name in ORACLE:
        raise ValueError(name)
    ORACLE[name] = with_tables(tables.split(), body, **extra)


# Fixed values, here and in the statements below: the labels that reports give to
# priorities, specialties, health, due dates and warranties.
YEAR_AGO = f"({NOW} - interval 12 month)"
TWO_YEARS_AGO = f"({NOW} - interval 24 month)"
DUE = f"""case when nextmaintenancedate < {NOW} then 'OVERDUE'
    when nextmaintenancedate <= {NOW} + interval 7 day then 'DUE IN 7 DAYS'
    when nextmaintenancedate <= {NOW} + interval 30 day then 'DUE IN 30 DAYS' else 'ON SCHEDULE' end"""
COVER = f"""case when warrantyexpiry is null then 'NO WARRANTY' when warrantyexpiry < {NOW} then 'EXPIRED'
    when warrantyexpiry <= {NOW} + interval 30 day then 'EXPIRING SOON' else 'ACTIVE' end"""
D = "::double"
DMY = "upper(strftime({}, '%d-%b-%Y'))"

DIRTY_EQ = """select * replace (case when departmentid = 3 then departmentid + 1000000000
    when equipmentid % 30 <> 11 then departmentid end as departmentid) from eq"""
DIRTY_JOB = """select * replace (
    case when equipmentid % 5 = 0 then equipmentid + 1000000000 when maintenanceid % 40 <> 7 then equipmentid end as equipmentid,
    case when technicianid % 7 = 3 then technicianid + 1000000000 when maintenanceid % 50 <> 9 then technicianid end
        as technicianid) from job"""

# Sources, sinks and snapshots

add("map_departments", "dept", "select * from dept")
add("map_technicians", "tech", "select * from tech")
add("map_users", "usr", "select * from usr")
add("map_equipment", "eq", f"select * replace (purchaseprice{D} as purchaseprice) from eq")
add("map_maintenance", "job", f'select * exclude (down) replace ("cost"{D} as "cost") from job')
add("map_history", "hist", f'select * replace ("cost"{D} as "cost") from hist')
add("map_alerts", "alert", "select * from alert")
add("map_audit", "aud", "select * from aud")
add("first_rows", "eq", 'select 20 "rows", 20 distinct_rows, 20 members')
add(
    "sample_rows",
    "eq",
    """select equipmentid, "name" from eq order by md5(cast(equipmentid as varchar) || '/7'), equipmentid limit 20""",
)
add(
    "map_holidays",
    "holi",
    "select holidayid, holidayname, strftime(holidaydate, '%Y-%m-%d') holidaydate, yr as \"year\" from holi",
)
# Filled columns by kind of total: text, number, money, moment, day.
FILLED_COLUMNS = {
    "departments": ("dept", "DeptName:t Location:t HeadOfDept:t DeptID:n"),
    "technicians": ("tech", "TechID:n FullName:t Specialty:t DepartmentID:n Status:t CertificationLevel:t"),
    "users": ("usr", "UserID:n Username:t FullName:t Role:t DepartmentID:n Status:t PasswordHash:p"),
    "equipment": (
        "eq",
        "EquipmentID:n SerialNumber:t Name:t Category:t PurchaseDate:m PurchasePrice:c WarrantyExpiry:m Status:t"
        " DepartmentID:n NextMaintenanceDate:m UtilizationHours:n",
    ),
    "maintenance": (
        "job",
        "MaintenanceID:n EquipmentID:n TechnicianID:n MaintenanceType:t ScheduledDate:m ActualDate:m CompletionDate:m"
        " Status:t Cost:c Description:t PartsReplaced:t",
    ),
    "history": ("hist", "HistoryID:n EquipmentID:n MaintenanceID:n TechnicianID:n ActionTaken:t DateFixed:m Cost:c DowntimeHours:n"),
    "alerts": (
        "alert",
        "AlertID:n EquipmentID:n AlertType:t Priority:t DateReported:m Status:t ResolutionDate:m IssueDescription:t",
    ),
    "audit": (
        "aud",
        "LogID:n TableName:t Operation:t PrimaryKeyValue:t Username:t Timestamp:m Status:t ErrorMessage:t",
    ),
    "holidays": ("holi", "HolidayID:n HolidayName:t HolidayDate:d yr:n"),
}
TOTAL = {
    "t": "length({})",
    "n": "{}",
    "c": "cast({} * 100 as bigint)",
    "m": "cast(floor(epoch({})) as bigint)",
    "d": "date_diff('day', date '1970-01-01', {})",
}


def column_totals(whole_seconds: bool = False) -> str:
    """Text files keep whole seconds."""
    out = []
    for table, (cte, columns) in FILLED_COLUMNS.items():
        for column in columns.split():
            name, kind = column.split(":")
            value = "'*'" if kind == "p" else f'"{name.lower()}"'
            total = TOTAL["t" if kind == "p" else kind].format(value)
            label = "Year" if name == "yr" else name
            distinct = f"date_trunc('second', {value})" if whole_seconds and kind == "m" else value
            out.append(
                f"""select '{table}' table_name, '{label}' column_name, count({value}) n, count(distinct {distinct}) distinct_n,
                cast(coalesce(sum({total}), 0) as bigint) total from {cte} having count({value}) > 0"""
            )
    return " union all ".join(out)


COUNTS = {
    "DEPARTMENTS": "dept",
    "TECHNICIANS": "tech",
    "EQUIPMENT": "eq",
    "USERS": "usr",
    "MAINTENANCE": "job",
    "MAINTENANCE_HISTORY": "hist",
    "ALERTS": "alert",
    "AUDIT_LOG": "aud",
    "HOLIDAYS": "holi",
}
ALL_TABLES = "dept tech eq usr job hist alert aud holi"


def counts(names) -> str:
    return " union all ".join(f"select '{n}' table_name, count(*) cnt from {COUNTS[n]}" for n in names)


add("load_tables", ALL_TABLES, column_totals())
add("load_tables_csv", ALL_TABLES, column_totals(whole_seconds=True))
add(
    "adapt_gen1_equipment",
    "g_eq",
    """select equipmentid, "name", upper(category) category, departmentid, case status when 'Working' then 'ACTIVE'
    when 'Faulty' then 'INACTIVE' else upper(replace(status, ' ', '_')) end status from g_eq""",
)
add(
    "adapt_gen1_maintenance",
    "job",
    f"""select maintenanceid, equipmentid, actualdate scheduleddate, actualdate, 'COMPLETED' status, "cost"{D} "cost"
    from job""",
)
add(
    "adapt_gen1_alerts",
    "g_alert",
    """select alertid, equipmentid, issuedescription, datereported,
    if(coalesce(trim(status), 'Open') in ('Open', 'Pending'), 'PENDING', 'RESOLVED') status from g_alert""",
)
add(
    "adapt_gen1_audit",
    "chg",
    """select change_id logid, 'EQUIPMENT' tablename, op operation, cast(row_key as varchar) primarykeyvalue, username,
    if(weekend, 'SUCCESS', 'DENIED') status,
    if(weekend, null, 'Operation disallowed: Weekday (Mon-Fri)') errormessage from chg""",
)
add(
    "complete_to_history_seed",
    "job",
    f"""select equipmentid, maintenanceid, technicianid, description actiontaken, actualdate + interval 1 day datefixed,
    "cost"{D} "cost", 2 + maintenanceid % 47 downtimehours,
    'Maintenance completed successfully. ' || coalesce(partsreplaced, '') || '.' notes,
    row_number() over (order by maintenanceid) historyid from job where status = 'COMPLETED'""",
)
add(
    "snapshot_daily_equipment_status",
    "fit dept",
    f"""select '2001-07-01' snapshot_date, deptname, category, count(*) total_equipment,
    count(*) filter (where status = 'ACTIVE') active,
    count(*) filter (where status = 'UNDER_MAINTENANCE') under_maintenance,
    count(*) filter (where status = 'INACTIVE') inactive,
    count(*) filter (where status = 'DECOMMISSIONED') decommissioned,
    count(*) filter (where nextmaintenancedate < {NOW}) overdue_maintenance,
    count(*) filter (where warrantyexpiry < {NOW}) expired_warranty,
    {rounded("sum(health)", "count(*)", 1, 1)} avg_health_score, sum(purchaseprice){D} total_value
    from fit join dept on deptid = departmentid group by deptname, category""",
)
add(
    "snapshot_monthly_maintenance",
    "job hist eq dept tech",
    f"""select strftime(actualdate, '%Y-%m') "month", deptname, category, count(*) total_maintenance,
    count(*) filter (where maintenancetype = 'PREVENTIVE') preventive,
    count(*) filter (where maintenancetype = 'CORRECTIVE') corrective,
    count(*) filter (where maintenancetype = 'EMERGENCY') emergency,
    sum(j."cost"){D} total_cost, {rounded(cents('sum(j."cost")'), 'count(j."cost")', 2, 2)} avg_cost,
    cast(sum(coalesce(downtimehours, 0)) as bigint) total_downtime,
    {rounded("sum(coalesce(downtimehours, 0))", "count(*)", 1)} avg_downtime,
    count(distinct techid) technicians_involved, 100.0{D} completion_rate
    from job j join eq using (equipmentid) join dept on deptid = eq.departmentid
    left join hist h on h.maintenanceid = j.maintenanceid left join tech on techid = j.technicianid
    where j.status = 'COMPLETED' and actualdate >= {TWO_YEARS_AGO} group by all""",
)
COST_ROWS = f"""from job j join eq using (equipmentid) join dept on deptid = departmentid
    left join hist h on h.maintenanceid = j.maintenanceid
    where j.status = 'COMPLETED' and actualdate >= {YEAR_AGO} group by 1, 2"""
add(
    "report_sink",
    "job eq dept hist",
    f"""select strftime(actualdate, '%Y-%m') "month", deptname, '2001-07-01' report_date, count(*) maintenance_count,
    sum(j."cost"){D} total_cost {COST_ROWS}""",
)

# Projections, filters and predicates

add(
    "sample_equipment",
    "eq",
    """select equipmentid, serialnumber, "name", category, status, departmentid from eq order by equipmentid limit 10""",
)
add(
    "holiday_list",
    "order_holi",
    f"""select holidayid, holidayname, {DMY.format("holidaydate")} holiday_day, yr as "year" from order_holi""",
)
add(
    "recent_audit",
    "aud",
    f"""select logid, tablename, operation, primarykeyvalue, username,
    {DMY.format('"timestamp"')} || strftime("timestamp", ' %H:%M:%S') "time", status, left(errormessage, 50) error
    from aud order by logid desc limit 50""",
)
add("pending_alerts", "alert", "select alertid, equipmentid, issuedescription from alert where status = 'PENDING'")
add(
    "denied_audit_count",
    "aud",
    f"""select count(*) total, count(*) filter (where status = 'DENIED') denied,
    count(*) filter (where "timestamp" >= {AUDIT_NOW} - interval 24 hour) total_24h,
    count(*) filter (where status = 'DENIED' and "timestamp" >= {AUDIT_NOW} - interval 24 hour) denied_24h from aud""",
)
add(
    "maintenance_due_soon",
    "eq",
    f"""select equipmentid, "name", nextmaintenancedate, {DUE} maintenance_status from eq
    where nextmaintenancedate is not null and status = 'ACTIVE'""",
)
add(
    "warranty_expiring",
    "eq",
    f"""select equipmentid, "name", warrantyexpiry, case when warrantyexpiry < {NOW} then 'EXPIRED'
    when warrantyexpiry <= {NOW} + interval 30 day then 'EXPIRES IN 30 DAYS'
    when warrantyexpiry <= {NOW} + interval 90 day then 'EXPIRES IN 90 DAYS' else 'VALID' end warranty_status
    from eq where warrantyexpiry is not null""",
)
add("warranty_status", "eq", f"select equipmentid, {COVER} warranty_status from eq")
add("distinct_status", "alert", "select distinct status from alert")
ADVICE = """case when health < 400 then 'CRITICAL - NEEDS REPLACEMENT' when health < 600 then 'POOR - SCHEDULE MAINTENANCE'
    when health < 800 then 'FAIR - MONITOR CLOSELY' else 'GOOD - NORMAL OPERATION' end"""
add(
    "urgent_equipment",
    "feat dept",
    f"""select equipmentid, "name", category, deptname, health / 1e1 health_score, risk failure_risk,
    {ADVICE} recommendation from feat join dept on deptid = departmentid
    where status <> 'DECOMMISSIONED' and health < 600 order by health, equipmentid limit 5""",
)
add(
    "predictive_top",
    "feat dept",
    f"""select equipmentid, "name", health / 1e1 health_score, {ADVICE} recommendation
    from feat join dept on deptid = departmentid
    where status <> 'DECOMMISSIONED' and health < 700 order by health, equipmentid limit 3""",
)

# Data quality

add("row_counts", ALL_TABLES, counts(COUNTS))
add(
    "data_statistics",
    "dept tech eq job alert",
    counts(["EQUIPMENT", "MAINTENANCE", "ALERTS", "TECHNICIANS", "DEPARTMENTS"]),
)
add(
    "orphan_equipment",
    "eq dept",
    """select equipmentid, departmentid from deq where departmentid is not null
    and not exists (select 1 from dept where deptid = departmentid)""",
    deq=DIRTY_EQ,
)
add(
    "orphan_maintenance",
    "job eq tech",
    """select maintenanceid, equipmentid, technicianid from djob j
    where not exists (select 1 from eq where eq.equipmentid = j.equipmentid)
    or not exists (select 1 from tech where techid = j.technicianid)""",
    djob=DIRTY_JOB,
)


def fk_checks(eq: str, job: str) -> str:
    return f"""select 'All equipment has valid department' as "check", if(exists (select 1 from {eq} e
        where departmentid is not null and not exists (select 1 from dept where deptid = e.departmentid)), 'FAIL', 'PASS') result
    union all select 'All maintenance has valid equipment', if(exists (select 1 from {job} j
        where not exists (select 1 from eq where eq.equipmentid = j.equipmentid)), 'FAIL', 'PASS')
    union all select 'All maintenance has valid technician', if(exists (select 1 from {job} j
        where not exists (select 1 from tech where techid = j.technicianid)), 'FAIL', 'PASS')"""


add("fk_verification", "job eq tech dept", fk_checks("deq", "djob"), deq=DIRTY_EQ, djob=DIRTY_JOB)
add("fk_verification_clean", "job eq tech dept", fk_checks("eq", "job"))
add(
    "completeness",
    "job eq tech dept",
    """select 'Departments with no equipment' as "check", count(*) as "count" from dept d
        where not exists (select 1 from deq where departmentid = d.deptid)
    union all select 'Equipment with no maintenance', count(*) from eq e where status = 'ACTIVE'
        and not exists (select 1 from djob j where j.equipmentid = e.equipmentid)
    union all select 'Technicians with no assigned maintenance', count(*) from tech t
        where not exists (select 1 from djob j where j.technicianid = t.techid)""",
    deq=DIRTY_EQ,
    djob=DIRTY_JOB,
)
add(
    "status_distribution",
    "eq job alert",
    " union all ".join(
        f"select '{label}' table_name, status, count(*) cnt from {t} group by status"
        for label, t in (("EQUIPMENT", "eq"), ("MAINTENANCE", "job"), ("ALERTS", "alert"))
    ),
)
IDS = {
    "DEPARTMENTS": "deptid",
    "TECHNICIANS": "techid",
    "EQUIPMENT": "equipmentid",
    "USERS": "userid",
    "MAINTENANCE": "maintenanceid",
    "MAINTENANCE_HISTORY": "historyid",
    "ALERTS": "alertid",
    "AUDIT_LOG": "logid",
    "HOLIDAYS": "holidayid",
}
add(
    "max_ids",
    ALL_TABLES,
    " union all ".join(
        f"select '{n}' table_name, cast(coalesce(max({IDS[n]}), 0) as bigint) max_id from {COUNTS[n]}" for n in COUNTS
    ),
)


def _rule(table: str, rule: str, sql: str) -> str:
    return f"select '{table}' table_name, '{rule}' \"rule\", cast(({sql}) as bigint) violations"


def _broken(cte: str, condition: str) -> str:
    return f"select count(*) from {cte} where {condition}"


def _repeats(cte: str, col: str) -> str:
    return f"select count({col}) - count(distinct {col}) from {cte}"


def _strays(cte: str, col: str, parent: str, key: str) -> str:
    return f"select count(*) from {cte} c where {col} is not null and not exists (select 1 from {parent} p where p.{key} = c.{col})"


CTE_OF = {
    "departments": ("dept", "DeptID"),
    "technicians": ("tech", "TechID"),
    "equipment": ("eq", "EquipmentID"),
    "users": ("usr", "UserID"),
    "maintenance": ("job", "MaintenanceID"),
    "history": ("hist", "HistoryID"),
    "alerts": ("alert", "AlertID"),
    "audit": ("aud", "LogID"),
    "holidays": ("holi", "HolidayID"),
}
# Columns the mapping leaves NULL: no value of theirs can break a rule.
EMPTY = {
    "departments": ["ContactEmail"],
    "technicians": ["ContactPhone", "Email"],
    "equipment": ["Manufacturer", "Model"],
    "users": ["Email"],
    "maintenance": ["CreatedBy"],
    "history": ["Notes"],
    "alerts": ["ResolutionNotes", "AssignedTo"],
    "audit": [],
    "holidays": [],
}
FILLED = {"users": {"PasswordHash": "'*'"}}


def _canonical_violations() -> str:
    out = []

    def col(table: str, name: str) -> str:
        if name in EMPTY[table]:
            return "null"
        return FILLED.get(table, {}).get(name, f'"{name.lower()}"')

    for table, (cte, key) in CTE_OF.items():
        out.append(_rule(table, f"{key} not null", _broken(cte, f"{key} is null")))
        out.append(_rule(table, f"{key} unique", _repeats(cte, key)))
    required = {
        "departments": "DeptName",
        "technicians": "FullName",
        "equipment": "SerialNumber Name Category PurchaseDate",
        "users": "Username PasswordHash FullName",
        "holidays": "HolidayName HolidayDate",
    }
    for table, names in required.items():
        for name in names.split():
            out.append(_rule(table, f"{name} not null", _broken(CTE_OF[table][0], f"{col(table, name)} is null")))
    out.append(_rule("equipment", "SerialNumber unique", _repeats("eq", "serialnumber")))
    out.append(_rule("users", "Username unique", _repeats("usr", "username")))
    domains = [
        ("equipment", "Status", "ACTIVE INACTIVE UNDER_MAINTENANCE DECOMMISSIONED"),
        ("users", "Role", "ADMIN TECHNICIAN MANAGER VIEWER"),
        ("maintenance", "MaintenanceType", "PREVENTIVE CORRECTIVE EMERGENCY"),
        ("maintenance", "Status", "SCHEDULED IN_PROGRESS COMPLETED CANCELLED"),
        ("alerts", "AlertType", "MAINTENANCE_DUE WARRANTY_EXPIRY CRITICAL_ISSUE LOW_USAGE HIGH_USAGE"),
        ("alerts", "Priority", "LOW MEDIUM HIGH CRITICAL"),
        ("alerts", "Status", "PENDING IN_PROGRESS RESOLVED ESCALATED"),
        ("audit", "Operation", "INSERT UPDATE DELETE"),
        ("audit", "Status", "SUCCESS DENIED ERROR"),
    ]
    for table, name, values in domains:
        inside = ", ".join(f"'{v}'" for v in values.split())
        out.append(
            _rule(table, f"{name} domain", _broken(CTE_OF[table][0], f"{col(table, name)} not in ({inside})"))
        )
    parents = [
        ("technicians", "DepartmentID", "departments"),
        ("equipment", "DepartmentID", "departments"),
        ("users", "DepartmentID", "departments"),
        ("maintenance", "EquipmentID", "equipment"),
        ("maintenance", "TechnicianID", "technicians"),
        ("history", "EquipmentID", "equipment"),
        ("history", "MaintenanceID", "maintenance"),
        ("history", "TechnicianID", "technicians"),
        ("alerts", "EquipmentID", "equipment"),
    ]
    for table, name, parent in parents:
        out.append(_rule(table, f"{name} in {parent}", _strays(CTE_OF[table][0], name, *CTE_OF[parent])))
    out.append(_rule("alerts", "AssignedTo in technicians", "select 0"))
    lengths = {
        "departments": dict(DeptName=100, Location=200, HeadOfDept=100, ContactEmail=100),
        "technicians": dict(
            FullName=100, ContactPhone=20, Email=100, Specialty=100, Status=20, CertificationLevel=50
        ),
        "equipment": dict(SerialNumber=50, Name=200, Category=50, Manufacturer=100, Model=50, Status=20),
        "users": dict(Username=50, PasswordHash=200, FullName=100, Email=100, Role=30, Status=20),
        "maintenance": dict(MaintenanceType=30, Status=20, PartsReplaced=500, CreatedBy=100),
        "history": dict(Notes=1000),
        "alerts": dict(AlertType=30, IssueDescription=500, Priority=20, Status=20, ResolutionNotes=1000),
        "audit": dict(TableName=50, Operation=10, PrimaryKeyValue=100, Username=100, Status=20, ErrorMessage=1000),
        "holidays": dict(HolidayName=100),
    }
    for table, limits in lengths.items():
        for name, limit in limits.items():
            value = col(table, name)
            sql = "select 0" if value == "null" else _broken(CTE_OF[table][0], f"length({value}) > {limit}")
            out.append(_rule(table, f"{name} length", sql))
    return " union all ".join(out)


add("constraint_violations", ALL_TABLES, _canonical_violations())
add(
    "constraint_rejects",
    "eq job tech dept",
    """select 'equipment' table_name, 'SerialNumber unique' "rule", cast(equipmentid as varchar) row_key, serialnumber "value"
        from (select *, min(equipmentid) over (partition by serialnumber) keeps from eq) where equipmentid <> keeps
    union all select 'equipment', 'DepartmentID in departments', cast(equipmentid as varchar), cast(departmentid as varchar)
        from deq where departmentid not in (select deptid from dept)
    union all select 'maintenance', 'EquipmentID in equipment', cast(maintenanceid as varchar), cast(equipmentid as varchar)
        from djob where equipmentid not in (select equipmentid from eq)
    union all select 'maintenance', 'TechnicianID in technicians', cast(maintenanceid as varchar), cast(technicianid as varchar)
        from djob where technicianid not in (select techid from tech)""",
    deq=DIRTY_EQ,
    djob=DIRTY_JOB,
)
NONE = "select 0"
add(
    "constraint_violations_gen1",
    "g_eq g_alert dept tech job",
    " union all ".join(
        _rule(*r)
        for r in [
            ("departments", "DeptID not null", NONE),
            ("departments", "DeptName not null", NONE),
            ("departments", "DeptName unique", _repeats("dept", "deptname")),
            ("technicians", "TechID not null", NONE),
            ("technicians", "FullName not null", NONE),
            ("technicians", "Contact unique", _repeats("tech", "techid % 997")),
            ("technicians", "Contact length", NONE),
            *(("equipment", f"{c} not null", NONE) for c in ("EquipmentID", "Name", "Category", "Status")),
            ("equipment", "Status domain", NONE),
            ("equipment", "Category domain", NONE),
            ("equipment", "DepartmentID in departments", _strays("g_eq", "departmentid", "dept", "deptid")),
            *(("maintenance", f"{c} not null", NONE) for c in ("EquipmentID", "TechnicianID", "MaintenanceDate")),
            ("maintenance", "EquipmentID in equipment", _strays("job", "equipmentid", "g_eq", "equipmentid")),
            ("maintenance", "TechnicianID in technicians", _strays("job", "technicianid", "tech", "techid")),
            *(("history", f"{c} not null", NONE) for c in ("EquipmentID", "TechnicianID", "ActionTaken")),
            *(("alerts", f"{c} not null", NONE) for c in ("EquipmentID", "IssueDescription", "DateReported")),
            ("alerts", "Status domain", _broken("g_alert", "status not in ('Pending', 'Resolved')")),
            ("alerts", "IssueDescription length", NONE),
            ("alerts", "Status length", NONE),
        ]
    ),
)

# Joins

add(
    "equipment_department",
    "eq dept",
    'select "name", category, status, deptname from eq join dept on deptid = departmentid',
)
add(
    "maintenance_detail",
    "job eq tech",
    f"""select maintenanceid, "name" equipment, fullname technician, maintenancetype, job.status, "cost"{D} "cost"
    from job join eq using (equipmentid) join tech on techid = technicianid order by maintenanceid limit 10""",
)
add(
    "equipment_dept_maintenance",
    "job eq dept",
    f"""select "name", category, deptname, actualdate maintenancedate, "cost"{D} "cost"
    from eq join dept on deptid = departmentid left join job using (equipmentid)""",
)
add(
    "left_join_on_condition",
    "eq alert",
    """select eq.equipmentid, alertid, priority from eq left join alert a
    on a.equipmentid = eq.equipmentid and a.status in ('PENDING', 'IN_PROGRESS')""",
)
add(
    "equipment_with_open_alerts",
    "eq alert",
    """select equipmentid, "name" from eq where equipmentid in (select equipmentid from alert where status = 'PENDING')""",
)
add(
    "maintenance_without_equipment",
    "job eq",
    """select maintenanceid, equipmentid from djob j
    where not exists (select 1 from eq where eq.equipmentid = j.equipmentid)""",
    djob=DIRTY_JOB,
)
add(
    "maintenance_count_top10",
    "job eq",
    """select equipmentid, "name", (select count(*) from job where job.equipmentid = eq.equipmentid) maintenancecount
    from eq order by maintenancecount desc, equipmentid limit 10""",
)
add(
    "holiday_lookup",
    "order_holi",
    """select o_orderkey, holidayname is not null is_holiday, holidayname holiday_name
    from orders left join order_holi on holidaydate = cast(o_orderdate as date)""",
)

# Aggregations and windows

add("equipment_by_category", "eq", "select category, count(*) totalequipment from eq group by category")
add(
    "equipment_by_department",
    "eq dept",
    "select deptname, count(*) equipmentcount from eq join dept on deptid = departmentid group by deptname",
)
VALUE = f"""select deptname, count(equipmentid) equipment_count, sum(purchaseprice){D} total_value
    from dept left join eq on departmentid = deptid group by deptname"""
add("department_value", "eq dept", VALUE)
add("value_by_department", "eq dept", VALUE)
add(
    "top_cost_equipment",
    "eq job",
    f"""select "name", sum("cost"){D} totalmaintenancecost from eq join job using (equipmentid) group by "name"
    order by sum("cost") desc, "name" limit 10""",
)
SPENT = f"""select eq.equipmentid, coalesce(sum("cost"), 0){D} total_maintenance_cost
    from eq left join job using (equipmentid) group by eq.equipmentid"""
add("total_maintenance_cost", "eq job", SPENT)
add("cost_per_equipment", "eq job", SPENT)
add(
    "technician_cost_rank",
    "job",
    f"""select technicianid, sum("cost"){D} totalcost, rank() over (order by sum("cost") desc) cost_rank,
    dense_rank() over (order by sum("cost") desc) dense_cost_rank from job group by technicianid""",
)
USE = f"""select "name", deptname, utilizationhours, purchaseprice{D} purchaseprice,
    {rounded("utilizationhours * 100", "720", 2)} utilization_percentage,
    rank() over (order by utilizationhours desc) utilization_rank
    from eq join dept on deptid = departmentid where status = 'ACTIVE'"""
add("utilization_rank", "eq dept", USE)
add("utilization_dashboard", "eq dept", USE)
add(
    "category_month_trend",
    "job eq",
    f"""select category, m as "month", n job_count, b prev_month_count, {pct("n - b", "b")} change_pct
    from (select *, lag(n) over (partition by category order by m) b from
        (select category, strftime(actualdate, '%Y-%m') m, count(*) n from job join eq using (equipmentid)
        where job.status = 'COMPLETED' and actualdate >= {TWO_YEARS_AGO} group by 1, 2))""",
)
add(
    "global_rank",
    "job",
    f"""select maintenanceid, "cost"{D} "cost", rank() over (order by "cost" desc) cost_rank,
    dense_rank() over (order by "cost") cost_dense_rank from job""",
)

# Reports

add(
    "executive_dashboard",
    "fit job alert hist",
    f"""select * from
    (select count(*) filter (where status = 'ACTIVE') active_equipment,
        count(*) filter (where status = 'UNDER_MAINTENANCE') equipment_under_maintenance,
        count(*) filter (where status = 'DECOMMISSIONED') decommissioned_equipment,
        (sum(purchaseprice) filter (where status = 'ACTIVE')){D} total_equipment_value,
        count(*) filter (where status = 'ACTIVE' and nextmaintenancedate < {NOW}) overdue_maintenance,
        count(*) filter (where status = 'ACTIVE' and warrantyexpiry < {NOW}) expired_warranties,
        {rounded("sum(health) filter (where status = 'ACTIVE')", "count(*) filter (where status = 'ACTIVE')", 1, 1)}
            avg_equipment_health_score from fit),
    (select count(*) filter (where status = 'SCHEDULED') scheduled_maintenance,
        count(*) filter (where status = 'IN_PROGRESS') maintenance_in_progress,
        count(*) filter (where status = 'COMPLETED' and actualdate >= {NOW} - interval 1 month) completed_last_month,
        (sum("cost") filter (where status = 'COMPLETED' and actualdate >= {YEAR_AGO})){D} annual_maintenance_cost from job),
    (select count(*) filter (where status = 'PENDING') pending_alerts,
        count(*) filter (where status = 'IN_PROGRESS') alerts_in_progress,
        count(*) filter (where priority = 'CRITICAL' and status in ('PENDING', 'IN_PROGRESS')) critical_alerts from alert),
    (select {rounded("sum(downtimehours)", "count(downtimehours)", 1)} avg_downtime_hours from hist
        where datefixed >= {NOW} - interval 3 month)""",
)
# The joins as written: every row of the product is there to be counted.
DEPT_ROWS = f"""select d.*, e.equipmentid, e.status, e.nextmaintenancedate, e.purchaseprice, e.health, r."cost", r.hrs,
    t.techid from dept d left join fit e on e.departmentid = d.deptid
    left join (select j.equipmentid, j."cost", h.downtimehours hrs from job j left join hist h using (maintenanceid)
        where j.status = 'COMPLETED' and j.actualdate >= {YEAR_AGO}) r on r.equipmentid = e.equipmentid
    left join tech t on t.departmentid = d.deptid"""
add(
    "department_performance",
    "dept fit job hist tech",
    f"""select deptid, deptname, location, headofdept, count(equipmentid) total_equipment,
    count(*) filter (where status = 'ACTIVE') active_equipment,
    count(*) filter (where status = 'UNDER_MAINTENANCE') under_maintenance,
    count(*) filter (where nextmaintenancedate < {NOW}) overdue_maintenance,
    sum(coalesce(purchaseprice, 0)){D} total_equipment_value, sum(coalesce("cost", 0)){D} maintenance_cost_last_year,
    {rounded("sum(coalesce(health, 0))", "count(*)", 1, 1)} avg_health_score,
    {rounded("sum(coalesce(hrs, 0))", "count(*)", 1)} avg_downtime_hours, count(distinct techid) assigned_technicians,
    rank() over (order by sum(coalesce(purchaseprice, 0)) desc) equipment_value_rank,
    rank() over (order by sum(coalesce("cost", 0)) desc) maintenance_cost_rank
    from prod group by deptid, deptname, location, headofdept""",
    prod=DEPT_ROWS,
)
add(
    "top_departments_by_cost",
    "dept fit job hist tech",
    f"""select deptname, count(equipmentid) total_equipment, sum(coalesce(purchaseprice, 0)){D} total_equipment_value,
    sum(coalesce("cost", 0)){D} maintenance_cost_last_year from prod group by deptid, deptname
    order by sum(coalesce("cost", 0)) desc, deptname limit 5""",
    prod=DEPT_ROWS,
)
add(
    "department_performance_corrected",
    "dept fit job hist tech",
    f"""select deptid, deptname, location, headofdept, coalesce(n, 0) total_equipment,
    coalesce(act, 0) active_equipment, coalesce(rep, 0) under_maintenance, coalesce(late, 0) overdue_maintenance,
    coalesce(val, 0){D} total_equipment_value, coalesce(spent, 0){D} maintenance_cost_last_year,
    coalesce({rounded("hp", "n", 1, 1)}, 0) avg_health_score, coalesce({rounded("hrs", "jobs", 1)}, 0) avg_downtime_hours,
    coalesce(staff, 0) assigned_technicians, rank() over (order by coalesce(val, 0) desc) equipment_value_rank,
    rank() over (order by coalesce(spent, 0) desc) maintenance_cost_rank
    from dept left join (select departmentid, count(*) n, count(*) filter (where status = 'ACTIVE') act,
        count(*) filter (where status = 'UNDER_MAINTENANCE') rep,
        count(*) filter (where nextmaintenancedate < {NOW}) late, sum(purchaseprice) val, sum(health) hp
        from fit group by departmentid) e on e.departmentid = deptid
    left join (select departmentid, count(*) jobs, sum(job."cost") spent, sum(coalesce(downtimehours, 0)) hrs
        from job join fit using (equipmentid) left join hist using (maintenanceid)
        where job.status = 'COMPLETED' and actualdate >= {YEAR_AGO} group by departmentid) j on j.departmentid = deptid
    left join (select departmentid, count(*) staff from tech group by departmentid) t on t.departmentid = deptid""",
)
add(
    "maintenance_analytics",
    "job hist eq",
    f"""select m as "month", yr || '-' || q as quarter, yr as "year", category, n total_maintenance,
    preventive_maintenance, corrective_maintenance, emergency_maintenance, total{D} total_cost,
    {rounded(cents("total"), "n", 2, 2)} avg_cost, low{D} min_cost, high{D} max_cost,
    cast(hrs as bigint) total_downtime_hours, {rounded("hrs", "hn", 1)} avg_downtime_hours,
    {rounded(cents("total"), "n", 2, 2)} cost_per_maintenance, {rounded("hrs", "n", 1)} downtime_per_maintenance,
    b prev_month_count, {pct("n - b", "b")} month_over_month_change_pct
    from (select *, lag(n) over (partition by category order by m) b from
        (select strftime(actualdate, '%Y-%m') m, quarter(actualdate) q, year(actualdate) yr, category, count(*) n,
        count(*) filter (where maintenancetype = 'PREVENTIVE') preventive_maintenance,
        count(*) filter (where maintenancetype = 'CORRECTIVE') corrective_maintenance,
        count(*) filter (where maintenancetype = 'EMERGENCY') emergency_maintenance,
        sum(j."cost") total, min(j."cost") low, max(j."cost") high, sum(downtimehours) hrs, count(downtimehours) hn
        from job j join eq using (equipmentid) left join hist h on h.maintenanceid = j.maintenanceid
        where j.status = 'COMPLETED' and actualdate >= {TWO_YEARS_AGO} group by 1, 2, 3, 4))""",
)
STAFF = f"""select techid, any_value(fullname) fullname, any_value(specialty) specialty, any_value(deptname) department,
    any_value(certificationlevel) certificationlevel, count(j.maintenanceid) n, count(*) rws,
    count(*) filter (where j.status = 'COMPLETED') done, count(*) filter (where j.status = 'IN_PROGRESS') running,
    count(*) filter (where j.status = 'SCHEDULED') planned,
    count(*) filter (where actualdate >= {NOW} - interval 1 month) m1,
    count(*) filter (where actualdate >= {NOW} - interval 3 month) m3,
    count(*) filter (where actualdate >= {YEAR_AGO}) m12, sum(coalesce(j."cost", 0)) spent,
    sum(coalesce(downtimehours, 0)) hrs, sum(coalesce(downtimehours, 999)) slow,
    count(*) filter (where j.status in ('IN_PROGRESS', 'SCHEDULED')) open_jobs
    from tech left join job j on j.technicianid = techid left join hist h on h.maintenanceid = j.maintenanceid
    left join dept on deptid = tech.departmentid where tech.status = 'ACTIVE' group by techid"""
add(
    "technician_analytics",
    "tech job hist dept",
    f"""select techid, fullname, specialty, department, certificationlevel, n total_maintenance_assigned,
    done completed_maintenance, running in_progress_maintenance, planned scheduled_maintenance,
    m1 last_month_maintenance, m3 last_quarter_maintenance, m12 last_year_maintenance, spent{D} total_cost_managed,
    {rounded(cents("spent"), "rws", 2, 2)} avg_cost_per_maintenance, {rounded("hrs", "rws", 1)} avg_downtime_hours,
    cast(hrs as bigint) total_downtime_hours,
    coalesce({pct("open_jobs", "(select max(open_jobs) from staff)")}, 0) workload_score,
    {pct("done", "n")} completion_rate_pct, rank() over (order by n desc) productivity_rank,
    rank() over (order by slow{D} / rws) efficiency_rank, rank() over (order by spent desc) cost_management_rank
    from staff""",
    staff=STAFF,
)
add(
    "technician_productivity",
    "tech job hist dept",
    """select techid, fullname, n total_maintenance_assigned, done completed_maintenance,
    rank() over (order by n desc) productivity_rank from staff""",
    staff=STAFF,
)
RISK_COLUMNS = f"""f.equipmentid, f."name", serialnumber, category, deptname, age / 1e2 age_years, utilizationhours,
    {rounded("utilizationhours * 100", "8760", 1)} utilization_percentage, health / 1e1 health_score,
    risk failure_risk, roi roi_percentage, f.status, {DUE} maintenance_status, purchaseprice{D} purchaseprice,
    warrantyexpiry, {COVER} warranty_status, {ADVICE} recommendation"""
add(
    "equipment_risk_assessment",
    "feat dept job hist alert",
    f"""select {RISK_COLUMNS}, total_maintenance_count, emergency_maintenance_count, total_maintenance_cost,
    avg_downtime_hours, active_alerts, critical_alerts
    from feat f join dept on deptid = departmentid join prod using (equipmentid) where f.status <> 'DECOMMISSIONED'""",
    prod=f"""select e.equipmentid, count(j.maintenanceid) total_maintenance_count,
        count(*) filter (where maintenancetype = 'EMERGENCY') emergency_maintenance_count,
        sum(coalesce(j."cost", 0)){D} total_maintenance_cost,
        {rounded("sum(coalesce(downtimehours, 0))", "count(*)", 1)} avg_downtime_hours, count(alertid) active_alerts,
        count(*) filter (where priority = 'CRITICAL') critical_alerts
        from feat e left join job j on j.equipmentid = e.equipmentid and j.status = 'COMPLETED'
        left join hist h on h.maintenanceid = j.maintenanceid
        left join alert a on a.equipmentid = e.equipmentid and a.status in ('IN_PROGRESS', 'PENDING')
        group by e.equipmentid""",
)
add(
    "equipment_risk_assessment_corrected",
    "feat dept hist alert",
    f"""select {RISK_COLUMNS}, n total_maintenance_count, emergencies emergency_maintenance_count,
    spent{D} total_maintenance_cost, {rounded("coalesce(hrs, 0)", "greatest(n, 1)", 1)} avg_downtime_hours,
    coalesce(open_alerts, 0) active_alerts, coalesce(critical, 0) critical_alerts
    from feat f join dept on deptid = departmentid
    left join (select equipmentid, sum(downtimehours) hrs from hist group by equipmentid) h using (equipmentid)
    left join (select equipmentid, count(*) open_alerts, count(*) filter (where priority = 'CRITICAL') critical
        from alert where status in ('PENDING', 'IN_PROGRESS') group by equipmentid) a using (equipmentid)
    where f.status <> 'DECOMMISSIONED'""",
)
HOURS = f"""select cast("timestamp" as date) d, hour("timestamp") h, count(*) n,
    count(*) filter (where status = 'DENIED') denied, count(*) filter (where status = 'SUCCESS') good,
    count(*) filter (where status = 'ERROR') bad, count(distinct tablename) tabs, count(distinct username) usrs,
    count(*) filter (where contains(errormessage, 'weekday')) wd,
    count(*) filter (where contains(errormessage, 'holiday')) hd,
    count(*) filter (where contains(errormessage, 'not allowed')) na
    from aud where "timestamp" >= date_trunc('day', {AUDIT_NOW}) - interval 30 day group by 1, 2"""
add(
    "audit_compliance",
    "aud",
    f"""select strftime(d, '%Y-%m-%d') audit_date, dayname(d) day_of_week, n total_operations, denied denied_operations,
    good successful_operations, bad error_operations, tabs tables_modified, usrs active_users, wd weekday_denials,
    hd holiday_denials, na rule_violation_denials, {pct("good", "n")} success_rate_pct,
    lpad(cast(h as varchar), 2, '0') hour_of_day, if(h between 8 and 17, n, 0) business_hours_operations,
    if(h between 8 and 17, 0, n) after_hours_operations from hrs""",
    hrs=HOURS,
)
add(
    "recent_audit_days",
    "aud",
    f"""select strftime(d, '%Y-%m-%d') audit_date, n total_operations, denied denied_operations,
    {pct("good", "n")} success_rate_pct from hrs order by d desc, h limit 5""",
    hrs=HOURS,
)
MARCH = "actualdate >= timestamp '2001-03-01' and actualdate < timestamp '2001-04-01'"
add(
    "monthly_performance_report",
    "dept fit job hist",
    f"""select *, rank() over (order by total_maintenance_cost desc) cost_rank,
    rank() over (order by avg_downtime_hours) downtime_rank, rank() over (order by avg_health_score desc) health_rank
    from (select deptname, count(equipmentid) equipment_count, count(*) filter (where status = 'ACTIVE') active_equipment,
        count(*) filter (where status = 'UNDER_MAINTENANCE') under_maintenance, count(maintenanceid) maintenance_count,
        count(*) filter (where maintenancetype = 'PREVENTIVE') preventive_maintenance,
        count(*) filter (where maintenancetype = 'CORRECTIVE') corrective_maintenance,
        sum(coalesce("cost", 0)){D} total_maintenance_cost,
        {rounded(cents('sum(coalesce("cost", 0))'), "count(*)", 2, 2)} avg_maintenance_cost,
        cast(sum(coalesce(hrs, 0)) as bigint) total_downtime_hours,
        {rounded("sum(coalesce(hrs, 0))", "count(*)", 1)} avg_downtime_hours,
        {rounded("sum(coalesce(health, 0))", "count(*)", 1, 1)} avg_health_score,
        {pct("count(*) filter (where job_status = 'COMPLETED')", "count(maintenanceid)")} maintenance_completion_rate
        from (select deptname, e.equipmentid, e.status, health, r.* exclude (equipmentid)
            from dept left join fit e on departmentid = deptid
            left join (select job.equipmentid, maintenanceid, maintenancetype, job."cost", job.status job_status,
                downtimehours hrs from job left join hist using (maintenanceid) where {MARCH}) r
            on r.equipmentid = e.equipmentid)
        group by deptname)""",
)
add(
    "monthly_performance_report_corrected",
    "dept fit job hist",
    f"""select *, rank() over (order by total_maintenance_cost desc) cost_rank,
    rank() over (order by avg_downtime_hours) downtime_rank, rank() over (order by avg_health_score desc) health_rank
    from (select deptname, coalesce(n, 0) equipment_count, coalesce(act, 0) active_equipment,
        coalesce(rep, 0) under_maintenance, coalesce(jobs, 0) maintenance_count, coalesce(pre, 0) preventive_maintenance,
        coalesce(cor, 0) corrective_maintenance, coalesce(spent, 0){D} total_maintenance_cost,
        coalesce({rounded(cents("spent"), "jobs", 2, 2)}, 0) avg_maintenance_cost,
        cast(coalesce(hrs, 0) as bigint) total_downtime_hours, coalesce({rounded("hrs", "jobs", 1)}, 0) avg_downtime_hours,
        coalesce({rounded("hp", "n", 1, 1)}, 0) avg_health_score, {pct("done", "jobs")} maintenance_completion_rate
        from dept left join (select departmentid, count(*) n, sum(health) hp,
            count(*) filter (where status = 'ACTIVE') act, count(*) filter (where status = 'UNDER_MAINTENANCE') rep
            from fit group by departmentid) e on e.departmentid = deptid
        left join (select departmentid, count(*) jobs, count(*) filter (where maintenancetype = 'PREVENTIVE') pre,
            count(*) filter (where maintenancetype = 'CORRECTIVE') cor,
            count(*) filter (where job.status = 'COMPLETED') done, sum(job."cost") spent,
            sum(coalesce(downtimehours, 0)) hrs from job join fit using (equipmentid) left join hist using (maintenanceid)
            where {MARCH} group by departmentid) j on j.departmentid = deptid)""",
)
add(
    "equipment_lifecycle_report",
    "feat dept",
    f"""select equipmentid, "name", category, deptname, age / 1e2 age_years,
    case when age < 300 then 'NEW (0-3 years)' when age < 700 then 'MID-LIFE (4-7 years)'
        when age < 1000 then 'MATURE (8-10 years)' else 'AGING (10+ years)' end age_category,
    purchaseprice{D} purchaseprice, spent{D} total_maintenance_cost,
    {pct(cents("spent"), cents("purchaseprice"))} maintenance_cost_percentage, utilizationhours,
    {rounded("utilizationhours * 10000", "age * 8760", 1)} annual_utilization_pct, health / 1e1 health_score,
    risk failure_risk, case when age >= 1000 and health < 500 then 'HIGH PRIORITY FOR REPLACEMENT'
        when health < 400 then 'SCHEDULE MAJOR MAINTENANCE OR REPLACEMENT'
        when health < 600 then 'MONITOR CLOSELY - CONSIDER UPGRADE'
        else 'CONTINUE NORMAL OPERATION' end lifecycle_recommendation, roi roi_percentage,
    case when roi < 5 then 'LOW ROI' when roi < 15 then 'MODERATE ROI' else 'HIGH ROI' end roi_category
    from feat join dept on deptid = departmentid where status = 'ACTIVE'""",
)
add(
    "predictive_maintenance_schedule",
    "feat dept",
    f"""select equipmentid, "name", category, deptname, age / 1e2 age_years, utilizationhours,
    health / 1e1 health_score, risk failure_risk, last_done last_maintenance_date, n total_maintenance_count,
    emergencies emergency_maintenance_count, pts / 1e3 calculated_risk_score,
    case when pts >= 80000 then 'CRITICAL - SCHEDULE IMMEDIATELY' when pts >= 60000 then 'HIGH - SCHEDULE WITHIN 2 WEEKS'
        when pts >= 40000 then 'MEDIUM - SCHEDULE WITHIN 4 WEEKS' else 'LOW - SCHEDULE ROUTINE' end maintenance_priority,
    {NOW} + to_days(case when pts >= 80000 then 7 when pts >= 60000 then 14 when pts >= 40000 then 28 else 90 end)
        recommended_schedule_date,
    cast(case when pts >= 80000 then 5000 when pts >= 60000 then 3000 when pts >= 40000 then 1500 else 800 end as bigint)
        estimated_cost,
    case category when 'IMAGING' then 'IMAGING EQUIPMENT SPECIALIST'
        when 'LIFE_SUPPORT' then 'LIFE SUPPORT SYSTEMS SPECIALIST' when 'SURGICAL' then 'SURGICAL EQUIPMENT SPECIALIST'
        when 'MONITORING' then 'MONITORING SYSTEMS SPECIALIST' else 'GENERAL BIOMEDICAL TECHNICIAN' end
        recommended_specialty
    from (select *, age * 25 + (1000 - health) * 100
        + case risk when 'CRITICAL' then 40000 when 'HIGH' then 30000 when 'MEDIUM' then 20000 else 10000 end pts from feat)
    join dept on deptid = departmentid where status = 'ACTIVE' and pts >= 30000""",
)
add(
    "equipment_health_score",
    "fit dept job hist",
    f"""select e.equipmentid, "name", deptname, age / 1e2 age_years, utilizationhours, coalesce(n, 0) maintenance_count,
    {rounded(cents("spent"), "n", 2, 2)} avg_maintenance_cost, cast(hrs as bigint) total_downtime,
    health / 1e1 health_score, case when health >= 800 then 'EXCELLENT' when health >= 600 then 'GOOD'
        when health >= 400 then 'FAIR' else 'POOR' end health_status
    from fit e join dept on deptid = departmentid
    left join (select job.equipmentid, count(*) n, sum(job."cost") spent, sum(downtimehours) hrs
        from job left join hist using (maintenanceid) group by job.equipmentid) j on j.equipmentid = e.equipmentid
    where e.status = 'ACTIVE'""",
)
add(
    "maintenance_cost_analysis",
    "job eq dept hist",
    f"""select strftime(actualdate, '%Y-%m') "month", deptname, count(*) maintenance_count, sum(j."cost"){D} total_cost,
    sum(j."cost"){D} / count(*) avg_cost, cast(sum(downtimehours) as bigint) total_downtime,
    {rounded(cents('sum(j."cost")'), "count(*)", 2, 2)} cost_per_maintenance {COST_ROWS}""",
)
TECH_ROWS = """select techid, fullname, deptname technician_dept, count(*) total_jobs,
    count(*) filter (where j.status = 'COMPLETED') completed_jobs,
    sum(downtimehours)::double / nullif(count(downtimehours), 0) avg_repair_time, sum(j."cost")::double total_cost_handled,
    {avg} avg_cost_per_job, rank() over (order by count(*) desc) performance_rank
    from job j join tech on techid = technicianid left join hist h on h.maintenanceid = j.maintenanceid
    left join dept on deptid = departmentid {where} group by techid, fullname, deptname"""
AVG_JOB = rounded(cents('sum(j."cost")'), "count(*)", 2, 2)
add(
    "technician_dashboard",
    "job tech hist dept",
    f"select * exclude (techid) from ({TECH_ROWS.format(avg=AVG_JOB, where=f'where actualdate >= {NOW} - interval 3 month')})",
)
add("technician_performance", "job tech hist dept", TECH_ROWS.format(avg=AVG_JOB, where=""))

# Rules over change events

add(
    "calendar_gate",
    "chg",
    """select change_id, is_holiday, weekend allowed,
    case when weekend then 'weekend' when is_holiday then 'public holiday' else 'weekday' end reason from chg""",
)
add(
    "calendar_gate_strict",
    "chg",
    """select change_id, is_holiday, weekend and not is_holiday allowed,
    case when not weekend then 'Operation disallowed: Weekday (Mon-Fri)'
        when is_holiday then 'Operation disallowed: Public holiday (' || holiday_name || ')' else 'Allowed' end reason
    from chg""",
)
add(
    "day_info",
    "order_holi",
    f"""select strftime(d, '%Y-%m-%d') as "day", 'Date: ' || {DMY.format("d")} || ', Day: ' || dayname(d) || ', Weekend: ' || w
    || ', Holiday: ' || if(holidayid is null, 'NO', 'YES') || ', Allowed: ' || w day_info
    from (select d, if(dayofweek(d) in (0, 6), 'YES', 'NO') w
        from (select distinct cast(o_orderdate as date) d from orders)) left join order_holi on holidaydate = d""",
)
DENIAL = """case when not weekend then 'Operation ' || op || ' on ' || table_name || ' table is not allowed on '
    || if(is_holiday, 'public holiday (' || dayname(event_ts) || ')', 'weekdays (Monday-Friday)')
    || '. Allowed only on weekends (Saturday and Sunday).' end"""
EQ_TEXT = """if(op <> 'INSERT', 'EquipmentID: ' || equipmentid || ', Name: ' || "name" || ', Status: ' || old_status, null)
    oldvalue, if(op <> 'DELETE', 'EquipmentID: ' || equipmentid || ', Name: ' || "name" || ', Status: ' || new_status, null)
    newvalue"""
JOB_TEXT = """if(op <> 'INSERT', 'MaintenanceID: ' || maintenanceid || ', EquipmentID: ' || equipmentid || ', Status: '
    || old_status, null) oldvalue, if(op <> 'DELETE', 'MaintenanceID: ' || maintenanceid || ', EquipmentID: ' || equipmentid
    || ', Status: ' || new_status, null) newvalue"""
EQ_AUDIT = f"""select change_id logid, table_name tablename, op operation, cast(equipmentid as varchar) primarykeyvalue,
    {EQ_TEXT}, username, event_ts "timestamp", if(weekend, 'SUCCESS', 'DENIED') status, {DENIAL} errormessage from eq_chg"""
add(
    "audit_changes",
    "eq_chg job_chg",
    f"""{EQ_AUDIT} union all select change_id, table_name, op, cast(maintenanceid as varchar), {JOB_TEXT}, username, event_ts,
    if(weekend, 'SUCCESS', 'DENIED'), {DENIAL} from job_chg""",
)
add("stream_audit", "eq_chg", EQ_AUDIT)
add(
    "split_changes",
    "chg",
    f"""select change_id, statement_id, if(weekend, 'accepted', 'rejected') side,
    case when not weekend then case table_name when 'EQUIPMENT' then -20001 when 'MAINTENANCE' then -20002 end end error_code,
    {DENIAL} message from chg""",
)
ATOMIC = (
    """select change_id, statement_id, if(first is null, 'accepted', 'rejected') side, if(first is null, null, -20003) error_code,
    first message from chg left join (select statement_id, arg_min('Operation ' || op || ' on ' || table_name
        || ' table is not allowed on weekdays or holidays.', change_id) first from chg where not weekend group by statement_id)
    using (statement_id)"""
)
add("split_changes_atomic", "chg", ATOMIC)
add("stream_split_changes", "chg", ATOMIC)
add(
    "statement_audit",
    "eq_chg",
    f"""select statement_id, change_id, table_name tablename, op operation, cast(equipmentid as varchar) primarykeyvalue,
    {EQ_TEXT}, username, 'DENIED' status,
    'Operation ' || op || ' on EQUIPMENT table is not allowed on weekdays or holidays.' errormessage
    from eq_chg where not weekend""",
)
add(
    "decommission_guard",
    "eq job alert",
    """select change_id, equipmentid, if(busy or warned, 'DENIED', 'ALLOWED') verdict,
    cast(case when busy then -20004 when warned then -20005 end as bigint) error_code,
    case when busy then 'Cannot decommission equipment ID ' || equipmentid
            || ' with active maintenance. Complete or cancel all maintenance first.'
        when warned then 'Cannot decommission equipment ID ' || equipmentid
            || ' with pending alerts. Resolve all alerts first.' end message,
    if(busy or warned, null, 'Status: ' || status) oldvalue,
    if(busy or warned, null, 'Status: DECOMMISSIONED (DECOMMISSIONED)') newvalue
    from (select equipmentid change_id, equipmentid, status,
        exists (select 1 from job j where j.equipmentid = eq.equipmentid and j.status in ('SCHEDULED', 'IN_PROGRESS')) busy,
        exists (select 1 from alert a where a.equipmentid = eq.equipmentid and a.status in ('PENDING', 'IN_PROGRESS'))
            warned from eq)""",
)
add(
    "decommission_guard_asof",
    "job alert",
    """select change_id, equipmentid, open_jobs, open_alerts, if(open_jobs > 0 or open_alerts > 0, 'DENIED', 'ALLOWED') verdict,
    cast(case when open_jobs > 0 then -20004 when open_alerts > 0 then -20005 end as bigint) error_code,
    case when open_jobs > 0 then 'Cannot decommission equipment ID ' || equipmentid
            || ' with active maintenance. Complete or cancel all maintenance first.'
        when open_alerts > 0 then 'Cannot decommission equipment ID ' || equipmentid
            || ' with pending alerts. Resolve all alerts first.' end message,
    if(open_jobs > 0 or open_alerts > 0, null, 'Status: ACTIVE') oldvalue,
    if(open_jobs > 0 or open_alerts > 0, null, 'Status: DECOMMISSIONED (DECOMMISSIONED)') newvalue
    from (select r.*, (select count(*) from job j where j.equipmentid = r.equipmentid and j.scheduleddate <= r.asked
                and (j.status in ('SCHEDULED', 'IN_PROGRESS')
                    or if(j.status = 'COMPLETED', j.completiondate, j.actualdate) > r.asked)) open_jobs,
            (select count(*) from alert a where a.equipmentid = r.equipmentid and a.datereported <= r.asked
                and (a.status in ('PENDING', 'IN_PROGRESS') or a.resolutiondate > r.asked)) open_alerts
        from (select maintenanceid * 2 change_id, equipmentid, completiondate asked from job where maintenanceid % 5 = 0
            union all select alertid * 2 + 1, equipmentid, datereported + interval 36 hour from alert where alertid % 3 = 0) r)""",
)
COMPLETED_JOBS = f"""select maintenanceid change_id, equipmentid, maintenanceid, technicianid, description actiontaken, completiondate datefixed,
    "cost"{D} "cost", {rounded("date_sub('second', scheduleddate, actualdate)", "3600", 1)} downtimehours,
    'Maintenance completed. Parts: ' || coalesce(partsreplaced, 'None') notes from done_chg"""
add("completion_to_history", "done_chg", COMPLETED_JOBS)
add("stream_completion", "done_chg", COMPLETED_JOBS)
UPDATED_PIECES = f"""select equipmentid, arg_max(completiondate, maintenanceid) lastmaintenancedate, {NOW} modifieddate
    from done_chg group by equipmentid"""
add(
    "completion_equipment_updates",
    "done_chg",
    UPDATED_PIECES,
)
add("stream_completion_equipment", "done_chg", UPDATED_PIECES)
add(
    "completion_applied",
    "done_chg eq",
    f"""select e.equipmentid, e."name", lastmaintenancedate, modifieddate from eq e left join ({UPDATED_PIECES}) u
    on u.equipmentid = e.equipmentid""",
)
COMPLETION_AUDIT = f"""select maintenanceid change_id, 'MAINTENANCE' tablename, 'UPDATE' operation,
    cast(maintenanceid as varchar) primarykeyvalue, 'Status: ' || old_status oldvalue,
    'Status: COMPLETED, Completed: ' || {DMY.format("completiondate")} newvalue, 'tech' || technicianid username,
    'SUCCESS' status from done_chg"""
add("completion_audit", "done_chg", COMPLETION_AUDIT)
add("stream_completion_audit", "done_chg", COMPLETION_AUDIT)


def warranty(expiry: str) -> str:
    left = f"date_sub('day', {NOW}, {expiry})"
    return f"""'WARRANTY_EXPIRY' alerttype, 'Warranty for ' || "name" || ' expires in ' || {left} || ' days (on '
    || {DMY.format(expiry)} || ')' issuedescription,
    case when {expiry} <= {NOW} + interval 30 day then 'HIGH' when {expiry} <= {NOW} + interval 60 day then 'MEDIUM'
    else 'LOW' end priority"""


SOON = f"between {NOW} + interval 1 day and {NOW} + interval 90 day"
add(
    "warranty_alerts",
    "eq",
    f"""select equipmentid change_id, equipmentid, {warranty("warrantyexpiry")}, 'PENDING' status, {NOW} datereported
    from eq where status = 'ACTIVE' and equipmentid % 6 <> 0 and warrantyexpiry {SOON}""",
)
add(
    "stream_warranty_alerts",
    "eq_chg",
    f"""select change_id, equipmentid, {warranty("new_expiry")}, 'PENDING' status, {NOW} datereported from eq_chg
    where new_status = 'ACTIVE' and new_expiry {SOON}
    and (op = 'INSERT' or (op = 'UPDATE' and new_expiry is distinct from old_expiry))""",
)
add(
    "stream_audit_hourly",
    "aud",
    """select date_trunc('hour', "timestamp") hour_start, count(*) total_operations,
    count(*) filter (where status = 'DENIED') denied_operations,
    count(*) filter (where status = 'SUCCESS') successful_operations,
    count(*) filter (where status = 'ERROR') error_operations, count(distinct username) active_users,
    count(distinct tablename) tables_modified from aud group by 1""",
)
add(
    "random_parents",
    "alert eq tech",
    """select alertid, equipmentid, drawn_equipment, drawn_technician from (select alertid, equipmentid,
        cast('0x' || md5('7:Drawn_Equipment:' || alertid)[1:15] as bigint)
            % (select count(*) from eq where status = 'ACTIVE') + 1 at1,
        cast('0x' || md5('7:Drawn_Technician:' || alertid)[1:15] as bigint)
            % (select count(*) from tech where status = 'ACTIVE') + 1 at2 from alert)
    join (select equipmentid drawn_equipment, row_number() over (order by equipmentid) at1 from eq where status = 'ACTIVE')
        using (at1)
    join (select techid drawn_technician, row_number() over (order by techid) at2 from tech where status = 'ACTIVE')
        using (at2)""",
)
add(
    "purge_old_maintenance",
    "job",
    f"""select maintenanceid, if(actualdate < {NOW} - interval 180 day, 'purged', 'kept') side from job""",
)
add(
    "purge_monthly",
    "job",
    f"""select maintenanceid, equipmentid, status from job where actualdate is null
    or actualdate >= {NOW} - interval 180 day""",
)
add(
    "apply_updates",
    "eq alert",
    """select equipmentid, "name", coalesce(fresh, status) status from eq left join
    (select equipmentid * 3 equipmentid, arg_max(if(status = 'ESCALATED', 'INACTIVE', 'UNDER_MAINTENANCE'), alertid) fresh
    from alert where status in ('ESCALATED', 'IN_PROGRESS') group by 1) using (equipmentid)""",
)
add(
    "append_with_keys",
    "job chg",
    """select change_id, row_key equipmentid, 'SCHEDULED' status,
    (select max(maintenanceid) from job) + row_number() over (order by change_id) maintenanceid from chg""",
)
add(
    "log_alert",
    "alert chg",
    """select change_id, row_key equipmentid, 'Delete attempted' issuedescription, event_ts datereported, 'PENDING' status,
    (select max(alertid) from alert) + row_number() over (order by change_id) alertid from chg where op = 'DELETE'""",
)
add(
    "equipment_exists",
    "eq",
    "select o_orderkey, o_orderkey in (select equipmentid from eq) equipment_exists from orders",
)
add(
    "technician_specialty",
    "eq tech",
    """select equipmentid, if(techid is null, 'Unknown', specialty) specialty from eq left join tech on techid = equipmentid""",
)
add(
    "holiday_upsert",
    "holi order_holi",
    """select holidayname, strftime(holidaydate, '%Y-%m-%d') holidaydate, year(holidaydate) as "year" from
    (select arg_min(holidayname, prio) holidayname, holidaydate from
        (select holidayname, holidaydate, 0 prio from order_holi where not starts_with(holidayname, 'Test Holiday')
        union all select holidayname, holidaydate, 1 from holi
        union all values ('Test Holiday - Monday', date '2024-01-29', 2), ('Test Holiday - Tuesday', date '2024-01-30', 2))
    group by holidaydate)""",
)

# Functions, procedures and views known by name only

add("equipment_age", "aged", "select equipmentid, age / 1e2 age_years from aged")
add("maintenance_due_status", "eq", f"select equipmentid, {DUE} maintenance_status from eq")
add(
    "validate_serial",
    "request eq",
    """select *, case when not coalesce(regexp_full_match(serialnumber, '[A-Z]{2,5}-[0-9]{4}-[0-9]{3}'), false) then 'INVALID'
    when serialnumber in (select serialnumber from eq) then 'DUPLICATE' else 'VALID' end verdict from request""",
)
add(
    "add_equipment",
    "screened eq",
    """select request_id, serialnumber, "name", departmentid, 'ACTIVE' status,
    (select max(equipmentid) from eq) + row_number() over (order by request_id) equipmentid
    from screened where reason is null""",
)
add("add_equipment_rejects", "screened", "select * from screened where reason is not null")
add(
    "technician_workload",
    "tech job",
    f"""select techid, open_jobs, coalesce({pct("open_jobs", "max(open_jobs) filter (where status = 'ACTIVE') over ()")}, 0)
    workload_score from (select techid, tech.status,
        count(maintenanceid) filter (where job.status in ('SCHEDULED', 'IN_PROGRESS')) open_jobs
        from tech left join job on technicianid = techid group by techid, tech.status)""",
)
add(
    "failure_risk",
    "feat",
    "select equipmentid, health / 1e1 health_score, recent recent_emergencies, risk failure_risk from feat",
)
add("equipment_roi", "feat", "select equipmentid, roi roi_percentage from feat")
add(
    "kpis",
    "eq job hist",
    f"""select (select count(*) from eq where status = 'ACTIVE') total_equipment,
    (select {rounded("sum(utilizationhours) * 100", "count(*) * 8760", 1)} from eq where status = 'ACTIVE')
        equipment_utilization,
    (select coalesce(sum("cost"), 0){D} from job where status = 'COMPLETED'
        and actualdate >= timestamp '2000-07-01' and actualdate < timestamp '2001-07-01') total_maintenance_cost,
    (select {rounded("sum(downtimehours)", "count(*)", 1)} from hist
        where datefixed >= timestamp '2000-07-01' and datefixed < timestamp '2001-07-01') avg_downtime""",
)
add(
    "automated_alerts",
    "feat alert",
    f"""select *, 'PENDING' status, {NOW} datereported from
    (select equipmentid, 'MAINTENANCE_DUE' alerttype, if(nextmaintenancedate < {NOW}, 'CRITICAL', 'HIGH') priority,
        'Maintenance due for ' || "name" issuedescription from feat
        where status = 'ACTIVE' and nextmaintenancedate <= {NOW} + interval 7 day
    union all select equipmentid, 'CRITICAL_ISSUE', 'CRITICAL', 'Critical failure risk for ' || "name" from feat
        where status = 'ACTIVE' and risk = 'CRITICAL'
    union all select equipmentid, 'LOW_USAGE', 'LOW', 'Low usage of ' || "name" from feat
        where status = 'ACTIVE' and utilizationhours < 876
    union all select equipmentid, 'HIGH_USAGE', 'MEDIUM', 'High usage of ' || "name" from feat
        where status = 'ACTIVE' and utilizationhours > 7884
    union all select equipmentid, alerttype, priority, issuedescription from (select equipmentid, status, warrantyexpiry,
        {warranty("warrantyexpiry")} from feat) where status = 'ACTIVE' and warrantyexpiry {SOON}) r
    where not exists (select 1 from alert a where a.equipmentid = r.equipmentid and a.alerttype = r.alerttype
        and a.status in ('PENDING', 'IN_PROGRESS'))""",
)
add(
    "equipment_maintenance_ranking",
    "eq job",
    f"""select equipmentid, "name", category, n maintenance_count, spent{D} total_cost,
    rank() over (partition by category order by spent desc) cost_rank,
    dense_rank() over (partition by category order by spent desc) cost_dense_rank,
    row_number() over (partition by category order by spent desc, equipmentid) row_num
    from (select eq.equipmentid, "name", category, count(maintenanceid) n, coalesce(sum("cost"), 0) spent
        from eq left join job using (equipmentid) group by all)""",
)
add(
    "monthly_maintenance_trends",
    "job",
    f"""select m as "month", n job_count, spent{D} total_cost, b{D} prev_cost, a{D} next_cost, (spent - b){D} cost_change
    from (select *, lag(spent) over (order by m) b, lead(spent) over (order by m) a from
        (select strftime(actualdate, '%Y-%m') m, count(*) n, sum("cost") spent from job group by 1))""",
)

# Indicators

add(
    "utilization_rates",
    "aged",
    f"""select equipmentid, {rounded("utilizationhours * 100", "720", 2)} pct_of_month,
    {rounded("utilizationhours * 100", "8760", 1)} pct_of_year,
    {rounded("utilizationhours * 10000", "age * 8760", 1)} pct_of_life from aged where status = 'ACTIVE'""",
)
add(
    "mtbf",
    "job",
    f"""select equipmentid, count(*) failures, {rounded("sum(gap)", "count(gap) * 86400", 2)} mtbf_days
    from (select equipmentid, date_sub('second', lag(actualdate) over (partition by equipmentid order by actualdate),
        actualdate) gap from job where status = 'COMPLETED' and maintenancetype in ('EMERGENCY', 'CORRECTIVE'))
    group by equipmentid""",
)
add(
    "mttr",
    "hist",
    f"""select equipmentid, count(*) repairs, {rounded("sum(downtimehours)", "count(*)", 2)} mttr_hours
    from hist group by equipmentid""",
)
add(
    "pm_compliance",
    "job",
    f"""select count(*) planned_jobs, count(*) filter (where ok) compliant_jobs,
    {pct("count(*) filter (where ok)", "count(*)")} compliance_pct from
    (select status = 'COMPLETED' and actualdate <= scheduleddate + interval 1 day ok from job
    where maintenancetype = 'PREVENTIVE' and scheduleddate < {NOW})""",
)
add(
    "emergency_rate",
    "job",
    f"""select count(*) filter (where e) emergency_jobs, count(*) total_jobs,
    {pct("count(*) filter (where e)", "count(*)")} emergency_pct
    from (select maintenancetype = 'EMERGENCY' e from job)""",
)
add(
    "cost_pct_of_value",
    "dept eq job",
    f"""select deptid, deptname, coalesce(val, 0){D} total_value, coalesce(spent, 0){D} total_cost,
    {pct(cents("coalesce(spent, 0)"), cents("val"))} cost_pct_of_value from dept
    left join (select departmentid, sum(purchaseprice) val from eq group by 1) v on v.departmentid = deptid
    left join (select departmentid, sum("cost") spent from eq join job using (equipmentid)
        where job.status = 'COMPLETED' group by 1) s on s.departmentid = deptid""",
)
add(
    "warranty_coverage",
    "eq",
    f"""select count(*) active_equipment, count(*) filter (where warrantyexpiry >= {NOW}) in_warranty,
    {pct(f"count(*) filter (where warrantyexpiry >= {NOW})", "count(*)")} coverage_pct from eq where status = 'ACTIVE'""",
)
add(
    "downtime_hours",
    "hist",
    "select equipmentid, cast(sum(downtimehours) as bigint) downtime_hours from hist group by equipmentid",
)
add(
    "downtime_by_department",
    "hist eq dept",
    """select deptname, cast(sum(downtimehours) as bigint) downtime_hours
    from hist join eq using (equipmentid) join dept on deptid = departmentid group by deptname""",
)
add(
    "alert_resolution_time",
    "alert",
    f"""select priority, count(*) resolved_alerts,
    {rounded("sum(date_sub('second', datereported, resolutiondate))", "count(*) * 3600", 1)} avg_resolution_hours
    from alert where status = 'RESOLVED' group by priority""",
)
add(
    "department_health",
    "fit dept",
    f"""select deptid, deptname, count(*) equipment_count, {rounded("sum(health)", "count(*)", 1, 1)} avg_health_score
    from fit join dept on deptid = departmentid group by deptid, deptname""",
)
add(
    "features_due",
    "fit",
    f"""select equipmentid, cast(health as bigint) health_units,
    case when nextmaintenancedate < {NOW} then 'OVERDUE' when nextmaintenancedate <= {NOW} + interval 7 day then 'DUE IN 7 DAYS'
        when nextmaintenancedate <= {NOW} + interval 30 day then 'DUE IN 30 DAYS' else 'ON SCHEDULE' end maintenance_status,
    case when warrantyexpiry is null then 'NO WARRANTY' when warrantyexpiry < {NOW} then 'EXPIRED'
        when warrantyexpiry <= {NOW} + interval 30 day then 'EXPIRING SOON' else 'ACTIVE' end warranty_status,
    case when warrantyexpiry < {NOW} then 'EXPIRED' when warrantyexpiry <= {NOW} + interval 30 day then 'EXPIRES IN 30 DAYS'
        when warrantyexpiry <= {NOW} + interval 90 day then 'EXPIRES IN 90 DAYS' else 'VALID' end warranty_window from fit""",
)

# The same tables by another way: as a stream, beside the stored table, from a feed.
for _name, _same in (
    ("stream_append_with_keys", "append_with_keys"),
    ("upsert_equipment", "apply_updates"),
    ("snapshot_monthly_refreshed", "snapshot_monthly_maintenance"),
    ("constraint_violations_incremental", "constraint_violations"),
):
    ORACLE[_name] = ORACLE[_same]

"""The canonical tables in SQL, for checking results with a second engine.

Written independently of the DataFrame mapping.  Rounded figures use integer
arithmetic on whole units, like the engine, so both round the same number.
"""

from __future__ import annotations

NOW = "timestamp '2001-07-01 12:00:00'"
AUDIT_NOW = "timestamp '2024-01-31 00:00:00'"


def rounded(num: str, den: str, digits: int, num_digits: int = 0) -> str:
    """num / den, half away from zero, NULL for a zero denominator."""
    shift = digits - num_digits
    a = f"(({num}) * {10 ** max(shift, 0)})"
    b = f"(nullif({den}, 0) * {10 ** max(-shift, 0)})"
    return f"(case when {a} < 0 then -1 else 1 end * ((2 * abs({a}) + {b}) // (2 * {b}))) / 1e{digits}"


def pct(num: str, den: str, digits: int = 1) -> str:
    return rounded(f"({num}) * 100", den, digits)


def cents(money: str) -> str:
    return f"cast(({money}) * 100 as hugeint)"


def cycle(key: str, *values: str) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case ({key}) % {len(values)} {arms} end"


HOLIDAY_NAME = """case strftime({d}, '%m-%d')
    when '01-01' then 'New Year''s Day' when '01-06' then 'Epiphany' when '07-04' then 'Liberation Day'
    when '12-25' then 'Christmas Day' when '12-26' then 'Boxing Day'
    when '12-31' then 'Test Holiday - Year End' end"""


def _calendar(table: str, column: str) -> str:
    name = HOLIDAY_NAME.format(d="d")
    return f"""select cast(strftime(d, '%Y%m%d') as bigint) holidayid, {name} holidayname, d holidaydate, year(d) yr
        from (select distinct cast({column} as date) d from {table}) where {name} is not null"""


TABLES = {
    "dept": """select cast(n_nationkey as bigint) deptid, n_name deptname, r_name location,
        'Head ' || n_name headofdept from nation join region on r_regionkey = n_regionkey""",
    "tech": f"""select s_suppkey techid, s_name fullname,
        {cycle("s_suppkey", "Electrical", "Mechanical", "Biomedical", "General")} specialty,
        cast(s_nationkey as bigint) departmentid, if(s_acctbal >= 0, 'ACTIVE', 'INACTIVE') status,
        'CERTIFIED LEVEL ' || (1 + s_suppkey % 5) certificationlevel from supplier""",
    "usr": f"""select c_custkey userid, 'user' || c_custkey username, c_name fullname,
        {cycle("c_custkey", "ADMIN", "TECHNICIAN", "MANAGER", "VIEWER")} "role",
        cast(c_nationkey as bigint) departmentid, 'ACTIVE' status from customer""",
    "eq": f"""select p_partkey equipmentid,
        upper(left(p_type, 4)) || '-' || (1990 + p_partkey % 11) || '-' || lpad(cast(p_partkey % 1000 as varchar), 3, '0')
            serialnumber,
        p_name "name", {cycle("p_size", "IMAGING", "LABORATORY", "MONITORING", "SURGICAL", "LIFE_SUPPORT")} category,
        {NOW} - to_days(cast(p_partkey * 13 % 5000 as int)) purchasedate,
        cast(p_retailprice as decimal(15,2)) * 1000 purchaseprice,
        case when p_partkey % 11 <> 0 then {NOW} + to_days(cast(p_partkey * 7 % 900 - 300 as int)) end warrantyexpiry,
        case (p_size + p_partkey) % 10 when 0 then 'INACTIVE' when 1 then 'UNDER_MAINTENANCE'
            when 2 then 'DECOMMISSIONED' else 'ACTIVE' end status,
        p_partkey % 25 departmentid,
        case when p_partkey % 17 <> 0 then {NOW} + to_days(cast(p_partkey * 11 % 240 - 60 as int)) end
            nextmaintenancedate,
        p_partkey * 37 % 8760 utilizationhours from part""",
    "lines": """select l_orderkey * 10 + l_linenumber id, l_orderkey % 10 lot, min(l_partkey) piece,
        min(l_suppkey) tech, max(l_shipdate) done, min(l_returnflag) flag, cast(min(l_quantity) as bigint) down,
        sum(cast(l_extendedprice as decimal(15,2))) amount from lineitem group by l_orderkey, l_linenumber""",
    "job": f"""select id maintenanceid, piece equipmentid, tech technicianid,
        case flag when 'A' then 'PREVENTIVE' when 'N' then 'CORRECTIVE' else 'EMERGENCY' end maintenancetype,
        done - to_days(cast(id % 3 as int)) scheduleddate, done actualdate,
        done + to_days(cast(1 + id % 2 as int)) completiondate,
        case when lot = 0 then 'CANCELLED' when done < {NOW} then 'COMPLETED'
            when lot = 1 then 'IN_PROGRESS' else 'SCHEDULED' end status,
        amount "cost", down, 'Maintenance ' || id description,
        case id % 5 when 0 then 'Filter replacement' when 1 then 'Battery replacement' end partsreplaced from lines""",
    "hist": """select maintenanceid historyid, equipmentid, maintenanceid, technicianid,
        'Maintenance ' || maintenanceid actiontaken, actualdate + interval 1 day datefixed, "cost", down downtimehours
        from job where status = 'COMPLETED' and maintenanceid % 7 <> 0""",
    "alert": f"""select event_id alertid, user_id equipmentid,
        {cycle("event_id", "MAINTENANCE_DUE", "WARRANTY_EXPIRY", "CRITICAL_ISSUE", "LOW_USAGE", "HIGH_USAGE")} alerttype,
        'Alert ' || event_id issuedescription, {cycle("event_id", "LOW", "MEDIUM", "HIGH", "CRITICAL")} priority,
        ts datereported, case event_id % 10 when 0 then 'PENDING' when 1 then 'IN_PROGRESS' when 2 then 'ESCALATED'
            else 'RESOLVED' end status,
        case when event_id % 10 > 2 then ts + to_hours(cast(event_id % 72 as int)) end resolutiondate
        from events where event_type = 'error'""",
    "holi": _calendar("events", "ts"),
    "order_holi": _calendar("orders", "o_orderdate"),
    "chg": """select event_id change_id, event_id // 4 statement_id,
        if(event_id % 2 = 0, 'EQUIPMENT', 'MAINTENANCE') table_name,
        case event_type when 'signup' then 'INSERT' when 'click' then 'DELETE' else 'UPDATE' end op,
        'user' || user_id username, ts event_ts, user_id row_key, dayofweek(ts) in (0, 6) weekend,
        holidayname is not null is_holiday, holidayname holiday_name
        from events left join holi on holidaydate = cast(ts as date) where event_type <> 'error'""",
    "aud": """select change_id logid, table_name tablename, op operation, cast(row_key as varchar) primarykeyvalue,
        username, event_ts "timestamp", if(weekend, 'SUCCESS', 'DENIED') status,
        case when not weekend then 'Operation ' || op || ' on ' || table_name || ' table is not allowed on '
            || if(is_holiday, 'public holiday (' || dayname(event_ts) || ')', 'weekdays (Monday-Friday)')
            || '. Allowed only on weekends (Saturday and Sunday).' end errormessage from chg""",
    # Features: age in hundredths of a year, health in tenths.
    "aged": f"""select *, (200 * 100 * date_sub('day', purchasedate, {NOW}) + 36525) // 73050 age from eq""",
    "fit": f"""select *,
        4 * (case when nextmaintenancedate < {NOW} then 30 when nextmaintenancedate <= {NOW} + interval 7 day then 60
            else 100 end)
        + 3 * (case when warrantyexpiry >= {NOW} then 100 else 50 end)
        + 3 * (case when age < 500 then 100 when age < 1000 then 70 else 40 end) health from aged""",
    "piece_jobs": f"""select equipmentid, count(*) n, sum("cost") spent, max(actualdate) last_done,
        count(*) filter (where maintenancetype = 'EMERGENCY') emergencies,
        count(*) filter (where maintenancetype = 'EMERGENCY' and actualdate between {NOW} - interval 12 month and {NOW})
            recent from job where status = 'COMPLETED' group by equipmentid""",
    "feat": f"""select fit.*, coalesce(n, 0) n, coalesce(spent, 0) spent, last_done, coalesce(emergencies, 0) emergencies,
        coalesce(recent, 0) recent,
        case when health < 500 or coalesce(recent, 0) >= 3 then 'CRITICAL'
            when health < 650 or coalesce(recent, 0) = 2 then 'HIGH'
            when health < 800 or coalesce(recent, 0) = 1 then 'MEDIUM' else 'LOW' end risk,
        {rounded(f"(utilizationhours * 12000 - {cents('coalesce(spent, 0)')}) * 100", cents("purchaseprice"), 1)} roi
        from fit left join piece_jobs using (equipmentid)""",
    # First generation.
    "g_eq": f"""select p_partkey equipmentid, p_name "name", p_partkey % 25 departmentid,
        {cycle("p_size", "Imaging", "Laboratory", "Monitoring", "Surgical", "General")} category,
        {cycle("p_partkey + p_size", "Working", "Under Maintenance", "Faulty", "Decommissioned")} status from part""",
    "g_alert": """select event_id alertid, user_id equipmentid, 'Issue reported for equipment ' || user_id issuedescription,
        ts datereported, case event_id % 6 when 0 then 'Pending' when 1 then 'Resolved' when 2 then ' Open '
            when 3 then 'In Progress' when 5 then 'Pending' end status from events where event_type = 'error'""",
    # Change feeds.
    "eq_chg": f"""select c.*, equipmentid, "name", e.status old_status,
        if(op = 'INSERT', e.status, {cycle("change_id", "UNDER_MAINTENANCE", "INACTIVE", "ACTIVE")}) new_status,
        e.warrantyexpiry old_expiry,
        if(change_id % 5 = 0, e.warrantyexpiry + interval 30 day, e.warrantyexpiry) new_expiry
        from chg c join eq e on equipmentid = row_key where table_name = 'EQUIPMENT'""",
    "job_chg": """select c.*, j.equipmentid, j.maintenanceid, j.status old_status, 'CANCELLED' new_status
        from chg c join (select equipmentid, min(maintenanceid) maintenanceid, arg_min(status, maintenanceid) status
            from job group by equipmentid) j on j.equipmentid = row_key where table_name = 'MAINTENANCE'""",
    "done_chg": """select * from (select *, case maintenanceid % 4 when 0 then 'IN_PROGRESS' when 1 then 'SCHEDULED'
        when 2 then 'COMPLETED' end old_status from job) where status = 'COMPLETED' and old_status <> 'COMPLETED'""",
    "request": """select equipmentid request_id, case equipmentid % 4 when 0 then serialnumber
        when 1 then 'NEW-2001-' || lpad(cast(equipmentid // 8 % 1000 as varchar), 3, '0')
        when 2 then 'serial ' || equipmentid end serialnumber, "name", equipmentid % 30 departmentid from eq""",
    "screened": """select r.*, case when r.serialnumber is null then 'serial number missing'
        when r.departmentid not in (select deptid from dept) then 'unknown department'
        when r.serialnumber in (select serialnumber from eq)
            or r.request_id > min(r.request_id) over (partition by r.serialnumber) then 'duplicate serial number' end reason
        from request r""",
}

# Tables a table is built from, besides the raw views.
NEEDS = {
    "job": ["lines"],
    "hist": ["job"],
    "chg": ["holi"],
    "aud": ["chg"],
    "aged": ["eq"],
    "fit": ["aged"],
    "piece_jobs": ["job"],
    "feat": ["fit", "piece_jobs"],
    "eq_chg": ["chg", "eq"],
    "job_chg": ["chg", "job"],
    "done_chg": ["job"],
    "request": ["eq"],
    "screened": ["request", "dept", "eq"],
}


def with_tables(names: list[str], body: str, **extra: str) -> str:
    """``body`` behind the CTEs it needs; ``extra`` CTEs come last."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = [f"{n} as ({TABLES[n]})" for n in ordered] + [f"{n} as ({sql})" for n, sql in extra.items()]
    return f"with {', '.join(ctes)} {body}" if ctes else body

"""DuckDB SQL for the registered queries.

Written against the semantics, in forms unlike the Spark plans (range joins, correlated minima,
DISTINCT ON), so that agreement means something. Fragments are shared CTEs; a query pulls in those it
names. Results use neutral types: bigint, double and text dates.
"""

from __future__ import annotations

import re

AS_OF = "date '2024-01-31'"
RUNS_AS_OF = "timestamp '2001-08-02 00:00:00'"

# Modes by the limit that applies to them. Accents, labels and messages below are fixed as well.
WALK = "('marche', 'running', 'marche/running')"
CYCLE = "('velo', 'trottinette', 'roller', 'skate', 'velo/trottinette/autres')"

EMPLOYEE_BUSINESS = (
    "employee_id", "last_name", "first_name", "birth_date_raw", "business_unit", "hire_date_raw",
    "gross_salary_raw", "contract_type", "cp_days_raw", "home_address", "declared_transport_mode",
)


def joined_text(columns) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in columns) + ")"


def mode_fold(column: str) -> str:
    return f"lower(translate(coalesce({column}, 'inconnu'), 'éèêëàâäîïôöùûüç', 'eeeeaaaiioouuuc'))"


def serial_date(column: str) -> str:
    return (
        f"case when coalesce({column}, '') = '' then null "
        f"when regexp_full_match(trim({column}), '[0-9]+([.][0-9]+)?') "
        f"then date '1899-12-30' + cast(round(cast(trim({column}) as decimal(30,10)), 0) as integer) "
        f"else cast(cast({column} as timestamp) as date) end"
    )


def axis(address: str, digest_start: int, origin: int, divisor: int) -> str:
    """One pseudo-coordinate from a postcode and a digest slice."""
    postcode = f"coalesce(cast(nullif(regexp_extract({address}, '([0-9]{{5}})', 1), '') as bigint), 34970)"
    bits = f"cast('0x' || substr(md5(coalesce({address}, '')), {digest_start}, 8) as bigint)"
    return f"cast(({origin} + (({postcode} // {divisor}) % 300) * 10 + {bits} % 1000) / 10000.0 as decimal(10,6))"


def sha_axis(address: str, digest_start: int, origin: int, divisor: int, office: str) -> str:
    postcode = f"coalesce(cast(nullif(regexp_extract({address}, '\\b([0-9]{{5}})\\b', 1), '') as bigint), 34970)"
    bits = f"cast('0x' || substr(sha256({address}), {digest_start}, 8) as bigint)"
    value = f"cast(({origin} + (({postcode} // {divisor}) % 300) * 10 + {bits} % 1000) / 10000.0 as decimal(10,6))"
    return f"case when coalesce({address}, '') = '' then {office} else {value} end"


def great_circle(lat: str, lon: str) -> str:
    """Distance to the office by the law of haversines."""
    lat, lon = f"cast({lat} as double)", f"cast({lon} as double)"
    h = (f"least(1.0, (1 - cos(radians(43.5652::double - {lat}))) / 2 + cos(radians({lat})) * cos(radians(43.5652::double)) "
         f"* (1 - cos(radians(3.9029::double - {lon}))) / 2)")
    return f"cast(round(2 * 6371 * asin(sqrt({h})), 2) as decimal(10,2))"


def in_range(mode: str, distance: str, walk: str, cycle: str) -> str:
    return (f"case when {mode} in {WALK} then {distance} <= {walk} "
            f"when {mode} in {CYCLE} then {distance} <= {cycle} else false end")


def yearly(days: int) -> str:
    recent = f"activity_date >= {AS_OF} - {days}"
    return f"""
        select employee_id, count(case when {recent} then 1 end) as activity_count_12m,
               count(distinct case when {recent} then activity_date end) as sport_days_count,
               max(activity_date) as last_activity_date,
               max(case when {recent} then process_date end) as last_process_date
        from sil_acts where is_valid_activity group by employee_id
    """


def joined(yearly_cte: str) -> str:
    return f"""
        select e.*, s.declared_sport, coalesce(y.activity_count_12m, 0) as activity_count_12m,
               coalesce(y.sport_days_count, 0) as sport_days_count, y.last_activity_date, y.last_process_date
        from sil_emp e left join sil_decl s using (employee_id) left join {yearly_cte} y using (employee_id)
    """


def snapshots(acts: str, days: int, known: str = "") -> str:
    """Plain form of the timeline: grid, range join, one group per employee and date."""
    return f"""
        select g.employee_id, g.snapshot_date,
               count(a.activity_id) filter (where a.activity_date = g.snapshot_date) as activity_count_on_date,
               coalesce(sum(a.distance_km) filter (where a.activity_date = g.snapshot_date), 0) as distance_km_on_date,
               coalesce(sum(a.duration_min) filter (where a.activity_date = g.snapshot_date), 0) as duration_min_on_date,
               count(a.activity_id) as activity_count_12m, count(distinct a.activity_date) as sport_days_count_12m,
               max(a.activity_date) as last_activity_date, max(a.process_date) as last_process_date
        from (select employee_id, snapshot_date from sil_emp, (select distinct activity_date as snapshot_date
              from {acts} where is_valid_activity)) g
        left join (select * from {acts} where is_valid_activity) a
          on a.employee_id = g.employee_id and g.snapshot_date - a.activity_date between 0 and {days} {known}
        group by all
    """


def timeline(snapshot_cte: str) -> str:
    """Snapshots with the decisions of the rule in force on their date."""
    return f"""
        select s.*, e.full_name, e.business_unit, e.contract_type, e.transport_mode, e.distance_km_to_office,
               w.rule_version, round(e.gross_salary * w.bonus_rate, 2) as potential_bonus_amount,
               list_contains(w.modes, e.transport_mode) as sportive,
               {in_range('e.transport_mode', 'e.distance_km_to_office', 'w.max_km_walk_run', 'w.max_km_cycle_scooter_other')} as within_limit,
               s.activity_count_12m >= w.min_activities_per_year as enough, w.wellbeing_days
        from {snapshot_cte} s join sil_emp e using (employee_id)
        join windows w on s.snapshot_date >= w.valid_from_inclusive
         and s.snapshot_date < coalesce(w.effective_to_exclusive, date '9999-12-31')
    """


FRAGMENTS: dict[str, str] = {
    "emp_raw": f"""
        select *, sha256({joined_text(EMPLOYEE_BUSINESS)}) as row_hash from (
            select 'hr-' || v as ingestion_id,
                   case when v = 2 then timestamp '2024-01-20 06:00:00' else timestamp '2024-01-05 06:00:00' end as ingested_at,
                   case when v = 2 then date '2024-01-20' else date '2024-01-05' end as process_date,
                   'employees.csv' as source_file,
                   case when k % 97 <> 13 then k::varchar end as employee_id,
                   ' Name' || k || ' ' as last_name,
                   case when k % 11 <> 0 then 'First' || c_nationkey end as first_name,
                   (20000 + k % 9000)::varchar as birth_date_raw,
                   c_mktsegment || ' ' as business_unit,
                   case when k % 50 = 7 then '' when k % 4 = 0 then (40000 + k % 4000)::varchar
                        when k % 4 = 1 then strftime(date '2009-07-06' + (k % 4000)::integer, '%Y-%m-%d 00:00:00')
                        when k % 4 = 2 then (40000 + k % 4000) || '.5' else (40000 + k % 4000) || '.0' end as hire_date_raw,
                   case when k % 101 = 5 then '0' when k % 103 = 7 then ''
                        else (20000 + k % 400 * 100 + (v - 1) * 500) || '.50' end as gross_salary_raw,
                   case when k % 89 = 3 then ' Interim'
                        else ['CDI', 'CDD', 'Stage', 'Alternance', 'Freelance'][k % 5 + 1] end as contract_type,
                   case when k % 53 = 9 then '' else (20 + k % 10)::varchar end as cp_days_raw,
                   case when k % 71 = 2 then null when k % 73 = 4 then 'sans code'
                        else ' No ' || (k % 90) || ', ' || (10000 + (k * 37) % 80000) || ' City' || c_nationkey end as home_address,
                   ['Vélo', 'Marche/running', ' Trottinette ', 'VÉLO', 'Transports en commun',
                    'Vélo/Trottinette/Autres', '', null][(k + v) % 8 + 1] as declared_transport_mode
            from (select *, c_custkey as k from customer), (select unnest([1, 2, 3]) as v)
            where v = 1 or (v = 2 and k % 3 = 0) or (v = 3 and k % 7 = 0)
        )
    """,
    "decl_raw": f"""
        select *, sha256({joined_text(('employee_id', 'declared_sport'))}) as row_hash from (
            select 'sport-' || v as ingestion_id,
                   case when v = 2 then timestamp '2024-01-20 06:00:00' else timestamp '2024-01-05 06:00:00' end as ingested_at,
                   case when v = 2 then date '2024-01-20' else date '2024-01-05' end as process_date,
                   'sports.csv' as source_file,
                   case when k % 97 <> 13 then k::varchar end as employee_id,
                   ['Running ', '', '  ', 'Vélo', null, ' Natation'][(k + v) % 6 + 1] as declared_sport
            from (select c_custkey as k from customer), (select unnest([1, 2]) as v)
            where v = 1 or k % 4 = 1
        )
    """,
    "act_parts": """
        select e, v, ts, user_id, cast(ts as date) as day, cast(ts as date) + (e % 3)::integer as process_date,
               case when e % 50 = 17 then -1.00 else cast(value as decimal(10,2)) + (v - 1) end::decimal(10,2) as km,
               case when e % 40 <> 11 then user_id::varchar end as employee_id,
               case when e % 60 <> 29 then cast(ts as date) end as activity_date,
               case when e % 8 = 0 then 0 else cast(json_extract_string(props, '$.k') as integer) end as minutes,
               upper(event_type) as activity_type, e % 500 + 100 as calories,
               case when v = 2 then e + 1000000000 else e end as offset_id,
               case when v = 2 and e % 20 = 3 then ts + interval 1 second else ts end as event_ts,
               ts + case when v = 2 then interval 60 minute else interval 1 minute end as consumed_at
        from (select *, event_id as e from events), (select unnest([1, 2]) as v)
        where v = 1 or e % 10 = 3
    """,
    "act_raw": """
        select e::varchar as event_id, process_date, 'sport_activities' as topic, user_id % 4 as partition_id, offset_id,
               event_ts, consumed_at, employee_id, activity_type, activity_date, km as distance_km,
               minutes as duration_min, calories as calories_burned,
               concat_ws('', '{"activity_id":"', e, '"', ',"employee_id":"' || employee_id || '"',
                   ',"activity_type":"', activity_type, '"', ',"activity_date":"' || activity_date || '"',
                   ',"distance_km":', km, ',"duration_min":', minutes, ',"calories_burned":', calories,
                   ',"source_system":"feed","event_ts":"', strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'Z"',
                   ',"process_date":"', process_date, '"}') as payload_json
        from act_parts
    """,
    "docs": """
        select s_suppkey as k, 'r' || s_suppkey as rule_version,
               date '2023-11-10' + ((s_suppkey * 13) % 97)::integer as effective_from,
               'Site ' || s_suppkey as office_address, '0.0' || (s_suppkey % 5 + 3) as rate_text,
               s_suppkey % 4 + 3 as wellbeing_days, s_suppkey % 20 + 5 as min_activities_per_year,
               s_suppkey % 10 + 8 as max_km_walk_run, s_suppkey % 12 + 15 as max_km_cycle_scooter_other,
               case when s_suppkey % 10 = 9 then cast([] as varchar[]) when s_suppkey % 3 = 0 then ['velo', 'marche/running']
                    when s_suppkey % 3 = 1 then ['velo', 'vélo', 'marche/running', 'trottinette']
                    else ['marche/running', 'trottinette'] end as modes,
               timestamp '2024-01-01 00:00:00' + to_minutes(s_suppkey) as loaded_at
        from supplier
    """,
    "rules": """
        select *, cast(rate_text as decimal(8,4)) as bonus_rate,
               case when len(modes) = 0 then '[]' else '["' || array_to_string(modes, '","') || '"]' end as modes_text,
               concat('{"rule_version":"', rule_version, '","effective_from":"', effective_from, '","office_address":"',
                   office_address, '","bonus_rate":', rate_text, ',"wellbeing_days":', wellbeing_days,
                   ',"min_activities_per_year":', min_activities_per_year, ',"max_km_walk_run":', max_km_walk_run,
                   ',"max_km_cycle_scooter_other":', max_km_cycle_scooter_other,
                   case when k % 10 <> 9 then ',"sportive_transport_modes":["' || array_to_string(modes, '","') || '"]' end,
                   ',"limits":{"city":{"max":', k % 7, '},"note":null,"ratio":1.5,' || numbers || ',"deep":' || deep || ',"empty":{}},"active":true',
                   case when k % 10 = 9 then ',"sportive_transport_modes":[]' end, '}') as rules_payload
        from docs, (select '"one":1.0,"thousand":1e3,"big":12345678901234567890,"under":-0.25,"list":[[1,{"a":2.5}],"é"]' as numbers,
            '{"l1":{"l2":{"l3":{"l4":{"l5":{"l6":{"l7":{"l8":{"l9":{"l10":{"l11":"é}"}}}}}}}}}}}' as deep)
    """,
    "windows": f"""
        select *, {AS_OF} >= effective_from and {AS_OF} < coalesce(effective_to_exclusive, date '9999-12-31') as is_current
        from (
            select r.*, case when pos = 1 then date '1900-01-01' else effective_from end as valid_from_inclusive,
                   lead(effective_from) over (order by pos) as effective_to_exclusive
            from (select *, row_number() over (order by effective_from, loaded_at, rule_version) as pos from rules) r
        )
    """,
    "params": """
        select rule_version, effective_from, unnest([
                 {'p': 'rule_version', 'j': '"' || rule_version || '"', 't': 'str'},
                 {'p': 'effective_from', 'j': '"' || effective_from || '"', 't': 'str'},
                 {'p': 'office_address', 'j': '"' || office_address || '"', 't': 'str'},
                 {'p': 'bonus_rate', 'j': rate_text, 't': 'float'},
                 {'p': 'wellbeing_days', 'j': wellbeing_days::varchar, 't': 'int'},
                 {'p': 'min_activities_per_year', 'j': min_activities_per_year::varchar, 't': 'int'},
                 {'p': 'max_km_walk_run', 'j': max_km_walk_run::varchar, 't': 'int'},
                 {'p': 'max_km_cycle_scooter_other', 'j': max_km_cycle_scooter_other::varchar, 't': 'int'},
                 {'p': 'sportive_transport_modes', 'j': modes_text, 't': 'array'},
                 {'p': 'limits.city.max', 'j': (k % 7)::varchar, 't': 'int'},
                 {'p': 'limits.note', 'j': 'null', 't': 'NoneType'},
                 {'p': 'limits.ratio', 'j': '1.5', 't': 'float'},
                 {'p': 'limits.one', 'j': '1.0', 't': 'float'},
                 {'p': 'limits.thousand', 'j': '1000.0', 't': 'float'},
                 {'p': 'limits.big', 'j': '12345678901234567890', 't': 'int'},
                 {'p': 'limits.under', 'j': '-0.25', 't': 'float'},
                 {'p': 'limits.list', 'j': '[[1,{"a":2.5}],"é"]', 't': 'array'},
                 {'p': 'limits.deep.l1.l2.l3.l4.l5.l6.l7.l8.l9.l10.l11', 'j': '"é}"', 't': 'str'},
                 {'p': 'active', 'j': 'true', 't': 'bool'}]) as entry, loaded_at, k
        from rules
    """,
    "parameters": """
        select rule_version, effective_from, entry.p as rule_path, entry.j as rule_value_json, entry.t as value_type, loaded_at, k
        from params
    """,
    "current_rule": "select * from windows where is_current",
    "emp_latest": """
        select distinct on (employee_id) * from emp_raw where employee_id is not null
        order by employee_id, ingested_at desc, row_hash desc
    """,
    "decl_latest": "select distinct on (employee_id) * from decl_raw order by employee_id, ingested_at desc, row_hash desc",
    "act_latest": "select distinct on (event_id) * from act_raw order by event_id, event_ts desc, offset_id desc",
    "emp_typed": f"""
        select employee_id, trim(last_name) as last_name, trim(first_name) as first_name,
               concat_ws(' ', trim(first_name), trim(last_name)) as full_name,
               {serial_date('birth_date_raw')} as birth_date, {serial_date('hire_date_raw')} as hire_date,
               trim(business_unit) as business_unit, cast(nullif(gross_salary_raw, '') as decimal(12,2)) as gross_salary,
               trim(contract_type) as contract_type, cast(nullif(cp_days_raw, '') as bigint) as cp_days,
               trim(home_address) as home_address, {mode_fold('trim(declared_transport_mode)')} as transport_mode,
               {axis('trim(home_address)', 1, 434000, 1)} as home_lat, {axis('trim(home_address)', 9, 37000, 10)} as home_lon,
               cast(43.5652 as decimal(10,6)) as office_lat, cast(3.9029 as decimal(10,6)) as office_lon
        from emp_latest
    """,
    "emp_located": f"select *, {great_circle('home_lat', 'home_lon')} as distance_km_to_office from emp_typed",
    "sil_emp": f"""
        select e.*, coalesce(list_contains(r.modes, e.transport_mode), false) as is_transport_mode_sportive,
               {in_range('e.transport_mode', 'e.distance_km_to_office', 'r.max_km_walk_run', 'r.max_km_cycle_scooter_other')}
                   as is_distance_rule_valid
        from emp_located e left join current_rule r on true
    """,
    "sil_decl": "select employee_id, nullif(trim(declared_sport), '') as declared_sport from decl_latest",
    "sil_acts": """
        select event_id as activity_id, employee_id, lower(activity_type) as activity_type, process_date, activity_date,
               distance_km, duration_min, calories_burned, 'feed' as source_system, event_ts,
               employee_id is not null and activity_date is not null and distance_km >= 0 and duration_min > 0 as is_valid_activity,
               concat(':runner: Activite ', lower(activity_type), ' enregistree pour le salarie ', employee_id, ' le ',
                   activity_date, ' (', distance_km, ' km, ', duration_min, ' min).') as slack_message_text
        from act_latest
    """,
    "year_365": yearly(365),
    "year_7": yearly(7),
    "joined_365": joined("year_365"),
    "joined_7": joined("year_7"),
    "bonus": f"""
        select j.*, r.bonus_rate, r.rule_version, round(j.gross_salary * r.bonus_rate, 2) as potential_bonus_amount,
               coalesce(j.is_transport_mode_sportive and j.is_distance_rule_valid, false) as eligibility_status,
               case when j.is_transport_mode_sportive and j.is_distance_rule_valid
                    then round(j.gross_salary * r.bonus_rate, 2) else 0 end as bonus_amount,
               case when not j.is_transport_mode_sportive then 'transport_non_sportif'
                    when not j.is_distance_rule_valid then 'distance_hors_regle' else 'eligible' end as eligibility_reason
        from joined_365 j, current_rule r
    """,
    "well_365": """
        select j.employee_id, j.full_name, j.business_unit, j.activity_count_12m, r.rule_version,
               j.activity_count_12m >= r.min_activities_per_year as eligibility_status,
               if(j.activity_count_12m >= r.min_activities_per_year, r.wellbeing_days, 0) as wellbeing_days_awarded,
               if(j.activity_count_12m >= r.min_activities_per_year, 'eligible', 'insufficient_activities') as eligibility_reason
        from joined_365 j, current_rule r
    """,
    "well_7": """
        select j.employee_id, j.full_name, j.business_unit, j.activity_count_12m, r.rule_version,
               j.activity_count_12m >= r.min_activities_per_year as eligibility_status,
               if(j.activity_count_12m >= r.min_activities_per_year, r.wellbeing_days, 0) as wellbeing_days_awarded,
               if(j.activity_count_12m >= r.min_activities_per_year, 'eligible', 'insufficient_activities') as eligibility_reason
        from joined_7 j, current_rule r
    """,
    "status": """
        select j.*, b.eligibility_status as is_bonus_eligible, b.bonus_amount, b.potential_bonus_amount,
               b.eligibility_reason as bonus_reason, w.eligibility_status as is_wellbeing_eligible,
               w.wellbeing_days_awarded, w.eligibility_reason as wellbeing_reason
        from joined_365 j left join bonus b using (employee_id) left join well_365 w using (employee_id)
    """,
    "snap_365": snapshots("sil_acts", 365),
    "snap_7": snapshots("sil_acts", 7),
    "long_acts": """
        select o_orderkey::varchar as activity_id, o_custkey::varchar as employee_id,
               cast(o_orderdate as date) + (o_orderkey % 3)::integer as process_date, cast(o_orderdate as date) as activity_date,
               cast(o_totalprice as decimal(10,2)) as distance_km, o_orderkey % 120 as duration_min,
               o_orderkey % 120 > 0 as is_valid_activity
        from orders
    """,
    "snap_long": snapshots("long_acts", 365),
    "snap_known": snapshots("sil_acts", 7, "and a.process_date <= g.snapshot_date"),
    "decided_known": timeline("snap_known"),
    "decided_365": timeline("snap_365"),
    "decided_7": timeline("snap_7"),
    "decided_long": timeline("snap_long"),
    "runs": """
        select 'dag_' || (o_orderkey % 5) as dag_id, o_orderkey::varchar as run_id, 'scheduled' as run_type,
               case o_orderstatus when 'F' then 'success' when 'O' then 'failed' else 'running' end as state,
               o_custkey % 2 = 0 as external_trigger, o_orderdate as execution_date, o_orderdate as data_interval_start,
               o_orderdate + interval 1 day as data_interval_end, o_orderdate + interval 1 minute as queued_at,
               case when o_orderkey % 37 <> 0 then o_orderdate + to_seconds(o_orderkey % 3600) end as start_date,
               case when o_orderkey % 37 <> 0 and o_orderstatus <> 'P'
                    then o_orderdate + to_seconds(o_orderkey % 3600 + o_custkey % 5000) end as end_date
        from orders
    """,
    "tasks": """
        select 'dag_' || (l_orderkey % 5) as dag_id, l_orderkey::varchar as run_id,
               case when l_linestatus = 'F' then if(l_returnflag = 'R', 'failed', 'success')
                    else case l_returnflag when 'A' then 'running' when 'N' then 'queued' else 'skipped' end end as state
        from lineitem
    """,
    "task_counts": """
        select dag_id, run_id, count(*) as task_count, sum((state = 'success')::bigint) as task_success_count,
               sum((state = 'failed')::bigint) as task_failed_count, sum((state = 'running')::bigint) as task_running_count,
               sum((state = 'queued')::bigint) as task_queued_count
        from tasks group by all
    """,
    "run_log": f"""
        select r.*, r.state as dag_state,
               date_diff('microsecond', r.start_date, coalesce(r.end_date, {RUNS_AS_OF})) / 1000000.0 as duration_seconds,
               coalesce(t.task_count, 0) as task_count, coalesce(t.task_success_count, 0) as task_success_count,
               coalesce(t.task_failed_count, 0) as task_failed_count, coalesce(t.task_running_count, 0) as task_running_count,
               coalesce(t.task_queued_count, 0) as task_queued_count
        from runs r left join task_counts t using (dag_id, run_id)
    """,
    "vol_silver": """
        select process_date, count(*) as silver_activity_count, count(case when is_valid_activity then 1 end) as valid_activity_count,
               count(case when not is_valid_activity then 1 end) as invalid_activity_count,
               count(distinct case when is_valid_activity then employee_id end) as active_employee_count
        from sil_acts group by 1
    """,
    "vol_gold": """
        select snapshot_date, count(case when activity_count_on_date > 0 then 1 end) as employee_snapshots_with_activity,
               sum(activity_count_on_date) as total_activities_on_date, count(case when enough then 1 end) as wellbeing_eligible_employee_count
        from decided_365 group by 1
    """,
    "vol_gold_7": """
        select snapshot_date, count(case when activity_count_on_date > 0 then 1 end) as employee_snapshots_with_activity,
               sum(activity_count_on_date) as total_activities_on_date, count(case when enough then 1 end) as wellbeing_eligible_employee_count
        from decided_7 group by 1
    """,
    "vol_gold_long": """
        select snapshot_date, count(case when activity_count_on_date > 0 then 1 end) as employee_snapshots_with_activity,
               sum(activity_count_on_date) as total_activities_on_date, count(case when enough then 1 end) as wellbeing_eligible_employee_count
        from decided_long group by 1
    """,
    "volumes": """
        select days.day as metric_date, coalesce(r.n, 0) as raw_event_count,
               coalesce(s.silver_activity_count, 0) as silver_activity_count, coalesce(s.valid_activity_count, 0) as valid_activity_count,
               coalesce(s.invalid_activity_count, 0) as invalid_activity_count, coalesce(s.active_employee_count, 0) as active_employee_count,
               coalesce(g.employee_snapshots_with_activity, 0) as employee_snapshots_with_activity,
               coalesce(g.total_activities_on_date, 0) as total_activities_on_date,
               coalesce(g.wellbeing_eligible_employee_count, 0) as wellbeing_eligible_employee_count
        from (select process_date as day from act_raw union select process_date from sil_acts union select snapshot_date from decided_365) days
        left join (select process_date, count(*) as n from act_raw group by 1) r on r.process_date = days.day
        left join vol_silver s on s.process_date = days.day
        left join vol_gold g on g.snapshot_date = days.day
    """,
    "volumes_7": """
        select days.day as metric_date, coalesce(r.n, 0) as raw_event_count,
               coalesce(s.silver_activity_count, 0) as silver_activity_count, coalesce(s.valid_activity_count, 0) as valid_activity_count,
               coalesce(s.invalid_activity_count, 0) as invalid_activity_count, coalesce(s.active_employee_count, 0) as active_employee_count,
               coalesce(g.employee_snapshots_with_activity, 0) as employee_snapshots_with_activity,
               coalesce(g.total_activities_on_date, 0) as total_activities_on_date,
               coalesce(g.wellbeing_eligible_employee_count, 0) as wellbeing_eligible_employee_count
        from (select process_date as day from act_raw union select process_date from sil_acts union select snapshot_date from decided_7) days
        left join (select process_date, count(*) as n from act_raw group by 1) r on r.process_date = days.day
        left join vol_silver s on s.process_date = days.day
        left join vol_gold_7 g on g.snapshot_date = days.day
    """,
    "anomalies": f"""
        select md5(employee_id || '-distance') as anomaly_id, 'sil_employees' as table_name, employee_id as record_id,
               'distance_rule_issue' as anomaly_type, 'Distance negative ou hors seuil reglementaire' as anomaly_detail
        from sil_emp, current_rule
        where distance_km_to_office < 0 or distance_km_to_office > case when transport_mode in {WALK} then max_km_walk_run
              when transport_mode in {CYCLE} and transport_mode <> 'velo/trottinette/autres' then max_km_cycle_scooter_other end
        union all
        select md5(employee_id || '-salary'), 'sil_employees', employee_id, 'salary_issue', 'Salaire brut non positif'
        from sil_emp where gross_salary <= 0
        union all
        select md5(activity_id || '-activity'), 'sil_sport_activities', activity_id, 'invalid_activity',
               'Activite invalide detectee dans le flux'
        from sil_acts where not is_valid_activity
    """,
    "counts": """
        select 'raw' as layer_name, 'rh_employees_raw' as table_name, count(*) as row_count from emp_raw
        union all select 'raw', 'sport_declarations_raw', count(*) from decl_raw
        union all select 'raw', 'sport_activities_stream_raw', count(*) from act_raw
        union all select 'silver', 'sil_employees', count(*) from sil_emp
        union all select 'silver', 'sil_sport_activities', count(*) from sil_acts
        union all select 'gold', 'gold_kpi_employee_status', count(*) from status
        union all select 'gold', 'gold_employee_benefit_timeline', count(*) from decided_365
        union all select 'gold', 'gold_employee_map', count(*) from sil_emp
    """,
    "landed": """
        select distinct on (event_id) * from act_raw where offset_id % 100 <> 57
        order by event_id, partition_id, offset_id
    """,
    "fault_orders": """
        select case when o_orderkey % 40 <> 1 then o_orderkey - o_orderkey % 3 end as order_id,
               case when o_orderkey % 50 <> 2 then o_custkey end as customer_id, o_orderstatus as status,
               o_totalprice::decimal(12,2) - 20000 as amount, case when o_orderkey % 7 <> 0 then o_orderkey % 5 end as priority
        from orders
    """,
    "repeated_orders": "select order_id from fault_orders where order_id is not null group by order_id having count(*) > 1",
    "faults": """
        select 'orders' as table_name, unnest([
                 {'c': 'not_null', 'f': 'order_id', 'n': count(case when order_id is null then 1 end)},
                 {'c': 'unique', 'f': 'order_id', 'n': count(case when order_id in (select order_id from repeated_orders) then 1 end)},
                 {'c': 'not_null', 'f': 'customer_id', 'n': count(case when customer_id is null then 1 end)},
                 {'c': 'relationships', 'f': 'customer_id', 'n': count(case when customer_id is not null and customer_id not in
                     (select c_custkey from customer where c_custkey % 10 <> 3) then 1 end)},
                 {'c': 'accepted_values', 'f': 'status', 'n': count(case when status not in ('F', 'O') then 1 end)},
                 {'c': 'in_set', 'f': 'priority', 'n': count(case when priority not in (1, 2, 4) then 1 end)},
                 {'c': 'non_negative', 'f': 'amount', 'n': count(case when amount < 0 then 1 end)},
                 {'c': 'positive_value', 'f': 'priority', 'n': count(case when priority <= 0 then 1 end)},
                 {'c': 'between', 'f': 'amount', 'n': count(case when amount <= 0 or amount > 100000 then 1 end)}
               ]) as r, count(*) as row_count from fault_orders
        union all
        select 'customers', {'c': 'unique', 'f': 'customer_id', 'n': count(*) - count(distinct c_custkey)}, count(*)
        from customer where c_custkey % 10 <> 3
    """,
    "model_checks": """
        select 'business_rules_history' as table_name, unnest([{'c': 'not_null', 'f': 'rule_version', 'n': count(*) - count(rule_version)}, {'c': 'unique', 'f': 'rule_version', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from rules where rule_version is not null group by rule_version having count(*) > 1))}]) as r, count(*) as row_count from rules
        union all
        select 'business_rules_validity' as table_name, unnest([{'c': 'not_null', 'f': 'rule_version', 'n': count(*) - count(rule_version)}, {'c': 'not_null', 'f': 'effective_from', 'n': count(*) - count(effective_from)}, {'c': 'unique', 'f': 'rule_version', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from windows where rule_version is not null group by rule_version having count(*) > 1))}]) as r, count(*) as row_count from windows
        union all
        select 'business_rules' as table_name, unnest([{'c': 'not_null', 'f': 'rule_version', 'n': count(*) - count(rule_version)}, {'c': 'unique', 'f': 'rule_version', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from current_rule where rule_version is not null group by rule_version having count(*) > 1))}]) as r, count(*) as row_count from current_rule
        union all
        select 'business_rule_parameters_history' as table_name, unnest([{'c': 'not_null', 'f': 'rule_version', 'n': count(*) - count(rule_version)}, {'c': 'not_null', 'f': 'rule_path', 'n': count(*) - count(rule_path)}, {'c': 'not_null', 'f': 'rule_value_json', 'n': count(*) - count(rule_value_json)}]) as r, count(*) as row_count from parameters
        union all
        select 'business_rule_parameters' as table_name, unnest([{'c': 'not_null', 'f': 'rule_version', 'n': count(*) - count(rule_version)}, {'c': 'not_null', 'f': 'rule_path', 'n': count(*) - count(rule_path)}, {'c': 'not_null', 'f': 'rule_value_json', 'n': count(*) - count(rule_value_json)}]) as r, count(*) as row_count from parameters join current_rule using (rule_version)
        union all
        select 'brz_rh_employees' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}]) as r, count(*) as row_count from emp_raw
        union all
        select 'brz_sport_declarations' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}]) as r, count(*) as row_count from decl_raw
        union all
        select 'brz_sport_activities' as table_name, unnest([{'c': 'not_null', 'f': 'activity_id', 'n': count(*) - count(event_id)}, {'c': 'unique', 'f': 'activity_id', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from act_raw where event_id is not null group by event_id having count(*) > 1))}]) as r, count(*) as row_count from act_raw
        union all
        select 'sil_employees' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}, {'c': 'not_null', 'f': 'gross_salary', 'n': count(*) - count(gross_salary)}, {'c': 'not_null', 'f': 'distance_km_to_office', 'n': count(*) - count(distance_km_to_office)}, {'c': 'unique', 'f': 'employee_id', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from sil_emp where employee_id is not null group by employee_id having count(*) > 1))}, {'c': 'positive_value', 'f': 'gross_salary', 'n': count(case when gross_salary <= 0 then 1 end)}, {'c': 'non_negative', 'f': 'distance_km_to_office', 'n': count(case when distance_km_to_office < 0 then 1 end)}, {'c': 'accepted_values', 'f': 'contract_type', 'n': count(case when contract_type not in ('CDI', 'CDD', 'Stage', 'Alternance', 'Freelance') then 1 end)}]) as r, count(*) as row_count from sil_emp
        union all
        select 'sil_sport_activities' as table_name, unnest([{'c': 'not_null', 'f': 'activity_id', 'n': count(*) - count(activity_id)}, {'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}, {'c': 'unique', 'f': 'activity_id', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from sil_acts where activity_id is not null group by activity_id having count(*) > 1))}, {'c': 'relationships', 'f': 'employee_id', 'n': count(case when employee_id is not null and employee_id not in (select employee_id from sil_emp where employee_id is not null) then 1 end)}, {'c': 'non_negative', 'f': 'distance_km', 'n': count(case when distance_km < 0 then 1 end)}]) as r, count(*) as row_count from sil_acts
        union all
        select 'sil_employee_activity_yearly' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}]) as r, count(*) as row_count from year_365
        union all
        select 'gold_eligible_sport_bonus' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}, {'c': 'relationships', 'f': 'employee_id', 'n': count(case when employee_id is not null and employee_id not in (select employee_id from sil_emp where employee_id is not null) then 1 end)}]) as r, count(*) as row_count from bonus
        union all
        select 'gold_eligible_wellbeing_days' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}]) as r, count(*) as row_count from well_365
        union all
        select 'gold_kpi_employee_status' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}]) as r, count(*) as row_count from status
        union all
        select 'gold_employee_benefit_timeline' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}, {'c': 'not_null', 'f': 'snapshot_date', 'n': count(*) - count(snapshot_date)}]) as r, count(*) as row_count from decided_365
        union all
        select 'gold_employee_map' as table_name, unnest([{'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)}, {'c': 'not_null', 'f': 'home_lat', 'n': count(*) - count(home_lat)}, {'c': 'not_null', 'f': 'home_lon', 'n': count(*) - count(home_lon)}, {'c': 'unique', 'f': 'employee_id', 'n': (select coalesce(sum(n), 0) from (select count(*) as n from sil_emp where employee_id is not null group by employee_id having count(*) > 1))}]) as r, count(*) as row_count from sil_emp
        union all
        select 'monitoring_runs' as table_name, unnest([{'c': 'not_null', 'f': 'dag_id', 'n': count(*) - count(dag_id)}, {'c': 'not_null', 'f': 'run_id', 'n': count(*) - count(run_id)}]) as r, count(*) as row_count from run_log
        union all
        select 'monitoring_activity_volumes_daily' as table_name, unnest([{'c': 'not_null', 'f': 'metric_date', 'n': count(*) - count(metric_date)}]) as r, count(*) as row_count from volumes
    """,
    "suite": """
        select 'sil_employees' as table_name, unnest([
                 {'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)},
                 {'c': 'unique', 'f': 'employee_id', 'n': (select count(*) from sil_emp x where (select count(*) from sil_emp y where y.employee_id = x.employee_id) > 1)},
                 {'c': 'between', 'f': 'gross_salary', 'n': count(case when gross_salary <= 0 then 1 end)},
                 {'c': 'between', 'f': 'distance_km_to_office', 'n': count(case when distance_km_to_office < 0 then 1 end)}
               ]) as r, count(*) as row_count from sil_emp
        union all
        select 'sil_sport_activities', unnest([
                 {'c': 'not_null', 'f': 'activity_id', 'n': count(*) - count(activity_id)},
                 {'c': 'unique', 'f': 'activity_id', 'n': (select count(*) from sil_acts x where (select count(*) from sil_acts y where y.activity_id = x.activity_id) > 1)},
                 {'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)},
                 {'c': 'not_null', 'f': 'activity_date', 'n': count(*) - count(activity_date)},
                 {'c': 'between', 'f': 'distance_km', 'n': count(case when distance_km < 0 then 1 end)}
               ]), count(*) from sil_acts
        union all
        select 'gold_kpi_employee_status', unnest([
                 {'c': 'not_null', 'f': 'employee_id', 'n': count(*) - count(employee_id)},
                 {'c': 'unique', 'f': 'employee_id', 'n': (select count(*) from status x where (select count(*) from status y where y.employee_id = x.employee_id) > 1)},
                 {'c': 'in_set', 'f': 'is_bonus_eligible', 'n': count(case when lower(is_bonus_eligible::varchar) not in ('true', 'false') then 1 end)},
                 {'c': 'in_set', 'f': 'is_wellbeing_eligible', 'n': count(case when lower(is_wellbeing_eligible::varchar) not in ('true', 'false') then 1 end)},
                 {'c': 'between', 'f': 'bonus_amount', 'n': count(case when bonus_amount < 0 then 1 end)},
                 {'c': 'between', 'f': 'wellbeing_days_awarded', 'n': count(case when wellbeing_days_awarded < 0 then 1 end)}
               ]), count(*) from status
    """,
}

_NEUTRAL = {
    "i": "cast({0} as bigint)",
    "n": "cast({0} as double)",
    "d": "strftime({0}, '%Y-%m-%d')",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
}


def columns(spec: str) -> str:
    """``name``, ``name:type`` or ``name:type=expression`` items, separated by ``;``, as a select list."""
    items = []
    for item in (part.strip() for part in spec.split(";") if part.strip()):
        head, _, expression = item.partition("=")
        name, _, kind = head.strip().partition(":")
        value = expression.strip() or name
        items.append(f"{_NEUTRAL.get(kind, '{0}').format(value)} as {name}")
    return ", ".join(items)


def build(spec: str, tail: str) -> str:
    """Select list plus the rest of the statement, with the fragments it needs as CTEs in order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in FRAGMENTS:
            if name not in needed and re.search(rf"\b{name}\b(?!\()", sql):
                visit(FRAGMENTS[name])
                if name not in needed:
                    needed.append(name)

    body = f"select {columns(spec)} {tail}"
    visit(tail)
    ctes = ", ".join(f"{n} as ({FRAGMENTS[n]})" for n in needed)
    return re.sub(r"\s*\n\s*", " ", f"with {ctes} {body}" if needed else body).strip()


EMP_BRONZE = "; ".join(f"{c}=trim({c})" for c in (
    "last_name", "first_name", "business_unit", "contract_type", "home_address", "declared_transport_mode"))
TIMELINE = """
    employee_id; full_name; business_unit; contract_type; snapshot_date:d; transport_mode; distance_km_to_office:n;
    activity_count_on_date; distance_km_on_date:n; duration_min_on_date:i; activity_count_12m; sport_days_count_12m;
    last_activity_date:d; last_process_date:d; is_bonus_eligible=coalesce(sportive and within_limit, false);
    potential_bonus_amount:n; bonus_amount:n=case when sportive and within_limit then potential_bonus_amount else 0 end;
    bonus_reason=case when not sportive then 'transport_non_sportif' when not within_limit then 'distance_hors_regle' else 'eligible' end;
    is_wellbeing_eligible=enough; wellbeing_days_awarded:i=if(enough, wellbeing_days, 0);
    wellbeing_reason=if(enough, 'eligible', 'insufficient_activities'); rule_version
"""
STATUS = """
    employee_id; full_name; business_unit; contract_type; is_bonus_eligible; bonus_amount:n; potential_bonus_amount:n;
    bonus_reason; is_wellbeing_eligible; wellbeing_days_awarded:i; wellbeing_reason; activity_count_12m:i;
    last_activity_date:d; last_process_date:d; transport_mode; distance_km_to_office:n
"""
WELL = """
    employee_id; reference_year:i=2024; full_name; business_unit; activity_count_12m:i; wellbeing_days_awarded:i;
    eligibility_status; eligibility_reason; rule_version
"""
DISTRIBUTION = """
    employees=count(*); eligible_bonus_employees=count(case when is_bonus_eligible then 1 end);
    eligible_wellbeing_employees=count(case when is_wellbeing_eligible then 1 end); total_bonus:n=sum(bonus_amount)
"""
MESSAGE = """
    message_id=sha256('notification-' || event_id); activity_id=event_id; employee_id; {extra}
    message_text=concat(':runner: Activite ', activity_type, ' enregistree pour le salarie ', employee_id, ' le ',
    activity_date, ' (', cast(distance_km as double), ' km, ', duration_min, ' min).'); status='generated'
"""
ID = "employee_id; ingestion_id; "
RULE_WIDE = """
    rule_version; effective_from:d; office_address; bonus_rate:n; wellbeing_days:i; min_activities_per_year:i;
    max_km_walk_run:n; max_km_cycle_scooter_other:n; sportive_transport_modes=modes_text; loaded_at:t
"""

ORACLE: dict[str, str] = {
    # sources, landing, sinks
    "land_table": build(f"""
        ingestion_id='run-1'; ingested_at:t=timestamp '2024-01-05 06:00:00'; process_date='2024-01-05';
        source_file='employees.csv'; employee_id=c_custkey::varchar; last_name=c_name; first_name=null::varchar;
        birth_date_raw=c_custkey::varchar; business_unit=c_mktsegment; hire_date_raw=null::varchar;
        gross_salary_raw=(c_custkey % 400 + 20000)::varchar; contract_type=null::varchar; cp_days_raw=null::varchar;
        home_address=null::varchar; declared_transport_mode=null::varchar;
        row_hash=sha256(concat_ws('|', c_custkey, c_name, '', c_custkey, c_mktsegment, '', c_custkey % 400 + 20000, '', '', '', ''))
        """, "from customer"),
    "clean_numeric_key": build(
        "o_orderkey; employee_id=if(o_orderkey % 2 = 0, o_orderkey::varchar, o_orderkey || '.05')", "from orders"),
    "row_hash": build(
        "c_custkey; row_hash=sha256(concat_ws('|', c_custkey, if(c_custkey % 5 = 0, '', c_name), c_mktsegment))", "from customer"),
    "tag_process_date": build("o_orderkey; o_orderstatus; process_date='2024-01-31'", "from orders"),
    "replace_batch": build("ingestion_id; process_date:d; source_file; employee_id; gross_salary_raw", """
        from (select ingestion_id, process_date, source_file, employee_id, gross_salary_raw from emp_raw where ingestion_id <> 'hr-2'
        union all select ingestion_id, process_date, source_file, employee_id, '31000.00' from emp_raw
        where ingestion_id = 'hr-2' and employee_id::bigint % 2 = 0)"""),
    "replace_batch_files": build(
        "source_file; process_date:d; ingestion_id; rows=count(*); salaries:n=sum(cast(nullif(pay, '') as decimal(12,2)))", """
        from (select *, if(ingestion_id = 'hr-2', '31000.00', gross_salary_raw) as pay from emp_raw
        where ingestion_id <> 'hr-2' or employee_id::bigint % 2 = 0)
        group by source_file, process_date, ingestion_id"""),
    "evolve_schema": build("key; name; segment", """
        from (select s_suppkey as key, s_name as name, null::varchar as segment from supplier
        union all select c_custkey, null, c_mktsegment from customer)"""),
    "upsert_by_key": build("""
        rule_version; effective_from:d; wellbeing_days:i=if(k % 2 = 0, wellbeing_days + 20, wellbeing_days);
        loaded_at:t=if(k % 2 = 0, loaded_at + interval 2 day, loaded_at)""", "from rules"),
    "upsert_stored": build("""
        rule_version; effective_from:d; wellbeing_days:i=if(k % 2 = 0, wellbeing_days + 20, wellbeing_days);
        loaded_at:t=if(k % 2 = 0, loaded_at + interval 2 day, loaded_at)""", "from rules"),
    "replace_stored": build("rule_version; rule_path; rule_value_json; value_type",
                            "from parameters where k % 5 <> 0 or rule_path <> 'limits.ratio'"),
    "insert_stored": build("event_id; offset_id; process_date:d",
                           "from act_raw where event_id::bigint % 2 = 1 and offset_id < 1000000000"),
    "evolve_stored": build("key; name; segment; ingestion_id", """
        from (select s_suppkey as key, s_name as name, null::varchar as segment, 'old' as ingestion_id from supplier
        union all select c_custkey, null, c_mktsegment, 'new' from customer)"""),
    "replace_by_key": build("rule_version; rule_path; rule_value_json; value_type",
                            "from parameters where k % 5 <> 0 or rule_path <> 'limits.ratio'"),
    "insert_if_absent": build("event_id; offset_id; process_date:d",
                              "from act_raw where event_id::bigint % 2 = 1 and offset_id < 1000000000"),
    "read_jsonl": build("""
        activity_id=event_id; employee_id; activity_type; activity_date:d; distance_km:n; duration_min:i;
        calories_burned:i; source_system='feed'; event_ts:t=date_trunc('millisecond', event_ts); process_date:d""", "from act_raw"),
    "write_jsonl": build("process_date:d; lines=count(*); known_employees=count(employee_id)", "from act_raw group by process_date"),
    "publish_rows": build("""
        key=o_custkey::varchar; value=concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey, ',"o_orderstatus":"',
        o_orderstatus, '","o_orderpriority":"', o_orderpriority, '"}')""", "from orders"),
    "backfill_dates": build("process_date:d=day; events=count(event_id)", """
        from (select unnest(generate_series(date '2024-01-03', date '2024-02-03', interval 1 day))::date as day)
        left join act_raw on process_date = day group by day"""),
    "materialize_layer": build("activity_type; is_valid_activity; activities=count(*); distance_km:n=sum(distance_km)",
                               "from sil_acts group by activity_type, is_valid_activity"),
    "assign_weighted_cohort": build("""
        c_custkey; cohort=case when marker <= 0.18 then 'dormant' when marker <= 0.5 then 'occasional'
        when marker <= 0.83 then 'regular' else 'intense' end""", """
        from (select c_custkey, (cast('0x' || substr(md5(c_custkey::varchar), 1, 8) as bigint) % 10000) / 10000.0 as marker from customer)"""),
    # enrichment
    "bronze_trim": build(ID + EMP_BRONZE, "from emp_raw"),
    "json_extract_typed": build(
        "activity_id=event_id; offset_id; activity_date:d; distance_km:n; duration_min:i; payload_process_date=process_date::varchar",
        "from act_raw"),
    "json_array_explode_in": build("employee_id; transport_mode; rule_count=coalesce(n, 0)", """
        from sil_emp left join (select m, count(*) as n from (select unnest(modes) as m from rules) group by m) on m = transport_mode"""),
    "json_array_contains": build("""
        rule_version; has_velo=list_contains(modes, 'velo'); has_accented=list_contains(modes, 'vélo');
        has_scooter=list_contains(modes, 'trottinette')""", "from rules"),
    "normalize_text_mode": build(f"{ID} transport_mode={mode_fold('declared_transport_mode')}", "from emp_raw"),
    "normalize_mode_lookup": build(f"""{ID} transport_mode=case coalesce(lower(trim(declared_transport_mode)), '')
        when '' then 'inconnu' when 'vélo' then 'velo' else lower(trim(declared_transport_mode)) end""", "from emp_raw"),
    "excel_serial_to_date": build(
        f"{ID} hire_date:d={serial_date('hire_date_raw')}; birth_date:d={serial_date('birth_date_raw')}", "from emp_raw"),
    "strict_cast_nullif": build(f"""{ID} gross_salary:n=cast(nullif(gross_salary_raw, '') as decimal(12,2));
        cp_days:i=nullif(cp_days_raw, ''); lenient_salary:i=if(gross_salary_raw = '0', 0, null)""", "from emp_raw"),
    "full_name": build(f"{ID} full_name=concat_ws(' ', first_name, trim(last_name))", "from emp_raw"),
    "nullif_trim": build(f"{ID} declared_sport=nullif(trim(declared_sport), '')", "from decl_raw"),
    "pseudo_geocode": build(
        f"{ID} home_lat:n={axis('home_address', 1, 434000, 1)}; home_lon:n={axis('home_address', 9, 37000, 10)}", "from emp_raw"),
    "pseudo_geocode_sha": build(f"""{ID} home_lat:n={sha_axis('home_address', 1, 434000, 1, '43.5652')};
        home_lon:n={sha_axis('home_address', 9, 37000, 10, '3.9029')}""", "from emp_raw"),
    "haversine_km": build(f"{ID} distance_km_to_office:n={great_circle('lat', 'lon')}", f"""
        from (select employee_id, ingestion_id, {axis('home_address', 1, 434000, 1)} as lat, {axis('home_address', 9, 37000, 10)} as lon from emp_raw)"""),
    "haversine_km_atan2": build(f"{ID} distance_km_to_office:n={great_circle('lat', 'lon')}", f"""
        from (select employee_id, ingestion_id, {axis('home_address', 1, 434000, 1)} as lat, {axis('home_address', 9, 37000, 10)} as lon from emp_raw)"""),
    "city_from_address": build(
        f"{ID} home_city=regexp_replace(trim(split_part(home_address, ',', 2)), '^[0-9]{{5}}\\s+', '')", "from emp_raw"),
    "render_message": build("""
        activity_id=event_id; offset_id; message_text=concat('activity ', lower(activity_type), ' of ', employee_id, ' on ',
        activity_date, ': ', distance_km, ' km')""", "from act_raw"),
    "anomaly_id": build(f"{ID} anomaly_id=md5(employee_id || '-distance')", "from emp_raw"),
    "duration_seconds": build("dag_id; run_id; duration_seconds:n", "from run_log"),
    "reference_year": build("reference_year:i=year(process_date); events=count(*)", "from act_raw group by year(process_date)"),
    "validity_flag": build("""
        activity_id=event_id; offset_id; is_valid_activity=employee_id is not null and activity_date is not null
        and distance_km >= 0 and duration_min > 0""", "from act_raw"),
    "office_coordinates": build(f"{ID} office_lat:n=43.5652; office_lon:n=3.9029", "from emp_raw"),
    # rules
    "flatten_rules": build("rule_version; rule_path; rule_value_json; value_type", "from parameters"),
    "flatten_event_props": build(
        "event_id; rule_path='k'; rule_value_json=json_extract_string(props, '$.k'); value_type='int'", "from events"),
    "normalize_rules_payload": build("rule_version; rules_payload", "from rules"),
    "require_rule_keys": build("rule_version; missing_keys='wellbeing_days'", "from rules where k % 7 = 3"),
    "rules_wide": build(RULE_WIDE + "; rules_payload", "from rules"),
    "rules_history": build(RULE_WIDE + """; is_latest=(effective_from, loaded_at, rule_version) =
        (select (effective_from, loaded_at, rule_version) from rules order by effective_from desc, loaded_at desc, rule_version desc limit 1)""",
                           "from rules"),
    "rules_validity": build(RULE_WIDE + "; valid_from_inclusive:d; effective_to_exclusive:d; is_current", "from windows"),
    "rules_current": build(RULE_WIDE + "; rules_payload", "from current_rule"),
    "rule_parameters_history": build("""
        rule_version; effective_from:d=w.effective_from; effective_to_exclusive:d=w.effective_to_exclusive; rule_path;
        rule_value_json; value_type; loaded_at:t=p.loaded_at; is_latest=w.is_current""",
                                     "from parameters p join windows w using (rule_version)"),
    "rule_parameters_current": build("""
        rule_version; effective_from:d=w.effective_from; effective_to_exclusive:d=w.effective_to_exclusive; rule_path;
        rule_value_json; value_type; loaded_at:t=p.loaded_at; is_latest=true""",
                                     "from parameters p join current_rule w using (rule_version)"),
    "rules_active_at": build("rule_version; effective_from:d; effective_to_exclusive:d", """
        from windows where date '2024-01-10' between effective_from and coalesce(effective_to_exclusive, date '9999-12-31') - 1"""),
    # joins
    "join_left_equi": build("employee_id; business_unit; declared_sport", "from sil_emp left join sil_decl using (employee_id)"),
    "join_left_status": build(STATUS, "from status"),
    "join_left_composite": build("dag_id; run_id; state; task_count", "from run_log"),
    "join_inner_equi": build("rule_version; effective_from:d; rule_path", "from parameters"),
    "join_asof_rule": build("activity_id; activity_date:d; rule_version; bonus_rate:n", """
        from sil_acts join windows on activity_date >= valid_from_inclusive
        and activity_date < coalesce(effective_to_exclusive, date '9999-12-31') where is_valid_activity"""),
    "join_interval_lookback": build(
        "employee_id; snapshot_date:d; activity_count_12m; sport_days_count_12m; last_activity_date:d; last_process_date:d",
        "from snap_7"),
    "join_cross_grid": build("employee_id; business_unit; snapshot_date:d=day",
                             "from sil_emp, (select distinct activity_date as day from sil_acts where is_valid_activity)"),
    "join_cross_rules": build("employee_id; rule_version; bonus_rate:n; min_activities_per_year:i", "from sil_emp, current_rule"),
    "join_cross_scalars": build("""
        eligible_bonus_employees=count(case when eligibility_status then 1 end);
        total_bonus_cost:n=coalesce(sum(bonus_amount) filter (where eligibility_status), 0);
        avg_bonus_amount:n=coalesce(round(cast(sum(bonus_amount) filter (where eligibility_status) as decimal(28,2)) / count(bonus_amount) filter (where eligibility_status), 2), 0);
        eligible_wellbeing_employees=(select count(*) from well_365 where eligibility_status);
        activity_count_total=(select count(*) from sil_acts where is_valid_activity)""", "from bonus /* well_365 sil_acts */"),
    "join_full_outer_chain": build("day:d; processed=count(*) filter (where s = 1); active=count(*) filter (where s = 2); born=count(*) filter (where s = 3)", """
        from (select process_date as day, 1 as s from act_raw union all select activity_date, 2 from sil_acts where is_valid_activity
        union all select birth_date, 3 from sil_emp where birth_date is not null) group by day"""),
    "in_subquery_flag": build("employee_id; transport_mode; is_sportive=is_transport_mode_sportive", "from sil_emp"),
    "scalar_subquery": build("activity_id; process_date:d",
                             "from sil_acts where process_date = (select max(process_date) from sil_acts)"),
    "anti_join_orphans": build("activity_id; employee_id", """
        from sil_acts where employee_id is not null and employee_id not in (select employee_id from sil_emp)"""),
    "orphan_keys": build("key=employee_id; row_count=count(*)", """
        from sil_acts where employee_id is not null and employee_id not in (select employee_id from sil_emp) group by employee_id"""),
    # aggregations
    "agg_yearly_activity": build(
        "employee_id; activity_year:i=2024; activity_count_12m; sport_days_count; last_activity_date:d; last_process_date:d", "from year_7"),
    "agg_filtered_global": build("""
        eligible_bonus_employees=count(case when eligibility_status then 1 end);
        total_bonus_cost:n=coalesce(sum(bonus_amount) filter (where eligibility_status), 0);
        avg_bonus_amount:n=coalesce(round(cast(sum(bonus_amount) filter (where eligibility_status) as decimal(28,2)) / count(bonus_amount) filter (where eligibility_status), 2), 0)
        """, "from bonus"),
    "agg_timeline_group": build("""
        employee_id; activity_date:d; activity_count=count(*); distance_km:n=sum(distance_km); duration_min:i=sum(duration_min);
        process_date:d=max(process_date)""", "from sil_acts where is_valid_activity group by employee_id, activity_date"),
    "agg_daily_counts": build("""
        process_date:d; silver_activity_count; valid_activity_count; invalid_activity_count; active_employee_count""", "from vol_silver"),
    "agg_timeline_daily": build("""
        snapshot_date:d; employee_snapshots_with_activity; total_activities_on_date:i; wellbeing_eligible_employee_count""", "from vol_gold"),
    "agg_timeline_daily_long": build("""
        snapshot_date:d; employee_snapshots_with_activity; total_activities_on_date:i; wellbeing_eligible_employee_count""", "from vol_gold_long"),
    "agg_timeline_daily_7d": build("""
        snapshot_date:d; employee_snapshots_with_activity; total_activities_on_date:i; wellbeing_eligible_employee_count""", "from vol_gold_7"),
    "agg_state_pivot": build("""
        dag_id; run_id; task_count; task_success_count:i; task_failed_count:i; task_running_count:i; task_queued_count:i""", "from task_counts"),
    "distinct_values": build("snapshot_date:d=activity_date", "from sil_acts where is_valid_activity group by activity_date"),
    "distinct_employee_ids": build("employee_id", "from emp_raw where employee_id is not null group by employee_id"),
    "row_counts": " union all ".join(
        f"select 'source' as layer_name, '{t}' as table_name, count(*) as row_count from {t}"
        for t in ("customer", "orders", "lineitem", "events", "supplier", "documents", "pages", "conversations")),
    # windows and dedup
    "dedup_latest_employee": build("employee_id; ingested_at:t; gross_salary_raw; row_hash", "from emp_latest"),
    "dedup_latest_declaration": build("employee_id; ingested_at:t; declared_sport=trim(declared_sport); row_hash", "from decl_latest"),
    "dedup_latest_activity": build("activity_id=event_id; event_ts:t; offset_id; distance_km:n", "from act_latest"),
    "rank_recency": build(
        "rule_version; recency_rank=row_number() over (order by effective_from desc, loaded_at desc, rule_version desc)", "from rules"),
    "rank_chronology": build("rule_version; chronology_rank=pos", "from windows"),
    "lead_next": build("rule_version; effective_from:d; next_effective_from:d=effective_to_exclusive", "from windows"),
    "rank_runs_by_time": build(
        "run_id; execution_date:t; position=row_number() over (order by execution_date, run_id::bigint)", "from runs"),
    # set operations, sort, limit
    "union_all_anomalies": build("table_name; anomaly_type; anomaly_detail; anomalies=count(*)",
                                 "from anomalies group by table_name, anomaly_type, anomaly_detail"),
    "union_all_counts": build("layer_name; table_name; row_count", "from counts"),
    "topk_recent": build("dag_id; run_id; state", """
        from runs order by coalesce(start_date, execution_date) desc nulls first, dag_id, run_id limit 20"""),
    "sort_series": build("process_date:d; raw_event_count=count(*)", "from act_raw group by process_date order by process_date"),
    # models
    "brz_rh_employees": build(f"""ingestion_id; ingested_at:t; process_date:d; source_file; employee_id; birth_date_raw;
        hire_date_raw; gross_salary_raw; cp_days_raw; row_hash; {EMP_BRONZE}""", "from emp_raw"),
    "brz_sport_declarations": build(
        "ingestion_id; ingested_at:t; process_date:d; source_file; employee_id; declared_sport=trim(declared_sport); row_hash",
        "from decl_raw"),
    "brz_sport_activities": build("""
        activity_id=event_id; process_date:d; topic; partition_id:i; offset_id; event_ts:t; consumed_at:t; payload_json;
        employee_id; activity_type; activity_date:d; distance_km:n; duration_min:i; calories_burned:i; source_system='feed';
        payload_process_date=process_date::varchar""", "from act_raw"),
    "brz_slack_messages": build(MESSAGE.format(extra="process_date:d; generated_at:t=consumed_at; channel_name='#sport-avantages';"),
                                "from (select distinct on (event_id) * from act_raw where offset_id % 100 <> 57 order by event_id, offset_id)"),
    "gold_slack_messages": build(MESSAGE.format(extra="generated_at:t=consumed_at; channel_name='#sport-avantages';"),
                                 "from (select distinct on (event_id) * from act_raw where offset_id % 100 <> 57 order by event_id, offset_id)"),
    "sil_employees": build("""
        employee_id; last_name; first_name; full_name; birth_date:d; hire_date:d; business_unit; gross_salary:n; contract_type;
        cp_days; home_address; transport_mode; home_lat:n; home_lon:n; office_lat:n; office_lon:n; distance_km_to_office:n;
        is_transport_mode_sportive; is_distance_rule_valid""", "from sil_emp"),
    "sil_sport_declarations": build("employee_id; declared_sport", "from sil_decl"),
    "sil_sport_activities": build("""
        activity_id; employee_id; activity_type; process_date:d; activity_date:d; distance_km:n; duration_min:i;
        calories_burned:i; source_system; event_ts:t; is_valid_activity; slack_message_text""", "from sil_acts"),
    "sil_employee_activity_yearly": build(
        "employee_id; activity_year:i=2024; activity_count_12m; sport_days_count; last_activity_date:d; last_process_date:d", "from year_365"),
    "sil_employee_activity_joined": build("""
        employee_id; full_name; business_unit; contract_type; gross_salary:n; transport_mode; distance_km_to_office:n;
        is_transport_mode_sportive; is_distance_rule_valid; declared_sport; activity_count_12m; sport_days_count;
        last_activity_date:d; last_process_date:d""", "from joined_365"),
    "gold_eligible_sport_bonus": build("""
        employee_id; reference_year:i=2024; full_name; business_unit; gross_salary:n; bonus_rate:n; potential_bonus_amount:n;
        transport_mode; distance_km_to_office:n; eligibility_status; bonus_amount:n; eligibility_reason; rule_version""", "from bonus"),
    "gold_eligible_wellbeing_days": build(WELL, "from well_365"),
    "gold_eligible_wellbeing_days_7d": build(WELL, "from well_7"),
    "gold_kpi_employee_status": build(STATUS, "from status"),
    "gold_employee_map": build("""
        employee_id; full_name=e.full_name; business_unit=e.business_unit; contract_type=e.contract_type;
        home_city=regexp_replace(trim(split_part(e.home_address, ',', 2)), '^[0-9]{5}\\s+', ''); home_lat:n=e.home_lat;
        home_lon:n=e.home_lon; distance_km_to_office:n=e.distance_km_to_office; is_bonus_eligible=s.is_bonus_eligible;
        is_wellbeing_eligible=s.is_wellbeing_eligible""", "from sil_emp e left join status s using (employee_id)"),
    "gold_kpi_finance": build("""
        reference_year:i=2024; eligible_bonus_employees=count(case when eligibility_status then 1 end);
        eligible_wellbeing_employees=(select count(*) from well_365 where eligibility_status);
        total_bonus_cost:n=coalesce(sum(bonus_amount) filter (where eligibility_status), 0);
        avg_bonus_amount:n=coalesce(round(cast(sum(bonus_amount) filter (where eligibility_status) as decimal(28,2)) / count(bonus_amount) filter (where eligibility_status), 2), 0);
        activity_count_total=(select count(*) from sil_acts where is_valid_activity)""", "from bonus /* well_365 sil_acts */"),
    "gold_employee_benefit_timeline": build(TIMELINE, "from decided_365"),
    "gold_employee_benefit_timeline_7d": build(TIMELINE, "from decided_7"),
    "timeline_refreshed": build(TIMELINE, "from decided_365"),
    "timeline_refreshed_7d": build(TIMELINE, "from decided_7"),
    "timeline_known_at": build(TIMELINE, "from decided_known"),
    "timeline_long_history": build("""
        snapshot_date:d; employees=count(*); on_date:i=sum(activity_count_on_date); distance_km:n=sum(distance_km_on_date);
        trailing:i=sum(activity_count_12m); trailing_days:i=sum(sport_days_count_12m); last_activity_date:d=max(last_activity_date);
        days_since_activity:i=sum(snapshot_date - last_activity_date); process_lag:i=sum(last_process_date - last_activity_date);
        wellbeing_eligible=count(case when enough then 1 end);
        bonus_amount:n=sum(case when sportive and within_limit then potential_bonus_amount else 0 end)""",
                                   "from decided_long group by snapshot_date"),
    "gold_quality_anomalies": build(
        "anomaly_id; detected_at='2024-01-31 12:00:00.000000'; table_name; record_id; anomaly_type; anomaly_detail", "from anomalies"),
    "monitoring_activity_volumes_daily": build("""
        metric_date:d; raw_event_count; silver_activity_count; valid_activity_count; invalid_activity_count; active_employee_count;
        employee_snapshots_with_activity; total_activities_on_date:i; wellbeing_eligible_employee_count""", "from volumes"),
    "monitoring_activity_volumes_daily_7d": build("""
        metric_date:d; raw_event_count; silver_activity_count; valid_activity_count; invalid_activity_count; active_employee_count;
        employee_snapshots_with_activity; total_activities_on_date:i; wellbeing_eligible_employee_count""", "from volumes_7"),
    "monitoring_runs": build("""
        dag_id; run_id; run_type; dag_state; external_trigger; execution_date:t; data_interval_start:t; data_interval_end:t;
        queued_at:t; start_date:t; end_date:t; duration_seconds:n; task_count; task_success_count:i; task_failed_count:i;
        task_running_count:i; task_queued_count:i""", "from run_log"),
    "monitoring_table_row_counts": build("layer_name; table_name; row_count", "from counts"),
    # dashboards and BI
    "dash_failed_runs_7d": build("failed_runs_last_7d=count(*)", f"""
        from runs where state = 'failed' and coalesce(start_date, execution_date) >= {RUNS_AS_OF} - interval 7 day"""),
    "dash_latest_day_volume": build("""
        raw_events_last_day:i=coalesce(sum(raw_event_count), 0); valid_activities_last_day:i=coalesce(sum(valid_activity_count), 0);
        invalid_activities_last_day:i=coalesce(sum(invalid_activity_count), 0)""",
                                    "from volumes where metric_date = (select max(metric_date) from volumes)"),
    "dash_flow_series": build("time:d=metric_date; value; metric", """
        from (select metric_date, raw_event_count as value, 'raw_events' as metric from volumes
        union all select metric_date, valid_activity_count, 'valid_activities' from volumes) order by metric_date, metric"""),
    "dash_active_series": build("time:d=metric_date; value; metric", """
        from (select metric_date, active_employee_count as value, 'active_employees' as metric from volumes
        union all select metric_date, wellbeing_eligible_employee_count, 'wellbeing_eligible' from volumes) order by metric_date, metric"""),
    "dash_active_series_7d": build("time:d=metric_date; value; metric", """
        from (select metric_date, active_employee_count as value, 'active_employees' as metric from volumes_7
        union all select metric_date, wellbeing_eligible_employee_count, 'wellbeing_eligible' from volumes_7) order by metric_date, metric"""),
    "dash_recent_runs": build("""
        dag_id; run_id; dag_state; start_date:t; end_date:t; duration_seconds:n=round(coalesce(duration_seconds, 0)); task_count;
        task_failed_count:i""", """
        from run_log order by coalesce(run_log.start_date, execution_date) desc nulls first, dag_id, run_id limit 20"""),
    "dash_row_counts": build("layer_name; table_name; row_count", "from counts order by layer_name, table_name"),
    "bi_program_kpis": build("""
        eligible_bonus_employees=count(case when is_bonus_eligible then 1 end);
        eligible_wellbeing_employees=count(case when is_wellbeing_eligible then 1 end); total_bonus_cost:n=sum(bonus_amount);
        total_wellbeing_days:i=sum(wellbeing_days_awarded)""", "from status"),
    "bi_distribution": build("contract_type; " + DISTRIBUTION, "from status group by contract_type"),
    "bi_distribution_by_mode": build("transport_mode; " + DISTRIBUTION, "from status group by transport_mode"),
    "bi_eligibility_trend": build("""
        snapshot_date:d; bonus_eligible_employees=count(distinct case when sportive and within_limit then employee_id end);
        wellbeing_eligible_employees=count(distinct case when enough then employee_id end)""", "from decided_365 group by snapshot_date"),
    "bi_eligibility_trend_7d": build("""
        snapshot_date:d; bonus_eligible_employees=count(distinct case when sportive and within_limit then employee_id end);
        wellbeing_eligible_employees=count(distinct case when enough then employee_id end)""", "from decided_7 group by snapshot_date"),
    "bi_activity_trend": build("snapshot_date:d; contract_type; activity_count:i=sum(activity_count_on_date)",
                               "from decided_365 group by snapshot_date, contract_type"),
    "bi_activity_trend_filtered": build("snapshot_date:d; business_unit; activity_count:i=sum(activity_count_on_date)", """
        from decided_365 where contract_type in ('CDI', 'CDD') and transport_mode in ('velo', 'marche/running')
        and snapshot_date between date '2024-01-08' and date '2024-01-21' group by snapshot_date, business_unit"""),
    # data quality
    "check_not_null": build("activity_id", "from sil_acts where employee_id is null"),
    "check_unique": build("activity_id=event_id; n_records=count(*)", "from act_raw group by event_id having count(*) > 1"),
    "check_accepted_values": build("employee_id; contract_type", """
        from sil_emp where contract_type not in ('CDI', 'CDD', 'Stage', 'Alternance', 'Freelance')"""),
    "check_relationships": build("activity_id; employee_id", """
        from sil_acts a where employee_id is not null and not exists (select 1 from sil_emp e where e.employee_id = a.employee_id)"""),
    "check_non_negative": build("activity_id; distance_km:n", "from sil_acts where sil_acts.distance_km < 0"),
    "check_positive_value": build("employee_id; gross_salary:n", "from sil_emp where sil_emp.gross_salary <= 0"),
    "check_between": build("employee_id; distance_km_to_office:n",
                           "from sil_emp where sil_emp.distance_km_to_office <= 2 or sil_emp.distance_km_to_office > 25"),
    "check_in_set": build("employee_id; is_bonus_eligible", "from status where is_bonus_eligible"),
    "validation_suite": build("table_name; check_name=r.c; column_name=r.f; row_count; failing_rows:i=r.n; success=r.n = 0", "from suite"),
    "validation_report": build("""
        table_name; row_count=max(row_count); success=bool_and(r.n = 0); evaluated_checks=count(*);
        successful_checks=count(case when r.n = 0 then 1 end); unsuccessful_checks=count(case when r.n <> 0 then 1 end);
        success_percent:n=round(100.0 * count(case when r.n = 0 then 1 end) / count(*), 2);
        generated_at='2024-01-31 12:00:00.000000'; report_success=(select bool_and(r.n = 0) from suite);
        details=string_agg(r.c || ':' || r.f || ':' || r.n || ':' || (r.n = 0)::varchar, ',' order by r.c, r.f)""",
                               "from suite group by table_name /* suite */"),
    "validation_suite_faults": build("table_name; check_name=r.c; column_name=r.f; row_count; failing_rows:i=r.n; success=r.n = 0", "from faults"),
    "model_tests": build("table_name; check_name=r.c; column_name=r.f; row_count; failing_rows:i=r.n; success=r.n = 0", "from model_checks"),
    "lenient_cast_rejects": """
        select c_custkey::varchar as employee_id, 'gross_salary_raw' as column_name, 'x' || c_custkey as raw_value,
               'not a decimal(12,2)' as reason from customer where c_custkey % 9 = 0
        union all select c_custkey::varchar, 'cp_days_raw', 'soon', 'not a int' from customer where c_custkey % 7 = 0
        union all select c_custkey::varchar, 'hire_date_raw', '2020-02-31', 'not a date' from customer where c_custkey % 11 = 0
    """,
    # streaming: replays and repeated deliveries change nothing
    "stream_source": build("topic; partition:i=partition_id; messages=count(*); last_offset=max(offset_id)",
                           "from act_raw group by topic, partition_id"),
    "stream_parse_event": build("""
        event_id=if(offset_id % 100 = 57, null, event_id); process_date:d=if(offset_id % 100 = 57, null, process_date); topic;
        partition_id; offset_id; event_ts:t=if(offset_id % 100 = 57, null, date_trunc('second', ts)); is_readable=offset_id % 100 <> 57""",
                                "from (select *, cast(substr(payload_json, strpos(payload_json, '\"event_ts\":\"') + 12, 19) as timestamp) as ts from act_raw)"),
    "stream_skip_errors": build("partition_id; offset_id; payload_json='{bad ' || event_id", "from act_raw where offset_id % 100 = 57"),
    "stream_dedup_first": build("event_id; process_date:d; partition_id; offset_id; payload_json", "from landed"),
    "stream_drain": build("event_id; process_date:d; partition_id; offset_id", "from landed"),
    "stream_compaction": build("event_id; process_date:d; partition_id; offset_id", "from landed"),
    "stream_notify_once": build(MESSAGE.format(extra="process_date:d;"), "from landed"),
    "stream_max_messages": build("event_id; partition_id; offset_id; run:i=if(place <= total // 3, 1, 2)", """
        from (select *, offset_id % 100 <> 57 as ok, count(*) over () as total, row_number() over (order by partition_id, offset_id) as place,
                     row_number() over (partition by event_id, offset_id % 100 <> 57 order by partition_id, offset_id) as copy from act_raw)
        where ok and copy = 1 and place <= total // 3 + total // 4"""),
    "stream_progress_metrics": build("""
        consumed=2 * count(*); accepted=count(distinct case when ok then event_id end);
        duplicates=2 * count(case when ok then 1 end) - count(distinct case when ok then event_id end);
        unreadable=2 * count(case when not ok then 1 end);
        other_process_date=2 * count(case when ok and process_date <> date '2024-01-20' then 1 end)""", "from (select *, offset_id % 100 <> 57 as ok from act_raw)"),
}

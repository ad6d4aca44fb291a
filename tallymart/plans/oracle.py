"""The registered queries in SQL, for checking their results on the same tables.

Written independently of the DataFrame code: inner joins and correlated conditions where that uses
hints, windows where that aggregates and joins, and the other way round.
"""

from __future__ import annotations

VIEWS = """
reports as (
  select p.p_brand as "dataElement", strftime(l.l_shipdate, '%Y%m') as period,
         'S' || l.l_suppkey as "orgUnit",
         l.l_returnflag || l.l_linestatus as "categoryOptionCombo",
         'default' as "attributeOptionCombo",
         case when l.l_linenumber = 7 then null
              when l.l_discount < 0.005 then '0'
              when p.p_size % 10 = 9 then cast(cast(l.l_quantity as int) as varchar) || '.5'
              else cast(cast(l.l_quantity as int) as varchar) end as value,
         'clerk' || (l.l_orderkey % 11) as "storedBy",
         strftime(cast(l.l_shipdate as date), '%Y-%m-%dT00:00:00.000') as created,
         strftime(cast(l.l_shipdate as date) + cast(l.l_orderkey % 120 as int),
                  '%Y-%m-%dT00:00:00.000') as "lastUpdated",
         'false' as followup,
         l.l_orderkey as ok, l.l_linenumber as ln, l.l_extendedprice as px
  from lineitem l join part p on p.p_partkey = l.l_partkey),
brands as (
  select brand, n, chr(65 + n % 5) as area
  from (select distinct p_brand as brand,
               cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int) as n from part)),
elements as (
  select brand as id, 'Indicator ' || brand as name, area, n,
         case n % 4 when 0 then 'INTEGER' when 1 then 'NUMBER' when 2 then 'PERCENTAGE'
                    else 'INTEGER_POSITIVE' end as value_type,
         'CC' || (n % 3) as combo_id, 'Combo ' || (n % 3) as combo_name, n % 2 = 0 as zero_counts
  from brands where brand <> 'Brand#25'),
combos as (
  select distinct l_returnflag || l_linestatus as id from lineitem
  where l_returnflag || l_linestatus <> 'RO'),
facilities as (
  select 'S' || s.s_suppkey as facility_uid, s.s_name as facility_name, 4 as facility_level,
         '/R' || r.r_regionkey || '/R' || r.r_regionkey || 'G' || (n.n_nationkey % 2)
           || '/N' || n.n_nationkey || '/S' || s.s_suppkey as path,
         case when s.s_suppkey % 5 <> 0 then 'Type ' || (s.s_suppkey % 3) end as facility_type,
         'R' || r.r_regionkey as country_uid, r.r_name as country_name,
         'R' || r.r_regionkey || 'G' || (n.n_nationkey % 2) as region_uid,
         r.r_name || ' half ' || (n.n_nationkey % 2) as region_name,
         'N' || n.n_nationkey as district_uid, n.n_name as district_name
  from supplier s join nation n on n.n_nationkey = s.s_nationkey
       join region r on r.r_regionkey = n.n_regionkey
  where s.s_suppkey % 25 <> 7),
unit_ids as (
  select facility_uid as id from facilities
  union select 'N' || n_nationkey from nation
  union select 'R' || n_regionkey || 'G' || (n_nationkey % 2) from nation
  union select 'R' || r_regionkey from region),
programs as (
  select 'R' || r.r_regionkey || a.area as id, a.area, r.r_name as country
  from region r, (values ('A'), ('B'), ('C'), ('D'), ('E')) a(area)
  where (ascii(substr('R' || r.r_regionkey, 2, 1)) + ascii(a.area)) % 3 <> 0),
program_items as (
  select p.id, p.area, p.country, b.brand from programs p join brands b on b.area = p.area),
resolved as (
  select r.*, e.name as de_name, e.value_type, e.area as health_area, e.combo_id,
         case when c.id is not null then 'combo ' || c.id end as coc_name,
         c.id is null as is_orphaned_coc
  from reports r join elements e on e.id = r."dataElement"
       left join combos c on c.id = r."categoryOptionCombo"
  where r."orgUnit" in (select id from unit_ids)),
latest as (
  select * from resolved
  qualify row_number() over (
    partition by "dataElement", period, "orgUnit", "categoryOptionCombo"
    order by "lastUpdated" desc, ok desc, ln desc, px desc) = 1),
flagged as (
  select l.*, f.* exclude (facility_uid), f.facility_uid is null as is_non_leaf,
         case when l.value_type in ('INTEGER', 'INTEGER_POSITIVE')
                then trunc(try_cast(l.value as double))
              else try_cast(l.value as double) end as numeric_value,
         date_diff('day', cast(last_day(strptime(l.period, '%Y%m')) as date),
                   cast(substr(l."lastUpdated", 1, 10) as date)) > 60 as is_late_reported,
         coalesce(l.value = '0', false) as is_explicit_zero,
         l.value is null as is_missing_value,
         cast(substr(l.period, 1, 4) as int) as year,
         cast(substr(l.period, 5, 2) as int) as month,
         l.period as year_month,
         substr(l.period, 1, 4) || 'Q' ||
           cast((cast(substr(l.period, 5, 2) as int) + 2) // 3 as varchar) as quarter,
         cast(last_day(strptime(l.period, '%Y%m')) as date) as period_end_date
  from latest l left join facilities f on f.facility_uid = l."orgUnit"),
expected as (
  select country, count(distinct brand) as expected_count from program_items group by country),
scores as (
  select f."orgUnit", f.period,
         case when any_value(x.expected_count) > 0 then
           least(cast(count(distinct f."dataElement") as double)
                 / cast(any_value(x.expected_count) as double), 1.0) end as completeness_score
  from flagged f left join expected x on x.country = f.country_name
  where f.value is not null group by f."orgUnit", f.period),
fact as (
  select f."dataElement" as de_uid, f."orgUnit" as ou_uid, f.period,
         (select min(p.id) from program_items p
          where p.brand = f."dataElement" and p.country = f.country_name) as program_id,
         f."categoryOptionCombo" as coc_uid, coalesce(f.coc_name, 'unknown') as coc_name,
         f.de_name, f.value as raw_value, f.numeric_value, f.is_late_reported,
         f.is_explicit_zero, f.is_missing_value, f.is_orphaned_coc, s.completeness_score,
         f."storedBy" as stored_by, f."lastUpdated" as last_updated, f.health_area,
         f.year_month, f.year, f.month, f.quarter, f.country_name, f.region_name,
         f.district_name, f.facility_name
  from flagged f
       left join scores s on s."orgUnit" = f."orgUnit" and s.period = f.period),
keyless as (
  select * replace (case when year % 3 <> 0 then ou_uid end as ou_uid,
                    case when month % 4 <> 0 then de_uid end as de_uid) from fact),
flagged_of_nulls as (
  select * replace (null::varchar as period, null::boolean as is_late_reported, null::int as year,
                    null::int as month, null::varchar as year_month, null::varchar as quarter)
  from (select * from (
          select f.*, row_number() over (partition by "dataElement", "orgUnit", "categoryOptionCombo"
                   order by "lastUpdated" desc, ok desc, ln desc, px desc) as latest_of_null
          from (select r.*, h.* exclude (facility_uid), h.facility_uid is null as is_non_leaf,
                       case when r.value_type in ('INTEGER', 'INTEGER_POSITIVE')
                         then trunc(try_cast(r.value as double)) else try_cast(r.value as double) end as numeric_value,
                       null::boolean as is_late_reported, coalesce(r.value = '0', false) as is_explicit_zero,
                       r.value is null as is_missing_value, null::int as year, null::int as month,
                       null::varchar as year_month, null::varchar as quarter
                from resolved r left join facilities h on h.facility_uid = r."orgUnit"
                where substr(r.period, 5, 2) = '02') f)
        where latest_of_null = 1)),
scores_of_nulls as (
  select f."orgUnit", case when any_value(x.expected_count) > 0 then
           least(cast(count(distinct f."dataElement") as double)
                 / cast(any_value(x.expected_count) as double), 1.0) end as completeness_score
  from flagged_of_nulls f left join expected x on x.country = f.country_name
  where f.value is not null group by f."orgUnit"),
fact_of_nulls as (
  select f."dataElement" as de_uid, f."orgUnit" as ou_uid, f.period,
         (select min(p.id) from program_items p
          where p.brand = f."dataElement" and p.country = f.country_name) as program_id,
         f."categoryOptionCombo" as coc_uid, coalesce(f.coc_name, 'unknown') as coc_name,
         f.de_name, f.value as raw_value, f.numeric_value, f.is_late_reported,
         f.is_explicit_zero, f.is_missing_value, f.is_orphaned_coc, s.completeness_score,
         f."storedBy" as stored_by, f."lastUpdated" as last_updated, f.health_area,
         f.year_month, f.year, f.month, f.quarter, f.country_name, f.region_name,
         f.district_name, f.facility_name
  from flagged_of_nulls f left join scores_of_nulls s on s."orgUnit" = f."orgUnit"
  union all by name
  select * from fact where month <> 2)
"""


#: First month that the first of two loads does not have; inside the tables' span.
CUTOFF = "199807"


def rounded(expression: str, places: int) -> str:
    """Half up on the shortest decimal form of a double."""
    return (
        f"cast(round(cast(cast({expression} as varchar) as decimal(38,17)), {places}) as double)"
    )


def mean_score(score: str) -> str:
    return (
        f"cast(sum(cast({score} as decimal(18,12))) as double)"
        f" / nullif(count({score}), 0)"
    )


def _index(period: str = "period") -> str:
    return f"(cast(substr({period},1,4) as int) * 12 + cast(substr({period},5,2) as int) - 1)"


VALUE_COLUMNS = (
    '"dataElement", period, "orgUnit", "categoryOptionCombo", "attributeOptionCombo", value, '
    '"storedBy", created, "lastUpdated", followup'
)
REJECT_COLUMNS = (
    '"dataElement", period, "orgUnit", "categoryOptionCombo", value, "storedBy", "lastUpdated"'
)
FACT_COLUMNS = (
    "de_uid, ou_uid, period, program_id, coc_uid, coc_name, de_name, raw_value, numeric_value, "
    "is_late_reported, is_explicit_zero, is_missing_value, is_orphaned_coc, completeness_score, "
    "stored_by, last_updated, health_area, year_month, year, month, quarter, country_name, "
    "region_name, district_name, facility_name"
)

_CALENDAR = """
  cast(substr(p, 1, 4) as int) as year, cast(substr(p, 5, 2) as int) as month,
  strftime(strptime(p, '%Y%m'), '%B') as month_name,
  substr(p, 1, 4) || 'Q' || cast((cast(substr(p, 5, 2) as int) + 2) // 3 as varchar) as quarter,
  cast(strptime(p, '%Y%m') as date) as period_start_date,
  cast(last_day(strptime(p, '%Y%m')) as date) as period_end_date
"""

_MONTH_SPAN = """
  select strftime(m, '%Y%m') as period from (
    select unnest(generate_series(
      (select min(strptime(period, '%Y%m')) from fact),
      (select max(strptime(period, '%Y%m')) from fact), interval 1 month)) as m)
"""


_STRAYED = """
  (select * replace (case period when '199503' then '999912' when '199504' then '198001'
                     else period end as period) from flagged)
"""


def _spans(table: str) -> str:
    """Facilities and months (``i`` the index) of the spans of a table, as ``grid``."""
    return f"""
      strayed as (select * from {table}),
      stretches as (
        select min(i) as f, max(i) as l from (
          select *, sum(case when i - before <= 25 then 0 else 1 end) over (order by i) as g from (
            select i, lag(i) over (order by i) as before from (
              select distinct {_index()} as i from strayed where period between '190001' and '210012')))
        group by g),
      grid as (
        select *, lpad(cast(i // 12 as varchar), 4, '0') || lpad(cast(i % 12 + 1 as varchar), 2, '0') as period
        from (select facility_uid, country_name, unnest(range(f, l + 1)) as i from facilities, stretches))
    """


def _silent_runs(table: str) -> str:
    return f"""
      select facility_uid, min(period) as first_period, max(period) as last_period,
             cast(count(*) as int) as months
      from (with {_spans(table)}
            select *, i - row_number() over (partition by facility_uid order by i) as island
            from grid g where not exists (
              select 1 from strayed s where s."orgUnit" = g.facility_uid and s.period = g.period
                and s.value is not null))
      group by facility_uid, island
    """


def _mom(gap_aware: bool) -> str:
    lag = "lag(total_value) over w"
    if gap_aware:
        lag = f"case when {_index()} - lag({_index()}) over w = 1 then {lag} end"
    change = "(total_value - prev_total) / prev_total * 100"
    return f"""
      select *, case when prev_total <> 0 then {rounded(change, 2)} end as mom_pct_change from (
        select *, {lag} as prev_total from (
          select de_uid, health_area, district_name, region_name, country_name, period, year_month,
                 sum(numeric_value) as total_value, min(de_name) as de_name
          from fact where numeric_value is not null
          group by de_uid, health_area, district_name, region_name, country_name, period, year_month)
        window w as (partition by de_uid, country_name, region_name, district_name order by period))
    """


def _rolling(months: int, by_calendar: bool = False, table: str = "fact") -> str:
    if by_calendar:
        frame = f"order by {_index()} range between {months - 1} preceding and current row"
    else:
        frame = f"order by period, coc_uid rows between {months - 1} preceding and current row"
    mean = f"avg(numeric_value) over (partition by ou_uid, de_uid {frame})"
    return f"""
      select de_uid, ou_uid, period, health_area, country_name, district_name, facility_name,
             numeric_value, {rounded("m", 4)} as rolling_avg_{months}m
      from (select *, {mean} as m from {table})
    """


def _rate(densify: bool) -> str:
    rate = "cast(coalesce(a.n, 0) as double) / cast(x.expected_facilities as double) * 100"
    months = (
        _MONTH_SPAN
        if densify
        else "select distinct period from fact"
    )
    return f"""
      select x.country_name, m.period, m.period as year_month,
             substr(m.period, 1, 4) || 'Q' ||
               cast((cast(substr(m.period, 5, 2) as int) + 2) // 3 as varchar) as quarter,
             cast(substr(m.period, 1, 4) as int) as year,
             cast(substr(m.period, 5, 2) as int) as month,
             coalesce(a.n, 0) as actual_facilities, x.expected_facilities,
             {rounded(rate, 2)} as reporting_rate_pct
      from (select country_name, count(distinct facility_uid) as expected_facilities
            from facilities group by country_name) x
      join ({months}) m on true
      left join (select country_name, period, count(distinct ou_uid) as n from fact
                 where numeric_value is not null or is_explicit_zero
                 group by country_name, period) a
        on a.country_name = x.country_name and a.period = m.period
      where {"true" if densify else "a.n is not null"}
    """


def _monthly(weight: str) -> str:
    if weight == "row":
        return "fact"
    return """(select country_name, period, quarter, year, month, year_month, ou_uid,
                      max(completeness_score) as completeness_score
               from fact group by all)"""


def _comparison(weight: str) -> str:
    return f"""
      select *, {rounded("avg_completeness * 100", 2)} as avg_completeness_pct from (
        select country_name, period, quarter, year, year_month,
               {mean_score("completeness_score")} as avg_completeness,
               min(completeness_score) as min_completeness,
               max(completeness_score) as max_completeness,
               count(distinct ou_uid) as reporting_facilities
        from {_monthly(weight)} group by country_name, period, quarter, year, year_month)
    """


def _runs(threshold: float, gap_aware: bool = False, weight: str = "row") -> str:
    if gap_aware:
        island = f"""(select count(*) from marked b where b.country_name is not distinct from a.country_name
          and b.period <= a.period and (not b.low or b.step <> 1))"""
    else:
        island = """row_number() over (partition by country_name order by period)
          - case when low then row_number() over (partition by country_name, low order by period) end"""
    return f"""
      select country_name, cast(island as int) as island_id, count(*) as consecutive_periods,
             min(period) as run_start_period, max(period) as run_end_period,
             {mean_score("m")} as avg_completeness_in_run
      from (
        with monthly as (
          select country_name, period, {mean_score("completeness_score")} as m
          from {_monthly(weight)} group by country_name, period),
        marked as (
          select *, coalesce(m < {threshold}, false) as low,
                 {_index()} - lag({_index()}, 1, {_index()} - 1) over (
                   partition by country_name order by period) as step from monthly)
        select a.*, {island} as island from marked a)
      where low group by country_name, island having count(*) >= 3
    """


def _anomalies(sigmas: float, include_current: bool = True) -> str:
    frame = "11 preceding and current row" if include_current else "12 preceding and 1 preceding"
    score = "abs(numeric_value - m) / sd"
    return f"""
      select ou_uid, facility_name, country_name, district_name, de_uid, health_area, period,
             numeric_value, {rounded("m", 4)} as rolling_mean, {rounded("sd", 4)} as rolling_stddev,
             {rounded(score, 2)} as z_score, c as window_count
      from (
        select *, avg(numeric_value) over w as m, stddev_pop(numeric_value) over w as sd,
               count(numeric_value) over w as c
        from fact where numeric_value > 0 and not is_missing_value
        window w as (partition by ou_uid, de_uid order by period, coc_uid
                     rows between {frame}))
      where c >= 3 and sd > 0 and {score} > {sigmas}
    """


def _together(queries: dict[str, str]) -> str:
    return " union all by name ".join(
        f"select '{name}' as report, * from ({query})" for name, query in queries.items()
    )


def _matrix() -> str:
    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    cells = ", ".join(
        f"""cast(coalesce(max(case when country_name = '{c}' and numeric_value is not null
            then 1 end), 0) as int) as "{c}\""""
        for c in names
    )
    return f"""
      select de_uid, {cells}, min(de_name) as de_name, min(health_area) as health_area
      from fact group by de_uid having count(numeric_value) > 0
    """


def _contract() -> str:
    counts = {
        ("reviewed_by.present", "present", "reviewed_by"): "1",
        ("program_id.present", "present", "program_id"): "0",
        ("program_id.type", "type", "program_id"): "0",
        ("program_id.not_null", "not_null", "program_id"): "count_if(program_id is null)",
        ("numeric_value.present", "present", "numeric_value"): "0",
        ("numeric_value.type", "type", "numeric_value"): "0",
        ("numeric_value.range", "range", "numeric_value"): (
            "count_if(numeric_value < 1 or numeric_value > 49)"
        ),
        ("health_area.present", "present", "health_area"): "0",
        ("health_area.type", "type", "health_area"): "0",
        ("health_area.allowed_values", "allowed_values", "health_area"): (
            "count_if(health_area not in ('A', 'B', 'C', 'D'))"
        ),
        ("quarter.present", "present", "quarter"): "0",
        ("quarter.type", "type", "quarter"): "0",
        ("quarter.pattern", "pattern", "quarter"): (
            "count_if(not regexp_matches(quarter, '^199[2-6]Q[1-4]$'))"
        ),
        ("year.present", "present", "year"): "0",
        ("year.type", "type", "year"): "1",
        ("late_zero", "custom", ""): "count_if(is_late_reported and is_explicit_zero)",
        ("key_there", "not_null", "de_uid"): "count_if(de_uid is null)",
        ("key_there", "not_null", "ou_uid"): "count_if(ou_uid is null)",
        ("zero_null_distinction", "custom", ""): (
            "count_if(is_explicit_zero and is_missing_value)"
        ),
    }
    details = {
        "reviewed_by.present": "'missing column'",
        "program_id.not_null": "'null values'",
        "numeric_value.range": "(select min(numeric_value) || '..' || max(numeric_value) from fact) || ' outside 1..49'",
        "health_area.allowed_values": "'values outside: A, B, C, D'",
        "quarter.pattern": "'no match of ^199[2-6]Q[1-4]$'",
        "year.type": "'expected string, found int'",
        "late_zero": "'is_late_reported and is_explicit_zero'",
        "key_there": "'null values'",
        "zero_null_distinction": "'is_explicit_zero and is_missing_value'",
    }
    rows = " union all ".join(
        f"select '{name}' as rule_name, '{kind}' as kind, '{column}' as column_name, "
        f"cast({n} as bigint) as violations, {details.get(name, 'null')} as text "
        f"{'from fact' if 'count' in n else ''}"
        for (name, kind, column), n in counts.items()
    )
    return f"""
      select * exclude (text), violations = 0 as passed, case when violations > 0 then text end as detail
      from ({rows})
      union all select 'plausible', 'custom', '', null, null, 'not evaluated: the check has no condition'
    """


_ORDER_DOC = """
  select o_orderpriority as item, 'C' || o_custkey as unit,
         strftime(o_orderdate, '%Y%m') as period, o_orderkey,
         case when o_orderkey % 97 = 0 then 'cut' when o_orderkey % 89 = 0 then 'bare'
              when o_orderkey % 7 = 0 then 'no unit' else 'whole' end as state
  from orders
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "ingest_documents": f"select {VALUE_COLUMNS} from reports",
        "ingest_split_documents": f"select {VALUE_COLUMNS} from reports",
        "ingest_split_nested": f"""
          select {VALUE_COLUMNS} from (
            select * replace (case when ok % 3 = 0 then "storedBy" || ' a}}b\\"]{{"dataValues":[{{' else "storedBy" end as "storedBy")
            from reports)
        """,
        "ingest_file_documents": f"select {VALUE_COLUMNS} from reports",
        "ingest_quarantine": """
          select * exclude (reason), case when reason is null then 'clean' else 'rejected' end as status,
                 case when reason is not null
                   then 'missing: ' || reason end as quarantine_reason
          from (select ok, ln, px, "dataElement", period, "orgUnit", value,
                       nullif(concat_ws(', ',
                         case when "dataElement" is null then 'dataElement' end,
                         case when period is null then 'period' end,
                         case when "orgUnit" is null then 'orgUnit' end), '') as reason
                from (select * replace (
                        case when ok % 37 <> 0 then "dataElement" end as "dataElement",
                        case when ok % 41 <> 0 then period end as period,
                        case when ln <> 6 then "orgUnit" end as "orgUnit") from reports))
        """,
        "ingest_lost_documents": f"""
          select status, quarantine_reason, item, count(*) as documents from (
            select case when state in ('cut', 'bare') then 'lost'
                        when state = 'no unit' then 'rejected' else 'clean' end as status,
                   case when state in ('cut', 'bare')
                          then 'unreadable: dataValues'
                        when state = 'no unit'
                          then 'missing: orgUnit' end as quarantine_reason,
                   case when state not in ('cut', 'bare') then item end as item
            from ({_ORDER_DOC})) group by all
        """,
        "ingest_all_counts": """
          select * from (values ('elements'), ('option_combos'), ('org_units'), ('programs'),
                                ('data_values')) d(dataset)
          join lateral (
            select case d.dataset
              when 'elements' then (select count(*) from elements)
              when 'option_combos' then (select count(*) from combos)
              when 'org_units' then (select count(*) from unit_ids)
              when 'programs' then (select count(*) from programs)
              else (select count(*) from reports where ok % 37 <> 0) end as clean,
            case when d.dataset = 'data_values'
              then (select count(*) from reports where ok % 37 = 0) else 0 end as rejected) on true
        """,
        "events_props_json": """
          select event_id, event_type,
                 cast(json_extract_string(props, '$.k') as int) as k from events
        """,
        "metadata_lookup": """
          select id as de_uid, name as de_name, value_type, combo_id as category_combo_id,
                 combo_name as category_combo_name, area as health_area,
                 'SUM' as aggregation_type, zero_counts as zero_is_significant
          from elements
        """,
        "resolve_ok": f"""
          select {VALUE_COLUMNS}, ok, ln, px, de_name, value_type, health_area, coc_name,
                 is_orphaned_coc from resolved
        """,
        "resolve_rejects": f"""
          select {REJECT_COLUMNS}, case when "orgUnit" not in (select id from unit_ids)
                   then 'orgUnit' else 'dataElement' end as unknown_key
          from reports
          where "orgUnit" not in (select id from unit_ids)
             or "dataElement" not in (select id from elements)
        """,
        "hierarchy_flat": "select * from facilities",
        "hierarchy_leaves_without_children": """
          select * from facilities
          union all by name
          select 'N' || n.n_nationkey as facility_uid, n.n_name as facility_name, 3 as facility_level,
                 '/R' || r.r_regionkey || '/R' || r.r_regionkey || 'G' || (n.n_nationkey % 2)
                   || '/N' || n.n_nationkey as path,
                 'R' || r.r_regionkey as country_uid, r.r_name as country_name,
                 'R' || r.r_regionkey || 'G' || (n.n_nationkey % 2) as region_uid,
                 r.r_name || ' half ' || (n.n_nationkey % 2) as region_name
          from nation n join region r on r.r_regionkey = n.n_regionkey
          where 'N' || n.n_nationkey not in (select district_uid from facilities)
        """,
        "cast_values_odd_text": """
          select l_orderkey, l_linenumber, text,
                 case when l_linenumber % 5 in (0, 1) then cast(l_quantity as double)
                      when l_linenumber % 5 = 2 then cast(l_quantity as double) * 100 end as numeric_value
          from (select *, cast(cast(l_quantity as int) as varchar) || case l_linenumber % 5
                  when 0 then '' when 1 then '.0' when 2 then 'e2' when 3 then 'd' else ' NaN' end as text
                from lineitem)
        """,
        "fact_null_periods": f"select {FACT_COLUMNS} from fact_of_nulls",
        "fact_null_periods_split_groups": f"select {FACT_COLUMNS} from fact_of_nulls",
        "rolling_avg_calendar_null_keys": _rolling(3, by_calendar=True, table="keyless"),
        "rolling_avg_calendar_null_keys_split_groups": _rolling(3, by_calendar=True, table="keyless"),
        "exports_rows": """
          select 'element' as kind, id, name, value_type as detail from elements
          union all select 'combo', id, 'combo ' || id, null from combos
          union all select 'program', id, 'Programme ' || area, country from programs
          union all select 'unit', facility_uid, facility_name, path from facilities
          union all select 'unit', 'R' || r_regionkey, r_name, '/R' || r_regionkey from region
          union all select distinct 'unit', 'R' || n_regionkey || 'G' || (n_nationkey % 2),
                 r_name || ' half ' || (n_nationkey % 2),
                 '/R' || n_regionkey || '/R' || n_regionkey || 'G' || (n_nationkey % 2)
                 from nation join region on r_regionkey = n_regionkey
          union all select 'unit', 'N' || n_nationkey, n_name,
                 '/R' || n_regionkey || '/R' || n_regionkey || 'G' || (n_nationkey % 2)
                   || '/N' || n_nationkey from nation
        """,
        "ingest_split_units": """
          select id, name, cast(len(string_split(path, '/')) - 1 as int) as level, path,
                 nullif(list_extract(string_split(path, '/'), -2), '') as parent, groups
          from (
            select 'R' || r_regionkey as id, r_name as name, '/R' || r_regionkey as path, 'L1:Country' as groups from region
            union all select distinct 'R' || n_regionkey || 'G' || (n_nationkey % 2),
                   r_name || ' half ' || (n_nationkey % 2),
                   '/R' || n_regionkey || '/R' || n_regionkey || 'G' || (n_nationkey % 2), 'L2:Region'
                   from nation join region on r_regionkey = n_regionkey
            union all select 'N' || n_nationkey, n_name,
                   '/R' || n_regionkey || '/R' || n_regionkey || 'G' || (n_nationkey % 2) || '/N' || n_nationkey, 'L3:District'
                   from nation
            union all select 'S' || s_suppkey, s_name,
                   '/R' || n_regionkey || '/R' || n_regionkey || 'G' || (n_nationkey % 2) || '/N' || n_nationkey || '/S' || s_suppkey, 'L4:Facility' || case when s_suppkey % 5 = 0 then '' else ',T' || (s_suppkey % 3) || ':Type ' || (s_suppkey % 3) end
                   from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 25 <> 7)
        """,
        "hierarchy_enrich": """
          select r."dataElement", r."orgUnit", r.ok, r.ln, r.px, f.* exclude (facility_uid),
                 f.facility_uid is null as is_non_leaf
          from resolved r left join facilities f on f.facility_uid = r."orgUnit"
        """,
        "dedup_latest": f"select {VALUE_COLUMNS}, ok, ln, px, de_name from latest",
        "cast_values": """
          select "dataElement", ok, ln, px, value, value_type, numeric_value from flagged
        """,
        "dq_flags": """
          select "dataElement", period, "orgUnit", "categoryOptionCombo", value,
                 is_late_reported, is_explicit_zero, is_missing_value, is_orphaned_coc
          from flagged
        """,
        "calendar": """
          select "dataElement", "orgUnit", "categoryOptionCombo", period, year, month, year_month,
                 quarter, period_end_date from flagged
        """,
        "dq_summary": "select t.*, "
        + ", ".join(
            f"{rounded(f'100 * {n}_rows / total_rows', 1)} as {n}_pct"
            for n in ("late", "zero", "missing", "orphaned_coc")
        )
        + """ from (
            select count(*) as total_rows,
                   count(*) filter (is_late_reported) as late_rows,
                   count(*) filter (is_explicit_zero) as zero_rows,
                   count(*) filter (is_missing_value) as missing_rows,
                   count(*) filter (is_orphaned_coc) as orphaned_coc_rows from flagged) t
        """,
        "completeness": 'select "orgUnit", period, completeness_score from scores',
        "completeness_strict": """
          select f."orgUnit", f.period,
                 case when any_value(x.expected_count) > 0 then least(
                   cast(count(distinct case when exists (
                     select 1 from program_items p
                     where p.country = f.country_name and p.brand = f."dataElement")
                     then f."dataElement" end) as double)
                   / cast(any_value(x.expected_count) as double), 1.0) end as completeness_score
          from flagged f left join expected x on x.country = f.country_name
          where f.value is not null group by f."orgUnit", f.period
        """,
        "completeness_dense": f"""
          select u.facility_uid as "orgUnit", m.period,
                 case when x.expected_count > 0
                   then coalesce(s.completeness_score, 0.0) end as completeness_score
          from facilities u join ({_MONTH_SPAN}) m on true
          left join expected x on x.country = u.country_name
          left join scores s on s."orgUnit" = u.facility_uid and s.period = m.period
        """,
        "completeness_dense_stray": f"""
          select coalesce(g.facility_uid, s."orgUnit") as "orgUnit",
                 coalesce(g.period, s.period) as period,
                 case when x.expected_count > 0 then coalesce(s.completeness_score, 0.0)
                   else s.completeness_score end as completeness_score
          from (with {_spans(_STRAYED)} select * from grid) g
          full join (
            select f."orgUnit", f.period,
                   case when any_value(x.expected_count) > 0 then
                     least(cast(count(distinct f."dataElement") as double)
                           / cast(any_value(x.expected_count) as double), 1.0) end as completeness_score
            from {_STRAYED} f left join expected x on x.country = f.country_name
            where f.value is not null group by f."orgUnit", f.period) s
          on s."orgUnit" = g.facility_uid and s.period = g.period
          left join expected x on x.country = g.country_name
        """,
        "silent_runs": _silent_runs("flagged"),
        "silent_runs_stray": _silent_runs(_STRAYED),
        "dq_gate": """
          select 'quarantine_rate' as check_name, q.n as observed, 0.1::double as threshold,
                 q.n <= 0.1 as passed from (
            select cast(count_if(ok % 37 = 0 or ok % 41 = 0 or ln = 6) as double) / count(*) as n
            from reports) q
          union all
          select 'lost_documents', 0.0::double, 0.0::double, true
          union all
          select 'ghost_rate', g.n, 0.09::double, g.n <= 0.09 from (
            select cast(count_if("orgUnit" not in (select id from unit_ids)
                        or "dataElement" not in (select id from elements)) as double)
                   / count(*) as n from reports) g
          union all
          select 'fact_rows', cast(count(*) as double), 1.0::double, count(*) >= 1 from fact
        """,
        "dim_element": """
          select id as de_uid, name as de_name, value_type, 'AGGREGATE' as domain_type,
                 'SUM' as aggregation_type, zero_counts as zero_is_significant,
                 combo_id as category_combo_id, combo_name as category_combo_name,
                 area as health_area
          from elements
        """,
        "dim_unit": """
          select facility_uid, facility_name, facility_type, facility_level, path, country_uid,
                 country_name, region_uid, region_name, district_uid, district_name
          from facilities
        """,
        "dim_period": f"""
          select p as period_id, {_CALENDAR} from (select distinct period as p from flagged)
        """,
        "dim_program": """
          select id as program_id, 'Programme ' || area as program_name,
                 area as program_short_name, area as health_area, country,
                 'Monthly' as reporting_frequency,
                 (select string_agg(brand, '|' order by brand) from brands b
                  where b.area = p.area) as expected_de_uids
          from programs p
        """,
        "mom_pct_change": _mom(False),
        "mom_pct_change_gap_aware": _mom(True),
        "rolling_avg_3m": _rolling(3),
        "rolling_avg_split_groups": _rolling(3),
        "rolling_avg_calendar": _rolling(3, by_calendar=True),
        "rolling_avg_calendar_split_groups": _rolling(3, by_calendar=True),
        "reporting_rate": _rate(False),
        "reporting_rate_dense": _rate(True),
        "top_underreporting": """
          select ou_uid, facility_name, country_name, health_area, zero_periods,
                 cast(r as int) as rank_in_health_area from (
            select *, rank() over (partition by health_area order by zero_periods desc) as r from (
              select ou_uid, facility_name, country_name, health_area, count(*) as zero_periods
              from (select ou_uid, facility_name, country_name, health_area, period from fact
                    group by ou_uid, facility_name, country_name, health_area, period
                    having count_if(numeric_value is null or numeric_value = 0) = count(*))
              group by ou_uid, facility_name, country_name, health_area))
          where r <= 5
        """,
        "volumes_by_quarter": """
          select health_area, quarter, year, sum(numeric_value) as total_volume,
                 count(distinct ou_uid) as reporting_facilities,
                 count(distinct de_uid) as indicators_reported, count(*) as total_rows
          from fact where numeric_value is not null group by health_area, quarter, year
        """,
        "completeness_comparison": _comparison("row"),
        "completeness_comparison_by_facility": _comparison("facility"),
        "coverage_matrix": _matrix(),
        "low_runs": _runs(0.36),
        "low_runs_gap_aware": _runs(0.33, gap_aware=True),
        "low_runs_by_facility": _runs(0.33, weight="facility"),
        "contract_report": _contract(),
        "sigma_anomalies_3": _anomalies(3.0),
        "sigma_anomalies_2_5": _anomalies(2.5),
        "sigma_anomalies_excluding_current": _anomalies(3.0, include_current=False),
        "sigma_anomalies_split_groups": _anomalies(2.05),
        "report_csv_roundtrip": """
          select health_area, quarter, year, sum(numeric_value) as total_volume,
                 count(distinct ou_uid) as reporting_facilities,
                 count(distinct de_uid) as indicators_reported, count(*) as total_rows
          from fact where numeric_value is not null group by health_area, quarter, year
        """,
        "rejects_csv_roundtrip": """
          select facility_uid as id, facility_level as level,
                 '[{"id":"L4","name":"Facility"}' || case when facility_type is not null then
                   ',{"id":"T' || facility_type[6:] || '","name":"' || facility_type || '"}'
                   else '' end || ']' as groups
          from facilities
          union all select 'R' || r_regionkey, 1, '[{"id":"L1","name":"Country"}]' from region
          union all select distinct 'R' || n_regionkey || 'G' || (n_nationkey % 2), 2,
                 '[{"id":"L2","name":"Region"}]' from nation
          union all select 'N' || n_nationkey, 3, '[{"id":"L3","name":"District"}]' from nation
        """,
        "loaded_partitions": "select distinct health_area, year_month from fact",
        "commit_log": """
          select health_area, year_month, n as rows, n as n_read, cast(version as bigint) as version from (
            select health_area, year_month, any_value(month) > 6 and count(*) filter (not is_explicit_zero) > 0 as second,
                   case when second then 2 else 1 end as version,
                   case when second then count(*) filter (not is_explicit_zero) else count(*) end as n
            from fact group by all)
          where health_area is distinct from 'A'
        """,
        "incremental_corrections": f"select {FACT_COLUMNS} from fact",
        "filter_new": f"""
          select {VALUE_COLUMNS}, ok, ln, px from reports
          where period not in (select year_month from fact where year_month < '{CUTOFF}')
        """,
        "filter_new_by_area": f"""
          select r.ok, r.ln, r.px, r."dataElement", r.period from resolved r
          where not exists (select 1 from fact f where f.year_month < '{CUTOFF}'
                            and f.health_area = r.health_area and f.year_month = r.period)
        """,
    }
    sql["fact"] = sql["fact_roundtrip"] = sql["fact_split_groups"] = (
        f"select {FACT_COLUMNS} from fact"
    )
    offered = "case when year_month < '{0}' then stored_by else 'second' end as stored_by".format(CUTOFF)
    sql["incremental_union"] = (
        f"select * replace ({offered}) from (select {FACT_COLUMNS} from fact)"
    )
    sql["incremental_skipped"] = f"""
      select period, count(*) as skipped from fact where year_month < '{CUTOFF}' group by period
    """
    for name in (
        "mom_pct_change", "reporting_rate", "top_underreporting", "volumes_by_quarter", "completeness_comparison",
        "coverage_matrix", "low_runs",
    ):
        sql[f"states_{name}"] = sql[name]  # from states or from rows, a report is the same
    sql["contract_report_in_write"] = sql["contract_report"]
    sql["dims_written"] = _together({d: sql[d] for d in ("dim_element", "dim_unit", "dim_period", "dim_program")})
    sql["analytics_written"] = _together(
        {
            "mom_pct_change": sql["mom_pct_change"],
            "rolling_avg_3m": sql["rolling_avg_3m"],
            "reporting_rate": sql["reporting_rate"],
            "top5_underreporting": sql["top_underreporting"],
        }
    )
    sql["aggregation_written"] = _together(
        {
            "volumes_by_quarter": sql["volumes_by_quarter"],
            "completeness_comparison": sql["completeness_comparison"],
            "coverage_matrix": sql["coverage_matrix"],
            "low_completeness_countries": _runs(0.8),
        }
    )
    return {name: f"with {VIEWS}\n{body}" for name, body in sql.items()}

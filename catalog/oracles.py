"""The registered results in DuckDB SQL over the given tables.

``CTES`` names the intermediate tables; an oracle is a final select, to which the
tables it needs are prepended. Written from the intended results, apart from the jobs.
"""

from __future__ import annotations

import re

from areaneed.constants import CRIME_CATEGORIES
from catalog.inputs import DAY_1, DAY_2, RUN_TS, SQL, oracle_input
from catalog.queries import AS_OF, EXTRACT_DAY, SPLIT_DAY

CTES: dict[str, str] = {name: oracle_input(name) for name in SQL}

# Staging

CTES["ent"] = """
select entityid as entity_id, entityname as entity_name,
  principaladdress1 as principal_address_1, principaladdress2 as principal_address_2,
  principalcity as principal_city, principalstate as principal_state,
  principalzipcode as principal_zip_code, principalcountry as principal_country,
  entitystatus as entity_status, jurisdictonofformation as jurisdiction_of_formation,
  entitytype as entity_type, cast(entityformdate as date) as entity_form_date
from raw_entities where principalstate = 'CO'"""

CTES["early"] = """
select agency_name, primary_county as county_name,
  cast(try_strptime(incident_date, '%m/%d/%Y') as date) as incident_date,
  cast(incident_hour as int) as incident_hour, offense_name, crime_against,
  offense_category_name, cast(age_num as int) as age_num, agency_type_name, city_name,
  '1997_2015' as source_period
from raw_incidents_early
where primary_county is not null and try_strptime(incident_date, '%m/%d/%Y') is not null"""

CTES["late"] = """
select pub_agency_name as agency_name, county_name,
  cast(try_strptime(incident_date, '%m/%d/%Y') as date) as incident_date,
  cast(incident_hour as int) as incident_hour, offense_name, crime_against,
  offense_category_name, cast(age_num as int) as age_num, offense_group,
  '2016_2020' as source_period
from raw_incidents_late
where county_name is not null and try_strptime(incident_date, '%m/%d/%Y') is not null"""

CTES["inc_stage"] = """
select statename as state_name, areaname as county, cast(periodyear as int) as year,
  cast(inctype as int) as income_type_code, incdesc as income_description,
  try_cast(replace(income, ',', '') as bigint) as income,
  try_cast(replace(population, ',', '') as bigint) as population
from raw_income where statename = 'Colorado' and areatype = 4"""

CTES["pop_stage"] = """
select * from (
  select county, cast(year as int) as year, cast(age as int) as age,
    try_cast(replace(malepopulation, ',', '') as bigint) as male_population,
    try_cast(replace(femalepopulation, ',', '') as bigint) as female_population,
    try_cast(replace(totalpopulation, ',', '') as bigint) as total_population,
    datatype as data_type, cast(fipscode as int) as fips_code
  from raw_population where county is not null)
where total_population > 0"""

CTES["zips"] = """
select cast(zip_code as varchar) as zip_code, lower(trim(city)) as city,
  lower(trim(county)) as county from raw_zip_lookup"""

CTES["cents"] = """
select upper(trim(county)) as county_code, trim(label) as county_label, cent_lat, cent_long
from raw_centroids"""

# Expressions


def _agency(col: str) -> str:
    out = col
    for pattern, new in [
        (r"\bDrug Enforcement Team\b", "Drug Task Force"),
        (r"\s+Police Department\b", ""),
        (r"\s+County Sheriff(''s Office)?\b", ""),
        (r"\s+Sheriff(''s Office)?\b", ""),
    ]:
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'gi')"
    return f"trim({out})"


def _county(col: str) -> str:
    out = f"lower(trim({col}))"
    for pattern, new in [(r",\s*(co|colorado)\s*$", ""), (r"\s+county\s*$", ""), (r"\s+", " ")]:
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return f"trim({out})"


def _county_list(col: str) -> str:
    return f"""array_to_string(list_sort(list_transform(
      string_split_regex(lower(trim({col})), '[;,]'), lambda x: trim(x))), ', ')"""


def _title(col: str) -> str:
    """Split before every word start: after a blank or one of the delimiters."""
    delims = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""
    pieces = f"regexp_extract_all({col}, '[^{delims}]+|[{delims}]+')"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1]) || x[2:]), '')"


_SEASON = """case when month({d}) in (12, 1, 2) then 'winter' when month({d}) <= 5 then 'spring'
  when month({d}) <= 8 then 'summer' else 'fall' end"""

# Unified tables

_KEEP = """crime_against in ('Property', 'Person', 'Society') and agency_name is not null
  and lower(trim(county_name)) <> 'not specified'"""

CTES["incidents"] = f"""
select {_agency('agency_name')} as agency_name, {_county_list('county_name')} as county_name,
  city_name, incident_date, incident_hour,
  {_title('lower(trim(offense_name))')} as offense_name, crime_against, offense_category_name,
  offense_group, age_num, source_period,
  cast(year(incident_date) as int) as incident_year,
  cast(month(incident_date) as int) as incident_month,
  cast(day(incident_date) as int) as incident_day,
  cast(dayofweek(incident_date) + 1 as int) as day_of_week,
  case when incident_hour >= 6 and incident_hour < 18 then 'day' else 'night' end as time_of_day,
  {_SEASON.format(d='incident_date')} as season
from (
  select agency_name, county_name, city_name, incident_date, incident_hour, offense_name,
    crime_against, offense_category_name, cast(null as varchar) as offense_group, age_num,
    source_period
  from early where {_KEEP}
  union all by name
  select late.*, raw_agency_city.city_name
  from late left join raw_agency_city on agency_name = pub_agency_name where {_KEEP})"""

CTES["economy"] = f"""
with i as (
  select county, {_county('county')} as k, year, max(population) as reported,
    max(income) filter (income_type_code = 2) as median_household_income,
    max(income) filter (income_type_code = 1) as per_capita_income,
    max(income) filter (income_type_code = 3) as total_personal_income
  from inc_stage where year between 1997 and 2024 and income is not null
    and county not in ('Colorado', 'United States')
  group by all),
p as (
  select *, lag(people) over (partition by k order by year) as prior from (
    select {_county('county')} as k, year, cast(sum(total_population) as bigint) as people,
      cast(sum(male_population) as bigint) as male_population,
      cast(sum(female_population) as bigint) as female_population
    from pop_stage where year between 1997 and 2024 group by all))
select county, k as county_normalized, year, median_household_income, per_capita_income,
  total_personal_income, male_population, female_population, prior as prior_year_population,
  people - prior as population_yoy_change,
  round((people - prior) / nullif(prior, 0) * 100, 4) as population_growth_pct,
  coalesce(people, reported) as total_population
from i left join p using (k, year)"""

# Tiers


def _tier(p: str, inverse: bool = False) -> str:
    steps = (1, 2, 3, 4) if inverse else (4, 3, 2, 1)
    return "case when {p} >= 0.75 then {} when {p} >= 0.5 then {} when {p} >= 0.25 then {} else {} end".format(
        *steps, p=p
    )


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CTES["cat_tiers"] = f"""
select *, {_tier('crime_percentile')} as crime_tier from (
  select county_name, offense_category_name, count(*) as total_crimes,
    percent_rank() over (partition by offense_category_name order by count(*))
      as crime_percentile
  from incidents
  where offense_category_name in ({', '.join(map(_text, CRIME_CATEGORIES))}) group by 1, 2)"""

_CATEGORY_TIERS = ", ".join(
    f"max(crime_tier) filter (offense_category_name = {_text(category)}) as {column}"
    for category, column in CRIME_CATEGORIES.items()
)
CTES["county_crime"] = f"""
select county_name, {_CATEGORY_TIERS},
  cast(round(avg(crime_tier)) as int) as overall_crime_tier
from cat_tiers group by county_name"""

CTES["county_income"] = f"""
select *, {_tier('income_percentile', True)} as income_tier from (
  select county_normalized as county,
    avg(median_household_income) as avg_median_household_income,
    percent_rank() over (order by avg(median_household_income)) as income_percentile
  from economy where median_household_income is not null group by 1)"""

CTES["county_rate"] = f"""
select *, {_tier('crime_percentile')} as crime_per_capita_tier from (
  select *, percent_rank() over (order by avg_crime_per_1000) as crime_percentile from (
    select county, round(avg(n / total_population * 1000), 9) as avg_crime_per_1000
    from (select county_name as county, incident_year as year, count(*) as n
          from incidents group by 1, 2)
    join (select county_normalized as county, year, total_population from economy
          where total_population > 0) using (county, year)
    group by 1))"""

CTES["ranks"] = """
select county, crime_rank, income_rank, population_rank,
  cast(round((crime_rank + income_rank + population_rank) / nullif(
    sign(crime_rank) + sign(income_rank) + sign(population_rank), 0)) as int) as final_rank
from (
  select county, cast(coalesce(max(c), 0) as int) as crime_rank,
    cast(coalesce(max(i), 0) as int) as income_rank,
    cast(coalesce(max(p), 0) as int) as population_rank
  from (
    select county_name as county, overall_crime_tier as c, null as i, null as p from county_crime
    union all select county, null, income_tier, null from county_income
    union all select county, null, null, crime_per_capita_tier from county_rate)
  group by county)"""

# History and dimensions

CTES["day1"] = """
select cast(entityid as bigint) as entity_id, entityname as entity_name,
  entitystatus as entity_status, entitytype as entity_type,
  cast(entityformdate as date) as entity_form_date,
  jurisdictonofformation as jurisdiction_of_formation,
  principaladdress1 as principal_address_1, principalcity as principal_city,
  principalstate as principal_state, principalzipcode as principal_zip_code
from raw_entities_1"""
CTES["day2"] = CTES["day1"].replace("raw_entities_1", "raw_entities_2")

_SAME = " and ".join(
    f"day1.{c} is not distinct from day2.{c}"
    for c in ["entity_status", "principal_zip_code", "principal_city", "entity_name", "entity_type"]
)

CTES["history"] = f"""
select *, md5(entity_id || '|' || valid_from) as scd_id from (
  select day1.*, '{DAY_1}' as valid_from,
    case when day2.entity_id is not null and {_SAME} then null else '{DAY_2}' end as valid_to
  from day1 left join day2 on day1.entity_id = day2.entity_id
  union all
  select day2.*, '{DAY_2}', null
  from day2 left join day1 on day1.entity_id = day2.entity_id
  where day1.entity_id is null or not ({_SAME}))"""

CTES["dates"] = f"""
select d as date_day, strftime(d, '%m/%d/%Y') as full_date, strftime(d, '%m/%d/%Y') as date_key,
  cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
  cast(month(d) as int) as month, strftime(d, '%B') as month_name,
  cast(day(d) as int) as day_of_month, cast(dayofweek(d) + 1 as int) as day_of_week,
  strftime(d, '%A') as day_name, cast(dayofyear(d) as int) as day_of_year,
  cast(weekofyear(d) as int) as week_of_year, {_SEASON.format(d='d')} as season,
  dayofweek(d) in (0, 6) as is_weekend
from (select cast(unnest(generate_series(
    date_trunc('year', (select min(incident_date) from incidents)),
    date_trunc('year', (select max(incident_date) from incidents)) + interval 1 year
      - interval 1 day, interval 1 day)) as date) as d)"""

CTES["geo"] = """
select *, 'Colorado' as state, row_number() over (
    order by county_name nulls last, city_name nulls last, zip_code nulls last) as geo_key
from (
  select z.city as city_name, z.county as county_name, z.zip_code, c.cent_lat, c.cent_long
  from zips z left join cents c on z.county = lower(c.county_label)
  union
  select '[County Level]', lower(county_label), null, cent_lat, cent_long from cents)"""

CTES["county_geo"] = "select county_name as county, geo_key from geo where city_name = '[County Level]'"
CTES["city_geo"] = """
select county_name as county, city_name as city, min(geo_key) as city_geo_key
from geo where city_name <> '[County Level]' group by all"""

CTES["offenses"] = """
select *, row_number() over (order by crime_against, offense_category_name,
    offense_name nulls last, offense_group) as offense_key
from (select distinct offense_category_name, offense_name, crime_against,
        coalesce(offense_group, 'Unknown') as offense_group
      from incidents where offense_category_name is not null)"""

CTES["agencies"] = """
select agency_name, primary_county, row_number() over (order by agency_name) as agency_key
from (select agency_name, arg_min(county_name, (-n, county_name)) as primary_county
      from (select agency_name, county_name, count(*) as n from incidents group by all)
      group by 1)"""

CTES["business"] = f"""
select md5(entity_id || '-' || valid_from) as business_key, scd_id as business_scd_id,
  entity_id, coalesce(entity_name, 'Unknown') as entity_name, principal_address_1,
  coalesce(z.city, lower(trim(principal_city))) as principal_city,
  coalesce(z.county, c.county, lower(principal_state)) as principal_county,
  principal_state, zip5 as principal_zip, entity_status, entity_type,
  entity_form_date as formation_date, jurisdiction_of_formation as jurisdiction,
  entity_status = 'Good Standing' as is_eligible, valid_to is null as is_current,
  valid_from, valid_to, '{RUN_TS}' as dw_updated_at
from (select *, case when regexp_full_match(principal_zip_code, '\\d{{5}}(-\\d{{4}})?')
        then left(principal_zip_code, 5) end as zip5 from history) h
left join zips z on h.zip5 = z.zip_code
left join (select city, min(county) as county from zips group by 1) c
  on lower(trim(h.principal_city)) = c.city"""

# Facts

CTES["crimes"] = """
select i.incident_date, i.incident_hour, i.time_of_day, i.age_num, i.source_period, d.date_key,
  g.geo_key, c.city_geo_key, o.offense_key, a.agency_key, 1 as crime_count
from incidents i
left join dates d on i.incident_date = d.date_day
left join agencies a using (agency_name)
left join offenses o on i.offense_category_name = o.offense_category_name
  and i.offense_name = o.offense_name and i.crime_against = o.crime_against
  and coalesce(i.offense_group, 'Unknown') = o.offense_group
left join county_geo g on g.county = split_part(i.county_name, ',', 1)
left join city_geo c on c.county = split_part(i.county_name, ',', 1)
  and c.city = lower(trim(i.city_name))"""

CTES["econ"] = """
select g.geo_key, year, make_date(year, 1, 1) as year_date, median_household_income,
  per_capita_income, total_personal_income, total_population, male_population,
  female_population, population_yoy_change, population_growth_pct
from economy left join county_geo g on county_normalized = g.county"""

_LABEL = """case composite_tier when 4 then 'Tier 4 - Maximum Subsidy'
    when 3 then 'Tier 3 - Enhanced Subsidy' when 2 then 'Tier 2 - Standard Subsidy'
    when 1 then 'Tier 1 - Basic Review' else 'Unranked' end"""


def _scored(rows: str, allowed: str = "true") -> str:
    return f"""
select business_key, entity_id, entity_name, principal_city, principal_county, principal_zip,
  entity_type, formation_date, geo_key, crime_rank as crime_tier, income_rank as income_tier,
  population_rank as population_tier, composite_tier,
  composite_tier >= 3 and {allowed} as qualifies_for_subsidy, {_LABEL} as subsidy_tier_label,
  composite_tier >= 3 and {allowed} as notification_eligible
from (select b.*, r.*, r.final_rank as composite_tier, g.geo_key
      from business b join ranks r on b.principal_county = r.county
      left join county_geo g on g.county = b.principal_county
      where final_rank > 0 and {rows})"""


CTES["scored"] = _scored("is_current")

# Reports

CTES["lookup"] = """
select entity_id, entity_name, principal_city, principal_county, principal_zip, entity_type,
  formation_date, crime_tier, income_tier, population_tier, composite_tier, subsidy_tier_label,
  qualifies_for_subsidy, notification_eligible,
  case composite_tier
    when 4 then 'Your business qualifies for Maximum Security Subsidy under the subsidy program.'
    when 3 then 'Your business qualifies for Enhanced Security Subsidy under the subsidy program.'
    when 2 then 'Your business qualifies for Standard review under the subsidy program.'
    when 1 then 'Your business is eligible for Basic Review under the subsidy program.'
    else 'Tier not yet assigned. Please contact the program office.' end as subsidy_message
from scored"""

CTES["baseline"] = """
select primary_county as county_name, agency_name, count(*) as total_crimes,
  cast(round(count(*) * 0.95) as bigint) as target_crimes_5pct_reduction,
  min(incident_date) as first_incident_date, max(incident_date) as last_incident_date
from crimes join agencies using (agency_key) group by 1, 2"""

CTES["city_crimes"] = """
select c.*, g.city_name, g.county_name, o.offense_category_name, o.crime_against
from crimes c join geo g on c.city_geo_key = g.geo_key join offenses o using (offense_key)"""

CTES["demographics"] = """
select city_name, county_name, offense_category_name, crime_against, count(*) as total_crimes,
  round(avg(age_num), 1) as avg_offender_age,
  round(count(*) * 100.0 / sum(count(*)) over (partition by city_name), 2) as pct_of_city_crimes
from city_crimes group by 1, 2, 3, 4"""

CTES["day_parts"] = """
select city_name, county_name, time_of_day, offense_category_name, crime_against, crime_count,
  cast(rnk as int) as rnk
from (select *, row_number() over (partition by city_name, time_of_day
        order by crime_count desc, county_name, offense_category_name, crime_against) as rnk
      from (select city_name, county_name, time_of_day, offense_category_name, crime_against,
              count(*) as crime_count from city_crimes group by all))
where rnk <= 3"""

CTES["trends"] = """
select *, round(avg(total_crimes) over (partition by city_name, month_name), 1)
    as avg_monthly_crimes,
  round(avg(total_crimes) over (partition by city_name, day_of_week), 1) as avg_dow_crimes
from (select g.city_name, g.county_name, d.month, d.month_name, d.season, d.day_of_week,
        d.day_name, count(*) as total_crimes
      from crimes c join geo g on c.city_geo_key = g.geo_key join dates d using (date_key)
      group by all)"""

CTES["place_crimes"] = """
select g.county, year(incident_date) as y, month(incident_date) as m, c.*,
  o.offense_category_name, o.crime_against
from crimes c join county_geo g using (geo_key) join offenses o using (offense_key)"""

CTES["county_means"] = """
select county, avg(total_population) as people, avg(median_household_income) as income
from econ join county_geo using (geo_key) group by 1"""


def _words(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", sql))


def with_tables(final: str) -> str:
    """Prepend the tables a select needs, in their order."""
    needed: set[str] = set()
    todo = _words(final) & CTES.keys()
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= (_words(CTES[name]) & CTES.keys()) - {name}
    if not needed:
        return final
    if final.lstrip().startswith("with "):
        final = f"select * from ({final})"
    parts = [f"{name} as ({body})" for name, body in CTES.items() if name in needed]
    return "with " + ",\n".join(parts) + "\n" + final


O: dict[str, str] = {}

_REG = "source_date, entityid, entitystatus, value, event_id"
_TS = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S') as ingested_at"

O["read_seed"] = "select pub_agency_name, city_name from raw_agency_city"
O["overwrite_partition"] = f"select {_REG} from raw_registrations"
O["read_landed"] = f"select {_REG} from raw_registrations where source_date = '{SPLIT_DAY}'"
O["read_landed_json"] = "select * from raw_entities"
_LINE = """concat('{"entityid":"', entityid, '","entityname":"', entityname, '"}')"""
_CUT = "cast(entityid as int) % 50 = 7"
O["split_landed_json"] = f"""
select case when not {_CUT} then entityid end as entityid,
  case when not {_CUT} then entityname end as entityname,
  case when {_CUT} then substring({_LINE}, 1, 20) end as rejected
from raw_entities where entityname is not null"""
O["lost_values"] = """
select "column", value, count(*) as n from (
  select 'incident_date' as "column", incident_date as value from raw_incidents_late
  where incident_date is not null and try_strptime(incident_date, '%m/%d/%Y') is null
  union all
  select 'incident_hour', incident_hour from raw_incidents_late
  where incident_hour is not null and try_cast(incident_hour as int) is null
  union all
  select 'age_num', age_num from raw_incidents_late
  where age_num is not null and try_cast(age_num as int) is null
  union all
  select 'income', income from raw_income
  where income is not null and try_cast(replace(income, ',', '') as bigint) is null
) group by 1, 2"""
O["filter_extract"] = f"""
select * from raw_entities
where entityformdate = '{EXTRACT_DAY}' and principalstate = 'CO'"""
O["add_audit_columns"] = f"""
select entityid, entitystatus, '{DAY_1}' as _ingested_at, date '2024-01-01' as _source_date
from raw_entities"""
O["assert_rows_landed"] = f"""
select source_date, entitystatus, count(*) as n from raw_registrations
where source_date = '{SPLIT_DAY}' group by all"""
_NEWEST = "order by ingested_at desc, event_id desc"
O["latest_per_key"] = f"""
select entityid, entitystatus, value, {_TS}, source_date, event_id
from (select *, row_number() over (partition by source_date, entityid {_NEWEST}) as rn
      from raw_registrations) where rn = 1"""
_TAKEN = ["entityid", "entitystatus", "value", "ingested_at", "source_date", "event_id"]
O["upsert_by_key"] = f"""
with ranked as (
  select * replace (strftime(ingested_at, '%Y-%m-%d %H:%M:%S') as ingested_at),
    source_date < '{SPLIT_DAY}' as old, row_number() over (
    partition by entityid, source_date < '{SPLIT_DAY}' {_NEWEST}) as rn from raw_registrations)
select {', '.join(f'case when n.entityid is null then t.{c} else n.{c} end as {c}' for c in _TAKEN)},
  t.entitystatus as first_status
from (select * from ranked where rn = 1 and old) t
full join (select * from ranked where rn = 1 and not old) n on t.entityid = n.entityid"""
O["upsert_keyed"] = f"""
select entityid, entitystatus, value, {_TS}, source_date, event_id
from (select *, row_number() over (partition by entityid {_NEWEST}) as rn
      from raw_registrations) where rn = 1"""
O["daily_register"] = O["upsert_keyed"]
_DAYS = f"""
(select *, lag(entitystatus) over days as last_status, row_number() over days as seen
 from (select *, row_number() over (partition by source_date, entityid {_NEWEST}) as rn
       from raw_registrations)
 where rn = 1 window days as (partition by entityid order by source_date))"""
O["daily_history"] = f"""
select entityid, entitystatus, value, {_TS}, source_date, event_id,
  md5(entityid || '|' || cast(source_date as varchar)) as scd_id,
  strftime(source_date, '%Y-%m-%d %H:%M:%S') as valid_from,
  strftime(lead(source_date) over (partition by entityid order by source_date),
    '%Y-%m-%d %H:%M:%S') as valid_to
from {_DAYS} where seen = 1 or entitystatus is distinct from last_status"""
O["scd2_snapshot"] = "select * from history"
O["scd2_as_of"] = f"""
select * from history
where valid_from <= '{AS_OF}' and coalesce(valid_to, '9999') > '{AS_OF}'"""
O["scd2_at_events"] = f"""
select r.event_id, cast(r.entityid as bigint) as entity_id, {_TS}, h.entity_status,
  h.principal_city
from raw_registrations r left join history h on cast(r.entityid as bigint) = h.entity_id
  and r.ingested_at >= cast(h.valid_from as timestamp)
  and r.ingested_at < coalesce(cast(h.valid_to as timestamp), timestamp '9999-01-01')"""
O["portal_rpt_city_time_trends"] = "select * from trends"
O["portal_rpt_city_time_of_day"] = "select * from day_parts"
O["portal_rpt_city_demographics"] = "select * from demographics"
O["write_layer"] = "select * from business"
O["write_layer_incidents"] = "select * from incidents"
O["portal_reads"] = f"select * replace ({_title('county_name')} as county_name) from baseline"

O["stg_business_entities"] = "select * from ent"
O["stg_crimes_1997_2015"] = "select * from early"
O["stg_crimes_2016_2020"] = "select * from late"
O["stg_income"] = "select * from inc_stage"
O["stg_population"] = "select * from pop_stage"
O["stg_city_county_zip"] = "select * from zips"
O["stg_county_boundaries"] = "select * from cents"
O["stg_snapshot"] = "select * from history"

O["normalize_county_names"] = f"""
select areaname, count(*) as n, {_county('areaname')} as county from raw_income group by areaname"""
O["normalize_agency_names"] = f"""
select pub_agency_name, count(*) as n, {_agency('pub_agency_name')} as agency
from (select pub_agency_name from raw_incidents_late
      union all select agency_name from raw_incidents_early) group by pub_agency_name"""
O["normalize_county_lists"] = f"""
select county_name, count(*) as n,
  case when county_name is not null then {_county_list('county_name')} end as county
from (select county_name from raw_incidents_late
      union all select primary_county from raw_incidents_early) group by county_name"""
O["initcap_delims_names"] = f"""
select offense_name, count(*) as n, {_title('lower(trim(offense_name))')} as offense
from (select offense_name from raw_incidents_late
      union all select offense_name from raw_incidents_early) group by offense_name"""

O["lookup_left"] = """
select e.entityid, e.principalcity, c.first_county, c.zips
from raw_entities e left join (
  select city, min(county) as first_county, count(*) as zips from zips group by 1) c
on lower(trim(e.principalcity)) = c.city"""
O["drill_across"] = """
select coalesce(a.county, b.county) as county, coalesce(a.year, b.year) as year, a.crimes,
  b.total_population
from (select county_name as county, incident_year as year, count(*) as crimes
      from incidents group by 1, 2) a
full join (select county_normalized as county, year, total_population from economy) b
  on a.county = b.county and a.year = b.year"""
O["anti"] = """
select county_name, count(*) as n from incidents
where county_name not in (select lower(county_label) from cents) group by 1"""
_CITY_RANKED = """
(select city_name, offense_category_name, count(*) as n, cast(row_number() over (
   partition by city_name order by count(*) desc, offense_category_name) as int) as rnk
 from incidents group by 1, 2)"""
O["first_of_group"] = f"select * exclude (rnk) from {_CITY_RANKED} where rnk = 1"
O["top_k_per_group"] = f"select * from {_CITY_RANKED} where rnk <= 3"
O["share_of"] = """
select city_name, offense_category_name, count(*) as n,
  round(count(*) * 100.0 / sum(count(*)) over (partition by city_name), 2) as share_pct
from incidents group by 1, 2"""
O["quartile_tier"] = f"""
select county_name, season, n, round(p, 9) as percentile, {_tier('p')} as tier from (
  select county_name, season, count(*) as n,
    percent_rank() over (partition by season order by count(*)) as p
  from incidents group by 1, 2)"""
O["pivot_max"] = """
select county_name, max(age_num) filter (crime_against = 'Property') as property_age,
  max(age_num) filter (crime_against = 'Person') as person_age,
  max(age_num) filter (crime_against = 'Society') as society_age
from incidents group by 1"""
O["yoy"] = """
select *, n - prior_year as yoy_change,
  round((n - prior_year) / nullif(prior_year, 0) * 100, 4) as growth_pct
from (select county_name, incident_year, count(*) as n,
        lag(count(*)) over (partition by county_name order by incident_year) as prior_year
      from incidents group by 1, 2)"""
O["percent_rank_over_all"] = """
select agency_name, incident_date, count(*) as n, sum(age_num)::bigint as ages,
  round(percent_rank() over (order by sum(age_num) nulls first), 9) as percentile
from incidents group by 1, 2"""
O["calendar_with_incidents"] = """
select d as date_day, strftime(d, '%m/%d/%Y') as date_key, coalesce(n, 0) as incidents
from (select cast(unnest(generate_series(date '1997-01-01', date '2024-12-31', interval 1 day))
        as date) as d)
left join (select incident_date as d, count(*) as n from incidents group by 1) using (d)
union all
select null, null, count(*) from incidents
where incident_date not between date '1997-01-01' and date '2024-12-31'"""
O["dim_agency_rebuilt"] = """
with early as (
  select agency_name, row_number() over (order by agency_name) as agency_key
  from (select distinct agency_name from incidents
        where incident_year < 2003 and agency_name is not null))
select a.agency_name, a.primary_county, coalesce(e.agency_key,
  (select count(*) from early) + row_number() over (
    partition by e.agency_key is null order by a.agency_name)) as agency_key
from agencies a left join early e using (agency_name)"""
O["with_key"] = """
select *, row_number() over (order by agency_name nulls last, county_name nulls last,
  city_name nulls last) as row_key
from (select distinct agency_name, county_name, city_name from incidents)"""
O["mean_of_present"] = """
select county, cast(round((crime_rank + population_rank) / nullif(
  sign(crime_rank) + sign(population_rank), 0)) as int) as crime_mean from ranks"""

O["int_crimes_unified"] = "select * from incidents"
O["int_income_population"] = "select * from economy"
O["crime_tiers"] = """
select * replace (round(crime_percentile, 9) as crime_percentile) from cat_tiers"""
O["crime_tier_county_rank"] = "select * from county_crime"
O["income_tier"] = """
select * replace (round(avg_median_household_income, 9) as avg_median_household_income,
  round(income_percentile, 9) as income_percentile) from county_income"""
O["per_capita_tier"] = """
select * replace (round(avg_crime_per_1000, 9) as avg_crime_per_1000,
  round(crime_percentile, 9) as crime_percentile) from county_rate"""
O["final_county_tier_rank"] = "select * from ranks"

O["dim_date"] = "select * from dates"
O["dim_geography"] = "select * from geo"
O["dim_offense"] = "select * from offenses"
O["dim_agency"] = "select * from agencies"
O["dim_business"] = "select * from business"
O["fct_crimes"] = "select * from crimes"
O["fct_income_population"] = "select * from econ"
O["fct_business_subsidy_tiers"] = "select * from scored"
O["fct_business_all_versions_by_status"] = _scored(
    "true", "coalesce(entity_status in ('Good Standing', 'Exists'), false)"
)
O["rpt_business_tier_lookup"] = "select * from lookup"
O["rpt_agency_baseline"] = "select * from baseline"
O["rpt_city_demographics"] = "select * from demographics"
O["rpt_city_time_of_day"] = "select * from day_parts"
O["rpt_city_time_trends"] = "select * from trends"

O["incident_counts"] = "\nunion all by name ".join(
    f"""select '{name}' as "set", {keys}, count(*) as n, min(incident_date) as first_date,
  max(incident_date) as last_date from incidents group by all"""
    for name, keys in (
        ("category", "county_name, offense_category_name"),
        ("year", "county_name, incident_year"),
        ("agency", "agency_name, county_name"),
        ("offense", "offense_category_name, offense_name, crime_against, offense_group"),
    )
)
O["fact_counts"] = f"""
with rows as (
  select c.*, cast(year(incident_date) as int) as year, cast(month(incident_date) as int) as month,
    {_SEASON.format(d="incident_date")} as season, offense_category_name,
    date_key is not null and offense_category_name is not null as whole
  from crimes c left join offenses using (offense_key))
""" + "\nunion all by name ".join(
    f"""select '{name}' as "set", {keys}, count(*) as n, count_if(whole) as placed,
  cast(sum(age_num) as bigint) as ages, count(age_num) as aged from rows group by all"""
    for name, keys in (
        ("county_month", "geo_key, year, month, offense_category_name"),
        ("city_hour", "city_geo_key, season, year, incident_hour"),
        ("city_category", "city_geo_key, season, year, offense_category_name"),
    )
)
O["agg_county_month"] = """
select county as county_name, cast(y as int) as year, cast(m as int) as month, total_crimes,
  round(total_crimes * 100000.0 / nullif(people, 0), 2) as crimes_per_100k, avg_age,
  top_offense_category
from (select geo_key, county, y, m, count(*) as total_crimes, round(avg(age_num), 2) as avg_age
      from place_crimes group by all)
join (select geo_key, y, m, arg_min(offense_category_name, (-n, offense_category_name))
        as top_offense_category
      from (select geo_key, y, m, offense_category_name, count(*) as n
            from place_crimes group by all) group by all) using (geo_key, y, m)
left join (select geo_key, year as y, max(total_population) as people from econ group by all)
  using (geo_key, y)"""
O["agg_tier_rankings"] = f"""
with yearly as (select geo_key, y, count(*) as n from place_crimes group by all),
money as (select geo_key, year as y, max(total_population) as people,
    max(median_household_income) as income from econ where geo_key is not null group by all),
scores as (
  select geo_key, y, max(a) as a, max(b) as b, max(c) as c from (
    select geo_key, y, {_tier('percent_rank() over (partition by y order by n)')} as a,
      0 as b, 0 as c from yearly
    union all
    select geo_key, y, 0,
      {_tier('percent_rank() over (partition by y order by income)', True)}, 0
    from money where income is not null
    union all
    select geo_key, y, 0, 0,
      {_tier('percent_rank() over (partition by y order by n * 1000 / people)')}
    from yearly join money using (geo_key, y) where people > 0)
  group by all)
select county as county_name, cast(y as int) as year, a as crime_score, b as income_score,
  c as population_score,
  'Tier ' || cast(round((a + b + c) / (sign(a) + sign(b) + sign(c))) as int) as overall_tier,
  cast(rank() over (partition by y order by a + b + c desc) as int) as tier_rank
from scores join county_geo using (geo_key)"""
O["agg_city_season"] = """
with cells as (
  select c.city_name, d.season, d.year, c.incident_hour, c.offense_category_name
  from city_crimes c join dates d using (date_key))
select city_name, season, year, round(total / days, 4) as avg_crimes_per_day, peak_crime_hour,
  top_offense_type
from (select city_name, season, year, count(*) as total from cells group by all)
join (select season, year, count(*) as days from dates group by all) using (season, year)
join (select city_name, season, year, arg_min(incident_hour, (-n, incident_hour))
        as peak_crime_hour
      from (select city_name, season, year, incident_hour, count(*) as n
            from cells group by all) group by all) using (city_name, season, year)
join (select city_name, season, year, arg_min(offense_category_name, (-n, offense_category_name))
        as top_offense_type
      from (select city_name, season, year, offense_category_name, count(*) as n
            from cells group by all) group by all) using (city_name, season, year)"""

# Metric layer

O["metrics_crimes"] = """
select cast(date_trunc('quarter', incident_date) as date) as metric_time,
  crime_against as offense__crime_against, count(*) as total_crimes,
  round(avg(age_num), 9) as crime_avg_age
from crimes left join offenses using (offense_key) group by 1, 2"""
O["metrics_economy"] = """
select county as geo__county_name,
  round(avg(median_household_income), 9) as avg_median_household_income,
  round(avg(per_capita_income), 9) as avg_per_capita_income,
  round(avg(total_personal_income), 9) as avg_total_personal_income,
  round(avg(total_population), 9) as avg_total_population,
  round(avg(population_yoy_change), 9) as avg_population_yoy_change,
  round(avg(population_growth_pct), 9) as avg_population_growth_pct,
  count(*) filter (population_growth_pct > 10) as counties_exceeding_10pct_growth_years
from econ left join county_geo using (geo_key) group by 1"""
O["metrics_business"] = """
select principal_county as business__principal_county, count(*) as business_count,
  round(avg(composite_tier), 9) as avg_business_composite_tier,
  count(*) filter (qualifies_for_subsidy) as subsidy_qualifying_business_count,
  count(*) filter (notification_eligible) as notification_eligible_business_count
from scored group by 1"""
O["metrics_agency"] = """
select county_name as agency_baseline__county_name,
  cast(sum(total_crimes) as bigint) as agency_total_crimes,
  cast(sum(target_crimes_5pct_reduction) as bigint) as agency_target_crimes_5pct_reduction,
  min(first_incident_date) as agency_first_incident_date,
  max(last_incident_date) as agency_last_incident_date
from baseline group by 1"""
_RATE = """
(select coalesce(a.t, b.t) as t, coalesce(a.county, b.county) as county, coalesce(n, 0) as n, people
 from (select cast(date_trunc('year', incident_date) as date) as t, county, count(*) as n
       from crimes left join county_geo using (geo_key) group by 1, 2) a
 full join (select year_date as t, county, avg(total_population) as people
       from econ left join county_geo using (geo_key) group by 1, 2) b
 on a.t is not distinct from b.t and a.county is not distinct from b.county)"""
O["metrics_crime_rate"] = f"""
select t as metric_time, county as geo__county_name, n as total_crimes,
  round(n / people, 9) as crime_to_population_ratio,
  round(n * 100000.0 / people, 9) as crime_rate_per_100k from {_RATE}"""
O["metrics_weekend_by_city"] = """
select city_name as city__city_name, time_of_day as incident__time_of_day,
  count(*) as total_crimes
from crimes c left join geo g on c.city_geo_key = g.geo_key
left join offenses using (offense_key) left join dates using (date_key)
where is_weekend and crime_against in ('Property', 'Person') group by 1, 2"""
O["metrics_by_agency"] = """
select agency_name as agency__agency_name,
  cast(date_trunc('month', incident_date) as date) as metric_time, count(*) as total_crimes,
  round(avg(age_num), 9) as crime_avg_age
from crimes left join agencies using (agency_key) left join county_geo using (geo_key)
where county <> 'nation_1' group by 1, 2"""
O["metrics_totals"] = """
select (select count(*) from crimes) as total_crimes,
  round((select count(*) from crimes) * 100000.0 / (select avg(total_population) from econ), 9)
    as crime_rate_per_100k,
  (select count(*) from scored) as business_count"""
O["saved_county_crime_annual"] = """
select cast(date_trunc('year', incident_date) as date) as metric_time,
  county as geo__county_name, count(*) as total_crimes
from crimes left join county_geo using (geo_key) group by 1, 2"""
O["saved_subsidy_by_county"] = """
select principal_county as business__principal_county,
  count(*) filter (qualifies_for_subsidy) as subsidy_qualifying_business_count,
  count(*) as business_count from scored group by 1"""
O["saved_income_population_annual"] = """
select year_date as metric_time, county as geo__county_name,
  round(avg(median_household_income), 9) as avg_median_household_income,
  round(avg(total_population), 9) as avg_total_population
from econ left join county_geo using (geo_key) group by 1, 2"""

# Portal

O["sq_county_crime_annual"] = """
select county as county_name, cast(year(incident_date) as int) as year,
  count(*) as total_crimes
from crimes join county_geo using (geo_key) group by 1, 2
order by total_crimes desc, county_name, year limit 20"""
O["sq_subsidy_by_county"] = """
select principal_county, count(*) as total_businesses,
  count(*) filter (qualifies_for_subsidy) as qualifying_businesses,
  round(100.0 * count(*) filter (qualifies_for_subsidy) / count(*), 1) as pct_qualifying
from scored group by 1 order by qualifying_businesses desc, principal_county limit 20"""
O["sq_income_population_annual"] = """
select county as county_name, year,
  round(avg(median_household_income), 0) as avg_median_household_income,
  round(avg(total_population), 0) as avg_total_population
from econ join county_geo using (geo_key) group by 1, 2
order by year desc, avg_median_household_income desc nulls last, county_name limit 20"""
O["crime_rate_spotlight"] = f"""
select {_title('county')} as county_name, total_crimes, round(people, 0) as avg_population,
  round(total_crimes * 100000.0 / nullif(people, 0), 1) as crime_rate_per_100k
from (select lower(county_name) as county, cast(sum(total_crimes) as bigint) as total_crimes
      from baseline group by 1)
join county_means using (county)
order by crime_rate_per_100k desc nulls last, county_name limit 15"""
O["headline_stats"] = """
select (select count(*) from crimes) as total_crimes,
  (select count(*) from lookup) as total_businesses,
  (select count(*) from lookup where qualifies_for_subsidy) as qualifying_businesses,
  cast(min(year(incident_date)) as int) as year_min,
  cast(max(year(incident_date)) as int) as year_max,
  cast(max(year(incident_date)) - min(year(incident_date)) + 1 as int) as years_of_data,
  (select count(*) from county_geo) as counties
from crimes"""
_DENSITY = f"""
select {_title('county')} as county_name, n as total_crimes, round(people, 9) as avg_population,
  EXTRA round(n * 100000.0 / nullif(people, 0), 1) as crime_rate_per_100k
from (select county, count(*) as n from crimes join county_geo using (geo_key) group by 1)
join county_means using (county)"""
O["crime_density"] = _DENSITY.replace("EXTRA", "")
O["crime_vs_income"] = (
    _DENSITY.replace("EXTRA", "round(income, 9) as avg_median_income,")
    + " where income is not null"
)
O["categories_by_county"] = f"""
select {_title('county')} as county_name, offense_category_name, crime_against,
  count(*) as total_crimes from place_crimes group by county, 2, 3"""
O["type_share_by_county"] = f"""
select {_title('county')} as county_name, crime_against, count(*) as total_crimes,
  round(count(*) * 100.0 / sum(count(*)) over (partition by county), 2) as pct_of_county_crimes
from place_crimes group by county, 2"""
O["county_monthly"] = f"""
select {_title('county')} as county_name, d.month, d.month_name, d.season,
  count(*) as total_crimes
from place_crimes join dates d using (date_key) group by county, 2, 3, 4"""
O["income_population_by_county"] = f"""
select {_title('county')} as county_name, year, median_household_income, per_capita_income,
  total_population, population_growth_pct, population_yoy_change
from econ join county_geo using (geo_key)"""
O["tier_breakdown"] = """
select composite_tier, subsidy_tier_label, count(*) as businesses from lookup group by 1, 2"""
O["eligible_by_county"] = f"""
select {_title('principal_county')} as principal_county, count(*) as eligible_businesses
from lookup where notification_eligible group by principal_county"""
O["eligible_total"] = """
select count(*) filter (notification_eligible) as eligible_businesses from lookup"""
O["search_businesses"] = """
select * from lookup where upper(entity_name) like '%CUSTOMER#0000000%'
order by entity_name, entity_id limit 101"""
O["search_businesses_by_id"] = "select * from lookup where entity_id = 123"
O["search_index"] = O["search_businesses"]
O["search_index_by_id"] = O["search_businesses_by_id"]
O["search_index_short_term"] = """
select * from lookup where upper(entity_name) like '%#0%'
order by entity_name, entity_id limit 500"""
O["search_index_no_such_id"] = """
select * from lookup where upper(entity_name) like '%00012%'
order by entity_name, entity_id limit 101"""
O["name_trigrams"] = """
select gram, count(distinct entity_id) as names
from (select entity_id, substring(name, i, 3) as gram
      from (select entity_id, name, unnest(range(1, length(name) - 1)) as i
            from (select entity_id, upper(entity_name) as name from lookup)))
group by 1"""

# Verified questions


def _top(key: str, measure: str, name: str, table: str, limit: int = 0, where: str = "") -> str:
    tail = f" limit {limit}" if limit else ""
    return f"""select {key}, {measure} as {name} from {table} {where}
group by all order by {name} desc, {key}{tail}"""


_N = "cast(sum(total_crimes) as bigint)"
_KIND = "offense_category_name, crime_against"
O["vq_top_crime_cities"] = _top("city_name", _N, "total_crimes", "trends", 10)
O["vq_crime_by_season"] = _top("season", _N, "total_crimes", "trends")
O["vq_crime_by_day_of_week"] = _top("day_name", _N, "total_crimes", "trends")
O["vq_most_common_crime_types"] = _top(_KIND, _N, "total_crimes", "demographics", 15)
O["vq_county_crime_totals"] = _top("county_name", _N, "total_crimes", "baseline", 10)
O["vq_statewide_prevention_target"] = f"""
select {_N} as baseline_crimes,
  cast(sum(target_crimes_5pct_reduction) as bigint) as target_crimes,
  cast(sum(total_crimes - target_crimes_5pct_reduction) as bigint) as crimes_to_prevent
from baseline"""
O["vq_qualifying_businesses_by_county"] = _top(
    "principal_county", "count(*)", "qualifying_businesses", "lookup", 20,
    "where qualifies_for_subsidy",
)
O["vq_tier_4_businesses"] = """
select count(*) filter (composite_tier = 4) as tier_4_businesses from lookup"""
O["vq_weekend_vs_weekday"] = f"""
select case when day_of_week in (1, 7) then 'Weekend' else 'Weekday' end as day_type,
  {_N} as total_crimes from trends group by 1"""
O["vq_top_agencies_by_crime"] = """
select agency_name, county_name, total_crimes, target_crimes_5pct_reduction from baseline
order by total_crimes desc, agency_name limit 15"""
O["vq_property_crime_cities"] = _top(
    "city_name", _N, "property_crimes", "demographics", 10, "where crime_against = 'Property'"
)
O["vq_avg_age_by_crime_type"] = _top(
    _KIND, "round(avg(cast(avg_offender_age as decimal(10, 1))), 1)", "avg_age", "demographics",
    15, "where avg_offender_age is not null",
)
O["vq_notification_eligible_by_county"] = _top(
    "principal_county", "count(*)", "notification_eligible_businesses", "lookup", 20,
    "where notification_eligible",
)

# Data quality


def _checks(rows: list[tuple[str, str, str]]) -> str:
    """(check, table, failing condition) -> one result row each."""
    return "\nunion all ".join(
        f"select '{check}' as \"check\", count(*) as failing_rows from {table} where {cond}"
        for check, table, cond in rows
    )


def _nulls(table: str, cols: list[str]) -> list[tuple[str, str, str]]:
    return [(f"not_null {c}", table, f"{c} is null") for c in cols]


def _duplicates(table: str, col: str) -> tuple[str, str, str]:
    per_value = f"(select {col} as v, count(*) as n from {table} where {col} is not null group by 1)"
    return (f"unique {col}", per_value, "n > 1")


O["dq_not_null"] = _checks(
    _nulls("crimes", ["date_key", "geo_key", "city_geo_key", "offense_key", "agency_key"])
)
O["dq_unique"] = _checks([_duplicates("business", c) for c in ("entity_id", "business_key")])
O["dq_accepted_values"] = _checks(
    [
        (
            "accepted_values offense_category_name",
            "incidents",
            "offense_category_name in ('Fraud Offenses', 'Assault Offenses')",
        )
    ]
)
O["dq_between"] = _checks([("between age_num", "incidents", "age_num < 18 or age_num > 60")])
O["dq_one_current_version"] = _checks(
    [
        (
            "one_current_version principal_zip",
            "(select principal_zip, count(*) as n from business where is_current group by 1)",
            "n <> 1",
        )
    ]
)
O["dq_tier_bounds"] = _checks(
    [("tier_bounds composite_tier", "scored", "composite_tier not between 2 and 3")]
)
O["dq_orphan_keys"] = _checks(
    [
        (
            "orphan_keys geo_key",
            "(select distinct if(geo_key % 2 = 0, geo_key, -geo_key) as geo_key from crimes)",
            "geo_key not in (select geo_key from geo)",
        )
    ]
)
O["dq_freshness"] = """
select 'freshness ingested_at' as "check", cast(0 as bigint) as failing_rows, 'warn' as status,
  round(date_sub('second', max(ingested_at), timestamp '2024-02-01 12:00:00') / 3600, 4)
    as age_hours
from raw_registrations
having date_sub('second', max(ingested_at), timestamp '2024-02-01 12:00:00')
  between 24 * 3600 and 48 * 3600"""

_CONTRACT_TABLES = {
    "dim_date": "dates",
    "dim_geography": "geo",
    "dim_offense": "offenses",
    "dim_agency": "agencies",
    "dim_business": "business",
    "fct_crimes": "crimes",
    "fct_income_population": "econ",
    "fct_business_subsidy_tiers": "scored",
    "rpt_agency_baseline": "baseline",
    "rpt_business_tier_lookup": "lookup",
}
O["dq_contract"] = "\nunion all ".join(
    f"select 'contract {name}' as \"check\", cast(0 as bigint) as failing_rows, count(*) as checked_rows from {cte}"
    for name, cte in _CONTRACT_TABLES.items()
)
O["dq_contract"] += """
union all select 'contract register', 3, count(*) from raw_entities"""
O["declared_schemas"] = """
select 'contract county_month' as "check", cast(0 as bigint) as failing_rows,
  count(distinct (geo_key, y, m)) as checked_rows from place_crimes
union all
select 'contract tier_rankings', 0, count(*) from (
  select geo_key, y from place_crimes union
  select geo_key, year from econ where geo_key is not null
    and (median_household_income is not null))
union all
select 'contract city_season', 0, count(distinct (city_name, season, year))
from city_crimes join dates using (date_key)
union all select 'contract raw_incidents', 0,
  (select count(*) from raw_incidents_early) + (select count(*) from raw_incidents_late)
union all select 'contract entities', 0, count(*) from raw_entities
union all select 'contract geocoded_entities', 0, count(*) from raw_entities
union all select 'contract clean_incidents', 0, count(*) from incidents
union all select 'contract clean_entities', 0, count(*) from raw_entities
  where principalstate = 'CO' and regexp_full_match(principalzipcode, '\\d{5}(-\\d{4})?')"""

_RAW_INCIDENT = """incident_date, try_cast(incident_hour as int) as incident_hour, offense_name,
  crime_against, offense_category_name"""
O["lake_raw_incidents"] = f"""
select agency_name as pub_agency_name, primary_county as county_name, {_RAW_INCIDENT},
  null as offense_group, try_cast(age_num as int) as age_num from raw_incidents_early
union all
select pub_agency_name, county_name, {_RAW_INCIDENT}, offense_group, try_cast(age_num as int)
from raw_incidents_late"""
_ZIPPED = """
(select e.*, case when regexp_full_match(principalzipcode, '\\d{5}(-\\d{4})?')
   then left(principalzipcode, 5) end as zip5, z.city as geo_city, z.county as geo_county
 from raw_entities e left join zips z
   on regexp_full_match(principalzipcode, '\\d{5}(-\\d{4})?') and left(principalzipcode, 5) = z.zip_code)"""
O["lake_entities"] = f"""
select cast(entityid as double) as entityid, entityname, principaladdress1, principaladdress2,
  principalcity, geo_county as principalcounty, principalstate, principalzipcode,
  principalcountry, entitystatus, jurisdictonofformation, entitytype,
  cast(entityformdate as date) as entityformdate from {_ZIPPED}"""
O["lake_geocoded_entities"] = f"""
select cast(entityid as double) as entityid, principaladdress1, principalcity, principalzipcode,
  concat_ws(', ', principaladdress1, principalcity, concat_ws(' ', principalstate, zip5))
    as full_address, geo_city, geo_county,
  case when geo_city is not null then principalstate end as geo_state,
  case when geo_city is not null then zip5 end as geo_postcode from {_ZIPPED}"""
O["lake_clean_incidents"] = f"""
select agency_name, county_name, incident_date, incident_hour, offense_name, crime_against,
  offense_category_name, age_num, '{RUN_TS}' as cleaned_at from incidents"""
O["lake_clean_entities"] = f"""
select cast(entityid as double) as entityid, entityname, principaladdress1,
  lower(trim(principalcity)) as principalcity, geo_county as principalcounty, principalstate,
  zip5 as principalzipcode, entitystatus, entitytype,
  cast(entityformdate as date) as entityformdate, '{RUN_TS}' as cleaned_at
from {_ZIPPED} where principalstate = 'CO' and zip5 is not null"""
O["publish_gate"] = """
select attempt, rule, cast(failing_rows as bigint) as failing_rows,
  (select count(*) from inc_stage) as published_rows
from (
  select 'not unique' as attempt, 'unique state_name' as rule, count(*) as failing_rows
  from (select state_name from inc_stage group by 1 having count(*) > 1)
  union all
  select 'not unique', 'unique county', count(*)
  from (select county from inc_stage group by 1 having count(*) > 1)
  union all
  select 'bad rows', 'not_null income', count(*) filter (income is null)
    + count(*) filter (income is null and income_type_code = 1) from inc_stage
  union all
  select 'bad rows', 'between year', count(*) filter (year not between 1996 and 2000)
    + count(*) filter (year not between 1996 and 2000 and income_type_code = 1) from inc_stage
) where failing_rows > 0"""
O["daily_gold"] = "select * from lookup"

_DAY = "time_of_day not in ('day', 'night')"
_SEASONS = "season not in ('winter', 'spring', 'summer', 'fall')"
_AGAINST = "crime_against not in ('Property', 'Person', 'Society')"
# Per table, the columns that may not be null and the other declared rules.
_DECLARED: list[tuple[str, str, list[str], list[tuple[str, str]]]] = [
    (
        "stg_business_entities",
        "ent",
        ["entity_id", "entity_name", "principal_state", "entity_form_date"],
        [],
    ),
    (
        "stg_crimes_1997_2015",
        "early",
        ["agency_name", "county_name", "incident_date", "offense_category_name"],
        [],
    ),
    (
        "stg_crimes_2016_2020",
        "late",
        ["agency_name", "county_name", "incident_date", "offense_category_name"],
        [],
    ),
    (
        "stg_income",
        "inc_stage",
        ["county", "year", "income"],
        [],
    ),
    (
        "stg_population",
        "pop_stage",
        ["county", "year", "total_population"],
        [
            ("between total_population", "total_population < 0"),
        ],
    ),
    (
        "int_crimes_unified",
        "incidents",
        ["agency_name", "county_name", "incident_date", "offense_name", "crime_against",
         "offense_category_name", "source_period", "incident_year", "incident_month",
         "day_of_week", "time_of_day", "season"],
        [
            ("between incident_hour", "incident_hour not between 0 and 23"),
            ("between age_num", "age_num not between 0 and 120"),
            ("between incident_month", "incident_month not between 1 and 12"),
            ("between day_of_week", "day_of_week not between 1 and 7"),
            ("accepted_values crime_against", _AGAINST),
            ("accepted_values source_period", "source_period not in ('1997_2015', '2016_2020')"),
            ("accepted_values time_of_day", _DAY),
            ("accepted_values season", _SEASONS),
        ],
    ),
    (
        "int_income_population",
        "economy",
        ["county", "year"],
        [
            ("between total_population", "total_population < 1"),
        ],
    ),
    (
        "crime_tiers",
        "cat_tiers",
        ["county_name", "offense_category_name", "total_crimes", "crime_percentile",
         "crime_tier"],
        [
            ("between crime_percentile", "crime_percentile not between 0 and 1"),
            ("accepted_values crime_tier", "crime_tier not in (1, 2, 3, 4)"),
        ],
    ),
    (
        "crime_tier_county_rank",
        "county_crime",
        ["county_name", "overall_crime_tier"],
        [
            ("between overall_crime_tier", "overall_crime_tier not between 1 and 4"),
        ],
    ),
    (
        "income_tier",
        "county_income",
        ["county", "avg_median_household_income", "income_percentile", "income_tier"],
        [
            ("between income_percentile", "income_percentile not between 0 and 1"),
            ("accepted_values income_tier", "income_tier not in (1, 2, 3, 4)"),
        ],
    ),
    (
        "per_capita_tier",
        "county_rate",
        ["county", "avg_crime_per_1000", "crime_percentile", "crime_per_capita_tier"],
        [
            ("between crime_percentile", "crime_percentile not between 0 and 1"),
            ("accepted_values crime_per_capita_tier", "crime_per_capita_tier not in (1, 2, 3, 4)"),
        ],
    ),
    (
        "final_county_tier_rank",
        "ranks",
        ["county", "crime_rank", "income_rank", "population_rank", "final_rank"],
        [
            ("between crime_rank", "crime_rank not between 0 and 4"),
            ("between income_rank", "income_rank not between 0 and 4"),
            ("between population_rank", "population_rank not between 0 and 4"),
            ("between final_rank", "final_rank not between 1 and 4"),
        ],
    ),
    (
        "dim_date",
        "dates",
        ["date_key", "full_date", "year", "quarter", "month", "day_of_week", "season"],
        [
            ("between month", "month not between 1 and 12"),
            ("between day_of_week", "day_of_week not between 1 and 7"),
            ("accepted_values season", _SEASONS),
        ],
    ),
    (
        "dim_geography",
        "geo",
        ["geo_key", "city_name", "county_name", "state"],
        [
            ("accepted_values state", "state <> 'Colorado'"),
        ],
    ),
    (
        "dim_offense",
        "offenses",
        ["offense_key", "offense_category_name", "crime_against"],
        [
            ("accepted_values crime_against", _AGAINST),
        ],
    ),
    (
        "dim_agency",
        "agencies",
        ["agency_key", "agency_name", "primary_county"],
        [],
    ),
    (
        "dim_business",
        "business",
        ["business_key", "entity_id", "entity_name", "entity_status", "is_current",
         "business_scd_id"],
        [],
    ),
    (
        "fct_crimes",
        "crimes",
        ["date_key", "geo_key", "offense_key", "incident_date", "time_of_day", "crime_count"],
        [
            ("accepted_values time_of_day", _DAY),
            ("between crime_count", "crime_count <> 1"),
        ],
    ),
    (
        "fct_income_population",
        "econ",
        ["geo_key", "year", "total_population"],
        [
            ("between total_population", "total_population < 1"),
        ],
    ),
    (
        "fct_business_subsidy_tiers",
        "scored",
        ["business_key", "entity_id", "composite_tier", "qualifies_for_subsidy",
         "subsidy_tier_label", "notification_eligible"],
        [
            ("between composite_tier", "composite_tier not between 1 and 4"),
        ],
    ),
    (
        "rpt_agency_baseline",
        "baseline",
        ["county_name", "agency_name", "total_crimes", "target_crimes_5pct_reduction",
         "first_incident_date", "last_incident_date"],
        [],
    ),
    (
        "rpt_business_tier_lookup",
        "lookup",
        ["entity_id", "entity_name", "principal_county", "composite_tier",
         "qualifies_for_subsidy", "notification_eligible", "subsidy_message"],
        [
            ("between composite_tier", "composite_tier not between 1 and 4"),
        ],
    ),
    (
        "rpt_city_time_trends",
        "trends",
        ["city_name", "county_name", "month", "month_name", "season", "day_of_week", "day_name",
         "total_crimes"],
        [
            ("accepted_values season", _SEASONS),
        ],
    ),
    (
        "rpt_city_time_of_day",
        "day_parts",
        ["city_name", "county_name", "time_of_day", "offense_category_name", "crime_against",
         "crime_count", "rnk"],
        [
            ("accepted_values time_of_day", _DAY),
            ("accepted_values crime_against", _AGAINST),
            ("accepted_values rnk", "rnk not in (1, 2, 3)"),
        ],
    ),
    (
        "rpt_city_demographics",
        "demographics",
        ["city_name", "county_name", "offense_category_name", "crime_against"],
        [
            ("accepted_values crime_against", _AGAINST),
        ],
    ),
]


def _declared_rows() -> str:
    selects = []
    for table, cte, required, rules in _DECLARED:
        tests = _nulls(cte, required) + [(check, cte, cond) for check, cond in rules]
        selects.append(f"select '{table}' as \"table\", * from ({_checks(tests)})")
    return "\nunion all ".join(selects)


O["dq_declared_row_checks"] = _declared_rows()

_UNIQUE = {
    "stg_business_entities": ("ent", ["entity_id"]),
    "stg_city_county_zip": ("zips", ["zip_code"]),
    "crime_tier_county_rank": ("county_crime", ["county_name"]),
    "income_tier": ("county_income", ["county"]),
    "per_capita_tier": ("county_rate", ["county"]),
    "final_county_tier_rank": ("ranks", ["county"]),
    "dim_date": ("dates", ["date_key", "full_date"]),
    "dim_geography": ("geo", ["geo_key"]),
    "dim_offense": ("offenses", ["offense_key"]),
    "dim_agency": ("agencies", ["agency_key", "agency_name"]),
    "dim_business": ("business", ["business_key", "business_scd_id"]),
    "fct_business_subsidy_tiers": ("scored", ["business_key", "entity_id"]),
    "rpt_business_tier_lookup": ("lookup", ["entity_id"]),
}
O["dq_declared_unique_checks"] = "\nunion all ".join(
    f"select '{table}' as \"table\", * from ({_checks([_duplicates(cte, c) for c in cols])})"
    for table, (cte, cols) in _UNIQUE.items()
)
O["dq_invariants"] = f"""
select 'dim_business' as "table", * from ({_checks([(
    "one_current_version entity_id",
    "(select entity_id, count(*) as n from business where is_current group by 1)", "n <> 1")])})
union all select 'fct_business_subsidy_tiers', * from ({_checks([(
    "tier_bounds composite_tier", "scored", "composite_tier not between 1 and 4")])})
union all select 'fct_crimes', * from ({_checks([(
    "orphan_keys geo_key", "(select distinct geo_key from crimes where geo_key is not null)",
    "geo_key not in (select geo_key from geo)")])})"""

O["stream_ingest_state"] = f"""
select entityid, entitystatus, value, {_TS}, source_date, event_id
from (select *, row_number() over (partition by entityid {_NEWEST}) as rn
      from raw_registrations) where rn = 1"""

ORACLES: dict[str, str] = {name: with_tables(sql) for name, sql in O.items()}
# The register keeps what a day does not name, so an entity of the first day alone stays open.
ORACLES["daily_gold"] = ORACLES["daily_gold"].replace(
    f"case when day2.entity_id is not null and {_SAME} then",
    f"case when day2.entity_id is null or ({_SAME}) then",
)

"""Raw inputs derived from the given tables.

The given tables are of another domain, so each raw input is a view over them: an area
is a nation, an agency a supplier, an entity a customer, an incident a line item. The
views carry the defects the jobs have to handle: missing and unparsable values, lists
of areas, spelling variants, unlisted codes. The SQL is common to Spark and DuckDB, so the same
text feeds a job and its check. Every view covers its tables whole; of the two days of the
register that make a history each lacks some entities, but none is in neither.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from areaneed.sources.scratch import materialise

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_AGENCY = """
  case cast(s.s_suppkey % 5 as int)
    when 0 then concat(s.s_name, ' Police Department')
    when 1 then concat(s.s_name, ' County Sheriff', chr(39), 's Office')
    when 2 then concat(s.s_name, ' sheriff')
    when 3 then concat(s.s_name, ' Drug Enforcement Team')
    else s.s_name
  end"""

# Lines of an order with a given remainder carry one kind of defect each.
_INCIDENT = f"""
  case when l.l_orderkey % 40 = 5 then null else {_AGENCY} end as AGENCY_COLUMN,
  case cast(l.l_orderkey % 40 as int)
    when 0 then concat(n.n_name, '; NATION_', cast(n.n_nationkey * 7 % 25 as string))
    when 1 then concat('  ', lower(n.n_name), ' ')
    when 2 then null
    when 3 then 'Not Specified'
    else n.n_name
  end as COUNTY_COLUMN,
  case when l.l_orderkey % 40 = 4 then 'unknown' else concat(
    lpad(cast(month(l.l_shipdate) as string), 2, '0'), '/',
    lpad(cast(day(l.l_shipdate) as string), 2, '0'), '/',
    cast(year(l.l_shipdate) + 4 as string)) end as incident_date,
  cast((l.l_orderkey * 7 + l.l_linenumber * 5) % 24 as string) as incident_hour,
  concat(' ', upper(p.p_type), '/', lower(p.p_brand), ' & other-kinds') as offense_name,
  case when l.l_orderkey % 40 = 6 then 'Not a Crime'
    when o.o_orderstatus = 'F' then 'Property'
    when o.o_orderstatus = 'O' then 'Person'
    else 'Society' end as crime_against,
  case p.p_size % 9
    when 0 then 'Destruction/Damage/Vandalism of Property'
    when 1 then 'Burglary/Breaking & Entering'
    when 2 then 'Larceny/Theft Offenses'
    when 3 then 'Motor Vehicle Theft'
    when 4 then 'Robbery'
    when 5 then 'Arson'
    when 6 then 'Stolen Property Offenses'
    when 7 then 'Fraud Offenses'
    else 'Assault Offenses' end as offense_category_name,
  case when l.l_linenumber % 2 = 0 then null
    else cast(cast(l.l_quantity as int) + 15 as string) end as age_num"""

_INCIDENT_TABLES = """
from {lineitem} l
join {orders} o on o.o_orderkey = l.l_orderkey
join {customer} c on c.c_custkey = o.o_custkey
join {nation} n on n.n_nationkey = c.c_nationkey
join {supplier} s on s.s_suppkey = l.l_suppkey
join {part} p on p.p_partkey = l.l_partkey"""

# The same joins, bracketed: the customer's area is looked up for each order, not for each line, so
# where customers are too many to broadcast it is the orders that are shuffled for them.
_INCIDENT_TABLES_BY_ORDER = """
from {lineitem} l
join ({orders} o
  join {customer} c on c.c_custkey = o.o_custkey
  join {nation} n on n.n_nationkey = c.c_nationkey) on o.o_orderkey = l.l_orderkey
join {supplier} s on s.s_suppkey = l.l_suppkey
join {part} p on p.p_partkey = l.l_partkey"""

_COMMA_NUMBER = """case when v < 1000 then cast(v as string) else concat(
    cast(cast(floor(v / 1000) as bigint) as string), ',',
    lpad(cast(v % 1000 as string), 3, '0')) end"""

_INCOME_BRANCH = """
select 'Colorado' as statename,
  case n_nationkey % 3 when 0 then concat(n_name, ' County')
    when 1 then concat(n_name, ' County, CO') else concat(n_name, '  county, Colorado') end
    as areaname,
  case when n_nationkey = 24 and y = 2005 then 1 else 4 end as areatype,
  y as periodyear, {code} as inctype, '{label}' as incdesc,
  case when y = 2004 and n_nationkey % 6 = {code} then 'N/A' else {number} end as income,
  cast(people as string) as population
from (
  select n.n_nationkey, n.n_name, year(o.o_orderdate) + 4 as y,
    cast(floor({measure}) as bigint) as v, count(*) * 100 as people
  from {{orders}} o join {{customer}} c on c.c_custkey = o.o_custkey
  join {{nation}} n on n.n_nationkey = c.c_nationkey
  group by n.n_nationkey, n.n_name, year(o.o_orderdate) + 4
) t{code}"""


def _income(code: int, label: str, measure: str) -> str:
    return _INCOME_BRANCH.format(code=code, label=label, measure=measure, number=_COMMA_NUMBER)


def _entities(status: str, city: str, rows: str) -> str:
    return f"""
select cast(c_custkey as string) as entityid,
  case when c_custkey % 97 = 0 then null else c_name end as entityname,
  concat(cast(c_custkey as string), ' Main St') as principaladdress1,
  cast(null as string) as principaladdress2,
  {city} as principalcity,
  case when c_custkey % 50 = 0 then 'WY' else 'CO' end as principalstate,
  case cast(c_custkey % 20 as int) when 0 then 'bad'
    when 1 then concat(cast(10000 + c_nationkey * 100 + c_custkey % 24 as string), '-0001')
    when 2 then '99999'
    else cast(10000 + c_nationkey * 100 + c_custkey % 24 as string) end as principalzipcode,
  'US' as principalcountry,
  {status} as entitystatus,
  'CO' as jurisdictonofformation,
  case when c_custkey % 3 = 0 then 'DLLC' else 'DPC' end as entitytype,
  concat(cast(2000 + c_custkey % 24 as string), '-',
    lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-',
    lpad(cast(1 + c_custkey % 28 as string), 2, '0')) as entityformdate
from {{customer}} {rows}"""


_STATUS = """case c_mktsegment when 'HOUSEHOLD' then 'Good Standing'
    when 'BUILDING' then 'Exists' when 'MACHINERY' then 'Delinquent'
    when 'FURNITURE' then 'Noncompliant' else 'Voluntarily Dissolved' end"""
_CITY = "concat('City ', cast(c_custkey % 8 as string))"
_LATER_STATUS = f"case when c_custkey % 5 = 0 then 'Voluntarily Dissolved' else {_STATUS} end"
_LATER_CITY = f"case when c_custkey % 7 = 0 then 'Old Town' else {_CITY} end"

SQL = {
    "raw_incidents_early": "select "
    + _INCIDENT.replace("AGENCY_COLUMN", "agency_name").replace("COUNTY_COLUMN", "primary_county")
    + """, 'City' as agency_type_name,
  case when l.l_orderkey % 40 = 8 then null
    else concat('City ', cast(c.c_custkey % 8 as string)) end as city_name"""
    + _INCIDENT_TABLES
    + " where year(l.l_shipdate) < 1998",
    "raw_incidents_late": "select "
    + _INCIDENT.replace("AGENCY_COLUMN", "pub_agency_name").replace(
        "COUNTY_COLUMN", "county_name"
    )
    + """,
  case when l.l_orderkey % 40 = 7 then null when p.p_size % 2 = 0 then 'Group A'
    else 'Group B' end as offense_group"""
    + _INCIDENT_TABLES
    + " where year(l.l_shipdate) >= 1998",
    "raw_agency_city": f"""
select {_AGENCY} as pub_agency_name,
  case when s.s_suppkey % 10 = 9 then null when s.s_suppkey % 10 = 4 then '[County Level]'
    else concat('City ', cast(s.s_suppkey % 8 as string)) end as city_name
from {{supplier}} s""",
    "raw_zip_lookup": """
select distinct cast(10000 + c.c_nationkey * 100 + c.c_custkey % 24 as int) as zip_code,
  concat(' City ', cast(c.c_custkey % 8 as string)) as city, n.n_name as county
from {customer} c join {nation} n on n.n_nationkey = c.c_nationkey""",
    "raw_centroids": """
select concat(lower(n_name), ' ') as county, n_name as label,
  cast(30.0 + n_nationkey as double) as cent_lat,
  cast(-100.0 - n_regionkey as double) as cent_long
from {nation}""",
    "raw_income": _income(1, "Per capita", "avg(o.o_totalprice)")
    + " union all "
    + _income(2, "Median household", "max(o.o_totalprice)")
    + " union all "
    + _income(3, "Total personal", "sum(o.o_totalprice)"),
    "raw_population": """
select case when n_nationkey = 23 and band = '5-LOW' then null else n_name end as county,
  cast(y as string) as year, substring(band, 1, 1) as age,
  cast(people * 49 as string) as malepopulation,
  cast(people * 51 as string) as femalepopulation,
  case when n_nationkey = 22 and band = '4-NOT SPECIFIED' then '0'
    when people * 100 < 1000 then cast(people * 100 as string)
    else concat(cast(cast(floor(people * 100 / 1000) as bigint) as string), ',',
      lpad(cast(people * 100 % 1000 as string), 3, '0')) end as totalpopulation,
  'Estimate' as datatype, cast(n_nationkey as string) as fipscode
from (
  select n.n_nationkey, n.n_name, year(o.o_orderdate) + 4 as y, o.o_orderpriority as band,
    count(distinct o.o_custkey) as people
  from {orders} o join {customer} c on c.c_custkey = o.o_custkey
  join {nation} n on n.n_nationkey = c.c_nationkey
  group by n.n_nationkey, n.n_name, year(o.o_orderdate) + 4, o.o_orderpriority
) t""",
    # The whole register, and two days of it for its history: the first still lacks some
    # entities; by the second some are gone, some have another status and some have moved.
    "raw_entities": _entities(_LATER_STATUS, _LATER_CITY, ""),
    "raw_entities_1": _entities(_STATUS, _CITY, "where c_custkey % 10 <> 0"),
    "raw_entities_2": _entities(
        _LATER_STATUS, _LATER_CITY, "where c_custkey % 17 <> 0 or c_custkey % 10 = 0"
    ),
    "raw_registrations": """
select cast(user_id as string) as entityid,
  case when event_id % 13 = 4 then null else event_type end as entitystatus,
  case when event_id % 11 = 3 then null else value end as value, ts as ingested_at, cast(ts as date) as source_date, event_id
from {events}""",
}

# When the two days of the register were compared with the entity history.
DAY_1 = "2024-01-01 06:00:00"
DAY_2 = "2024-02-01 06:00:00"
RUN_TS = "2024-02-02 06:00:00"


_given: dict[tuple[str, str], DataFrame] = {}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its schema is looked up once per session."""
    path = f"{sf_dir}/{table}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _given:
        _given[key] = spark.read.parquet(path)
    return _given[key]


def raw_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw input as a view over the given tables."""
    sql = SQL[name].replace(_INCIDENT_TABLES, _INCIDENT_TABLES_BY_ORDER)
    used = {t: given(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


_landed: dict[tuple[str, str, str], DataFrame] = {}


class Landing(Mapping):
    """Inputs by name, each made when first asked for and kept."""

    def __init__(self, make: Mapping[str, Callable[[], DataFrame]]):
        self._make = make
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw input as a landed table: written once per session, then read from its files."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        _landed[key] = materialise(raw_input(spark, sf_dir, name), name)
    return _landed[key]


@cache
def oracle_input(name: str) -> str:
    """The same view for DuckDB, where the given tables are views of the same name."""
    return SQL[name].format(**{t: t for t in TABLES})

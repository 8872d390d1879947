"""Inputs derived from the given tables, in SQL that Spark and DuckDB both run.

Each uses every row of its tables, and its groups keep their size as the tables grow, but
for the first study, which holds a third of all subjects.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 9, 1)
HORIZON = 365
SNAPSHOT = "date '2001-09-01'"

SUBJECTS = """
select
  case when c.c_custkey % 3 = 0 then 'ST-0'
       else concat('ST-', cast(cast(floor(c.c_custkey / 50) as int) as string)) end as study_protocol,
  c.c_custkey as subject_number,
  cast(c.c_nationkey as int) as parent_depot,
  cast(c.c_custkey % 40 as int) as site_id,
  case when c.c_nationkey = 7 then null else concat('Nation ', chr(65 + c.c_nationkey)) end as country,
  case when o.o_orderkey % 11 = 0 then null when o.status = 'F' then 'Treatment Discontinued'
       when o.status = 'O' then 'Randomized' else 'Crossover' end as subject_status,
  concat(' Arm ', cast(c.c_custkey % 3 as string), ' ') as randomized_treatment,
  case when o.o_orderkey % 2 = 0 then 'Physician’s Choice' else null end as tpc,
  case when o.o_orderkey % 13 = 0 then null else
    concat(case o.o_orderkey % 4 when 0 then 'Crossover ' when 1 then 'TPC ' else '' end,
           case when o.o_orderkey % 5 = 0 then concat('C', cast(o.o_orderkey % 9 as string), 'D', cast(1 + o.o_orderkey % 15 as string))
                else concat('Cycle ', cast(o.o_orderkey % 9 as string), ' Day ', cast(1 + o.o_orderkey % 15 as string)) end)
    end as last_study_visit_recorded,
  case when o.o_orderkey % 29 = 0 then null else o.last_date end as last_study_visit_date,
  date '2001-09-01' as extract_date
from {customer} c
join (select o_custkey, o_orderstatus as status, max(o_orderkey) as o_orderkey,
             cast(max_by(o_orderdate, o_orderkey) as date) as last_date
      from {orders} group by o_custkey, o_orderstatus) o
  on o.o_custkey = c.c_custkey
"""

RULES = """
select p_partkey as rule_no,
  concat('st-', cast(cast(floor(p_partkey / 66) as int) as string)) as study_protocol,
  concat('ARM ', cast(p_partkey % 3 as string)) as randomized_treatment,
  case when p_partkey % 11 = 10 then null
       when cast(floor(p_partkey / 3) as int) % 2 = 0 then 'randomized' else 'crossover' end as subject_status,
  case when cast(floor(p_partkey / 6) as int) % 2 = 0 then 'PHYSICIAN''S CHOICE' else null end as tpc,
  case when p_partkey % 7 < 3 then concat('nation ', chr(65 + cast(floor(p_partkey / 2) as int) % 25)) else null end as country,
  case when p_partkey % 13 = 0 then null
       else concat(
         case when p_partkey % 7 < 3 and p_partkey % 5 = 0 then concat('(Nation ', chr(65 + cast(floor(p_partkey / 2) as int) % 25), ') ') else '' end,
         case cast(floor(p_partkey / 12) as int) % 2 when 0 then 'Alphamab' else 'Betanib' end,
         case when p_partkey % 7 < 3 and p_partkey % 5 = 1 then concat('-Nation ', chr(65 + cast(floor(p_partkey / 2) as int) % 25)) else '' end,
         ' ', cast(p_size as string), 'mg') end as study_drug_dispensed,
  case when p_partkey % 13 = 0 and p_partkey % 2 = 0 then concat('Add ', p_name) else null end as additional_study_drug_dispensed,
  case when p_partkey % 19 = 0 then null else case p_size % 3 when 0 then '1' when 1 then '8, 1' else '1,8,x,15' end end as visit_days,
  case when p_partkey % 17 = 0 then null else cast(1 + p_size % 4 as bigint) end as dispensing_quantity,
  case when p_partkey % 23 = 0 then null else cast(21 + p_size % 8 as bigint) end as dispensing_frequency_days,
  case when p_size % 5 = 0 then cast(6 + p_size % 10 as double) when p_size % 5 = 1 then cast(0.5 as double) else null end as max_cycles
from {part}
"""

# One row per subject and rule shape, for the projection on its own.
VISIT_INPUT = """
select o_orderkey as subject_number,
  case when o_orderkey % 31 = 0 then null else cast(o_orderdate as date) end as last_study_visit_date,
  case when o_orderkey % 17 = 0 then null else
    concat(case o_orderkey % 4 when 0 then 'Crossover ' when 1 then 'TPC ' else '' end,
           'Cycle ', cast(o_orderkey % 9 as string), ' Day ', cast(1 + o_orderkey % 15 as string)) end as last_study_visit_recorded,
  case o_orderkey % 5 when 0 then '1' when 1 then '15, 8,1' when 2 then '1,8,8' when 3 then 'none' else null end as visit_days,
  case when o_orderkey % 7 = 0 then null else cast(14 + o_orderkey % 60 as bigint) end as dispensing_frequency_days,
  case o_orderkey % 6 when 0 then cast(4.7 as double) when 1 then cast(12 as double) when 2 then cast(0 as double) else null end as max_cycles
from {orders}
"""

FILES = """
select cast(ts as date) as snapshot_date, event_id as listing_no, ts as modified,
  concat('Sponsor ST-', cast(user_id % 9 as string), '-', cast(cast(floor(user_id / 9) as int) as string)) as study_name,
  concat('Sponsor ST-', cast(user_id % 9 as string), '-', cast(cast(floor(user_id / 9) as int) as string), '_',
    case event_id % 13
      when 0 then 'Subject Summary (Unblinded)' when 1 then 'Site Inventory Summary (Unblinded)'
      when 2 then 'Depot Inventory Summary (Unblinded)' when 3 then 'Comparator Supply Method Site Level'
      when 4 then 'Comparator SupplyMethod Country Level' when 5 then 'Participant Summary (Unblinded)'
      when 6 then 'Subject Summary' when 7 then 'Subject Visit Summary' when 8 then 'Inventory Levels Site'
      when 9 then 'Inventory Levels Depot' when 10 then 'Supply Method Country' when 11 then 'Notes'
      else 'Inventory Summary' end,
    case when event_id % 29 = 0 then '2024-13-01-00-00-00'
         else replace(replace(substring(cast(ts as string), 1, 19), ' ', '-'), ':', '-') end,
    case when event_id % 17 = 0 then '.txt' when event_id % 5 = 0 then '.enc' when event_id % 23 = 0 then '.CSV' else '.csv' end) as file_name
from {events}
"""

PATHS = """
select concat('/landing/',
    case when event_id % 37 = 0 then 'archive' when event_id % 41 = 0 then '20241399'
         else replace(cast(cast(ts as date) as string), '-', '') end,
    '/Sponsor ST-', cast(user_id % 9 as string), '/report ', cast(event_id as string), '.csv') as path
from {events}
"""

TEXTS = """
select o_orderkey as id,
  case o_orderkey % 4 when 0 then concat(lpad(cast(1 + o_orderkey % 31 as string), 2, '0'), '-Nov-2025')
    when 1 then concat(cast(1 + o_orderkey % 28 as string), ' Mar 2024') when 2 then 'not a date' else null end as raw_date,
  case o_orderkey % 4 when 0 then '1975' when 1 then concat(cast(1 + o_orderkey % 28 as string), '/11/1975')
    when 2 then 'unknown' else concat('0', cast(1 + o_orderkey % 9 as string), ' Jan 2001') end as raw_year,
  case o_orderkey % 3 when 0 then concat('1, ', cast(o_orderkey % 50 as string), ',x,15') when 1 then '1' else null end as raw_days,
  case o_orderkey % 6 when 0 then concat('TPC C', cast(o_orderkey % 40 as string), 'D', cast(o_orderkey % 30 as string))
    when 1 then concat('cycle ', cast(o_orderkey % 40 as string), ' day ', cast(o_orderkey % 30 as string))
    when 2 then concat('Crossover Cycle', cast(o_orderkey % 40 as string)) when 3 then 'Screening' when 4 then 'Day 3' else null end as raw_visit,
  concat('  ‘', o_orderpriority, '’ ') as raw_text,
  concat('Sponsor GX-EU-', cast(o_orderkey % 900 as string), '-', cast(o_custkey as string),
    case when o_orderkey % 10 = 0 then '-04_05' else '' end, '_Subject Summary.csv') as raw_file,
  case o_orderkey % 4 when 0 then cast(o_custkey as string) when 1 then concat(' ', cast(o_custkey as string), ' ')
    when 2 then '12.5' else 'n/a' end as raw_number
from {orders}
"""

MEMBERS = """
select event_type, concat('ST-', cast(user_id as string)) as study_protocol, cast(ts as date) as extract_date
from {events}
"""

ALL = {
    "subjects": SUBJECTS,
    "rules": RULES,
    "visit_input": VISIT_INPUT,
    "files": FILES,
    "paths": PATHS,
    "texts": TEXTS,
    "members": MEMBERS,
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    text = ALL[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared folder, or below the session's warehouse where none
    is set, so that driver and executors see the same files.

    Checkpoints need a folder too; a session without one gets it from here.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(f"{shared}/checkpoints")
    return f"{shared.rstrip('/')}/run-{name}-{uuid.uuid4().hex}"


def cte(*names: str) -> str:
    """The same inputs as the head of a DuckDB query."""
    plain = {t: t for t in TABLES}
    return "with " + ",\n".join(f"{n} as ({ALL[n].format(**plain)})" for n in names)

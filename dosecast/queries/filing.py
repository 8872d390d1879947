"""Queries on report files, snapshots, coverage, load status and writers."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dosecast.operators import coverage, snapshots, versions
from dosecast.plans import status
from dosecast.queries.fixtures import cte, frame, scratch, table
from dosecast.sources import files as file_ops
from dosecast.sources.envelope import output_name

EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
FIRST, LAST = dt.date(2024, 1, 10), dt.date(2024, 1, 20)


def listing(spark, sf):
    return (
        frame(spark, sf, "files")
        .withColumnsRenamed({"snapshot_date": "extract_date", "modified": "modificationTime"})
        .withColumn("path", F.lpad(F.col("listing_no").cast("string"), 12, "0"))
    )


def members(spark, sf):
    return frame(spark, sf, "members")


def member_tables(spark, sf):
    """One snapshot table per event type."""
    m = members(spark, sf)
    return {t: m.where(F.col("event_type") == t).drop("event_type") for t in EVENT_TYPES}


def snapshot_catalogue(spark, sf):
    return file_ops.snapshot_catalogue(frame(spark, sf, "paths"))


def snapshot_latest(spark, sf):
    return snapshots.latest_snapshot(members(spark, sf))


def snapshot_range(spark, sf):
    return snapshots.snapshot_range(members(spark, sf), start=FIRST, end=LAST)


def latest_members(spark, sf):
    return snapshots.latest_members(member_tables(spark, sf))


def load_summary(spark, sf):
    return snapshots.load_summary(member_tables(spark, sf))


def coverage_sets(spark, sf):
    newest = {
        t: snapshots.latest_snapshot(df).select("study_protocol")
        for t, df in member_tables(spark, sf).items()
    }
    plan = table(spark, sf, "customer").select(
        F.concat(F.lit("ST-"), F.col("c_custkey").cast("string"))
    )
    return {**newest, "demand": plan}


def coverage_pivot(spark, sf):
    return coverage.coverage(coverage_sets(spark, sf))


def coverage_full_outer(spark, sf):
    return coverage.in_order(coverage.coverage_by_joins(coverage_sets(spark, sf)))


def watch_list_latest(spark, sf):
    watched = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("ST-"), F.col("c_custkey").cast("string")).alias("study")
    )
    return coverage.watch_list(snapshots.latest_snapshot(members(spark, sf)), watched)


def classify_files(spark, sf):
    return listing(spark, sf).select(
        "listing_no",
        file_ops.classify_file(F.col("file_name")).alias("file_type"),
        file_ops.classify_file(F.col("file_name"), by_modification=True).alias("narrow_type"),
    )


def classify_reports(spark, sf):
    return listing(spark, sf).select(
        "listing_no", file_ops.classify_report(F.col("file_name")).alias("r")
    ).select("listing_no", "r.*")


def name_timestamp(spark, sf):
    def stamp(*extensions):
        found = file_ops.name_timestamp(F.col("file_name"), extensions)
        return F.date_format(found, "yyyy-MM-dd HH:mm:ss")

    return listing(spark, sf).select(
        "listing_no", stamp("csv").alias("csv_time"), stamp("csv", "enc").alias("any_time")
    )


NEWEST = ["extract_date", "study_name", "file_type", "listing_no", "file_name"]


def with_strays(spark, sf):
    """The listing with files that lie directly in a date folder, so of no study."""
    study = F.when(F.col("listing_no") % 43 != 0, F.col("study_name"))
    return listing(spark, sf).withColumn("study_name", study)


def latest_file_by_name(spark, sf):
    return file_ops.latest_by_name(with_strays(spark, sf), keep=["listing_no", "file_name"]).select(*NEWEST)


def latest_file_by_mtime(spark, sf):
    return file_ops.latest_by_modification(
        with_strays(spark, sf), keep=["listing_no", "file_name"]
    ).select(*NEWEST)


def latest_report_file(spark, sf):
    return file_ops.latest_reports(with_strays(spark, sf))


ALLOWED = [f"Sponsor ST-{i}-{j}" for i in range(0, 9, 2) for j in range(4)]


def allow_list(spark, sf):
    return file_ops.allow_list(listing(spark, sf), ALLOWED).select("listing_no", "study_name")


def aimed_at(file_name):
    report = file_ops.classify_report(file_name)
    return file_ops.target_table(report["report_name"], report["subreport_name"])


def target_map(spark, sf):
    return listing(spark, sf).select(
        "listing_no", aimed_at(F.col("file_name")).alias("target_table")
    )


def decrypt_names(spark, sf):
    kind = F.element_at(
        F.array(*[F.lit(t) for t in ("csv", "xlsx", "xls", "unknown")]),
        (F.col("listing_no") % 4 + 1).cast("int"),
    )
    name = F.when(F.col("listing_no") % 7 == 0, F.upper("file_name")).otherwise(F.col("file_name"))
    return listing(spark, sf).select("listing_no", output_name(name, kind).alias("output_name"))


def lineage_columns(spark, sf):
    named = file_ops.describe_paths(frame(spark, sf, "paths"))
    return named.select("path", "extract_date", "study_name", F.col("file_name").alias("source_file"))


TABLES = sorted({t for _, _, t in file_ops.TARGET_TABLES if t != file_ops.NO_TARGET})


def loaded_rows(spark, sf):
    """Each file but every third with the table that it was loaded into."""
    return listing(spark, sf).where("listing_no % 3 <> 0").select(
        aimed_at(F.col("file_name")).alias("t"),
        F.regexp_replace("study_name", "^Sponsor ", "").alias("study_protocol"),
        "extract_date",
    )


def tables_of(loaded):
    return {t: loaded.where(F.col("t") == t).drop("t") for t in TABLES}


def loaded_tables(spark, sf):
    """The curated tables, as if each file but every third had been loaded into its own."""
    return tables_of(loaded_rows(spark, sf))


def study_list(spark, sf):
    """Each study of the files times the report labels, as the sheet would list them."""
    labels = F.array(
        *[
            F.struct(
                F.lit(r).alias("r"), F.lit(s).cast("string").alias("s"), F.lit(i).alias("i")
            )
            for i, (r, s, _) in enumerate(file_ops.TARGET_TABLES)
        ]
    )
    studies = listing(spark, sf).groupBy("study_name").agg(F.min("listing_no").alias("n"))
    sheet = studies.select("study_name", "n", F.explode(labels).alias("l")).select(
        (F.col("n") * 10 + F.col("l.i")).cast("string").alias("S. No"),
        F.col("study_name").alias("Study Name"),
        F.lit("auto").alias("UI Mode"),
        F.col("l.r").alias("Report Name"),
        F.col("l.s").alias("SubReport Name"),
    )
    return status.read_study_list(sheet)


def study_status(spark, sf):
    newest = file_ops.latest_reports(snapshots.latest_snapshot(listing(spark, sf)))
    found = status.load_status(
        study_list(spark, sf),
        newest,
        snapshots.latest_members(loaded_tables(spark, sf)),
        TABLES,
        F.to_date(F.lit("20240130"), "yyyyMMdd"),
        "Sponsor",
    )
    return status.in_list_order(found)


def load_check(spark, sf):
    name = F.col("file_name")
    asked = listing(spark, sf).select(
        "listing_no",
        F.when(F.col("listing_no") % 11 != 0, name).alias("file_name"),
        aimed_at(name).alias("target_table"),
        F.regexp_replace("study_name", "^Sponsor ", "").alias("study_protocol"),
    )
    checked = status.check_loads(
        asked, snapshots.latest_members(loaded_tables(spark, sf)), TABLES
    )
    return checked.select("listing_no", "load_successful")


def dated(spark, sf):
    return members(spark, sf)


def snapshot_replace(spark, sf):
    """Two loads; the second replaces the dates it holds and leaves the others."""
    path = scratch(spark, "snapshot")
    m = dated(spark, sf)
    snapshots.replace_partitions(m, path, "extract_date", ["study_protocol"])
    again = m.where(F.col("extract_date") >= F.lit(LAST)).withColumn("event_type", F.lit("again"))
    snapshots.replace_partitions(again, path, "extract_date")
    snapshots.replace_partitions(again, path, "extract_date")
    return spark.read.parquet(path).select("event_type", "study_protocol", "extract_date")


def partition_replace(spark, sf):
    path = scratch(spark, "partition")
    m = dated(spark, sf)
    snapshots.replace_partitions(m, path, "event_type")
    late = m.where((F.col("event_type") == "view") & (F.col("extract_date") > F.lit(LAST)))
    snapshots.replace_partitions(late, path, "event_type")
    return spark.read.parquet(path).select("study_protocol", "extract_date", F.col("event_type").cast("string"))


def full_overwrite(spark, sf):
    path = scratch(spark, "full")
    m = dated(spark, sf)
    snapshots.overwrite(m, path)
    snapshots.overwrite(m.where(F.col("extract_date") < F.lit(FIRST)), path)
    return spark.read.parquet(path)


def atomic_replace(spark, sf):
    """Two declared dates are replaced, one of them by nothing; then a write that fails half way
    and one with a row of another date leave the table as it is."""
    path = scratch(spark, "versions")
    m = dated(spark, sf)
    dates = [LAST, LAST + dt.timedelta(days=1)]
    versions.replace_all(m, path, "extract_date")
    again = m.where(F.col("extract_date") == F.lit(LAST)).withColumn("event_type", F.lit("again"))
    for _ in range(2):
        versions.replace_values(again, path, "extract_date", dates)
    broken = again.withColumn("event_type", F.raise_error(F.lit("broken")).cast("string"))
    for bad in (broken, m):
        try:
            versions.replace_values(bad, path, "extract_date", dates)
        except (PySparkException, ValueError):
            continue
        raise AssertionError("a bad write went through")
    return versions.read_table(spark, path, m.schema, "extract_date")


def vanished_values(spark, sf):
    """Of three declared types one has no row in a later write, so its old rows go."""
    path = scratch(spark, "values")
    m = dated(spark, sf).withColumn("event_type", F.col("event_type").cast("string"))
    types = [r[0] for r in m.select("event_type").distinct().orderBy("event_type").limit(3).collect()]
    versions.replace_all(m, path, "event_type")
    late = m.where((F.col("event_type") == types[0]) & (F.col("extract_date") > F.lit(LAST)))
    versions.replace_values(late, path, "event_type", types)
    return versions.read_table(spark, path, m.schema, "event_type")


def atomic_overwrite(spark, sf):
    """The whole table twice; values that the second write lacks are gone."""
    path = scratch(spark, "whole")
    m = dated(spark, sf)
    versions.replace_all(m, path, "extract_date")
    versions.replace_all(m.where(F.col("extract_date") < F.lit(FIRST)), path, "extract_date")
    return versions.read_table(spark, path, m.schema, "extract_date")


def schema_drift(spark, sf):
    """A table under changing columns: a new column and a changed type are refused and leave it as
    it is, then a new column widens it, and a write without that column leaves it null."""
    path = scratch(spark, "drift")
    m = dated(spark, sf)
    versions.replace_all(m, path, "extract_date")
    last = m.where(F.col("extract_date") == F.lit(LAST))
    wider = last.withColumn("name_size", F.length("study_protocol"))
    for bad, drift in ((wider, "same"), (last.withColumn("study_protocol", F.lit(1)), "widen")):
        try:
            versions.replace_values(bad, path, "extract_date", [LAST], drift=drift)
        except ValueError:
            continue
        raise AssertionError("columns that differ went through")
    versions.replace_values(wider, path, "extract_date", [LAST], drift="widen")
    first = m.where(F.col("extract_date") == F.lit(FIRST)).withColumn("event_type", F.lit("late"))
    versions.replace_values(first, path, "extract_date", [FIRST], drift="widen")
    return versions.read_table(spark, path, None, "extract_date")


def csv_roundtrip(spark, sf):
    path = scratch(spark, "csv")
    t = frame(spark, sf, "texts").select("id", "raw_text", "raw_days", "raw_date")
    snapshots.write_csv(t, path)
    return snapshots.read_csv(spark, path, t.schema)


QUERIES = {
    "snapshot_catalogue": snapshot_catalogue,
    "snapshot_latest": snapshot_latest,
    "snapshot_range": snapshot_range,
    "latest_members": latest_members,
    "load_summary": load_summary,
    "coverage_pivot": coverage_pivot,
    "coverage_full_outer": coverage_full_outer,
    "watch_list_latest": watch_list_latest,
    "classify_files": classify_files,
    "classify_reports": classify_reports,
    "name_timestamp": name_timestamp,
    "latest_file_by_name": latest_file_by_name,
    "latest_file_by_mtime": latest_file_by_mtime,
    "latest_report_file": latest_report_file,
    "allow_list": allow_list,
    "target_map": target_map,
    "decrypt_names": decrypt_names,
    "lineage_columns": lineage_columns,
    "load_check": load_check,
    "study_status": study_status,
    "snapshot_replace": snapshot_replace,
    "partition_replace": partition_replace,
    "full_overwrite": full_overwrite,
    "atomic_replace": atomic_replace,
    "vanished_values": vanished_values,
    "atomic_overwrite": atomic_overwrite,
    "schema_drift": schema_drift,
    "csv_roundtrip": csv_roundtrip,
}

# --- the same in SQL -------------------------------------------------------------------

MEMBERS = cte("members")
NEWEST_DAY = "(select max(extract_date) from members)"
N = "lower(file_name)"


def kind_sql(summary: str, supply: str) -> str:
    return f"""case when not {N} like '%.csv' then null when {summary} then 'subject'
      when {N} like '%site%' and {N} like '%inventory%' then 'site' when {N} like '%depot%' and {N} like '%inventory%' then 'depot'
      when {N} like '%site%' and {supply} then 'slsm' when {N} like '%country%' and {supply} then 'clsm' end"""


WIDE = kind_sql(
    f"({N} like '%subject summary%' or {N} like '%participant summary%')",
    f"({N} like '%supplymethod%' or {N} like '%supply method%')",
)
NARROW = kind_sql(f"{N} like '%subject summary%'", f"{N} like '%supplymethod%'")
TIME = r"try_strptime(regexp_extract(file_name, '(\d{{4}}-\d{{2}}-\d{{2}}-\d{{2}}-\d{{2}}-\d{{2}})\.({0})$', 1), '%Y-%m-%d-%H-%M-%S')"
KNOWN = f"""known as (
  select *, {WIDE} as file_type, {NARROW} as narrow_type, {TIME.format('csv')} as csv_time, {TIME.format('csv|enc')} as any_time,
    case when not ({N} like '%.csv' or {N} like '%.enc') then null
      when {N} like '%subject summary%' or {N} like '%participant summary%' then
        case when not {N} like '%unblinded%' then 'Subject Summary' when {N} like '%subject%' then 'Subject Summary (Unblinded)' else 'Participant Summary (Unblinded)' end
      when {N} like '%subject visit summary%' then 'Subject Visit Summary'
      when {N} like '%inventory summary%' then 'Inventory Summary (Unblinded)'
      when {N} like '%inventory levels%' then 'Inventory Levels'
      when {N} like '%comparator supply%' or ({N} like '%supply method%' and not {N} like '%comparator%') then 'Comparator Supply (Unblinded)' end as report_name
  from files),
subs as (
  select *, case
      when report_name = 'Inventory Summary (Unblinded)' then case when {N} like '%site%' then 'Site Inventory Summary' when {N} like '%depot%' then 'Depot Inventory Summary' end
      when report_name = 'Inventory Levels' then case when {N} like '%site%' then 'Site' when {N} like '%depot%' then 'Depot' end
      when report_name = 'Comparator Supply (Unblinded)' then case when {N} like '%site%' then 'Site Level Supply Method' when {N} like '%country%' then 'Country Level Supply Method' end
    end as subreport_name
  from known),
targets(i, report, sub, tab) as (values
  (0, 'Comparator Supply (Unblinded)', 'Country Level Supply Method', 'clinical_supply_method_country_level'),
  (1, 'Comparator Supply (Unblinded)', 'Site Level Supply Method', 'clinical_supply_method_site_level'),
  (2, 'Inventory Levels', 'Site', 'NA'), (3, 'Inventory Levels', 'Depot', 'NA'),
  (4, 'Inventory Summary (Unblinded)', 'Site Inventory Summary', 'clinical_site_inventory'),
  (5, 'Inventory Summary (Unblinded)', 'Depot Inventory Summary', 'clinical_depot_inventory'),
  (6, 'Participant Summary (Unblinded)', null, 'clinical_subject_summary'), (7, 'Subject Summary', null, 'NA'),
  (8, 'Subject Summary (Unblinded)', null, 'clinical_subject_summary'), (9, 'Subject Visit Summary', null, 'NA')),
aimed as (
  select s.*, coalesce(t.tab, 'NA') as target_table, regexp_replace(study_name, '^Sponsor ', '') as study_protocol
  from subs s left join targets t on s.report_name = t.report and s.subreport_name is not distinct from t.sub),
loaded as (select target_table as tab, study_protocol, snapshot_date from aimed where listing_no % 3 <> 0 and target_table <> 'NA'),
present as (
  select distinct tab, study_protocol from loaded l
  where snapshot_date = (select max(snapshot_date) from loaded k where k.tab = l.tab))
"""
FILES = cte("files") + ",\n" + KNOWN


STRAY_SQL = " and listing_no % 43 <> 0"


def newest_sql(kind: str, time: str, keys: str, strays: bool = True) -> str:
    return f"""select * from (
      select *, row_number() over (partition by {keys} order by {time} desc, listing_no) as rn
      from subs where {kind} is not null and {time} is not null{STRAY_SQL if strays else ''}) where rn = 1"""


SETS = ", ".join(
    f"s_{t} as (select distinct study_protocol from members where event_type = '{t}' and extract_date = (select max(extract_date) from members where event_type = '{t}'))"
    for t in EVENT_TYPES
)
FIRST_OF = [f"s_{t}.study_protocol" for t in EVENT_TYPES]
COVERAGE = (
    MEMBERS
    + f", {SETS}, s_demand as (select distinct concat('ST-', c_custkey) as study_protocol from customer) select "
    + ", ".join(f"s_{t}.study_protocol as {t}" for t in EVENT_TYPES)
    + ", s_demand.study_protocol as demand from s_view"
    + "".join(
        f" full outer join s_{t} on coalesce({', '.join(FIRST_OF[:i + 1])}) = s_{t}.study_protocol"
        for i, t in enumerate([*EVENT_TYPES[1:], "demand"])
    )
)
DAY_OK = "regexp_full_match(d, '[0-9]{8}') and try_strptime(d, '%Y%m%d') is not null"
PATHS = cte("paths") + ", parts as (select path, split_part(path, '/', 3) as d, split_part(path, '/', 4) as study, split_part(path, '/', 5) as f from paths) "

ORACLES = {
    "snapshot_catalogue": PATHS
    + f"select distinct d as folder, cast(try_strptime(d, '%Y%m%d') as date) as extract_date from parts where {DAY_OK}",
    "lineage_columns": PATHS
    + f"select path, cast(case when {DAY_OK} then try_strptime(d, '%Y%m%d') end as date) as extract_date, case when {DAY_OK} then study end as study_name, f as source_file from parts",
    "snapshot_latest": MEMBERS + f"select * from members where extract_date = {NEWEST_DAY}",
    "snapshot_range": MEMBERS
    + f"select * from members where extract_date between date '{FIRST}' and date '{LAST}'",
    "latest_members": MEMBERS
    + "select distinct event_type as table_name, study_protocol from members m where extract_date = (select max(extract_date) from members k where k.event_type = m.event_type)",
    "load_summary": MEMBERS
    + """select event_type as table_name, max(extract_date) as max_extract_date, count(*) as row_count_at_max_extract_date, count(distinct study_protocol) as distinct_study_count
      from members m where extract_date = (select max(extract_date) from members k where k.event_type = m.event_type) group by event_type""",
    "coverage_pivot": COVERAGE,
    "coverage_full_outer": COVERAGE,
    "watch_list_latest": MEMBERS
    + f"select * from members where extract_date = {NEWEST_DAY} and study_protocol in (select concat('ST-', c_custkey) from customer where c_mktsegment = 'BUILDING')",
    "classify_files": FILES + "select listing_no, file_type, narrow_type from known",
    "classify_reports": FILES + "select listing_no, report_name, subreport_name from subs",
    "name_timestamp": FILES
    + "select listing_no, strftime(csv_time, '%Y-%m-%d %H:%M:%S') as csv_time, strftime(any_time, '%Y-%m-%d %H:%M:%S') as any_time from known",
    "latest_file_by_name": FILES
    + f"select snapshot_date as extract_date, study_name, file_type, listing_no, file_name from ({newest_sql('file_type', 'csv_time', 'snapshot_date, study_name, file_type')})",
    "latest_file_by_mtime": FILES
    + f"select snapshot_date as extract_date, study_name, narrow_type as file_type, listing_no, file_name from ({newest_sql('narrow_type', 'modified', 'snapshot_date, study_name, narrow_type')})",
    "latest_report_file": FILES
    + f"select snapshot_date as extract_date, study_name, report_name, subreport_name, file_name from ({newest_sql('report_name', 'any_time', 'snapshot_date, study_name, report_name, subreport_name')})",
    "allow_list": FILES
    + f"select listing_no, study_name from files where study_name in ({', '.join(repr(a) for a in ALLOWED)})",
    "target_map": FILES + "select listing_no, target_table from aimed",
    "decrypt_names": FILES
    + r""", k as (select listing_no, case when listing_no % 7 = 0 then upper(file_name) else file_name end as f, ['csv', 'xlsx', 'xls', 'unknown'][listing_no % 4 + 1] as t from files),
      b as (select listing_no, t, regexp_replace(f, '(?i)\.enc$', '') as f from k)
      select listing_no, case when t = 'unknown' then f else concat(regexp_replace(f, '([^.])\.[^.]*$', '\1'), '.', t) end as output_name from b""",
    "load_check": FILES
    + """select listing_no, case when listing_no % 11 <> 0 and target_table <> 'NA' then p.tab is not null end as load_successful
      from aimed a left join present p on a.target_table = p.tab and a.study_protocol = p.study_protocol""",
    "study_status": FILES
    + f""", newest as (select * from ({newest_sql('report_name', 'any_time', 'study_name, report_name, subreport_name', False).replace('from subs where', "from subs where snapshot_date = (select max(snapshot_date) from files) and")})),
      listed as (select study_name, min(listing_no) as n from files group by study_name),
      st as (select cast(n * 10 + i as int) as s_no, l.study_name, 'auto' as ui_mode, t.report as report_name, t.sub as subreport_name, t.tab as target_table,
          regexp_replace(l.study_name, '^Sponsor ', '') as study_protocol from listed l cross join targets t)
      select st.*, f.file_name, date '2024-01-30' as extract_date,
        case when f.file_name is not null and st.target_table <> 'NA' then p.tab is not null end as load_successful
      from st left join newest f on st.study_name = f.study_name and st.report_name = f.report_name and st.subreport_name is not distinct from f.subreport_name
      left join present p on st.target_table = p.tab and st.study_protocol = p.study_protocol""",
    "snapshot_replace": MEMBERS
    + f"select case when extract_date >= date '{LAST}' then 'again' else event_type end as event_type, study_protocol, extract_date from members",
    "partition_replace": MEMBERS
    + f"select study_protocol, extract_date, event_type from members where event_type <> 'view' or extract_date > date '{LAST}'",
    "full_overwrite": MEMBERS + f"select * from members where extract_date < date '{FIRST}'",
    "atomic_replace": MEMBERS
    + f"""select case when extract_date = date '{LAST}' then 'again' else event_type end as event_type, study_protocol, extract_date
      from members where extract_date <> date '{LAST}' + 1""",
    "vanished_values": MEMBERS
    + f""", t as (select event_type, row_number() over (order by event_type) as n from (select distinct event_type from members))
      select m.* from members m join t using (event_type) where n > 3 or (n = 1 and extract_date > date '{LAST}')""",
    "atomic_overwrite": MEMBERS + f"select * from members where extract_date < date '{FIRST}'",
    "schema_drift": MEMBERS
    + f"""select case when extract_date = date '{FIRST}' then 'late' else event_type end as event_type, study_protocol, extract_date,
      case when extract_date = date '{LAST}' then cast(length(study_protocol) as int) end as name_size from members""",
    "csv_roundtrip": cte("texts") + "select id, raw_text, raw_days, raw_date from texts",
}

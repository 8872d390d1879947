"""Queries on whole jobs: each writes its tables and reads them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dosecast.functions.rows import union_all
from dosecast.plans import jobs
from dosecast.plans.curate import curate_reports
from dosecast.queries import filing, planning, reading
from dosecast.queries.fixtures import AS_OF, HORIZON, frame, scratch
from dosecast.schemas import PLAN_TABLE, REPORTS, STATUS_TABLE

DAY, STAMP = reading.DAY, reading.STAMP

# File type -> report title, header line, line of a customer.
FILES = {
    "depot": (
        "Depot Inventory Summary",
        "Depot ID,Country,FP Expiry Date,Quantity Study Drug - Available,Approved Countries",
        "concat_ws(',', c_custkey % 30, concat('N', c_nationkey), if(c_custkey % 3 = 0, 'n/a', '05-Nov-2026'), "
        "c_custkey, if(file_no % 2 = 0 and c_custkey % 10 = 0, 'All', ''))",
    ),
    "site": (
        "Site Inventory Summary",
        "Site ID,Country,Location,Parent Depot,Quantity Study Drug - Assigned",
        "concat_ws(',', c_custkey % 40, concat('N', c_nationkey), concat('\"', c_mktsegment, ', left\"'), "
        "if(c_custkey % 7 = 0, 'x', cast(c_custkey % 9 as string)), c_custkey)",
    ),
    "slsm": (
        "Site Supply Method",
        "Site ID,Country,Comparator Name,Site Level Supply Method",
        "concat_ws(',', c_custkey % 40, concat('N', c_nationkey), c_name, if(c_custkey % 4 = 0, '', c_mktsegment))",
    ),
    "clsm": (
        "Country Supply Method",
        "Country,Comparator Name,Country Level Supply Method",
        "concat_ws(',', concat('N', c_nationkey), c_name, if(c_custkey % 4 = 0, 'NA', c_mktsegment))",
    ),
}


def report_files(spark, sf, file_type):
    """One file per fifty customers with the labels of the type as its header."""
    title, header, line = FILES[file_type]
    files = reading.csv_files(spark, sf, header, F.expr(line))
    code = F.expr(reading.CODE.format("file_no"))
    name = F.concat(F.lit("Sponsor "), code, F.lit(f"_{title}.csv"))
    return files.select("file_no", name.alias("file_name"), F.lit(DAY).alias("extract_date"), "content")


def curated(spark, sf, file_type, *columns):
    rows, _ = curate_reports(report_files(spark, sf, file_type), file_type, None, STAMP)
    return rows.select("study_protocol", "country", *columns, "extract_date", "source_file")


def curate_depot(spark, sf):
    return curated(
        spark, sf, "depot", "depot_id", "fp_expiry_date", "quantity_study_drug_available", "approved_countries"
    )


def curate_site(spark, sf):
    return curated(spark, sf, "site", "site_id", "location", "parent_depot", "quantity_study_drug_assigned")


def curate_site_supply(spark, sf):
    return curated(spark, sf, "slsm", "site_id", "comparator_name", "site_level_supply_method")


def curate_country_supply(spark, sf):
    return curated(spark, sf, "clsm", "comparator_name", "country_level_supply_method")


def curate_rejects(spark, sf):
    """Subject files with every fault: in their text, their name, and without a mapping."""
    top = F.when(F.col("file_no") % 4 == 3, F.repeat(F.lit("no header here\n"), 10)).otherwise("Report,\n")
    files = reading.csv_files(spark, sf, "Subject,Value", F.expr(reading.BROKEN_LINE), top)
    code = F.when(F.col("file_no") % 8 == 4, F.lit("no code ")).otherwise(
        F.expr(reading.CODE.format("file_no"))
    )
    name = F.concat(code, F.lit(" "), F.col("file_no").cast("string"), F.lit("_Subject Summary.csv"))
    named = files.select(name.alias("file_name"), F.lit(DAY).alias("extract_date"), "content")
    known = reading.customer(spark, sf).where("file_no % 16 <> 8").select(
        F.expr(reading.CODE.format("file_no")).alias("study")
    )
    sheet = known.distinct().select(
        F.lit("subject").alias("file_type"), "study", F.lit("Subject Number").alias("label"),
        F.lit("Subject").alias("spec"), F.lit(1).cast("long").alias("row_no"),
    )
    _, rejects = curate_reports(named, "subject", sheet, STAMP)
    return rejects.select("file_name", "extract_date", "study_code", "file_type", "reason")


def landed(spark, sf):
    """All five types on two days, each file once more under an older time."""
    subject = reading.subject_files(spark, sf).withColumn("file_type", F.lit("subject"))
    others = [report_files(spark, sf, t).withColumn("file_type", F.lit(t)) for t in FILES]
    stamps = F.array(*[F.lit(s) for s in ("2025-11-06-01-00-00", "2025-11-06-02-30-00")])
    days = F.array(F.lit(DAY), F.lit(DAY + dt.timedelta(days=1)))
    study = F.concat(F.lit("Sponsor "), F.expr(reading.CODE.format("file_no")))
    name = F.concat(F.regexp_replace("file_name", r"\.csv$", " "), F.col("stamp"), F.lit(".csv"))
    return (
        union_all([subject, *others])
        .withColumn("stamp", F.explode(stamps))
        .withColumn("extract_date", F.explode(days))
        .withColumns({"study_name": study, "file_name": name})
        .withColumn("path", F.concat_ws("/", F.col("extract_date").cast("string"), "study_name", "file_name"))
        .drop("stamp", "file_no", "file_type")
    )


def curate_job(spark, sf):
    """Files of two days to the five tables and the rejects; a second run changes nothing."""
    target = scratch(spark, "curate")
    sheet = reading.study_sheet(spark, sf, reading.specs_for_subjects()).where("file_no % 3 <> 2")
    for _ in range(2):
        jobs.curate_snapshots(landed(spark, sf), target, {"subject": sheet}, processed_at=STAMP)

    def back(table):
        return jobs.read_table(spark, target, table).withColumn("table_name", F.lit(table))

    rows = [
        back(table).select("table_name", "study_protocol", "country", "source_file", "extract_date")
        for _, table in REPORTS.values()
    ]
    rejects = back(jobs.REJECTS).select(
        "table_name", F.col("study_code").alias("study_protocol"), F.col("reason").alias("country"),
        F.col("file_name").alias("source_file"), "extract_date",
    )
    return union_all([*rows, rejects])


def decrypt_landing(spark, sf):
    target = scratch(spark, "landing")
    files = reading.sealed(spark, sf).select(
        F.date_add(F.lit(DAY), (F.col("doc_id") % 3).cast("int")).alias("extract_date"),
        F.concat(F.lit("Sponsor "), (F.col("doc_id") % 5).cast("string")).alias("study_name"),
        "file_name",
        "content",
    )
    jobs.decrypt_snapshots(files, reading.key(spark), target)
    return jobs.read_table(spark, target, jobs.LANDING).select(
        "extract_date", "study_name", "file_name", "success", "mode", "base64_decoded", "file_type",
        "output_name", F.md5("content").alias("content_md5"),
    )


def status_job(spark, sf):
    target = scratch(spark, "status")
    # Every table is read twice, for its newest date and for its studies.
    loaded = filing.loaded_rows(spark, sf).where(F.col("t").isin(*filing.TABLES)).persist()
    try:
        jobs.status_snapshots(
            filing.with_strays(spark, sf),
            filing.study_list(spark, sf),
            filing.tables_of(loaded),
            target,
            "Sponsor",
        )
    finally:
        loaded.unpersist()
    return jobs.read_table(spark, target, STATUS_TABLE)


def planned(spark, sf, target):
    jobs.plan_snapshot(
        frame(spark, sf, "subjects"),
        frame(spark, sf, "rules"),
        target,
        as_of=AS_OF,
        horizon_days=HORIZON,
        processed_at=planning.STAMP,
    )


def plan_job(spark, sf):
    """The plan from the rules table as it is; the job leaves unusable rules out."""
    target = scratch(spark, "plan")
    planned(spark, sf, target)
    return jobs.read_table(spark, target, PLAN_TABLE).drop("processed_timestamp")


def step_counts(spark, sf):
    """Rows of every step of two runs of the plan job, counted while they ran."""
    target = scratch(spark, "steps")
    for _ in range(2):
        planned(spark, sf, target)
    return jobs.run_steps(spark, target).select("job", "step_no", "step", "row_count")


def vanished_rejects(spark, sf):
    """Rejects of two days; then all files of the second day are good, and its rejects are gone."""
    target = scratch(spark, "rejects")
    sheet = reading.study_sheet(spark, sf, reading.specs_for_subjects())
    files = landed(spark, sf)
    jobs.curate_snapshots(files, target, {"subject": sheet.where("file_no % 3 <> 2")}, processed_at=STAMP)
    again = files.where(F.col("extract_date") > F.lit(DAY))
    jobs.curate_snapshots(again, target, {"subject": sheet}, processed_at=STAMP)
    return jobs.read_table(spark, target, jobs.REJECTS).select("study_code", "extract_date", "reason")


def load_range(spark, sf):
    """Lines of the date folders of a range, by two runs with a ledger. Before the second, one
    date gets another file; it reads that date again and no other."""
    root, target = scratch(spark, "folders"), scratch(spark, "ledger")
    days = [DAY + dt.timedelta(days=i) for i in range(5)]
    rows = reading.customer(spark, sf).select("c_custkey", F.col("c_name").alias("line"))

    def put(part, day, study):
        folder = f"{root}/{day:%Y%m%d}/Sponsor {study}"
        part.select("line").coalesce(1).write.mode("append").text(folder)

    for i, day in enumerate(days):
        put(rows.where(F.col("c_custkey") % 5 == i), day, "A")
    loads = []
    for run in range(2):
        files = jobs.snapshot_files(
            spark, root, pattern="part-*", start=days[1], end=days[3], ledger=jobs.loaded_files(spark, target)
        )
        lines = files.select("extract_date", "study_name", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line"))
        loads.append(lines.where("line <> ''").withColumn("run", F.lit(run)))
        loads[-1].write.parquet(f"{target}/run-{run}")
        jobs.record_files(files, target)
        put(rows.where(F.col("c_custkey") % 5 == 0), days[2], "B")
    return spark.read.schema(loads[0].schema).parquet(f"{target}/run-0", f"{target}/run-1")


QUERIES = {
    "curate_depot": curate_depot,
    "curate_site": curate_site,
    "curate_site_supply": curate_site_supply,
    "curate_country_supply": curate_country_supply,
    "curate_rejects": curate_rejects,
    "curate_job": curate_job,
    "decrypt_landing": decrypt_landing,
    "status_job": status_job,
    "plan_job": plan_job,
    "step_counts": step_counts,
    "vanished_rejects": vanished_rejects,
    "load_range": load_range,
}

# --- the same in SQL -------------------------------------------------------------------


def rows_sql(file_type: str, columns: str) -> str:
    name = f"concat('Sponsor ', {reading.SQL_CODE}, '_{FILES[file_type][0]}.csv')"
    return (
        reading.CUSTOMER
        + f"""select {reading.SQL_CODE} as study_protocol, concat('N', c_nationkey) as country, {columns},
      date '{DAY}' as extract_date, {name} as source_file from c"""
    )


# Table, title, and country; subject files of some studies have no mapping.
JOB_TABLES = [(REPORTS[t][1], title, "concat('N', c_nationkey)", "true") for t, (title, _, _) in FILES.items()]
JOB_TABLES.append(
    (
        REPORTS["subject"][1],
        "Subject Summary",
        f"case when file_no % 2 = 1 then coalesce({reading.LAND}, c_mktsegment) else c_mktsegment end",
        "file_no % 3 <> 2",
    )
)


def job_sql() -> str:
    name = "concat('Sponsor ', {code}, '_{title} 2025-11-06-02-30-00.csv') as source_file"
    parts = [
        f"""select '{table}' as table_name, {reading.SQL_CODE} as study_protocol, {country} as country,
        {name.format(code=reading.SQL_CODE, title=title)} from c where {kept}"""
        for table, title, country, kept in JOB_TABLES
    ]
    parts.append(
        f"""select distinct '{jobs.REJECTS}', {reading.SQL_CODE}, 'no_header_mapping',
        {name.format(code=reading.SQL_CODE, title='Subject Summary')} from c where file_no % 3 = 2"""
    )
    days = f"(values (date '{DAY}'), (date '{DAY + dt.timedelta(days=1)}')) as d(extract_date)"
    return f"{reading.CUSTOMER} select a.*, d.extract_date from ({' union all '.join(parts)}) a cross join {days}"


REJECT_CODE = "case when file_no % 8 <> 4 then " + reading.SQL_CODE + " end"

ORACLES = {
    "curate_depot": rows_sql(
        "depot",
        """cast(c_custkey % 30 as int) as depot_id, case when c_custkey % 3 <> 0 then date '2026-11-05' end as fp_expiry_date,
      c_custkey as quantity_study_drug_available,
      case when max(case when file_no % 2 = 0 and c_custkey % 10 = 0 then 1 end) over (partition by file_no) is null then concat('N', c_nationkey)
        when file_no % 2 = 0 and c_custkey % 10 = 0 then 'All' end as approved_countries""",
    ),
    "curate_site": rows_sql(
        "site",
        """cast(c_custkey % 40 as int) as site_id, concat(c_mktsegment, ', left') as location,
      case when c_custkey % 7 <> 0 then cast(c_custkey % 9 as int) end as parent_depot, c_custkey as quantity_study_drug_assigned""",
    ),
    "curate_site_supply": rows_sql(
        "slsm",
        """cast(c_custkey % 40 as varchar) as site_id, c_name as comparator_name,
      case when c_custkey % 4 <> 0 then c_mktsegment end as site_level_supply_method""",
    ),
    "curate_country_supply": rows_sql(
        "clsm",
        "c_name as comparator_name, case when c_custkey % 4 <> 0 then c_mktsegment end as country_level_supply_method",
    ),
    "curate_rejects": reading.CUSTOMER
    + f"""select distinct concat(coalesce({REJECT_CODE}, 'no code '), ' ', file_no, '_Subject Summary.csv') as file_name,
      date '{DAY}' as extract_date, {REJECT_CODE} as study_code, 'subject' as file_type,
      case when file_no % 8 = 4 then 'no_study_code' when file_no % 16 = 8 then 'no_header_mapping'
        else case file_no % 4 when 1 then 'long_row' when 2 then 'open_quote' else 'no_header' end end as reason
      from c where file_no % 4 = 3 or (file_no % 4 = 1 and c_custkey % 50 = 17) or (file_no % 4 = 2 and c_custkey % 50 = 23)
        or file_no % 8 = 4 or file_no % 16 = 8""",
    "curate_job": job_sql(),
    "decrypt_landing": reading.ORACLES["decrypt_job"]
    .replace("select doc_id, kind not in", f"select date '{DAY}' + cast(doc_id % 3 as int) as extract_date, concat('Sponsor ', doc_id % 5) as study_name, file_name, kind not in")
    .replace("cast(case when kind not in (3, 7) then n end as int) as output_size, ", ""),
    "status_job": filing.FILES
    + f""", newest as (select * from ({filing.newest_sql('report_name', 'any_time', 'snapshot_date, study_name, report_name, subreport_name')})),
      listed as (select study_name, min(listing_no) as n from files group by study_name),
      st as (select cast(n * 10 + i as int) as s_no, l.study_name, 'auto' as ui_mode, t.report as report_name, t.sub as subreport_name, t.tab as target_table,
          regexp_replace(l.study_name, '^Sponsor ', '') as study_protocol, d.extract_date
        from listed l cross join targets t cross join (select distinct snapshot_date as extract_date from files) d)
      select st.*, f.file_name,
        case when f.file_name is not null and st.target_table <> 'NA' then p.tab is not null end as load_successful
      from st left join newest f on st.extract_date = f.snapshot_date and st.study_name = f.study_name and st.report_name = f.report_name
        and st.subreport_name is not distinct from f.subreport_name
      left join present p on st.target_table = p.tab and st.study_protocol = p.study_protocol""",
    "plan_job": planning.ORACLES["flagship_projection"],
    "step_counts": planning.rolled_ctes(planning.RULE_FILTER)
    + planning.visit_ctes("rolled", "parsed_last_visit_cycle", "parsed_last_visit_day")
    + """select t.*, 'plan' as job from (select unnest([
        {'step_no': 0, 'step': 'subjects', 'row_count': (select count(*) from subjects)},
        {'step_no': 1, 'step': 'active', 'row_count': (select count(*) from s)},
        {'step_no': 2, 'step': 'scoped', 'row_count': (select count(*) from m where rule_scope = 0)},
        {'step_no': 3, 'step': 'generic', 'row_count': (select count(*) from m where rule_scope = 1)},
        {'step_no': 4, 'step': 'not_overridden', 'row_count': (select count(*) from kept)},
        {'step_no': 5, 'step': 'with_drug', 'row_count': (select count(*) from needed)},
        {'step_no': 6, 'step': 'subject_drugs', 'row_count': (select count(*) from rolled)},
        {'step_no': 7, 'step': 'visits', 'row_count': (select count(*) from visit)}], recursive := true)) t, range(2)""",
    "vanished_rejects": reading.CUSTOMER
    + f"""select distinct {reading.SQL_CODE} as study_code, date '{DAY}' as extract_date, 'no_header_mapping' as reason
      from c where file_no % 3 = 2""",
    "load_range": f"""with p as (select c_name as line, date '{DAY}' + cast(c_custkey % 5 as int) as extract_date from customer),
      x as (select line, extract_date, 'Sponsor A' as study_name from p
        union all select line, date '{DAY}' + 2, 'Sponsor B' from p where extract_date = date '{DAY}')
      select *, 0 as run from x where study_name = 'Sponsor A' and extract_date between date '{DAY}' + 1 and date '{DAY}' + 3
      union all select *, 1 as run from x where extract_date = date '{DAY}' + 2""",
}

"""The jobs do each part of their work once, and leave nothing behind in the session."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from dosecast.plans import jobs
from dosecast.sources import files as file_ops
from dosecast.sources import headers, reports

DAY = dt.date(2025, 11, 6)


def test_every_report_file_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def opened(content):
        reads.add(1)
        return content

    titles = {
        "Depot Inventory Summary": "Depot ID,Country\n1,N1\n",
        "Site Inventory Summary": "Site ID,Country\n2,N2\n",
        "Country Supply Method": "no header\n",
    }
    files = spark.createDataFrame(
        [
            (f"{s}/{t}", DAY, f"Sponsor AB-CD-1-{s}", f"Sponsor AB-CD-1-{s}_{t} 2025-11-06-01-00-00.csv", bytearray(c, "utf8"))
            for s in range(3)
            for t, c in titles.items()
        ],
        "path string, extract_date date, study_name string, file_name string, content binary",
    )
    target, kept = str(tmp_path), set(spark.sparkContext._jsc.getPersistentRDDs())
    jobs.curate_snapshots(files.withColumn("content", opened("content")), target, {})
    assert reads.value == 9
    assert jobs.read_table(spark, target, jobs.REJECTS).where("reason = 'no_header'").count() == 3
    assert jobs.read_table(spark, target, "clinical_site_inventory").count() == 3
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept


def test_plan_files_do_not_grow_with_the_studies(spark, tmp_path):
    def plan(*studies):
        subjects = spark.createDataFrame(
            [(f"ST-{s}", n, "Arm", dt.date(2025, 1, 1), "Cycle 1 Day 1", DAY) for s in studies for n in range(2)],
            "study_protocol string, subject_number long, randomized_treatment string, "
            "last_study_visit_date date, last_study_visit_recorded string, extract_date date",
        )
        rules = subjects.select("study_protocol", "randomized_treatment").distinct().selectExpr(
            "*", "'Drug 1mg' AS study_drug_dispensed", "'1' AS visit_days", "1L AS dispensing_quantity",
            "28L AS dispensing_frequency_days", "string(null) AS subject_status", "string(null) AS country",
            "double(null) AS max_cycles", "string(null) AS tpc", "string(null) AS additional_study_drug_dispensed",
        )
        jobs.plan_snapshot(subjects, rules, str(tmp_path), as_of=DAY, horizon_days=60)
        return jobs.read_table(spark, str(tmp_path), "clinical_demand_plan")

    first = plan(*range(60))
    per_study = {r.study_name: r["count"] for r in first.groupBy("study_name").count().collect()}
    assert len(per_study) == 60 and len(set(per_study.values())) == 1
    assert len(list((tmp_path / "clinical_demand_plan").rglob("part-*.parquet"))) < 60
    again = plan(3, 99)
    assert again.count() == first.count() * 61 // 60


def test_status_job_classifies_the_loaded_files_once(spark, monkeypatch):
    plans, run = [], jobs.status_snapshots

    def watched(listing, studies, tables, *rest):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in tables.values())
        run(listing, studies, tables, *rest)

    monkeypatch.setattr(jobs, "status_snapshots", watched)
    status_job = entry_points.queries()["status_job"]
    assert status_job(spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) > 1 and all(p.count("InMemoryRelation") == 1 for p in plans)


def test_names_and_sheets_are_worked_out_once(spark, tmp_path):
    names, cells = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def named(name):
        names.add(1)
        return name

    @F.udf("string")
    def told(study):
        cells.add(1)
        return study

    files = spark.createDataFrame(
        [
            (f"{s}/{c}", DAY, f"Sponsor AB-CD-1-{s}", f"AB-CD-1-{s}_Subject Summary 2025-11-06-0{c}-00-00.csv", bytearray(f"Subj,Land\n{s},N{c}\n", "utf8"))
            for s in range(4)
            for c in range(2)
        ],
        "path string, extract_date date, study_name string, file_name string, content binary",
    )
    newest = file_ops.latest_by_name(files.drop("content").withColumn("file_name", named("file_name")))
    assert sorted(r.path for r in newest.collect()) == [f"{s}/1" for s in range(4)]
    assert names.value == 8
    rows = [("subject", f"AB-CD-1-{s}", label, spec, i) for s in range(3) for i, (label, spec) in enumerate((("Subject Number", "Subj"), ("Country", "Land")))]
    sheet = spark.createDataFrame(rows, "file_type string, study string, label string, spec string, row_no long")
    told_sheet, target = sheet.withColumn("study", told("study")), str(tmp_path)
    headers.header_map(told_sheet).collect()
    once = cells.value
    jobs.curate_snapshots(files, target, {"subject": told_sheet})
    assert cells.value == 2 * once
    back = jobs.read_table(spark, target, "clinical_subject_summary")
    assert sorted((r.study_protocol, r.subject_number, r.country) for r in back.collect()) == [(f"AB-CD-1-{s}", s, "N1") for s in range(3)]
    rejects = jobs.read_table(spark, target, jobs.REJECTS).select("study_code", "reason").collect()
    assert [tuple(r) for r in rejects] == [("AB-CD-1-3", "no_header_mapping")]


def test_files_unfold_to_the_rows_of_their_records(spark):
    text = 'a,b,c\n1,NA,"x, ""y"""\n,2\n\n3,4,\n'
    labels = ["a", "First", "Fixed", "None"]
    specs = F.create_map(*[F.lit(v) for v in ("First", "b, c", "Fixed", "x=told")])
    files = spark.createDataFrame([(1, text), (2, text.replace('"', "").replace("x, ", "")), (3, "a,b\n"), (4, "none")], "n int, content string")
    resolved = headers.resolve_labels(reports.parse_reports(files).withColumn("specs", specs), labels)
    by_row = headers.harmonise(reports.report_rows(resolved), labels, ["n"]).collect()
    rows = headers.harmonise_files(resolved, labels, ["n"]).collect()
    assert sorted(rows, key=str) == sorted(by_row, key=str)
    assert (1, "1", 'x, "y"', "told", None) in rows and (2, "1", "y", "told", None) in rows and len(rows) == 6

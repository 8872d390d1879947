"""Listing, snapshots, load status, coverage, tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dosecast import schemas
from dosecast.operators import coverage, snapshots
from dosecast.plans import jobs, status
from dosecast.sources import envelope
from dosecast.sources import files as file_ops

D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


@pytest.fixture
def landing(tmp_path):
    names = [
        "20250101/Co S1/Co S1_Subject Summary2025-01-01-10-00-00.csv",
        "20250101/Co S1/Co S1_Subject Summary2025-01-01-11-00-00.csv",
        "20250101/Co S1/Co S1+Site Inventory Summary (Unblinded)2025-01-01-11-00-00.enc",
        "20250102/Co S2/Co S2_Depot Inventory Summary2025-01-02-11-00-00.csv",
        "20250102/direct.enc",
        "20251399/Co S1/Co S1_Subject Summary2025-01-01-11-00-00.csv",
        "notes/Co S1/x.csv",
    ]
    for n in names:
        path = tmp_path / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("a,b\n1,2\n")
    return str(tmp_path)


def test_listing_finds_both_depths_and_reads_no_content(spark, landing):
    listed = file_ops.list_files(spark, landing)
    assert listed.count() == 7
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    described = {
        (r.extract_date, r.study_name, r.file_name)
        for r in file_ops.describe_paths(listed).where("extract_date is not null").collect()
    }
    assert (D2, None, "direct.enc") in described
    assert (D1, "Co S1", "Co S1+Site Inventory Summary (Unblinded)2025-01-01-11-00-00.enc") in described
    assert len(described) == 5


def test_catalogue_and_globs(spark, landing):
    got = file_ops.snapshot_catalogue(file_ops.list_files(spark, landing)).collect()
    assert [(r.folder, r.extract_date) for r in got] == [("20250101", D1), ("20250102", D2)]
    assert file_ops.read_files(spark, landing, "20250102", "*.enc").select("content").count() == 1


def test_newest_file_by_name(spark, landing):
    listed = file_ops.describe_paths(file_ops.list_files(spark, landing)).where("extract_date is not null")
    got = file_ops.latest_by_name(listed).select("study_name", "file_type", "file_name").collect()
    assert sorted(map(tuple, got)) == [
        ("Co S1", "subject", "Co S1_Subject Summary2025-01-01-11-00-00.csv"),
        ("Co S2", "depot", "Co S2_Depot Inventory Summary2025-01-02-11-00-00.csv"),
    ]


def test_ties_and_bad_names(spark):
    t = "2025-01-01-10-00-00"
    names = [("b", f"Subject Summary{t}.csv"), ("a", f"Subject Summary{t}.csv"), ("c", "Subject Summary2025-02-30-10-00-00.csv"),
             ("d", f"Subject Summary{t}.CSV"), ("e", "Subject Summary.csv")]
    df = spark.createDataFrame([(D1, "S", p, n) for p, n in names], "extract_date date, study_name string, path string, file_name string")
    assert [r.path for r in file_ops.latest_by_name(df).collect()] == ["a"]


@pytest.mark.parametrize(
    "name,kind,narrow",
    [
        ("X Participant Summary.csv", "subject", None),
        ("Site Subject Summary inventory.CSV", "subject", "subject"),
        ("site Inventory.csv", "site", "site"),
        ("Depot inventory.csv", "depot", "depot"),
        ("Site Level Supply Method.csv", "slsm", None),
        ("Country SupplyMethod.csv", "clsm", "clsm"),
        ("Country list.csv", None, None),
        ("Subject Summary.enc", None, None),
    ],
)
def test_file_types(spark, name, kind, narrow):
    df = spark.createDataFrame([(name,)], "n string")
    assert tuple(df.select(file_ops.classify_file(F.col("n")), file_ops.classify_file(F.col("n"), True)).first()) == (kind, narrow)


def test_status_is_tri_state(spark):
    study_list = status.read_study_list(
        spark.createDataFrame(
            [("2", "Co S1", "m", "Subject Summary (Unblinded)", None, "kept"),
             ("1", "Co S2", "m", "Subject Summary (Unblinded)", None, "kept"),
             ("x", "Co S3", "m", "Subject Summary (Unblinded)", None, "kept"),
             ("3", "Co S1", "m", "Inventory Levels", "Site", "kept")],
            "`S. No` string, `Study Name` string, `UI Mode` string, `Report Name` string, `SubReport Name` string, note string",
        )
    )
    newest = spark.createDataFrame(
        [("Co S1", "Subject Summary (Unblinded)", None, "f1"), ("Co S2", "Subject Summary (Unblinded)", None, "f2"), ("Co S1", "Inventory Levels", "Site", "f3")],
        "study_name string, report_name string, subreport_name string, file_name string",
    )
    loaded = spark.createDataFrame([("S1", D2), ("S2", D1), (None, D2)], "study_protocol string, extract_date date")
    members = snapshots.latest_members({"clinical_subject_summary": loaded})
    got = status.in_list_order(
        status.load_status(study_list, newest, members, ["clinical_subject_summary"], F.lit(D2), "Co")
    ).collect()
    assert [(r.s_no, r.study_protocol, r.file_name, r.target_table, r.load_successful, r.note) for r in got] == [
        (None, "S3", None, "clinical_subject_summary", None, "kept"),
        (1, "S2", "f2", "clinical_subject_summary", False, "kept"),
        (2, "S1", "f1", "clinical_subject_summary", True, "kept"),
        (3, "S1", "f3", "NA", None, "kept"),
    ]
    older = snapshots.latest_members({"t": loaded}, as_of=D1).collect()
    assert [r.study_protocol for r in older] == ["S2"]


def test_coverage_keeps_null_members_apart(spark):
    def one(*values):
        return spark.createDataFrame([(v,) for v in values], "s string")

    sets = {"a": one("x", "x", None), "b": one("x", "y", None), "c": one("z")}
    got = sorted(map(tuple, coverage.coverage(sets).collect()), key=str)
    chain = sorted(map(tuple, coverage.coverage_by_joins(sets).collect()), key=str)
    assert got == chain
    assert got.count((None, None, None)) == 2 and ("x", "x", None) in got


def test_snapshot_choice(spark):
    df = spark.createDataFrame([(1, D1), (2, D2), (3, None)], "i int, extract_date date")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(snapshots.latest_snapshot(df)) == [2]
    assert ids(snapshots.snapshot_range(df)) == [1, 2, 3]
    assert ids(snapshots.snapshot_range(df, start=D2)) == [2]
    assert ids(snapshots.snapshot_range(df, end=D1)) == [1]
    assert ids(snapshots.snapshot_range(df, start=D1, end=D1)) == [1]
    assert ids(snapshots.snapshot_range(df, end=D1, historical=False)) == [2]


def test_load_summary_of_an_empty_table(spark):
    df = spark.createDataFrame([("S1", D1), (None, D1), ("S1", D1)], "study_protocol string, extract_date date")
    got = snapshots.load_summary({"full": df, "empty": df.where("false")}).collect()
    assert sorted(map(tuple, got)) == [("empty", None, 0, 0), ("full", D1, 3, 1)]


def test_replace_partitions_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, D1), (2, D2)], "i int, extract_date date")
    snapshots.replace_partitions(df, path, "extract_date")
    again = spark.createDataFrame([(5, D2)], "i int, extract_date date")
    for _ in range(2):
        snapshots.replace_partitions(again, path, "extract_date")
    assert sorted((r.i, r.extract_date) for r in spark.read.parquet(path).collect()) == [(1, D1), (5, D2)]


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, D1), (2, D2)], "i int, extract_date date")
    snapshots.replace_partitions(df, path, "extract_date")
    plan = snapshots.latest_snapshot(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan and "Subquery" in plan


def test_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS trial CASCADE")
    schemas.create_tables(spark, "trial")
    schemas.create_tables(spark, "trial", recreate=True)
    found = {r.tableName for r in spark.sql("SHOW TABLES IN trial").collect()}
    assert found == set(schemas.table_schemas())
    widths = {n: len(s) for n, (s, _) in schemas.table_schemas().items()}
    assert widths == {
        "clinical_subject_summary": 30, "clinical_depot_inventory": 24, "clinical_site_inventory": 26,
        "clinical_supply_method_site_level": 9, "clinical_supply_method_country_level": 7,
        "clinical_treatment_groups": 13, "clinical_demand_plan": 16, "clinical_studylist_status": 10,
    }
    row = spark.createDataFrame([("S1", "C", "N", "M", D1, "f", dt.datetime(2025, 1, 1))], schemas.report_schema("clsm"))
    for _ in range(2):
        snapshots.replace_table_partitions(row, "trial.clinical_supply_method_country_level", "extract_date")
    snapshots.replace_table_partitions(row.withColumn("extract_date", F.lit(D2)), "trial.clinical_supply_method_country_level", "extract_date")
    assert spark.table("trial.clinical_supply_method_country_level").count() == 2


def test_jobs_refuse_empty_input(spark, tmp_path):
    columns = "path string, extract_date date, study_name string, file_name string, content binary"
    none = spark.createDataFrame([], columns)
    with pytest.raises(ValueError, match="no rows"):
        jobs.curate_snapshots(none, str(tmp_path), {})
    with pytest.raises(ValueError, match="no rows"):
        jobs.decrypt_snapshots(none, envelope.key_frame(spark, "MDEyMzQ1Njc4OWFiY2RlZg=="), str(tmp_path))


def test_snapshot_files_needs_a_date_folder(spark, tmp_path):
    (tmp_path / "archive" / "Sponsor X").mkdir(parents=True)
    (tmp_path / "archive" / "Sponsor X" / "a.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="date folders"):
        jobs.snapshot_files(spark, str(tmp_path))
    (tmp_path / "20251106" / "Sponsor X").mkdir(parents=True)
    (tmp_path / "20251106" / "Sponsor X" / "b.csv").write_text("a,b\n")
    found = jobs.snapshot_files(spark, str(tmp_path)).select("file_name", "study_name").collect()
    assert [tuple(r) for r in found] == [("b.csv", "Sponsor X")]


DEPOT_FILE = "Title,\nDepot ID,Land,FP Expiry Date\n1,{},05-Nov-2025\n"


def test_curate_folder_reads_changed_dates(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")

    def put(day, code, body, study="Co"):
        folder = root / day / study
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"Co {code}_Depot Inventory 2025-11-06-01-00-00.csv").write_text(body)

    def run(**options):
        return jobs.curate_folder(spark, str(root), target, {}, processed_at=dt.datetime(2025, 11, 6), **options)

    def rows(table="clinical_depot_inventory"):
        return sorted((str(r.extract_date), r.study_code if table == jobs.REJECTS else r.study_protocol)
                      for r in jobs.read_table(spark, target, table).collect())

    for day in ("20251105", "20251106", "20251107"):
        put(day, "AB-CD-1-2", DEPOT_FILE.format(day))
    put("20251106", "AB-CD-3-4", DEPOT_FILE.format("x" * 5000), "Large")
    d5, d6, d7 = (dt.date(2025, 11, d) for d in (5, 6, 7))
    # The newest date alone, then a range; files over the bound are not opened.
    assert run(max_bytes=1000) == [d7] and rows() == [("2025-11-07", "AB-CD-1-2")]
    assert run(start=d6, historical=True, max_bytes=1000) == [d6]
    assert rows() == [("2025-11-06", "AB-CD-1-2"), ("2025-11-07", "AB-CD-1-2")]
    assert rows(jobs.REJECTS) == [("2025-11-06", "AB-CD-3-4")]
    assert run(start=d6, historical=True) == []
    # A changed file makes its date come again, whole, and its rejects go.
    put("20251106", "AB-CD-3-4", DEPOT_FILE.format("Land"), "Large")
    assert run(end=d6, historical=True, max_bytes=1000) == [d5, d6]
    assert rows() == [("2025-11-05", "AB-CD-1-2"), ("2025-11-06", "AB-CD-1-2"), ("2025-11-06", "AB-CD-3-4"), ("2025-11-07", "AB-CD-1-2")]
    assert rows(jobs.REJECTS) == []
    assert run(historical=True) == []
    steps = jobs.run_steps(spark, target).where("step = 'clinical_depot_inventory'").collect()
    assert sorted(r.row_count for r in steps) == [1, 1, 3]


def test_landing_tells_why_and_keeps_files_apart(spark, tmp_path):
    secret = envelope.key_frame(spark, "MDEyMzQ1Njc4OWFiY2RlZg==")
    rows = [(D1, "S", "a.enc", None, True), (D1, "S", "b.enc", b"no envelope", False)]
    columns = "extract_date date, study_name string, file_name string, content binary, too_large boolean"
    jobs.decrypt_snapshots(spark.createDataFrame(rows, columns), secret, str(tmp_path))
    found = {r.file_name: (r.success, r.reason) for r in jobs.read_table(spark, str(tmp_path), jobs.LANDING).collect()}
    assert found == {"a.enc": (False, "too_large"), "b.enc": (False, "not_opened")}
    twins = [(D1, "S", n, True, "x.csv", b"") for n in ("x.csv.enc", "x.enc")]
    landing = spark.createDataFrame(twins, "extract_date date, study_name string, file_name string, success boolean, output_name string, content binary")
    assert jobs.landed_files(landing).select("path").distinct().count() == 2

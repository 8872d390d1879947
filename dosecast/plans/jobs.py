"""The jobs from end to end: decrypt, curate, plan and status, over one or many snapshots.

Each takes DataFrames and a target folder of the session's file system. Its tables are versioned
(``operators/versions.py``): a write replaces the dates (or studies) that the job was given, as a
whole or not at all, so a job may run again, and a date whose rows vanished becomes empty. Every
job appends the rows of its steps to a run table. An input without any row is an error, since it
would pass for an empty report.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions import rows as row_ops
from dosecast.functions import text
from dosecast.operators import match, versions
from dosecast.operators.joins import is_small
from dosecast.operators.snapshots import latest_members, latest_snapshot, snapshot_range
from dosecast.operators.steps import StepCounts
from dosecast.plans.curate import curate_judged, header_maps, judge_files, parse_files, rejected_files
from dosecast.plans.demand import plan_demand, prepare_subjects
from dosecast.plans.status import load_status
from dosecast.schemas import PLAN_TABLE, REPORTS, STATUS_SCHEMA, STATUS_TABLE
from dosecast.sources import envelope
from dosecast.sources import files as file_ops

# Columns without which a rule serves nobody.
REQUIRED_RULE_COLUMNS = ("dispensing_quantity", "dispensing_frequency_days", "visit_days")
REJECTS = "rejected_reports"
LANDING = "landed_files"
LEDGER = "loaded_files"
STEPS = "run_steps"
# Column by which each table is cut, of those not cut by date.
CUT_BY = {PLAN_TABLE: "study_name"}
DATE = "extract_date"


def table_path(target: str, table: str) -> str:
    return f"{target.rstrip('/')}/{table}"


def read_table(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A table that a job wrote, as it is now."""
    return versions.read_table(spark, table_path(target, table), None, CUT_BY.get(table, DATE))


def run_steps(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the steps of all runs: ``run_at, job, step_no, step, row_count``."""
    return spark.read.parquet(table_path(target, STEPS))


def refuse_empty(df: DataFrame, what: str) -> DataFrame:
    """The DataFrame itself; a ValueError where it has no row."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


def _distinct(df: DataFrame, column: str) -> list:
    """The values by which a table is cut, calendar days or studies: a short list."""
    return [r[0] for r in df.select(column).distinct().collect()]


def snapshot_files(
    spark: SparkSession,
    root: str,
    folders: str = "*",
    pattern: str = "*",
    start: dt.date | None = None,
    end: dt.date | None = None,
    historical: bool = True,
    ledger: DataFrame | None = None,
    max_bytes: int = file_ops.MAX_FILE_BYTES,
) -> DataFrame:
    """Files of the date folders of ``root`` from ``start`` to ``end``, with content and
    ``too_large`` (then without); of the newest date alone unless ``historical``.

    Dates are chosen from the listing, before content is read. With a ``ledger`` (that of
    ``record_files``) only the dates whose files changed since come, whole; no row if none did.
    An error where no date folder of the range has a file.
    """
    listed = file_ops.describe_paths(file_ops.list_files(spark, root, folders, pattern))
    dated = listed.where(F.col(DATE).isNotNull())
    chosen = snapshot_range(dated, DATE, start, end, historical)
    refuse_empty(chosen, f"files in date folders of {root}")
    names = _distinct(file_ops.changed_dates(chosen, ledger), "folder")
    read = file_ops.read_bounded_files(spark, root, names or folders, pattern, max_bytes)
    return file_ops.describe_paths(read if names else read.limit(0)).where(F.col(DATE).isNotNull())


def record_files(files: DataFrame, target: str) -> None:
    """Note in the ledger of ``target`` that these files, whole dates of them, were loaded. To be
    called last: a run that stops before it loads its dates again."""
    seen = files.select(*file_ops.LEDGER)
    versions.replace_values(seen, table_path(target, LEDGER), DATE, _distinct(seen, DATE))


def loaded_files(spark: SparkSession, target: str) -> DataFrame | None:
    """The ledger of ``target``; None before the first load."""
    if versions.table_schema(spark, table_path(target, LEDGER)) is None:
        return None
    return read_table(spark, target, LEDGER)


def decrypt_snapshots(
    files: DataFrame, key: DataFrame, target: str, run_at: dt.datetime | None = None
) -> None:
    """Decrypt ``extract_date, study_name, file_name, content`` rows into the landing table.

    Files that cannot be opened land as rows without content and ``success`` false. ``reason``
    tells ``too_large`` (if ``files`` has that column) from ``not_opened``.
    """
    spark, large = files.sparkSession, F.lit(False)
    if "too_large" in files.columns:
        large = F.coalesce("too_large", large)
    chosen = files.select(DATE, "study_name", "file_name", "content", large.alias("too_large"))
    opened = envelope.decrypt_files(refuse_empty(chosen, "encrypted files"), key)
    reason = F.when(F.col("too_large"), "too_large").when(~F.col("success"), "not_opened")
    steps = StepCounts()
    landed = steps.watch(
        opened.withColumn("reason", reason).drop("too_large"),
        files=F.count(F.lit(1)),
        opened=F.count_if("success"),
    )
    versions.replace_values(landed, table_path(target, LANDING), DATE, _distinct(chosen, DATE))
    steps.write(spark, table_path(target, STEPS), "decrypt", run_at)


def landed_files(landing: DataFrame) -> DataFrame:
    """Opened files of the landing table, as ``curate_snapshots`` takes them.

    The path is that of the encrypted file, so two files that open to one name stay apart.
    """
    return landing.where("success").select(
        F.concat_ws("/", F.date_format(DATE, "yyyyMMdd"), "study_name", "file_name").alias("path"),
        DATE,
        "study_name",
        F.col("output_name").alias("file_name"),
        "content",
    )


def curate_snapshots(
    files: DataFrame,
    target: str,
    sheets: Mapping[str, DataFrame],
    studies: Sequence[str] = (),
    processed_at: dt.datetime | None = None,
    code_pattern: str = text.STUDY_CODE_PATTERN,
    drift: str = "same",
) -> None:
    """Curate the newest report of each date, study folder and type into its table.

    ``files`` has ``path, extract_date, study_name, file_name, content``, a path once; ``sheets``
    maps a file type to its long header sheet. Files that are rejected go to the table of rejects.

    A date is replaced in the table of a type if the input has a report of that type for it, and
    in the table of rejects if it has any file. ``drift`` is the rule for changed columns.
    """
    spark = files.sparkSession
    dated = file_ops.allow_list(files.where(F.col(DATE).isNotNull()), studies)
    # The choice needs names only, so no content is read for it or shuffled by it.
    newest = file_ops.latest_by_name(dated.drop("content")).select("path", "file_type", DATE).persist()
    kept, steps = [newest], StepCounts()
    try:
        # Calendar days of five types.
        dates: dict[str, list] = {t: [] for t in REPORTS}
        for r in newest.select("file_type", DATE).distinct().collect():
            dates[r.file_type].append(r[DATE])
        if not any(dates.values()):
            raise ValueError("no rows: report files")
        few = newest.drop(DATE)
        # Many names are hashed beside the files, so that no content is sorted.
        few = F.broadcast(few) if is_small(few) else few.hint("shuffle_hash")
        chosen = dated.select("path", DATE, "file_name", "content").join(few, "path")
        maps = header_maps(sheets)
        if maps is not None:
            kept.append(maps := maps.persist())
        # Read, shuffled, parsed and judged once for all types and the rejects.
        judged = judge_files(parse_files(chosen.drop("path"), code_pattern), maps, list(sheets)).persist()
        kept.append(judged)
        # The rejects go first and alone: they fill the cache, one task for each part of it.
        told, path = rejected_files(judged), table_path(target, REJECTS)
        rejects = versions.stage_values(told, path, DATE, _distinct(dated, DATE))

        def stage(file_type: str):
            rows, path = curate_judged(judged, file_type, processed_at), table_path(target, REPORTS[file_type][1])
            return versions.stage_values(rows, path, DATE, dates[file_type], drift=drift)

        # A table's last tasks are few, so the tables are written side by side.
        with ThreadPoolExecutor(len(REPORTS)) as pool:
            running = [pool.submit(inheritable_thread_target(spark)(stage), t) for t in REPORTS]
        for (_, table), one in zip(REPORTS.values(), running, strict=True):
            # In order: a type that fails leaves the tables before it replaced, and no other.
            steps.add(table, one.result()())
        steps.add(REJECTS, rejects())
    finally:
        for df in kept:
            df.unpersist()
    steps.write(spark, table_path(target, STEPS), "curate", processed_at)


def curate_folder(
    spark: SparkSession,
    root: str,
    target: str,
    sheets: Mapping[str, DataFrame],
    start: dt.date | None = None,
    end: dt.date | None = None,
    historical: bool = False,
    max_bytes: int = file_ops.MAX_FILE_BYTES,
    **options,
) -> list[dt.date]:
    """Curate the plain report files below ``root`` whose dates changed since the last load; the
    dates loaded. A run without a change opens no file. ``options`` are those of
    ``curate_snapshots``; files over ``max_bytes`` are rejected as they have no text."""
    files = snapshot_files(
        spark, root, start=start, end=end, historical=historical,
        ledger=loaded_files(spark, target), max_bytes=max_bytes,
    )
    dates = sorted(_distinct(files.select(DATE), DATE))
    if dates:
        curate_snapshots(files, target, sheets, **options)
        record_files(files, target)
    return dates


def status_snapshots(
    listing: DataFrame,
    study_list: DataFrame,
    tables: Mapping[str, DataFrame],
    target: str,
    sponsor: str,
    run_at: dt.datetime | None = None,
) -> None:
    """Write the status of every report of the study list for each date of the listing.

    A date of the listing is a calendar day, so the list of them stays short. A study counts as
    loaded if it is in the newest snapshot of its table.
    """
    spark = listing.sparkSession
    dated = listing.where(F.col(DATE).isNotNull())
    refuse_empty(dated.select(DATE), "listed files")
    days = dated.agg(F.collect_set(DATE)).scalar()
    status = load_status(
        refuse_empty(study_list, "study list").withColumn(DATE, F.explode(days)),
        file_ops.latest_reports(dated),
        latest_members(tables),
        list(tables),
        None,
        sponsor,
    )
    steps = StepCounts()
    fitted = steps.watch(
        row_ops.fit_schema(status, STATUS_SCHEMA),
        reports=F.count(F.lit(1)),
        with_file=F.count("file_name"),
        loaded=F.count_if("load_successful"),
    )
    versions.replace_values(
        fitted, table_path(target, STATUS_TABLE), DATE, _distinct(dated, DATE), sort=["s_no"]
    )
    steps.write(spark, table_path(target, STEPS), "status", run_at)


def plan_snapshot(
    subjects: DataFrame,
    rules: DataFrame,
    target: str,
    required: Sequence[str] = REQUIRED_RULE_COLUMNS,
    processed_at: dt.datetime | None = None,
    **options,
) -> None:
    """Plan the newest snapshot of the subjects with the rules that have all required columns.

    The plan of every study of the snapshot is replaced; a study without a visit has none then.
    ``options`` are those of ``plan_demand``.
    """
    spark = subjects.sparkSession
    # Both are read by several jobs: measured, counted, matched.
    newest = latest_snapshot(subjects).persist()
    usable = row_ops.require(rules, required).persist()
    try:
        if newest.isEmpty():
            refuse_empty(subjects, "subjects")
        if usable.isEmpty():
            refuse_empty(rules, "rules")
        steps = StepCounts()
        plan = plan_demand(newest, usable, processed_at=processed_at, watch=steps.watch, **options)
        named = match.normalise(prepare_subjects(newest), ["study_protocol"])
        # The rollup has dealt the subjects over the tasks and sorted them; their visits stay there.
        written = versions.replace_values(
            plan,
            table_path(target, PLAN_TABLE),
            "study_name",
            _distinct(named, "study_protocol"),
            sort=["subject_number", "cycle", "day"],
            folders=False,
            placed=True,
        )
    finally:
        newest.unpersist()
        usable.unpersist()
    steps.add("visits", written)
    steps.write(spark, table_path(target, STEPS), "plan", processed_at)

"""Load status: which report of the study list arrived, and whether its study was loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions import text
from dosecast.schemas import STUDY_LIST_LABELS
from dosecast.sources import files as file_ops


def read_study_list(sheet: DataFrame) -> DataFrame:
    """The study-list sheet with table column names; other columns stay."""
    return sheet.withColumnsRenamed(dict(STUDY_LIST_LABELS))


def attach_files(study_list: DataFrame, newest: DataFrame) -> DataFrame:
    """Left join of the study list to the newest report files; null sub-reports match.

    Where the list has an ``extract_date``, files of that date count only.

    ``newest`` comes out of an aggregate, so Spark knows its real size when it joins.
    """
    found = newest.select(
        F.col("study_name").alias("_study"),
        F.col("report_name").alias("_report"),
        F.col("subreport_name").alias("_subreport"),
        *([F.col("extract_date").alias("_day")] if "extract_date" in study_list.columns else []),
        "file_name",
    )
    on = (
        (F.col("study_name") == F.col("_study"))
        & (F.col("report_name") == F.col("_report"))
        & F.col("subreport_name").eqNullSafe(F.col("_subreport"))
    )
    if "_day" in found.columns:
        on = on & (F.col("extract_date") == F.col("_day"))
    return study_list.join(found, on, "left").drop("_study", "_report", "_subreport", "_day")


def check_loads(status: DataFrame, members: DataFrame, tables: list[str]) -> DataFrame:
    """Add ``load_successful``: null where the question does not arise, else whether the study
    is in the newest snapshot of its target table.

    It does not arise without a file, a study or a target among ``tables``. ``members`` holds
    each ``(table_name, study_protocol)`` once.
    """
    known = members.select(
        F.col("table_name").alias("_table"),
        F.col("study_protocol").alias("_member"),
        F.lit(True).alias("_loaded"),
    )
    on = (F.col("target_table") == F.col("_table")) & (
        F.col("study_protocol") == F.col("_member")
    )
    asked = (
        F.col("file_name").isNotNull()
        & F.col("study_protocol").isNotNull()
        & F.col("target_table").isin(*tables)
        & (F.col("target_table") != file_ops.NO_TARGET)
    )
    joined = status.join(known, on, "left")
    return joined.withColumn(
        "load_successful", F.when(asked, F.coalesce("_loaded", F.lit(False)))
    ).drop("_table", "_member", "_loaded")


def load_status(
    study_list: DataFrame,
    newest: DataFrame,
    members: DataFrame,
    tables: list[str],
    snapshot: Column | None,
    sponsor: str,
) -> DataFrame:
    """One row per report of the study list: its file, target table and load result.

    ``newest`` holds one snapshot's newest files; without ``snapshot`` the list has the date of
    each row and ``newest`` may hold many. ``sponsor`` is the word (a regular
    expression) that study names start with and study codes do not.
    """
    status = attach_files(study_list, newest).withColumns(
        {
            "target_table": file_ops.target_table(
                F.col("report_name"), F.col("subreport_name")
            ),
            "study_protocol": text.strip_prefix(F.col("study_name"), sponsor),
        }
    )
    checked = check_loads(status, members, tables)
    if snapshot is not None:
        checked = checked.withColumn("extract_date", snapshot)
    return checked.withColumn("s_no", F.col("s_no").try_cast("int"))


def in_list_order(status: DataFrame) -> DataFrame:
    return status.orderBy("s_no")


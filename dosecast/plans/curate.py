"""Curate report files into their tables, and the rules sheet into the rules table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions import rows as row_ops
from dosecast.functions import text
from dosecast.operators.joins import is_small
from dosecast.schemas import (
    REPORTS,
    RULE_LABELS,
    RULES_SCHEMA,
    report_date_columns,
    report_labels,
    report_schema,
)
from dosecast.sources import headers, lines, reports
from dosecast.sources.files import describe_paths, with_study_code

STUDY_LABEL = "Study Protocol"
BORN, APPROVED, COUNTRY = "Year of Birth", "Approved Countries", "Country"


LINEAGE = ("file_name", "extract_date", "study_code")


def _with_sheet(
    files: DataFrame, file_type: str, header_rows: DataFrame | None, code_pattern: str
) -> DataFrame:
    """Files of one type with their study code and header specs."""
    if file_type not in REPORTS:
        raise ValueError(f"unknown file type {file_type!r}, expected one of {sorted(REPORTS)}")
    coded = with_study_code(files, code_pattern).withColumn("file_type", F.lit(file_type))
    return headers.with_specs(coded, header_rows)


def _reason() -> Column:
    """Why a file is rejected: no code, not readable, or a subject report without mapping."""
    reason = F.when(F.col("study_code").isNull(), F.lit("no_study_code")).otherwise(
        F.col("reason")
    )
    unmapped = (F.col("file_type") == "subject") & F.col("specs").isNull()
    return F.coalesce(reason, F.when(unmapped, F.lit("no_header_mapping")))


def read_reports(
    files: DataFrame,
    file_type: str,
    header_rows: DataFrame | None,
    code_pattern: str = text.STUDY_CODE_PATTERN,
) -> DataFrame:
    """Parsed files of one type with their study code, header specs and reject reason.

    ``files`` has ``file_name, extract_date, content``; ``header_rows`` is the long header
    sheet, or None where there is no sheet. All files go through one plan.
    """
    parsed = reports.parse_reports(_with_sheet(files, file_type, header_rows, code_pattern))
    return _judged(parsed)


def _judged(parsed: DataFrame) -> DataFrame:
    reason = _reason()
    return parsed.withColumns(
        {"reason": reason, "records": F.when(reason.isNull(), F.col("records"))}
    )


def parse_files(files: DataFrame, code_pattern: str = text.STUDY_CODE_PATTERN) -> DataFrame:
    """Files of any types with their study code, parsed: what ``judge_files`` takes."""
    return reports.parse_reports(with_study_code(files, code_pattern))


def header_maps(sheets: Mapping[str, DataFrame | None]) -> DataFrame | None:
    """The header maps of the types that have a long sheet, as one DataFrame; None for no sheet."""
    maps = [
        headers.header_map(long.where(F.col("file_type") == t))
        for t, long in sheets.items()
        if t in REPORTS and long is not None
    ]
    return row_ops.union_all(maps) if maps else None


def judge_files(
    parsed: DataFrame, maps: DataFrame | None, sheeted: Sequence[str] = ()
) -> DataFrame:
    """Parsed files of all types (``file_type``) with header specs and reject reason, in one join.
    ``maps`` are the ``header_maps`` of the types ``sheeted``; the others need no mapping."""
    if maps is None:
        return _judged(parsed.withColumn("specs", headers.no_specs()))
    specs = F.when(F.col("file_type").isin(*sheeted), F.col("specs")).otherwise(headers.no_specs())
    return _judged(headers.join_maps(parsed, maps).withColumn("specs", specs))


def rejected_files(judged: DataFrame) -> DataFrame:
    """The files that ``judge_files`` rejects, with the reason."""
    return judged.where(F.col("reason").isNotNull()).select(*LINEAGE, "file_type", "reason")


def curate_reports(
    files: DataFrame,
    file_type: str,
    header_rows: DataFrame | None = None,
    processed_at: dt.datetime | None = None,
    code_pattern: str = text.STUDY_CODE_PATTERN,
) -> tuple[DataFrame, DataFrame]:
    """Table rows of all files of one type, and the files rejected with a reason."""
    parsed = read_reports(files, file_type, header_rows, code_pattern)
    return _curated(parsed, file_type, processed_at)


def curate_judged(
    judged: DataFrame, file_type: str, processed_at: dt.datetime | None = None
) -> DataFrame:
    """Table rows of the files of one type that ``judge_files`` lets pass."""
    return _curated(judged.where(F.col("file_type") == file_type), file_type, processed_at)[0]


def _curated(
    parsed: DataFrame, file_type: str, processed_at: dt.datetime | None
) -> tuple[DataFrame, DataFrame]:
    rejects = reports.report_rejects(parsed).drop("specs")
    labels = report_labels(file_type)
    resolved = headers.resolve_labels(parsed, labels)
    if file_type == "depot":
        resolved = headers.default_source(resolved, labels, APPROVED, COUNTRY)
    rows = headers.harmonise_files(resolved, labels, LINEAGE)
    return _to_table(rows, file_type, processed_at), rejects


def curate_large_reports(
    spark: SparkSession,
    paths: Sequence[str],
    file_type: str,
    header_rows: DataFrame | None = None,
    processed_at: dt.datetime | None = None,
    code_pattern: str = text.STUDY_CODE_PATTERN,
) -> tuple[DataFrame, DataFrame]:
    """``curate_reports`` for files too large for one task, read in splits from ``paths``."""
    read, files = lines.read_large_reports(spark, paths)
    named = describe_paths(files.withColumn("path", F.col("file")))
    judged = _with_sheet(named, file_type, header_rows, code_pattern).withColumn(
        "reason", _reason()
    )
    labels = report_labels(file_type)
    good = headers.resolve_labels(judged.where(F.col("reason").isNull()), labels).select(
        "file", *LINEAGE, "sources"
    )
    few = is_small(good)
    rows = headers.harmonise(
        read.join(F.broadcast(good) if few else good, "file"), labels, LINEAGE
    )
    if file_type == "depot":
        by_file = ["extract_date", "file_name"]
        rows = headers.default_if_all_null(rows, APPROVED, COUNTRY, by_file, few)
    rejects = judged.where(F.col("reason").isNotNull()).select(*LINEAGE, "file_type", "reason")
    return _to_table(rows, file_type, processed_at), rejects


def _to_table(rows: DataFrame, file_type: str, processed_at: dt.datetime | None) -> DataFrame:
    """Harmonised rows in the schema of their table."""
    if file_type == "subject":
        rows = rows.withColumn(BORN, text.extract_year(F.col(BORN)).cast("string"))
    named = row_ops.rename_labels(
        rows.withColumn(STUDY_LABEL, F.col("study_code")), report_labels(file_type)
    ).withColumns(
        {
            "source_file": F.col("file_name"),
            "processed_timestamp": row_ops.run_stamp(processed_at),
        }
    )
    dated = named.withColumns(
        {c: text.first_date(F.col(c)) for c in report_date_columns(file_type)}
    )
    return row_ops.fit_schema(dated, report_schema(file_type))


def curate_rules(sheet: DataFrame) -> DataFrame:
    """The rules sheet as a table: chosen columns, stripped, without empty rows, typed."""
    named = sheet.select(*[F.col("`" + l + "`").alias(c) for l, c, _ in RULE_LABELS])
    return row_ops.fit_schema(
        row_ops.drop_all_null(row_ops.strip_strings(named)), RULES_SCHEMA
    )

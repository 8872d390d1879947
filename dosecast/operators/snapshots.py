"""Dated snapshots: choose, replace and summarise them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions.rows import union_all


def latest_snapshot(df: DataFrame, date_column: str = "extract_date") -> DataFrame:
    """Rows of the newest date, as one plan; the date prunes partitions at run time."""
    newest = df.agg(F.max(date_column)).scalar()
    return df.where(F.col(date_column) == newest)


def snapshot_range(
    df: DataFrame,
    date_column: str = "extract_date",
    start: dt.date | None = None,
    end: dt.date | None = None,
    historical: bool = True,
) -> DataFrame:
    """Rows of the dates from ``start`` to ``end``, both included and both optional.

    Without ``historical`` the bounds do not count and only the newest date is kept.
    """
    if not historical:
        return latest_snapshot(df, date_column)
    if start is not None:
        df = df.where(F.col(date_column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(date_column) <= F.lit(end))
    return df


def latest_members(
    tables: Mapping[str, DataFrame],
    member: str = "study_protocol",
    date_column: str = "extract_date",
    as_of: dt.date | None = None,
) -> DataFrame:
    """Distinct members of each table's newest snapshot ``(table_name, member)``.

    ``as_of`` takes that date's snapshot instead of the newest.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        dated = (
            latest_snapshot(df, date_column)
            if as_of is None
            else df.where(F.col(date_column) == F.lit(as_of))
        )
        return (
            dated.where(F.col(member).isNotNull())
            .select(F.lit(name).alias("table_name"), F.col(member).alias(member))
        )

    return union_all([one(n, df) for n, df in tables.items()]).distinct()


def load_summary(
    tables: Mapping[str, DataFrame],
    member: str = "study_protocol",
    date_column: str = "extract_date",
) -> DataFrame:
    """Per table: newest date, its rows and its distinct studies.

    The union is counted per study first, so one shuffle of small rows serves all tables and
    a study that holds most rows shrinks before it.
    """
    rows = union_all(
        [
            latest_snapshot(df, date_column).select(
                F.lit(n).alias("table_name"),
                F.col(date_column).alias("_date"),
                F.col(member).alias("_member"),
            )
            for n, df in tables.items()
        ]
    )
    per_member = rows.groupBy("table_name", "_member").agg(
        F.max("_date").alias("_date"), F.count(F.lit(1)).alias("_rows")
    )
    found = per_member.groupBy("table_name").agg(
        F.max("_date").alias("max_extract_date"),
        F.sum("_rows").alias("row_count_at_max_extract_date"),
        F.count("_member").alias("distinct_study_count"),
    )
    # An empty table still reports a row. One row per table name, as given.
    names = rows.sparkSession.createDataFrame([(n,) for n in tables], "table_name string")
    return names.join(found, "table_name", "left").select(
        "table_name",
        "max_extract_date",
        F.coalesce("row_count_at_max_extract_date", F.lit(0)).alias(
            "row_count_at_max_extract_date"
        ),
        F.coalesce("distinct_study_count", F.lit(0)).alias("distinct_study_count"),
    )


def run_summary(plan: DataFrame) -> DataFrame:
    """Visits, subjects, drugs and date range of a plan.

    Visits are counted per subject and drug first, so the distinct counts expand that smaller
    result and not every visit.
    """
    pairs = plan.groupBy("subject_number", "drug_dispensed").agg(
        F.count(F.lit(1)).alias("_visits"),
        F.min("predicted_next_visit_date").alias("_first"),
        F.max("predicted_next_visit_date").alias("_last"),
    )
    return pairs.agg(
        F.coalesce(F.sum("_visits"), F.lit(0)).alias("total_visits"),
        F.countDistinct("subject_number").alias("unique_subjects"),
        F.countDistinct("drug_dispensed").alias("unique_drugs"),
        F.min("_first").alias("first_visit_date"),
        F.max("_last").alias("last_visit_date"),
    )


def _balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    # Rebalance keeps the rows of a partition value together and, at run time, cuts a value
    # that holds much of the data into several files.
    return df.hint("rebalance", *[F.col(c) for c in by])


def replace_partitions(
    df: DataFrame, path: str, by: str, sort: Sequence[str] = (), max_rows_per_file: int = 5_000_000
) -> None:
    """Write under ``path``, replacing only the values of ``by`` that occur in ``df``.

    Run again on the same rows it gives the same table. A value without any row in ``df``
    keeps what it had.
    """
    balanced = _balanced(df, [by])
    if sort:
        balanced = balanced.sortWithinPartitions(by, *sort)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(by)
        .parquet(path)
    )


def replace_table_partitions(df: DataFrame, table: str, by: str) -> None:
    """``replace_partitions`` for an existing catalog table partitioned by ``by``."""
    spark = df.sparkSession
    ordered = _balanced(df.select(*spark.table(table).columns), [by])
    mode = "spark.sql.sources.partitionOverwriteMode"
    # Inserting into a table takes the mode from the session only.
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ordered.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole dataset under ``path``."""
    df.write.mode("overwrite").parquet(path)


CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read CSV files with a header line in an explicit schema."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)

"""Helpers that act on every row or on the column list of a DataFrame, without a shuffle."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosecast.functions import text


def drop_sparse(df: DataFrame, n: int = 1) -> DataFrame:
    """Keep the rows that have more than ``n`` non-null values."""
    return df.na.drop(thresh=n + 1)


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows where each of the columns has a value."""
    return df.na.drop("any", subset=list(columns))


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return df.select(
        *[
            text.strip(F.col(_quote(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(_quote(f.name))
            for f in df.schema
        ]
    )


def coerce_dates(
    df: DataFrame, marker: str = "date", formats: Sequence[str] = text.REPORT_DATE_FORMATS
) -> DataFrame:
    """Turn each column whose name holds ``marker`` into a date; bad values become null."""

    def to_date(field: T.StructField) -> Column:
        column = F.col(_quote(field.name))
        if marker not in field.name.lower() or isinstance(field.dataType, T.DateType):
            return column
        if isinstance(field.dataType, T.StringType):
            column = F.coalesce(column.try_cast("date"), text.first_date(column, formats))
        return column.try_cast("date").alias(field.name)

    return df.select(*[to_date(f) for f in df.schema])


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def project_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Trim the column names, then keep the wanted ones that exist, in the wanted order."""
    trimmed = trim_column_names(df)
    return trimmed.select(*[_quote(c) for c in wanted if c in trimmed.columns])


def rename_first_like(df: DataFrame, marker: str, new_name: str) -> DataFrame:
    """Rename the first column whose name holds ``marker`` in any case."""
    hit = next((c for c in df.columns if marker.lower() in c.lower()), None)
    return df if hit is None else df.withColumnRenamed(hit, new_name)


def run_stamp(at: dt.datetime | None) -> Column:
    """The given time of a run, else now."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def column_name(label: str) -> str:
    """Table column of a report label: lower case, runs of other signs as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def rename_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rename the report labels among the columns to their table columns."""
    return df.withColumnsRenamed({l: column_name(l) for l in labels if l in df.columns})


def _cast(column: Column, field: T.StructField) -> Column:
    return column.try_cast(field.dataType)


def fit_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the schema's types and select in its order.

    A value that does not fit becomes null (``cast_failures`` counts these), and a column
    the input lacks is null throughout.
    """
    return df.select(
        *[
            (
                _cast(F.col(_quote(f.name)), f)
                if f.name in df.columns
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column: values present, and values that do not fit the schema's type."""
    fields = [f for f in schema if f.name in df.columns]
    return _count_per_column(
        df,
        {f.name: (F.col(_quote(f.name)), _cast(F.col(_quote(f.name)), f)) for f in fields},
        "present",
        "failed",
        lambda raw, fitted: raw.isNotNull() & fitted.isNull(),
    )


def parse_rate(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = text.REPORT_DATE_FORMATS
) -> DataFrame:
    """One row per date column: values present, and values that some layout parses."""
    return _count_per_column(
        df,
        {c: (F.col(_quote(c)), text.first_date(F.col(_quote(c)), formats)) for c in columns},
        "present",
        "parsed",
        lambda raw, fitted: fitted.isNotNull(),
    )


def _count_per_column(df, pairs, present, other, test) -> DataFrame:
    """Counts for many columns in one aggregate, turned to one row per column."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(raw.isNotNull()).alias(present),
                F.count_if(test(raw, fitted)).alias(other),
            ).alias(f"c{i}")
            for i, (name, (raw, fitted)) in enumerate(pairs.items())
        ]
    )
    return counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(pairs))])))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

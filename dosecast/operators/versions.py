"""Tables whose partitions are replaced at once: a write is seen as a whole or not at all.

Below the table's path, ``data/version=<id>/<column>=<value>/`` holds the files of one write and
``log/`` says which version serves a value. A write of many values goes without folders of values
to ``rows/version=<id>/``, so that its files grow with its bytes and not with the values. Data files are written first; the write counts from
the moment its rows are in the log, a single file that appears at its commit. A write that fails
before leaves files that no reader sees. What a write replaces is declared, not read off its rows,
so a declared value without a row becomes empty.

Each commit also keeps the table's columns. A write whose columns differ is refused, or widens the
table, or, where it replaces all rows, replaces the columns too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dosecast.functions.rows import union_all

LOG_SCHEMA = "commit long, version string, value string, filled boolean, whole boolean, columns string"
# What a write may do to the columns of the table.
DRIFT = ("same", "widen", "replace")
# How the name of a version without folders of values begins.
FLAT = "flat-"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The files under ``path``; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The log: a row per commit and replaced value. ``filled`` is false where the value became
    empty; ``whole`` marks a commit that replaced the table."""
    return _read(spark, f"{path.rstrip('/')}/log", LOG_SCHEMA)


def live_versions(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and the ``version`` that serves it now."""
    log = commits(spark, path)
    since = log.agg(F.coalesce(F.max(F.when(F.col("whole"), F.col("commit"))), F.lit(0))).scalar()
    return (
        log.where((F.col("commit") >= since) & F.col("filled").isNotNull())
        .groupBy("value")
        .agg(F.max(F.struct("commit", "version", "filled")).alias("last"))
        .where("last.filled")
        .select("value", "last.version")
    )


def table_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns of the table since its last commit; None before the first."""
    told = F.when(F.col("columns").isNotNull(), F.col("commit"))
    stored = commits(spark, path).agg(F.max_by("columns", told)).first()[0]
    return None if stored is None else StructType.fromJson(json.loads(stored))


def schema_changes(old: StructType, new: StructType) -> dict[str, str]:
    """Column -> ``added``, ``missing`` or ``changed``, of those that differ. Neither the order of
    the columns nor whether they may be null counts."""
    before, after = ({f.name: f.dataType.simpleString() for f in s} for s in (old, new))
    gone = {c: "missing" for c in before if c not in after}
    kept = {c: "added" if c not in before else "changed" for c, t in after.items() if before.get(c) != t}
    return gone | kept


def merged_schema(old: StructType | None, new: StructType, drift: str) -> StructType:
    """The table's columns after a write of ``new``; a ValueError where the rule forbids it.

    ``same`` refuses every change. ``widen`` takes new columns, null in the rows before, and
    leaves columns that the write lacks null in its rows; a changed type is refused. ``replace``
    takes the columns of the write.
    """
    if drift not in DRIFT:
        raise ValueError(f"drift must be one of {DRIFT}, not {drift!r}")
    plain = StructType([StructField(f.name, f.dataType) for f in new])
    if old is None or drift == "replace":
        return plain
    changes = schema_changes(old, plain)
    refused = {c: k for c, k in changes.items() if drift == "same" or k == "changed"}
    if refused:
        raise ValueError(f"columns differ from the table's: {refused}")
    return StructType([*old.fields, *[f for f in plain if changes.get(f.name) == "added"]])


def read_table(spark: SparkSession, path: str, schema: StructType | None, by: str) -> DataFrame:
    """The rows of the table now. ``schema`` has its columns (None: those of the last commit),
    ``by`` is the one it is cut by. Folders of replaced versions are not listed."""
    path = path.rstrip("/")
    schema = schema or table_schema(spark, path)
    if schema is None:
        raise ValueError(f"no table under {path}")
    stored = StructType([*schema.fields, StructField("version", StringType())])
    live = live_versions(spark, path).select(
        F.col("version").alias("_version"), F.col("value").alias("_value")
    )
    # A name per write that still serves a value.
    serving = sorted(r[0] for r in live.select("_version").distinct().collect())
    if not serving:
        return spark.createDataFrame([], schema)
    kinds = {
        "data": [v for v in serving if not v.startswith(FLAT)],
        "rows": [v for v in serving if v.startswith(FLAT)],
    }
    data = union_all(
        [
            spark.read.schema(stored)
            .option("basePath", f"{path}/{kind}")
            .parquet(*[f"{path}/{kind}/version={v}" for v in versions])
            for kind, versions in kinds.items()
            if versions
        ]
    )
    # One row per value of the table: small enough for Spark to prune folders by it.
    serves = (F.col("version") == F.col("_version")) & F.col(by).cast("string").eqNullSafe(F.col("_value"))
    return data.join(F.broadcast(live), serves, "left_semi").select(*schema.fieldNames())


def replace_values(
    df: DataFrame,
    path: str,
    by: str,
    values: Sequence,
    max_rows_per_file: int = 5_000_000,
    drift: str = "same",
    sort: Sequence[str] = (),
    folders: bool = True,
    placed: bool = False,
) -> int:
    """Replace the rows of the declared ``values`` of ``by``, and no others, by ``df``; the number
    of rows written.

    A value without a row in ``df`` becomes empty. A row of an undeclared value is an error that
    leaves the table as it was. Run again on the same rows it gives the same table. ``drift`` is
    ``same`` or ``widen``; ``sort`` orders the rows of a file by ``by`` and these columns.

    Without ``folders`` the values get no folder each, for tables with thousands of them. Rows
    that are ``placed`` stay in the tasks where they are, else those of a value come together.
    """
    return stage_values(df, path, by, values, max_rows_per_file, drift, sort, folders, placed)()


def stage_values(
    df: DataFrame,
    path: str,
    by: str,
    values: Sequence,
    max_rows_per_file: int = 5_000_000,
    drift: str = "same",
    sort: Sequence[str] = (),
    folders: bool = True,
    placed: bool = False,
) -> Callable[[], int]:
    """``replace_values`` up to its commit: the files are written and checked, and no reader sees
    them until the function given back is called. Several tables may be staged at once."""
    if drift == "replace":
        raise ValueError("the columns can be replaced with all rows only")
    declared = [None if v is None else str(v) for v in values]
    return _stage(df, path, by, declared, max_rows_per_file, drift, sort, folders, placed)


def replace_all(
    df: DataFrame,
    path: str,
    by: str,
    max_rows_per_file: int = 5_000_000,
    drift: str = "same",
    sort: Sequence[str] = (),
) -> int:
    """Replace the whole table by ``df``, its columns too under the drift ``replace``; the number
    of rows written."""
    return _stage(df, path, by, None, max_rows_per_file, drift, sort)()


def _stage(
    df: DataFrame,
    path: str,
    by: str,
    declared: list | None,
    max_rows: int,
    drift: str,
    sort: Sequence[str],
    folders: bool = True,
    placed: bool = False,
) -> Callable[[], int]:
    spark, path, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    version = version if folders else FLAT + version
    # Before any file is written.
    columns = merged_schema(table_schema(spark, path), df.schema, drift).json()
    # Few values need few parts, which Spark cuts where they are large.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts if declared is None else max(1, min(parts, len(declared)))
    balanced = df if placed else df.hint("rebalance", parts, F.col(by))
    if sort:
        balanced = balanced.sortWithinPartitions(by, *sort)
    writer, files = balanced.write.option("maxRecordsPerFile", max_rows), f"{path}/rows/version={version}"
    if folders:
        writer, files = writer.partitionBy(by), f"{path}/data/version={version}"
    writer.parquet(files)
    # Counted on the files: one column of them, or their footers alone.
    written = spark.read.schema(df.schema).parquet(files)
    counts = dict(written.groupBy(F.col(by).cast("string")).count().collect())
    whole, replaced = declared is None, set(counts) if declared is None else set(declared)
    strange = sum(n for v, n in counts.items() if v not in replaced)
    if strange:
        raise ValueError(f"{strange} rows of values of {by} that were not declared")

    def commit() -> int:
        last = commits(spark, path).agg(F.coalesce(F.max("commit"), F.lit(0))).first()[0]
        rows = [(last + 1, version, v, v in counts, whole, None) for v in replaced]
        if whole:
            # An empty table has a commit too.
            rows.append((last + 1, version, None, None, True, columns))
        # One row tells the columns.
        rows[:1] = [(*r[:-1], columns) for r in rows[:1]]
        # One file, so that readers see all rows of the commit or none.
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/log")
        return sum(counts.values())

    return commit

"""Join helpers that hold at any size and under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 4_000_000
MAX_HEAVY_KEYS = 2_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: texts and binaries by length, nested values as JSON, other
    values by their fixed width."""
    width = F.lit(0)
    for field in df.schema.fields:
        kind = field.dataType
        value = df[f"`{field.name}`"]
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        else:
            width += F.lit(16 if isinstance(kind, T.DecimalType) else 8)
    return width.cast("long")


def is_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a DataFrame with one aggregate job: does it fit a broadcast?"""
    rows, size = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))
    ).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast where the measured size allows it, else leave the choice to Spark."""
    return F.broadcast(df) if is_small(df) else df


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """``left.k <=> right.k`` over all keys; Spark hashes and sorts on these."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def heavy_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame | None:
    """The keys of more than ``rows_per_task`` rows with ``_salts``, the tasks each needs; None
    where there are none.

    One job that reads the key columns only and counts before it shuffles. Of more than
    ``MAX_HEAVY_KEYS`` such keys the heaviest are given: any other has less than one part in
    ``MAX_HEAVY_KEYS`` of all rows.
    """
    heaviest = (
        df.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("int").alias("_salts"))
        .where("_salts > 1")
        .orderBy(F.desc("_salts"), *keys)
        .limit(MAX_HEAVY_KEYS)
    )
    found = heaviest.collect()
    return df.sparkSession.createDataFrame(found, heaviest.schema) if found else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_columns: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Null-safe shuffled join on ``keys`` whose heavy left keys spread over many tasks.

    A left key with more than ``rows_per_task`` rows is cut into salts by a hash of
    ``row_columns``, and the right rows of that key, and of no other, are repeated once per
    salt. The salt depends on the row alone, so a task that runs again routes its rows as
    before. ``how`` may be any type that keeps or drops left rows: inner, left, left_semi,
    left_anti. ``heavy`` gives the ``heavy_keys`` of some of the ``keys`` where they are known
    already, False that there are none; else they are counted here.
    """
    heavy = heavy_keys(left, keys, rows_per_task) if heavy is None else heavy
    if heavy is None or heavy is False:
        renamed = {k: f"_r{i}" for i, k in enumerate(keys)}
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(renamed[k]))
        return left.join(right.withColumnsRenamed(renamed), on, how).drop(*renamed.values())
    parts = [k for k in heavy.columns if k != "_salts"]

    def with_salts(df: DataFrame) -> DataFrame:
        # At most MAX_HEAVY_KEYS rows.
        few = F.broadcast(heavy.toDF(*[f"_h{i}" for i in range(len(parts))], "_salts"))
        on = F.lit(True)
        for i, k in enumerate(parts):
            on = on & df[k].eqNullSafe(few[f"_h{i}"])
        return df.join(few, on, "left").drop(*[f"_h{i}" for i in range(len(parts))])

    salts = F.coalesce("_salts", F.lit(1))
    a = with_salts(left).withColumn(
        "_salt", F.pmod(F.xxhash64(*row_columns), salts).cast("int")
    ).drop("_salts")
    b = with_salts(right).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    ).drop("_salts")
    renamed = {k: f"_r{i}" for i, k in enumerate([*keys, "_salt"])}
    b = b.withColumnsRenamed(renamed)
    on = F.col("_salt") == F.col(renamed["_salt"])
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(renamed[k]))
    return a.join(b, on, how).drop("_salt", *renamed.values())


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_columns: Sequence[str],
    how: str = "inner",
    small: bool | None = None,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Null-safe join with a side that is usually small.

    Broadcast where ``right`` is measured to fit, else a salted shuffle join. The key columns
    appear once, as in the left input. ``small`` skips the measurement, ``heavy`` the count of
    the left keys.
    """
    if not (is_small(right) if small is None else small):
        return salted_join(left, right, keys, row_columns, how, heavy=heavy)
    renamed = {k: f"_r{i}" for i, k in enumerate(keys)}
    side = F.broadcast(right.withColumnsRenamed(renamed))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(renamed[k]))
    return left.join(side, on, how).drop(*renamed.values())

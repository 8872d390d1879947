"""Which studies occur in which table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.functions.rows import union_all


def coverage(sets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per member of any set, one column per set: the member, or null where missing.

    ``sets`` maps a name to a one-column DataFrame; repeats are allowed. A null member
    matches no other and keeps a row of its own per set. One union and one aggregate with a
    partial form replace a chain of full outer joins.
    """
    tagged = union_all(
        [df.toDF("member").withColumn("set", F.lit(name)) for name, df in sets.items()]
    )
    null_set = F.when(F.col("member").isNull(), F.col("set"))
    return (
        tagged.groupBy("member", null_set.alias("null_set"))
        .agg(
            *[
                # A boolean keeps the aggregate a hash aggregate; the member is the key.
                F.max(F.col("set") == name).alias(f"in_{i}")
                for i, name in enumerate(sets)
            ]
        )
        .select(
            *[F.when(F.col(f"in_{i}"), F.col("member")).alias(n) for i, n in enumerate(sets)]
        )
    )


def coverage_by_joins(sets: Mapping[str, DataFrame]) -> DataFrame:
    """The same rows by chained full outer joins on the first key present so far."""
    frames = [df.toDF(name).distinct() for name, df in sets.items()]

    def step(done: DataFrame, nxt: DataFrame) -> DataFrame:
        first = F.coalesce(*done.columns) if len(done.columns) > 1 else F.col(done.columns[0])
        return done.join(nxt, first == F.col(nxt.columns[0]), "full_outer")

    return reduce(step, frames)


def in_order(covered: DataFrame) -> DataFrame:
    """Sorted by the first member present."""
    return covered.orderBy(F.coalesce(*covered.columns))


def watch_list(df: DataFrame, members: DataFrame, key: str = "study_protocol") -> DataFrame:
    """Rows whose key is on the list, as a semi join; Spark sizes the list's side itself."""
    listed = members.select(F.col(members.columns[0]).alias(key)).distinct()
    return df.join(listed, key, "left_semi")

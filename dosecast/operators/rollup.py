"""Roll matched rows up to one row per subject and drug."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_first_sum(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    first_values: Sequence[str],
    first_rows: Sequence[str],
    order: Column,
) -> DataFrame:
    """Group by ``keys`` (null is a key), sum ``sums``, and take firsts by ``order``.

    ``first_values`` take their first non-null value, each column on its own.
    ``first_rows`` take the value of the first row, null included. A sum without any value
    is 0. Every aggregate has a partial form, so a hot group shrinks before the shuffle.
    """
    keyed = df.withColumn("_order", order)
    aggregates = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    aggregates += [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in first_values
    ]
    if first_rows:
        aggregates.append(F.min_by(F.struct(*first_rows), "_order").alias("_first"))
    rolled = keyed.groupBy(*keys).agg(*aggregates)
    return rolled.select(*keys, *sums, *first_values, *[f"_first.{c}" for c in first_rows])

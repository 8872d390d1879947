"""Helpers shared by the corpus operators: tables, scratch tables, prefix sums, hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Words of a text for mixing: runs of anything but white space (fixed value of the contract).
SPACED_WORD = r"[^\x20\x09-\x0D]+"
# Rows that one bucket of a numbering holds on average.
ROWS_PER_BUCKET = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this subpackage, once per application, wherever the driver found
    it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        here = Path(__file__).parent
        path = Path(tempfile.mkdtemp(prefix="dosecast-")) / "dosecast_llm.zip"
        with zipfile.ZipFile(path, "w") as out:
            for source in (here.parent / "__init__.py", *sorted(here.glob("*.py"))):
                out.write(source, source.relative_to(here.parent.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or below
    the session's checkpoint folder or warehouse where that is not set."""
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    )
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a scratch table and read it again: lineage ends in files that survive a
    lost executor, and the planner knows their size."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash52(*parts: Column | str) -> Column:
    """52 bits of the MD5 of the parts, joined by ``|``. Null parts read as ``null``."""
    texts = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null"))
        for p in parts
    ]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 13), 16, 10).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket_count(df: DataFrame) -> int:
    return max(1, -(-df.count() // ROWS_PER_BUCKET))


def prefix_sums(
    df: DataFrame,
    group: str,
    bucket: Column,
    order: Sequence[Column],
    size: Column,
    name: str,
) -> DataFrame:
    """Add ``name``: the sum of ``size`` over the rows before this one in its group, by
    ``bucket`` and then ``order``.

    Groups are summed in two levels, so no task sorts a whole group: bucket totals first, then
    the rows of each bucket. ``group`` must not be null.
    """
    rows = df.withColumns({"_bucket": bucket, "_size": size})
    totals = rows.groupBy(group, "_bucket").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    within = (
        Window.partitionBy(group, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(starts, [group, "_bucket"])
        .withColumn(name, F.col("_start") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
        .drop("_bucket", "_size", "_start")
    )

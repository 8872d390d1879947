"""Read floating-header CSV files in splits, for files too large for one task.

``reports.parse_reports`` takes a file as one row. Here Spark splits the files and reads
lines, and a quoted cell may run over line ends and over splits. A line is inside or outside
quotes before it, and so after it: as a function of the state before, each line keeps it,
turns it, or sets it. Running these together first inside each split and then over the splits
of a file tells where every record starts, without reading a file in one piece.

A record is put together in one task, so its length is bounded: two stray quotes far apart in a
file make one record of all between them. Lengths are summed before any line is gathered, and a
file with a longer record is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosecast.functions.text import is_blank
from dosecast.operators.joins import broadcast_if_small
from dosecast.sources.reports import (
    MAX_HEADER_LINES,
    NULL_TOKENS,
    null_tokens_out,
    split_record,
    unique_names,
)

MAX_RECORD_BYTES = 16 << 20

_INSIDE = r'(?:[^"]++|"")*+'
_CLOSED_CELL = rf'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
# The line ends inside quotes when it starts outside, and when it starts inside.
_OPENS = rf'^(?:{_CLOSED_CELL},)*+"{_INSIDE}$'
_STAYS = rf'^{_INSIDE}(?:$|"[^,]*+(?:,{_CLOSED_CELL})*+,"{_INSIDE}$)'


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with ``file``, ``block`` (start of the split) and ``n`` (from 0 in the split)."""
    # The path comes URL-encoded; a plain "+" in a name is no space.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    raw = spark.read.text(list(paths)).select(
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "^\ufeff", "").alias("value"),
    )
    # A split is read by one task in order, and holds a bounded number of bytes.
    order = Window.partitionBy("file", "block").orderBy("at")
    return raw.withColumn("n", F.row_number().over(order) - 1).drop("at")


def _headers(lines: DataFrame, max_lines: int) -> DataFrame:
    """Number of the header line per file ``(file, top)``; null where there is none."""
    cells = F.split("value", ",")
    full = (F.size(cells) > 1) & F.forall(cells, lambda c: ~is_blank(c))
    return (
        lines.where((F.col("block") == 0) & (F.col("n") < max_lines))
        .groupBy("file")
        .agg(F.min(F.when(full, F.col("n"))).alias("top"))
    )


def _after(before: Column, zero: Column, one: Column) -> Column:
    return F.when(before == 0, zero).otherwise(one)


def _running(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """States before each row for both states at the group's start: ``before0, before1``.

    ``zero`` and ``one`` are the row's states after it for the state before it. The state is
    what the last setting row set, turned by every turning row since.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    past = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("zero") == 1) & (F.col("one") == 0)
    sets = F.col("zero") == F.col("one")
    counted = df.withColumn("_turns", F.sum(turns.cast("int")).over(upto))
    marked = counted.withColumns(
        {
            "_set": F.last(
                F.when(sets, F.struct(F.col("zero").alias("v"), F.col("_turns").alias("t"))),
                ignorenulls=True,
            ).over(past),
            "_past": F.coalesce(F.max("_turns").over(past), F.lit(0)),
        }
    )

    def before(start: int) -> Column:
        value = F.coalesce(F.col("_set.v"), F.lit(start))
        return (value + F.col("_past") - F.coalesce(F.col("_set.t"), F.lit(0))) % 2

    return marked.withColumns({"before0": before(0), "before1": before(1)}).drop(
        "_turns", "_set", "_past"
    )


def _records(
    lines: DataFrame, heads: DataFrame, max_record_bytes: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records ``(file, block, no, text)``, the files that end inside quotes, and the files with a
    record of more than ``max_record_bytes``; neither kind has records of several lines."""
    kept = lines.join(heads, "file").where(
        F.col("top").isNotNull() & ((F.col("block") > 0) | (F.col("n") >= F.col("top")))
    )
    stepped = kept.select(
        "file",
        "block",
        "n",
        "value",
        F.col("value").rlike(_OPENS).cast("int").alias("zero"),
        F.col("value").rlike(_STAYS).cast("int").alias("one"),
    )
    # The states serve three results; the checkpoint keeps the text from being scanned thrice.
    scanned = _running(stepped, ["file", "block"], "n").checkpoint()
    ends = scanned.groupBy("file", "block").agg(
        F.max_by(_after(F.col("before0"), F.col("zero"), F.col("one")), "n").alias("zero"),
        F.max_by(_after(F.col("before1"), F.col("zero"), F.col("one")), "n").alias("one"),
    )
    # One row per split from here on.
    entered = _running(ends, ["file"], "block").select(
        "file",
        "block",
        F.col("before0").alias("entry"),
        _after(F.col("before0"), F.col("zero"), F.col("one")).alias("exit"),
    )
    unclosed = (
        entered.groupBy("file").agg(F.max_by("exit", "block").alias("exit"))
        .where("exit = 1").select("file")
    )
    placed = (
        scanned.join(broadcast_if_small(entered.drop("exit")), ["file", "block"])
        .withColumn("before", _after(F.col("entry"), F.col("before0"), F.col("before1")))
        .withColumn("starts", 1 - F.col("before"))
        .withColumn("open", _after(F.col("before"), F.col("zero"), F.col("one")) == 1)
    )
    numbered = placed.withColumn(
        "no",
        F.sum("starts").over(
            Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    # A split that begins inside a record carries on the last record started before it.
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy("file", "block").agg(F.sum("starts").alias("started"))
        .withColumn(
            "_from",
            F.last(
                F.when(F.col("started") > 0, F.struct("block", "started")), ignorenulls=True
            ).over(past),
        )
        .select("file", "block", F.col("_from.block").alias("from_block"), F.col("_from.started").alias("from_no"))
    )
    whole = (F.col("starts") == 1) & ~F.col("open")
    single = numbered.where(whole).select("file", "block", "no", F.col("value").alias("text"))
    parts = (
        numbered.where(~whole)
        .join(broadcast_if_small(carried), ["file", "block"])
        .join(unclosed, "file", "left_anti")
    )
    inherited = F.col("no") == 0
    keyed = parts.select(
        "file",
        F.when(inherited, F.col("from_block")).otherwise(F.col("block")).alias("record_block"),
        F.when(inherited, F.col("from_no")).otherwise(F.col("no")).alias("no"),
        "block",
        "n",
        "value",
    )
    # Line ends between the lines count, that after the last does not.
    bytes_of = F.octet_length("value").cast("long")
    sizes = keyed.groupBy("file", "record_block", "no").agg((F.sum(bytes_of + 1) - 1).alias("size"))
    long = (
        sizes.select("file", "size")
        .unionByName(single.select("file", F.octet_length("text").cast("long").alias("size")))
        .groupBy("file")
        .agg(F.max("size").alias("size"))
        .where(F.col("size") > max_record_bytes)
        .select("file")
    )
    joined = (
        keyed.join(long, "file", "left_anti")
        .groupBy("file", "record_block", "no")
        .agg(F.array_sort(F.collect_list(F.struct("block", "n", "value"))).alias("parts"))
        .select(
            "file",
            F.col("record_block").alias("block"),
            "no",
            F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("text"),
        )
    )
    return single.unionByName(joined).where(~is_blank(F.col("text"))), unclosed, long


def read_large_reports(
    spark: SparkSession,
    paths: Sequence[str],
    max_header_lines: int = MAX_HEADER_LINES,
    tokens: Sequence[str] = NULL_TOKENS,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(file, block, no, cells)`` of large CSV files, and ``(file, header, reason)``.

    The rows are those of ``reports.report_rows``; ``block, no`` give their order in the file.
    Files with a reason have no rows; ``long_record`` is one more reason here, of a file with a
    record of more than ``max_record_bytes``. Needs a checkpoint folder.
    """
    lines = read_lines(spark, paths)
    heads = broadcast_if_small(_headers(lines, max_header_lines))
    records, unclosed, long = _records(lines, heads, max_record_bytes)
    parsed = records.withColumn("cells", split_record(F.col("text")))
    first = F.min(F.struct("block", "no", "cells"))
    files = (
        parsed.withColumn("width", F.size("cells"))
        .groupBy("file")
        .agg(first.alias("first"), F.max("width").alias("widest"))
    )
    broken = lines.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8")
    )
    judged = (
        broken.join(heads, "file", "left")
        .join(files, "file", "left")
        .join(unclosed.withColumn("unclosed", F.lit(True)), "file", "left")
        .join(long.withColumn("long", F.lit(True)), "file", "left")
        .select(
            "file",
            unique_names(F.col("first.cells")).alias("header"),
            F.col("first.block").alias("first_block"),
            F.col("first.no").alias("first_no"),
            F.when(~F.col("utf8"), "not_utf8")
            .when(F.col("top").isNull(), "no_header")
            .when(F.col("unclosed"), "open_quote")
            .when(F.col("long"), "long_record")
            .when(F.col("widest") > F.size("first.cells"), "long_row")
            .alias("reason"),
        )
    )
    good = broadcast_if_small(judged.where(F.col("reason").isNull()).drop("reason", "header"))
    rows = (
        parsed.join(good, "file")
        .where(
            (F.col("block") != F.col("first_block")) | (F.col("no") != F.col("first_no"))
        )
        .select("file", "block", "no", null_tokens_out(F.col("cells"), tokens).alias("cells"))
    )
    return rows, judged.select("file", "header", "reason")

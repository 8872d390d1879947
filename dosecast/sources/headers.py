"""Map the headers of each study's reports to the standard labels.

A header sheet has one row per standard label and one column per study. A cell names the
study's own column, lists several ("a, b": the first with a value wins), or fixes a value
("x=literal").
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions.text import is_blank, let, strip
from dosecast.operators.joins import broadcast_if_small, is_small
from dosecast.sources.reports import null_tokens_out

LABEL = "Column Header"


def sheet_to_rows(
    sheet: DataFrame, file_type: str, row_no: str | None = None, label: str = LABEL
) -> DataFrame:
    """Long form of a header sheet: ``file_type, study, label, spec, row_no``.

    Needs the label column. ``row_no`` names a column with the row order; without one the
    order of reading counts, which is right for a sheet in one file. Every study column is
    kept, blank cells too, so that a study without any entry is still a known study.
    """
    if label not in sheet.columns:
        raise ValueError(f"column {label!r} not in the header sheet: {sheet.columns}")
    order = F.monotonically_increasing_id() if row_no is None else F.col(row_no)
    studies = [c for c in sheet.columns if c not in (label, row_no)]
    numbered = sheet.withColumn("row_no", order.cast("long")).withColumnRenamed(label, "label")
    return numbered.unpivot(["label", "row_no"], studies, "study", "spec").select(
        F.lit(file_type).alias("file_type"), "study", "label", "spec", "row_no"
    )


def header_specs(long: DataFrame) -> DataFrame:
    """The spec that counts per ``(file_type, study, label)``.

    Exact repeats count once, at their first row. A column named for two labels goes to the
    last; a label with two columns takes the one named last. Fixed values go to each of their
    labels.
    """
    spec = strip(F.col("spec"))
    fixed = F.col("spec").contains("=")
    once = (
        long.where(F.col("label").isNotNull() & ~is_blank(F.col("spec")))
        .groupBy("file_type", "study", "label", spec.alias("spec"))
        .agg(F.min("row_no").alias("row_no"))
    )
    by_column = once.groupBy(
        "file_type", "study", "spec", F.when(fixed, F.col("label")).alias("fixed_label")
    ).agg(F.max_by("label", "row_no").alias("label"), F.min("row_no").alias("row_no"))
    return by_column.groupBy("file_type", "study", "label").agg(
        F.max_by("spec", "row_no").alias("spec")
    )


def header_map(long: DataFrame) -> DataFrame:
    """One row per known ``(file_type, study)`` with ``specs``, a map of label to spec.

    A study whose cells are all blank has an empty map. A map holds at most one entry per
    label of the sheet.
    """
    found = (
        header_specs(long)
        .groupBy("file_type", "study")
        .agg(F.map_from_entries(F.collect_list(F.struct("label", "spec"))).alias("specs"))
    )
    known = long.select("file_type", "study").distinct()
    return known.join(found, ["file_type", "study"], "left").withColumn(
        "specs", F.coalesce("specs", no_specs())
    )


def with_specs(files: DataFrame, long: DataFrame | None, study: str = "study_code") -> DataFrame:
    """Add ``specs`` to each file by its type and study; null where the sheet lacks the study."""
    if long is None:
        return files.withColumn("specs", no_specs())
    return join_maps(files, header_map(long), study)


def no_specs() -> Column:
    return F.create_map().cast("map<string,string>")


def join_maps(files: DataFrame, maps: DataFrame, study: str = "study_code") -> DataFrame:
    """``with_specs`` by maps that ``header_map`` gave."""
    named = broadcast_if_small(maps.withColumnRenamed("study", study))
    return files.join(named, ["file_type", study], "left")


def resolve(label: Column, header: Column, specs: Column) -> Column:
    """Where a file takes a standard label from: ``struct(fixed, places)``.

    ``fixed`` is the literal, ``places`` the positions (from 1) of the source columns in the
    file's header, first choice first. Worked out once per file, so a row only looks up.
    """

    def place(name: Column) -> Column:
        return F.array_position(header, name)

    def found(spec: Column) -> Column:
        several = F.filter(
            F.transform(F.split(spec, ","), lambda n: place(strip(n))), lambda p: p > 0
        )
        own = F.filter(F.array(place(label)), lambda p: p > 0)
        places = (
            F.when(spec.contains(","), several)
            .when(F.array_contains(header, spec), F.array(place(spec)))
            .otherwise(own)
        )
        fixed = F.when(spec.contains("="), strip(F.regexp_extract(spec, "(?s)=(.*)$", 1)))
        return F.struct(fixed.alias("fixed"), places.alias("places"))

    return let(F.try_element_at(specs, label), found)


def take(source: Column, cells: Column) -> Column:
    """The value a row has for a resolved label: the literal, else its first non-null cell."""
    places = source["places"]

    def at(p: Column) -> Column:
        return F.get(cells, (p - 1).cast("int"))

    first = F.get(F.filter(F.transform(places, at), lambda v: v.isNotNull()), 0)
    return F.coalesce(source["fixed"], at(F.get(places, 0)), F.when(F.size(places) > 1, first))


def resolve_labels(
    files: DataFrame, labels: Sequence[str], header: str = "header", specs: str = "specs"
) -> DataFrame:
    """Add ``sources``, an array with the resolution of every label in their order."""
    wanted = F.array(*[F.lit(l) for l in labels])

    def all_of(file: Column) -> Column:
        return F.transform(wanted, lambda l: resolve(l, file["header"], file["specs"]))

    file = F.struct(F.col(header).alias("header"), F.col(specs).alias("specs"))
    return files.withColumn("sources", let(file, all_of))


def default_source(
    files: DataFrame, labels: Sequence[str], label: str, fallback: str
) -> DataFrame:
    """Let ``label`` take the source of ``fallback`` in the resolved files where no record has
    a value for it. Each file decides by its own records, so nothing is joined."""
    own, other = labels.index(label), labels.index(fallback)

    def chosen(sources: Column) -> Column:
        has_value = F.exists(
            "records", lambda r: take(sources[own], null_tokens_out(r)).isNotNull()
        )
        return F.when(has_value, sources).otherwise(
            F.transform(
                sources, lambda s, i: F.when(i == own, sources[other]).otherwise(s)
            )
        )

    return files.withColumn("sources", let(F.col("sources"), chosen))


def harmonise(rows: DataFrame, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows of resolved files as a table with the standard labels."""

    def values(cells: Column) -> Column:
        return F.transform("sources", lambda source: take(source, cells))

    taken = rows.select(*keep, let(F.col("cells"), values).alias("_values"))
    return taken.select(
        *keep, *[F.get("_values", F.lit(i)).alias(l) for i, l in enumerate(labels)]
    )


def harmonise_files(files: DataFrame, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows of resolved files (``records``, null for none) as a table with the standard labels.

    Each file is worked out as a whole and then unfolded, so its ``sources`` are not copied to
    every row, and the place of a label is told once per file.
    """

    def told(source: Column) -> Column:
        places = source["places"]
        return F.struct(
            source["fixed"].alias("fixed"),
            (F.get(places, 0) - 1).cast("int").alias("at"),
            F.when(F.size(places) > 1, places).alias("several"),
        )

    def value(source: Column, cells: Column) -> Column:
        tried = F.transform(source["several"], lambda p: F.get(cells, (p - 1).cast("int")))
        first = F.get(F.filter(tried, lambda v: v.isNotNull()), 0)
        return F.coalesce(
            source["fixed"], F.get(cells, source["at"]), F.when(source["several"].isNotNull(), first)
        )

    def rows(sources: Column) -> Column:
        return F.transform(
            "records",
            lambda r: let(
                null_tokens_out(r), lambda cells: F.transform(sources, lambda s: value(s, cells))
            ),
        )

    # The outer form keeps Spark from testing the array's size ahead of the explode.
    unfolded = files.select(
        *keep, F.explode_outer(let(F.transform("sources", told), rows)).alias("_values")
    ).where(F.col("_values").isNotNull())
    return unfolded.select(
        *keep, *[F.get("_values", F.lit(i)).alias(l) for i, l in enumerate(labels)]
    )


def default_if_all_null(
    rows: DataFrame, column: str, fallback: str, by: Sequence[str], few: bool | None = None
) -> DataFrame:
    """Fill ``column`` from ``fallback`` in the groups where no row has a value.

    The groups that have one are found by an aggregate with a partial form and joined back as
    one row each, so a group that holds most rows stays spread over its tasks. ``few`` says
    whether the groups fit a broadcast; measured when not given.
    """
    filled = (
        rows.where(F.col(_q(column)).isNotNull()).select(*by).distinct()
        .withColumn("_has_value", F.lit(True))
    )
    renamed = {k: f"_g{i}" for i, k in enumerate(by)}
    on = F.lit(True)
    for k in by:
        on = on & F.col(_q(k)).eqNullSafe(F.col(renamed[k]))
    groups = filled.withColumnsRenamed(renamed)
    if few is None:
        few = is_small(groups)
    joined = rows.join(F.broadcast(groups) if few else groups, on, "left")
    return joined.withColumn(
        column, F.when(F.col("_has_value"), F.col(_q(column))).otherwise(F.col(_q(fallback)))
    ).drop("_has_value", *renamed.values())


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

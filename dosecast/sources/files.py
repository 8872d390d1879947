"""List report files, tell what they are, and pick the newest of each kind.

Layout: ``<root>/<yyyyMMdd>/<study folder>/<file>``. Functions take a listing DataFrame, so a
listing from a catalogue table works as well as one from the file system.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions import text

# Report and sub-report -> table; any other pair is "NA".
TARGET_TABLES = (
    ("Comparator Supply (Unblinded)", "Country Level Supply Method", "clinical_supply_method_country_level"),
    ("Comparator Supply (Unblinded)", "Site Level Supply Method", "clinical_supply_method_site_level"),
    ("Inventory Levels", "Site", "NA"),
    ("Inventory Levels", "Depot", "NA"),
    ("Inventory Summary (Unblinded)", "Site Inventory Summary", "clinical_site_inventory"),
    ("Inventory Summary (Unblinded)", "Depot Inventory Summary", "clinical_depot_inventory"),
    ("Participant Summary (Unblinded)", None, "clinical_subject_summary"),
    ("Subject Summary", None, "NA"),
    ("Subject Summary (Unblinded)", None, "clinical_subject_summary"),
    ("Subject Visit Summary", None, "NA"),
)
NO_TARGET = "NA"


# Content of a file is one value of one row; a longer file is not opened.
MAX_FILE_BYTES = 512 << 20


def read_files(
    spark: SparkSession, root: str, folders: str | Sequence[str] = "*", pattern: str = "*"
) -> DataFrame:
    """The files directly in each date folder and one level below, with their content.

    ``folders`` is a glob over date folders, or a list of them, ``pattern`` one over file names.
    """
    chosen = [folders] if isinstance(folders, str) else folders
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load([f"{root.rstrip('/')}/{f}/*" for f in chosen])
    )


def read_bounded_files(
    spark: SparkSession,
    root: str,
    folders: str | Sequence[str] = "*",
    pattern: str = "*",
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """``read_files`` with ``too_large``: files over ``max_bytes`` are listed and not opened, and
    have null content. Spark tells the length before it opens a file."""
    listed = read_files(spark, root, folders, pattern)
    small = listed.where(F.col("length") <= max_bytes).withColumn("too_large", F.lit(False))
    large = listed.where(F.col("length") > max_bytes).drop("content")
    return small.unionByName(
        large.withColumns({"content": F.lit(None).cast("binary"), "too_large": F.lit(True)})
    )


def list_files(spark: SparkSession, root: str, folders: str = "*", pattern: str = "*") -> DataFrame:
    """The same without the content, so that no file is opened."""
    return read_files(spark, root, folders, pattern).select("path", "modificationTime", "length")


def describe_paths(listing: DataFrame) -> DataFrame:
    """Add ``folder``, ``extract_date``, ``study_name`` and ``file_name`` from the path.

    The date folder is the last or last but one folder of the path; a file directly in it has
    no study. ``extract_date`` is null where that folder's name is not a date.
    """
    two_up = F.regexp_extract("path", r"/([^/]+)/[^/]+/[^/]+$", 1)
    one_up = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    nested = folder_date(two_up).isNotNull()
    return listing.withColumns(
        {
            "folder": F.when(nested, two_up).otherwise(one_up),
            "extract_date": F.coalesce(folder_date(two_up), folder_date(one_up)),
            "study_name": F.when(nested, one_up),
            "file_name": F.regexp_extract("path", r"([^/]+)$", 1),
        }
    )


def folder_date(name: Column) -> Column:
    """Date of a folder named ``yyyyMMdd``; null for any other name."""
    return F.when(name.rlike("^[0-9]{8}$"), F.try_to_date(name, "yyyyMMdd"))


def snapshot_catalogue(listing: DataFrame) -> DataFrame:
    """Date folders that hold files ``(folder, extract_date)``, oldest first."""
    return (
        describe_paths(listing)
        .where(F.col("extract_date").isNotNull())
        .select("folder", "extract_date")
        .distinct()
        .orderBy("extract_date")
    )


LEDGER = ("extract_date", "path", "modificationTime", "length")


def changed_dates(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """``extract_date`` and ``folder`` of the listing's dates whose files are not those of the
    ledger: a file is new, gone, or has another time or length. Without a ledger, all dates.

    ``listing`` has ``folder`` and the columns of the ledger. Dates that only the ledger has are
    not told.
    """
    dated = listing.where(F.col("extract_date").isNotNull())
    if ledger is None:
        return dated.select("extract_date", "folder").distinct()
    # One aggregate tells both directions: a file that only one side has is there once.
    both = dated.select(*LEDGER, F.col("folder")).unionByName(
        ledger.select(*LEDGER, F.lit(None).cast("string").alias("folder"))
    )
    return (
        both.groupBy(*LEDGER)
        .agg(F.max("folder").alias("folder"), F.count(F.lit(1)).alias("_sides"))
        .groupBy("extract_date")
        .agg(F.max("folder").alias("folder"), F.min("_sides").alias("_least"))
        .where("_least < 2 AND folder IS NOT NULL")
        .select("extract_date", "folder")
    )


def allow_list(df: DataFrame, studies: Sequence[str], column: str = "study_name") -> DataFrame:
    """Keep the listed studies; an empty list keeps all."""
    return df.where(F.col(column).isin(*studies)) if studies else df


def name_timestamp(file_name: Column, extensions: Sequence[str] = ("csv",)) -> Column:
    """Time stamp right before the extension (exact case); null where missing or not a time."""
    pattern = rf"(\d{{4}}-\d{{2}}-\d{{2}}-\d{{2}}-\d{{2}}-\d{{2}})\.(?:{'|'.join(extensions)})$"
    return F.try_to_timestamp(
        F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit("")), F.lit("yyyy-MM-dd-HH-mm-ss")
    )


def _has(name: Column, *words: str) -> Column:
    """The name holds one of the words."""
    found = name.contains(words[0])
    for w in words[1:]:
        found = found | name.contains(w)
    return found


def classify_file(file_name: Column, by_modification: bool = False) -> Column:
    """File type of a report name, null for other files.

    ``by_modification`` gives the narrower naming of the choice by modification time.
    """
    summary = ("subject summary",) if by_modification else ("subject summary", "participant summary")
    supply = ("supplymethod",) if by_modification else ("supplymethod", "supply method")

    def kind(name: Column) -> Column:
        found = (
            F.when(_has(name, *summary), "subject")
            .when(_has(name, "site") & _has(name, "inventory"), "site")
            .when(_has(name, "depot") & _has(name, "inventory"), "depot")
            .when(_has(name, "site") & _has(name, *supply), "slsm")
            .when(_has(name, "country") & _has(name, *supply), "clsm")
        )
        return F.when(name.endswith(".csv"), found)

    return kind(F.lower(file_name))


# Words of a report name: the first ones tell the report, the others its variant and part.
KIND_WORDS = (
    "subject summary", "participant summary", "subject visit summary", "inventory summary",
    "inventory levels", "comparator supply", "supply method", "comparator",
)
PART_WORDS = ("unblinded", "subject", "site", "depot", "country")
SUMMARY, VISIT, INVENTORY, LEVELS, SUPPLY = range(1, 6)


def _kind(found: set[str]) -> int:
    """Report of a name that holds these words; the first that fits, 0 for none."""
    if found & {"subject summary", "participant summary"}:
        return SUMMARY
    if "subject visit summary" in found:
        return VISIT
    if "inventory summary" in found:
        return INVENTORY
    if "inventory levels" in found:
        return LEVELS
    supply = "comparator supply" in found or ("supply method" in found and "comparator" not in found)
    return SUPPLY if supply else 0


def _titles(kind: int, found: set[str]) -> tuple[str | None, str | None]:
    """Report and sub-report of a kind, by the other words of the name."""
    stock = next((w for w in ("site", "depot") if w in found), None)
    supply = "site" if "site" in found else "country" if "country" in found else None
    if kind == SUMMARY:
        person = "Subject" if "subject" in found else "Participant"
        return (f"{person} Summary (Unblinded)" if "unblinded" in found else "Subject Summary"), None
    if kind == VISIT:
        return "Subject Visit Summary", None
    if kind == INVENTORY:
        return "Inventory Summary (Unblinded)", stock and f"{stock.title()} Inventory Summary"
    if kind == LEVELS:
        return "Inventory Levels", stock and stock.title()
    if kind == SUPPLY:
        return "Comparator Supply (Unblinded)", supply and f"{supply.title()} Level Supply Method"
    return None, None


def _words_of(mask: int, words: Sequence[str]) -> set[str]:
    return {w for k, w in enumerate(words) if mask >> k & 1}


def _mask(name: Column, words: Sequence[str]) -> Column:
    """A number with one bit for each of the words that the name holds."""
    bits = [name.contains(w).cast("int") * (1 << k) for k, w in enumerate(words)]
    return reduce(operator.add, bits)


def _all_titles() -> list[tuple[str | None, str | None]]:
    """Titles by kind and by the other words of the name."""
    parts = range(1 << len(PART_WORDS))
    return [_titles(k, _words_of(m, PART_WORDS)) for k in range(SUPPLY + 1) for m in parts]


def report_code(file_name: Column) -> Column:
    """One number for each report and sub-report, by the file name; null for other files.

    Every word is looked for once and gives a bit; the rules are worked out beforehand for all
    combinations. Name and kind are bound, so a plan that uses the number often stays small enough
    to be compiled.
    """
    kinds = F.array(*[F.lit(_kind(_words_of(m, KIND_WORDS))) for m in range(1 << len(KIND_WORDS))])
    number = {t: k for k, t in enumerate(dict.fromkeys(_all_titles()))}
    numbers = F.array(*[F.lit(number[t]) for t in _all_titles()])

    def coded(name: Column) -> Column:
        part = _mask(name, PART_WORDS)
        code = text.let(
            F.get(kinds, _mask(name, KIND_WORDS)),
            lambda kind: F.when(kind > 0, F.get(numbers, kind * (1 << len(PART_WORDS)) + part)),
        )
        return F.when(name.endswith(".csv") | name.endswith(".enc"), code)

    return text.let(F.lower(file_name), coded)


def report_titles(code: Column) -> tuple[Column, Column]:
    """Report and sub-report of a code."""
    titles = list(dict.fromkeys(_all_titles()))
    report, subreport = (
        F.array(*[F.lit(t).cast("string") for t in column]) for column in zip(*titles, strict=True)
    )
    return F.get(report, code), F.get(subreport, code)


def classify_report(file_name: Column) -> Column:
    """``struct(report_name, subreport_name)`` of a file name, null for files that are none."""
    code = report_code(file_name)
    report, subreport = report_titles(code)
    titles = F.struct(report.alias("report_name"), subreport.alias("subreport_name"))
    return F.when(code.isNotNull(), titles)


def target_table(report: Column, subreport: Column) -> Column:
    """Table that a report fills, "NA" for none; an empty sub-report counts as null."""
    tables = F.create_map(
        *[F.lit(v) for name, sub, t in TARGET_TABLES for v in (f"{name}\n{sub or ''}", t)]
    )
    pair = F.concat(report, F.lit("\n"), F.coalesce(subreport, F.lit("")))
    return F.coalesce(F.try_element_at(tables, pair), F.lit(NO_TARGET))


def latest(
    files: DataFrame, keys: Sequence[str], time: str, tie: str, keep: Sequence[str], also: Sequence[str]
) -> DataFrame:
    """Per key the row of the newest ``time`` in a study folder; the smallest ``tie`` wins a draw.
    Rows without a ``time`` or one of the columns ``also`` do not count.

    An aggregate with a partial form: a study that holds most files shrinks before the shuffle.
    """
    # Files that lie outside a study folder belong to no study.
    counts = F.col("study_name").isNotNull() & F.col(time).isNotNull()
    for k in also:
        counts = counts & F.col(k).isNotNull()
    # A row without an order is never the least. As a filter the condition would move ahead of the
    # columns it tests and work them out again at each place that names them.
    newest_first = F.when(counts, F.struct(-F.unix_micros(F.col(time).cast("timestamp")), F.col(tie)))
    return (
        files.groupBy(*keys)
        .agg(F.min_by(F.struct(*keep), newest_first).alias("_file"))
        .where(F.col("_file").isNotNull())
        .select(*keys, *[f"_file.{c}" for c in keep])
    )


def latest_by_name(files: DataFrame, tie: str = "path", keep: Sequence[str] = ("path", "file_name")) -> DataFrame:
    """Newest curated file per date, study folder and file type, by the time in its name."""
    found = files.withColumns(
        {
            "file_type": classify_file(F.col("file_name")),
            "_time": name_timestamp(F.col("file_name")),
        }
    )
    return latest(found, ["extract_date", "study_name", "file_type"], "_time", tie, keep, ["file_type"])


def latest_by_modification(
    files: DataFrame, tie: str = "path", keep: Sequence[str] = ("path", "file_name")
) -> DataFrame:
    """The same by modification time."""
    found = files.withColumn(
        "file_type", classify_file(F.col("file_name"), by_modification=True)
    )
    return latest(
        found, ["extract_date", "study_name", "file_type"], "modificationTime", tie, keep, ["file_type"]
    )


def latest_reports(files: DataFrame, tie: str = "path") -> DataFrame:
    """Newest file per date, study, report and sub-report; a null sub-report is a group."""
    found = files.withColumns(
        {
            "_code": report_code(F.col("file_name")),
            "_time": name_timestamp(F.col("file_name"), ("csv", "enc")),
        }
    )
    # Titles are told of the chosen files only.
    newest = latest(found, ["extract_date", "study_name", "_code"], "_time", tie, ["file_name"], ["_code"])
    report, subreport = report_titles(F.col("_code"))
    return newest.select(
        "extract_date", "study_name", report.alias("report_name"), subreport.alias("subreport_name"), "file_name"
    )


def with_study_code(files: DataFrame, pattern: str = text.STUDY_CODE_PATTERN) -> DataFrame:
    """Add ``study_code`` from the file name; null where the name holds none."""
    return files.withColumn("study_code", text.extract_code(F.col("file_name"), pattern))

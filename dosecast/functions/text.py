"""Column functions for report text: codes, dates, visit labels, drug names.

Every function takes and returns a ``Column`` built from Spark's own expressions. ``let`` and
the list functions use higher-order functions, which leave generated code for their own part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts of the vendor reports, tried from left to right.
REPORT_DATE_FORMATS = ("d-MMM-yyyy", "d MMM yyyy")

# Layouts a birth date may come in, day first.
BIRTH_DATE_FORMATS = (
    "d/M/yyyy",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "yyyy-MM-dd",
    "d-M-yyyy",
    "d.M.yyyy",
)

# Two letter groups, two number groups, and an optional cohort pair such as "-04_05".
# A deployment with other codes passes its own pattern.
STUDY_CODE_PATTERN = r"[A-Z]{2}-[A-Z]{2}-\d+-\d+(?:-\d+_\d+)?"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Every sign that counts as white space in Unicode.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, no-break spaces included."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True where the text is null or holds white space only."""
    return F.coalesce(strip(text), F.lit("")) == ""


def _first_number(text: Column, pattern: str, default: int) -> Column:
    digits = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.lit(default))


def parse_cycle_number(label: Column) -> Column:
    """Cycle number of a visit label ("C20D1", "Cycle 46 Day 8"), 0 when there is none."""
    return _first_number(label, r"(?i)(?:C|Cycle\s?)(\d+)", 0)


def parse_cycle_day(label: Column) -> Column:
    """Day number of a visit label, 1 when there is none."""
    return _first_number(label, r"(?i)(?:D|Day\s?)(\d+)", 1)


def parse_int_list(text: Column) -> Column:
    """Numbers of a comma-separated list, in order and with repeats; other tokens drop out.

    Null, and text without any number, give an empty array.
    """
    tokens = F.transform(F.split(text, ","), strip)
    numbers = F.transform(
        F.filter(tokens, lambda t: t.rlike("^[0-9]+$")), lambda t: t.try_cast("int")
    )
    return F.coalesce(
        F.filter(numbers, lambda n: n.isNotNull()), F.array().cast("array<int>")
    )


def visits_per_cycle(visit_days: Column) -> Column:
    """How many visits one cycle has according to its day list."""
    return F.size(parse_int_list(visit_days))


def need_per_cycle(visit_days: Column, quantity: Column) -> Column:
    """Units one cycle needs; null where the quantity is null."""
    return visits_per_cycle(visit_days) * quantity


def choose_drug(study_drug: Column, additional_drug: Column) -> Column:
    """The study drug, else the additional one."""
    return F.coalesce(study_drug, additional_drug)


def mentions(text: Column, word: str) -> Column:
    """True where the text holds the word in any case; false for null."""
    return F.coalesce(F.lower(text).contains(word.lower()), F.lit(False))


def visit_label(last_label: Column, cycle: Column, day: Column) -> Column:
    """"Cycle c Day d", with the arm prefix taken from the last recorded visit's label."""
    prefix = (
        F.when(mentions(last_label, "crossover"), F.lit("Crossover "))
        .when(mentions(last_label, "tpc"), F.lit("TPC "))
        .otherwise(F.lit(""))
    )
    return F.concat(
        prefix, F.lit("Cycle "), cycle.cast("string"), F.lit(" Day "), day.cast("string")
    )


def normalise_text(text: Column) -> Column:
    """Straight quotes for curly ones, then strip; case and null are kept."""
    return strip(F.translate(text, "‘’“”", "''\"\""))


def extract_code(text: Column, pattern: str = STUDY_CODE_PATTERN) -> Column:
    """First study code in the text, null when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def strip_prefix(text: Column, prefix_pattern: str) -> Column:
    """Remove a leading word (a regular expression) and the white space after it."""
    return F.regexp_replace(text, rf"^(?:{prefix_pattern})\s+", "")


def first_date(text: Column, formats: Sequence[str] = REPORT_DATE_FORMATS) -> Column:
    """The date by the first layout that fits, null when none does."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def extract_year(text: Column, formats: Sequence[str] = BIRTH_DATE_FORMATS) -> Column:
    """Four digits as they stand, else the year of a day-first date, else null."""
    return F.when(text.rlike("^[0-9]{4}$"), text.try_cast("int")).otherwise(
        F.year(first_date(text, formats))
    )


def safe_cast(value: Column, data_type: str) -> Column:
    """Cast; null where the value does not fit."""
    return value.try_cast(data_type)


def base_name_before_dose(drug: Column) -> Column:
    """Text before the first white space that a digit follows, null when there is none."""
    pattern = r"^(.*?)\s\d"
    return F.when(drug.rlike(pattern), F.regexp_extract(drug, pattern, 1))


def drop_dose(drug: Column) -> Column:
    """Cut each line of the text at its first digit."""
    return strip(F.regexp_replace(drug, r"\d.*", ""))


def place_pattern(places: Column) -> Column:
    """Alternation of the place names in an array, null for none.

    Longer names go first, so that a name inside another one ("Korea" in "South Korea")
    does not break it.
    """
    longest_first = F.array_sort(
        F.array_distinct(F.filter(places, lambda p: ~is_blank(p))),
        lambda a, b: F.coalesce(
            F.nullif(F.length(b) - F.length(a), F.lit(0)),
            F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(F.lit(0)),
        ),
    )
    quoted = F.transform(longest_first, lambda p: F.concat(F.lit(r"\Q"), p, F.lit(r"\E")))
    return F.nullif(F.array_join(quoted, "|"), F.lit(""))


def drop_places(text: Column, pattern: Column) -> Column:
    """Remove the whole-word place names of a ``place_pattern``, in any case, with one hyphen
    beside them; a null pattern changes nothing."""
    behind = F.concat(F.lit(r"(?iU)\b(?:"), pattern, F.lit(r")\b-?"))
    ahead = F.concat(F.lit(r"(?iU)-\b(?:"), pattern, F.lit(r")\b"))
    once = F.regexp_replace(text, behind, F.lit(""))
    return F.coalesce(F.regexp_replace(once, ahead, F.lit("")), text)


def tidy_name(text: Column) -> Column:
    """Drop round brackets, outer hyphens and white space, and squeeze inner white space."""
    steps = ((r"[()]", ""), (r"(?U)^[\s\-]+", ""), (r"(?U)[\s\-]+$", ""), (r"(?U)\s{2,}", " "))
    return strip(reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, text))

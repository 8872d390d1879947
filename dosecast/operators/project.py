"""Project the future visits of each subject and drug."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions import text

# Days looked ahead, and the cycle length where a rule gives none.
HORIZON_DAYS = 1095
DEFAULT_PERIOD = 28
# Cycle numbers, day numbers and cycle lengths beyond this are faults of the data.
OUT_OF_RANGE = 1_000_000


def as_date(as_of: dt.date | Column | None) -> Column:
    """The day the projection starts from; today where none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def visit_days(days: Column) -> Column:
    """Sorted day numbers of a cycle, day 1 where the list has none; repeats stay."""
    listed = F.array_sort(text.parse_int_list(days))
    return F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(1)))


def period_days(frequency: Column) -> Column:
    return F.coalesce(frequency.try_cast("int"), F.lit(DEFAULT_PERIOD))


def cycle_cap(max_cycles: Column) -> Column:
    """Highest cycle number allowed, null for no cap."""
    return F.when(max_cycles >= 1, F.floor(max_cycles).try_cast("int"))


def first_future_day(day_one: Column, period: Column, as_of: Column) -> Column:
    """Day 1 of the next cycle, moved by whole periods to lie after ``as_of`` if past."""
    start = F.date_add(day_one, period)
    missed = F.floor(F.datediff(as_of, start) / period).cast("int") + 1
    return F.when(start < as_of, F.date_add(start, missed * period)).otherwise(start)


def bad_periods(plan: DataFrame) -> DataFrame:
    """Rows that cannot be projected because the cycle length is not positive."""
    return projection_rejects(plan).where(F.col("reason") == "bad_period")


def reject_reason(cycle: Column, day: Column, period: Column) -> Column:
    """Why a row cannot be projected, null where it can."""
    return F.when(period <= 0, "bad_period").when(
        F.greatest(cycle, day, period) > OUT_OF_RANGE, "out_of_range"
    )


def projection_rejects(plan: DataFrame) -> DataFrame:
    """The rows that ``project_visits`` leaves out as faulty, with the ``reason``:
    ``bad_period`` or ``out_of_range``."""
    cycle, day = last_visit(plan)
    period = period_days(F.col("dispensing_frequency_days"))
    return plan.withColumn("reason", reject_reason(cycle, day, period)).where("reason IS NOT NULL")


def last_visit(plan: DataFrame) -> tuple[Column, Column]:
    """Cycle and day of the last visit: the parsed columns where they exist, else the label's."""
    label = F.col("last_study_visit_recorded")
    cycle, day = text.parse_cycle_number(label), text.parse_cycle_day(label)
    if "parsed_last_visit_cycle" in plan.columns:
        cycle = F.col("parsed_last_visit_cycle")
    if "parsed_last_visit_day" in plan.columns:
        day = F.col("parsed_last_visit_day")
    return cycle, day


def project_visits(
    plan: DataFrame,
    as_of: dt.date | Column | None = None,
    horizon_days: int = HORIZON_DAYS,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per visit due up to ``horizon_days`` after ``as_of``.

    Reads ``subject_number, last_study_visit_date, last_study_visit_recorded, visit_days,
    dispensing_frequency_days, max_cycles``, and the parsed last cycle and day where they
    exist. Cycle offset -1 stands for the rest of the current cycle and 0, 1, ... for the
    cycles after it; the last offset follows from the horizon and the cap, so each row knows
    its visits without a loop. No shuffle: the rows only multiply where they are.

    Rows of ``projection_rejects`` give no visits. Offsets are 64-bit and are compared with the
    horizon before they become dates, so a large day number cannot wrap into the past.
    """
    today = as_date(as_of)
    label = F.col("last_study_visit_recorded")
    carried = [c for c in plan.columns if c not in _PROJECTED] if carry is None else list(carry)
    cycle, day = last_visit(plan)
    ready = (
        plan.where(
            F.col("last_study_visit_date").isNotNull() & F.col("subject_number").isNotNull()
        )
        .select(
            *carried,
            label.alias("_label"),
            F.col("last_study_visit_date").cast("date").alias("_last"),
            cycle.cast("long").alias("_cycle"),
            day.cast("long").alias("_day"),
            visit_days(F.col("visit_days")).alias("_days"),
            period_days(F.col("dispensing_frequency_days")).alias("_period"),
            cycle_cap(F.col("max_cycles")).cast("long").alias("_cap"),
        )
        .where(reject_reason(F.col("_cycle"), F.col("_day"), F.col("_period")).isNull())
        .withColumn("_day_one", F.date_sub("_last", (F.col("_day") - 1).cast("int")))
        .withColumn("_start", first_future_day(F.col("_day_one"), F.col("_period"), today))
    )
    end = F.date_add(today, horizon_days)
    first_day = F.element_at("_days", 1).cast("long")
    room = F.datediff(end, F.col("_start")).cast("long") - (first_day - 1)
    last_offset = F.floor(room / F.col("_period"))
    # "least" skips a null cap.
    last_offset = F.least(last_offset, F.col("_cap") - F.col("_cycle") - 1)
    never = F.lit(-1).cast("long")
    offsets = F.sequence(never, F.greatest(last_offset, never))
    k = F.col("_offset")
    base = F.when(k < 0, F.col("_day_one")).otherwise(F.col("_start"))
    ahead = F.greatest(k, F.lit(0)) * F.col("_period") + F.col("day") - 1
    date = F.date_add(base, ahead.cast("int"))
    return (
        ready.withColumn("_offset", F.explode(offsets))
        .withColumn("day", F.explode("_days"))
        .where((k >= 0) | (F.col("day") > F.col("_day")))
        .where(ahead <= F.datediff(end, base))
        .withColumn("cycle", (F.col("_cycle") + 1 + k).cast("int"))
        .withColumn("predicted_next_visit_date", date)
        .where(F.coalesce(F.col("cycle") <= F.col("_cap"), F.lit(True)))
        .select(
            *carried,
            text.visit_label(F.col("_label"), F.col("cycle"), F.col("day")).alias(
                "predicted_study_visit"
            ),
            "cycle",
            "day",
            "predicted_next_visit_date",
        )
    )


_PROJECTED = frozenset(
    (
        "last_study_visit_recorded", "last_study_visit_date", "visit_days",
        "dispensing_frequency_days", "max_cycles", "parsed_last_visit_cycle",
        "parsed_last_visit_day",
    )
)

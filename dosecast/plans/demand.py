"""Demand plan: which drug each subject needs at which future visit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions import rows
from dosecast.operators import match, steps
from dosecast.operators.project import HORIZON_DAYS, project_visits
from dosecast.operators.rollup import rollup_first_sum
from dosecast.schemas import PLAN_SCHEMA

SUBJECT_COLUMNS = (
    "study_protocol", "site_id", "country", "parent_depot", "subject_number", "tpc",
    "subject_status", "randomized_treatment", "last_study_visit_recorded",
    "last_study_visit_date", "extract_date",
)
RULE_COLUMNS = (
    "study_protocol", "randomized_treatment", "subject_status", "tpc", "study_drug_dispensed",
    "additional_study_drug_dispensed", "country", "visit_days", "dispensing_quantity",
    "dispensing_frequency_days", "max_cycles",
)
PLAN_KEYS = ("study_protocol", "subject_number", "drug_dispensed")
NEED = "total_medicines_required_per_cycle"
# Columns whose null is a value of its own: the normalised texts and the parsed numbers.
FIRST_ROW = (
    "randomized_treatment", "tpc", "subject_country", "parsed_last_visit_cycle",
    "parsed_last_visit_day",
)
FIRST_VALUE = (
    "parent_depot", "site_id", "subject_status", "last_study_visit_recorded",
    "last_study_visit_date", "extract_date", "visit_days", "dispensing_quantity",
    "dispensing_frequency_days", "max_cycles",
)
SORT_KEYS = ("study_name", "parent_depot", "site_id", "subject_number", "cycle", "day")


def _with_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    kept = rows.project_available(df, wanted)
    missing = {c: F.lit(None).cast("string") for c in wanted if c not in kept.columns}
    return kept.withColumns(missing) if missing else kept


def prepare_subjects(subjects: DataFrame) -> DataFrame:
    """Trimmed names, the needed columns, real dates."""
    return rows.coerce_dates(_with_columns(subjects, SUBJECT_COLUMNS))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Trimmed names and the needed columns; ``rule_no`` stays where the input has it."""
    trimmed = rows.trim_column_names(rules)
    if "tpc" not in trimmed.columns:
        trimmed = rows.rename_first_like(trimmed, "tpc", "tpc")
    extra = [c for c in ("rule_no",) if c in trimmed.columns]
    return _with_columns(trimmed, [*RULE_COLUMNS, *extra])


def rule_order(rules: DataFrame) -> list[str]:
    """Row order of the rules: their number, or their content where there is none."""
    if "rule_no" in rules.columns:
        return ["rule_no"]
    return [
        "study_drug_dispensed", "additional_study_drug_dispensed", "visit_days",
        "dispensing_quantity", "dispensing_frequency_days", "max_cycles",
    ]


def subject_drugs(
    subjects: DataFrame,
    rules: DataFrame,
    fallback: str = "all",
    excluded: Sequence[str] = match.EXCLUDED_STATUSES,
    match_null_base: bool = False,
    watch: Callable[..., DataFrame] = steps.unwatched,
) -> DataFrame:
    """One row per study, subject and drug, with the need per cycle and the visit pattern."""
    read = watch(prepare_subjects(subjects), subjects=steps.rows())
    active = watch(match.active_subjects(read, excluded), active=steps.rows())
    ready_rules = match.normalise(prepare_rules(rules), match.NORMALISED_RULES)
    ready = match.normalise(active, match.NORMALISED)
    kept = match.match_rules(ready, ready_rules, fallback, match_null_base, watch)
    matched = watch(match.add_need(kept), with_drug=steps.rows())
    rolled = rollup_first_sum(
        matched,
        PLAN_KEYS,
        [NEED],
        FIRST_VALUE,
        FIRST_ROW,
        match.order_key(matched, rule_order(ready_rules)),
    )
    return watch(rolled, subject_drugs=steps.rows())


def plan_demand(
    subjects: DataFrame,
    rules: DataFrame,
    as_of: dt.date | Column | None = None,
    horizon_days: int = HORIZON_DAYS,
    fallback: str = "all",
    excluded: Sequence[str] = match.EXCLUDED_STATUSES,
    match_null_base: bool = False,
    processed_at: dt.datetime | None = None,
    watch: Callable[..., DataFrame] = steps.unwatched,
) -> DataFrame:
    """Every visit due up to the horizon with the drug and quantity it needs.

    The result is not sorted; ``sort_plan`` does that for display. ``watch`` (that of a
    ``StepCounts``) counts the rows of every step.
    """
    drugs = subject_drugs(subjects, rules, fallback, excluded, match_null_base, watch)
    carry = [
        "study_protocol", "parent_depot", "site_id", "subject_number", "subject_status",
        "subject_country", "randomized_treatment", "tpc", "drug_dispensed",
        "dispensing_quantity", "extract_date",
    ]
    visits = project_visits(drugs, as_of, horizon_days, carry)
    stamped = visits.withColumnRenamed("study_protocol", "study_name").withColumn(
        "processed_timestamp", rows.run_stamp(processed_at)
    )
    return rows.fit_schema(stamped, PLAN_SCHEMA)


def sort_plan(plan: DataFrame) -> DataFrame:
    return plan.orderBy(*[F.col(c).asc_nulls_last() for c in SORT_KEYS])


def first_visits(plan: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of the sorted plan; ties resolve by drug and date."""
    ties = ("drug_dispensed", "predicted_next_visit_date")
    return plan.orderBy(*[F.col(c).asc_nulls_last() for c in (*SORT_KEYS, *ties)]).limit(n)

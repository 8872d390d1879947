"""Match subjects to dispensing rules, with country-scoped rules over generic ones.

A rule with a country is *scoped* and applies to subjects of that country; a rule without is
*generic*. Both match on study, treatment, choice drug and status, in any case, and null keys
equal each other. A matched row is dropped where scoped rules exist for the same keys,
country and drug base name but none of them lists the row's drug.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.functions import text
from dosecast.operators import steps
from dosecast.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    ROWS_PER_TASK,
    heavy_keys,
    lookup_join,
    row_bytes,
)
from dosecast.operators.steps import unwatched

MATCH_KEYS = ("study_protocol", "randomized_treatment", "tpc", "subject_status")
SCOPE = "country"
DRUG = "study_drug_dispensed"
NORMALISED = ("study_protocol", "randomized_treatment", "tpc", "country")
NORMALISED_RULES = (*NORMALISED, "study_drug_dispensed", "additional_study_drug_dispensed")

# The statuses of subjects who have left treatment.
EXCLUDED_STATUSES = (
    "Screen Failed",
    "Pre-Screened Failed",
    "Treatment Discontinued",
    "Crossover Treatment Discontinued",
)


def active_subjects(
    subjects: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Drop the excluded statuses (exact case); a null status stays."""
    return subjects.where(F.coalesce(~F.col("subject_status").isin(*excluded), F.lit(True)))


def normalise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``normalise_text`` on those of the columns that exist."""
    return df.withColumns(
        {c: text.normalise_text(F.col(c)) for c in columns if c in df.columns}
    )


def scoped_rules(rules: DataFrame) -> DataFrame:
    return rules.where(F.col(SCOPE).isNotNull())


def generic_rules(rules: DataFrame) -> DataFrame:
    return rules.where(F.col(SCOPE).isNull())


@dataclass(frozen=True)
class RuleSize:
    """Measured rules: rows, bytes and distinct countries."""

    rows: int
    size: int
    places: int

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES


def measure(rules: DataFrame) -> RuleSize:
    """Look at the rules, to choose how to join them."""
    widths = F.coalesce(F.sum(row_bytes(rules)), F.lit(0))
    return RuleSize(*rules.agg(F.count(F.lit(1)), widths, F.count_distinct(SCOPE)).first())


def _folded(column: str) -> str:
    return f"_{column}_folded"


FOLDED_KEYS = [_folded(k) for k in MATCH_KEYS]
FOLDED_SCOPE = _folded(SCOPE)


def fold_keys(df: DataFrame) -> DataFrame:
    """Add the lower-case match keys."""
    return df.withColumns({_folded(k): F.lower(k) for k in (*MATCH_KEYS, SCOPE)})


def unfold(df: DataFrame) -> DataFrame:
    return df.drop(*FOLDED_KEYS, FOLDED_SCOPE)


def _rule_side(rules: DataFrame) -> DataFrame:
    """Folded keys and the rule's own columns; the key columns come from the subject."""
    return fold_keys(rules).drop(*MATCH_KEYS, SCOPE)


def match_scoped(
    subjects: DataFrame,
    rules: DataFrame,
    small: bool | None = None,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Folded subjects joined to the scoped rules of their keys and country."""
    side = _rule_side(scoped_rules(rules))
    joined = lookup_join(
        subjects, side, [*FOLDED_KEYS, FOLDED_SCOPE], subjects.columns, "inner", small, heavy
    )
    return joined.withColumns({"subject_country": F.col(SCOPE), "rule_scope": F.lit(0)})


def match_generic(
    subjects: DataFrame,
    rules: DataFrame,
    small: bool | None = None,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Folded subjects joined to the generic rules of their keys."""
    side = _rule_side(generic_rules(rules)).drop(FOLDED_SCOPE)
    joined = lookup_join(subjects, side, FOLDED_KEYS, subjects.columns, "inner", small, heavy)
    return joined.withColumns({"subject_country": F.col(SCOPE), "rule_scope": F.lit(1)})


def match_in_one_pass(subjects: DataFrame, rules: DataFrame) -> DataFrame:
    """``match_scoped`` and ``match_generic`` as one broadcast join, for small rules."""
    side = _rule_side(rules).withColumnRenamed(FOLDED_SCOPE, "_rule_country")
    renamed = {k: f"_r{i}" for i, k in enumerate(FOLDED_KEYS)}
    side = F.broadcast(side.withColumnsRenamed(renamed))
    on = F.col("_rule_country").isNull() | (F.col("_rule_country") == F.col(FOLDED_SCOPE))
    for k in FOLDED_KEYS:
        on = on & F.col(k).eqNullSafe(F.col(renamed[k]))
    return (
        subjects.join(side, on)
        .withColumns(
            {
                "subject_country": F.col(SCOPE),
                "rule_scope": F.col("_rule_country").isNull().cast("int"),
            }
        )
        .drop(*renamed.values(), "_rule_country")
    )


def without_scoped_match(
    subjects: DataFrame,
    rules: DataFrame,
    small: bool | None = None,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Folded subjects that no scoped rule matches.

    Whether a row matches follows from its keys and country alone, so this is an anti join
    on them and needs no row number.
    """
    keys = [*FOLDED_KEYS, FOLDED_SCOPE]
    side = fold_keys(scoped_rules(rules)).select(*keys).distinct()
    return lookup_join(subjects, side, keys, subjects.columns, "left_anti", small, heavy)


def rule_base_names(rules: DataFrame) -> DataFrame:
    """The scoped rules with ``base_name``: the drug up to its first digit, without any of
    the rules' country names; null where no study drug is named.

    The names form one pattern however many there are, which reaches the rules as a scalar
    subquery.
    """
    scoped = scoped_rules(rules)
    pattern = scoped.agg(text.place_pattern(F.collect_set(SCOPE))).scalar()
    cleaned = text.drop_places(text.drop_dose(F.col(DRUG)), F.col("_pattern"))
    return (
        scoped.withColumn("_pattern", pattern)
        .withColumn("base_name", text.tidy_name(cleaned))
        .drop("_pattern")
    )


def overridden_drugs(rules: DataFrame, match_null_base: bool = False) -> DataFrame:
    """Which drug of which keys is overridden in which country.

    The answer depends on the rules only, so it is computed on them before any subject is
    read: one row per (folded keys, folded country, drug). ``match_null_base`` also lets a
    drug without a dose collide with scoped rules that name no study drug.
    """
    base_keys = [*FOLDED_KEYS, "base_name"]
    listed = (
        fold_keys(rule_base_names(rules))
        .select(*base_keys, FOLDED_SCOPE, DRUG)
        .distinct()
    )
    offered = (
        fold_keys(rules)
        .withColumnRenamed(FOLDED_SCOPE, "_own_scope")
        .withColumn("base_name", text.base_name_before_dose(F.col(DRUG)))
        .select(*base_keys, "_own_scope", DRUG)
        .distinct()
    )
    if not match_null_base:
        listed = listed.where(F.col("base_name").isNotNull())
        offered = offered.where(F.col("base_name").isNotNull())
    governed = listed.select(*base_keys, FOLDED_SCOPE).distinct()
    candidates = _null_safe_join(offered, governed, base_keys).where(
        F.col("_own_scope").isNull() | (F.col("_own_scope") == F.col(FOLDED_SCOPE))
    )
    keys = [*FOLDED_KEYS, FOLDED_SCOPE, DRUG]
    return (
        _null_safe_join(candidates, listed, [*keys, "base_name"], "left_anti")
        .select(*keys)
        .distinct()
    )


def _null_safe_join(left, right, keys, how="inner") -> DataFrame:
    """Null-safe join of two rule-sized sides; Spark picks the strategy."""
    renamed = {k: f"_r{i}" for i, k in enumerate(keys)}
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(renamed[k]))
    return left.join(right.withColumnsRenamed(renamed), on, how).drop(*renamed.values())


def drop_overridden(
    matched: DataFrame,
    rules: DataFrame,
    match_null_base: bool = False,
    size: RuleSize | None = None,
    broadcast: bool | None = None,
    heavy: DataFrame | bool | None = None,
) -> DataFrame:
    """Remove the folded matched rows whose drug is overridden in the subject's country.

    ``heavy`` gives the heavy match keys of the subjects, so that the matched rows need not be
    counted; ``broadcast=False`` never sends the overridden drugs to every executor."""
    size = size or measure(rules)
    gone = overridden_drugs(rules, match_null_base)
    keys = [*FOLDED_KEYS, FOLDED_SCOPE, DRUG]
    # A drug can be gone in each country at most, so the rules bound the list.
    small = size.small and size.rows * size.places <= BROADCAST_ROWS
    chosen = False if broadcast is False else small or None
    return lookup_join(matched, gone, keys, matched.columns, "left_anti", chosen, heavy)


def match_rules(
    subjects: DataFrame,
    rules: DataFrame,
    fallback: str = "all",
    match_null_base: bool = False,
    watch: Callable[..., DataFrame] = unwatched,
    broadcast: bool | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All matches of the subjects, overridden drugs removed.

    ``fallback="all"`` lets generic rules match every subject; ``"unmatched"`` only those
    without a scoped match. Rules that fit a broadcast meet the subjects in one pass.
    Others are shuffled to them, and match keys of more than ``rows_per_task`` subjects, counted
    once on the subjects' key columns, spread over many tasks in each of the joins.
    ``broadcast`` goes before the measured size; ``watch`` counts the rows of the steps.
    """
    if fallback not in ("all", "unmatched"):
        raise ValueError(f"fallback must be 'all' or 'unmatched', not {fallback!r}")
    size = measure(rules)
    small = size.small if broadcast is None else broadcast
    folded = fold_keys(subjects)
    heavy = None
    if not small:
        # False: there are none, so no join counts them again.
        found = heavy_keys(folded, FOLDED_KEYS, rows_per_task)
        heavy = False if found is None else found
    if fallback == "all" and small:
        matched = match_in_one_pass(folded, rules)
    else:
        rest = (
            folded if fallback == "all" else without_scoped_match(folded, rules, small, heavy)
        )
        matched = match_scoped(folded, rules, small, heavy).unionByName(
            match_generic(rest, rules, small, heavy)
        )
    scope = F.col("rule_scope")
    matched = watch(matched, scoped=F.count_if(scope == 0), generic=F.count_if(scope == 1))
    kept = drop_overridden(matched, rules, match_null_base, size, broadcast, heavy)
    return unfold(watch(kept, not_overridden=steps.rows()))


def add_need(matched: DataFrame) -> DataFrame:
    """Add the drug, the need per cycle and the parsed last visit; drop rows without a drug."""
    label = F.col("last_study_visit_recorded")
    return matched.withColumns(
        {
            "visit_count_per_cycle": text.visits_per_cycle(F.col("visit_days")),
            "total_medicines_required_per_cycle": text.need_per_cycle(
                F.col("visit_days"), F.col("dispensing_quantity")
            ),
            "drug_dispensed": text.choose_drug(
                F.col(DRUG), F.col("additional_study_drug_dispensed")
            ),
            "parsed_last_visit_cycle": text.parse_cycle_number(label),
            "parsed_last_visit_day": text.parse_cycle_day(label),
        }
    ).where(F.col("drug_dispensed").isNotNull())


def order_key(matched: DataFrame, rule_order: Sequence[str]) -> Column:
    """Sort key of matched rows: scoped first, then the subject row, then the rule row."""
    subject_order = (
        "site_id", "parent_depot", "subject_status", "tpc", "randomized_treatment",
        "subject_country", "last_study_visit_date", "last_study_visit_recorded",
    )
    return F.struct(
        F.col("rule_scope"), *[F.col(c) for c in subject_order], *[F.col(c) for c in rule_order]
    )

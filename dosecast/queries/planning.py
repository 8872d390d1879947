"""Queries on projection, matching and the demand plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dosecast.functions import rows, text
from dosecast.operators import match, snapshots
from dosecast.operators.project import bad_periods, project_visits, projection_rejects
from dosecast.operators.rollup import rollup_first_sum
from dosecast.plans import demand
from dosecast.queries.fixtures import AS_OF, HORIZON, cte, frame

STAMP = dt.datetime(2001, 9, 1)


def visits(spark, sf):
    return frame(spark, sf, "visit_input")


def project(spark, sf):
    return project_visits(visits(spark, sf), AS_OF, HORIZON)


def project_current(spark, sf):
    """Rest of the current cycle: the last recorded cycle's number is kept."""
    plan = visits(spark, sf).withColumn(
        "last_cycle", text.parse_cycle_number(F.col("last_study_visit_recorded"))
    )
    carried = project_visits(plan, AS_OF, HORIZON, ["subject_number", "last_cycle"])
    return carried.where("cycle = last_cycle").drop("last_cycle")


def project_future(spark, sf):
    plan = visits(spark, sf).withColumn(
        "last_cycle", text.parse_cycle_number(F.col("last_study_visit_recorded"))
    )
    carried = project_visits(plan, AS_OF, HORIZON, ["subject_number", "last_cycle"])
    return carried.where("cycle > last_cycle").drop("last_cycle")


def project_rollforward(spark, sf):
    """First future visit of each subject: past cycles are skipped, their numbers are not."""
    return (
        project_future(spark, sf)
        .groupBy("subject_number")
        .agg(
            F.min("predicted_next_visit_date").alias("first_date"),
            F.min("cycle").alias("first_cycle"),
        )
    )


def project_capped(spark, sf):
    capped = visits(spark, sf).where("max_cycles >= 1")
    return project_visits(capped, AS_OF, HORIZON, ["subject_number", "max_cycles"])


def project_defaults(spark, sf):
    """Visits per subject, for subjects without a period or a usable day list."""
    bare = visits(spark, sf).where(
        F.col("dispensing_frequency_days").isNull()
        | (F.size(text.parse_int_list(F.col("visit_days"))) == 0)
    )
    return (
        project_visits(bare, AS_OF, HORIZON)
        .groupBy("subject_number")
        .agg(F.count(F.lit(1)).alias("visits"), F.max("predicted_next_visit_date").alias("last_date"))
    )


def bad_period(spark, sf):
    plan = visits(spark, sf).withColumn(
        "dispensing_frequency_days", F.col("dispensing_frequency_days") - 30
    )
    return bad_periods(plan).select("subject_number", "reason")


def faulty_visits(spark, sf):
    """The visits with labels, day lists and cycle lengths that no calendar holds mixed in."""
    number = F.col("subject_number")
    return visits(spark, sf).withColumns(
        {
            "last_study_visit_recorded": F.when(number % 50 == 0, "C2147483647D1").otherwise(
                F.col("last_study_visit_recorded")
            ),
            "visit_days": F.when(number % 53 == 0, "1,2147483647").otherwise(F.col("visit_days")),
            "dispensing_frequency_days": F.when(number % 59 == 0, F.lit(0)).otherwise(
                F.col("dispensing_frequency_days")
            ),
        }
    )


def projection_faults(spark, sf):
    return projection_rejects(faulty_visits(spark, sf)).select("subject_number", "reason")


def project_faulty(spark, sf):
    return project_visits(faulty_visits(spark, sf), AS_OF, HORIZON, ["subject_number"])


def visit_label(spark, sf):
    label = F.col("last_study_visit_recorded")
    return visits(spark, sf).select(
        "subject_number",
        text.visit_label(label, text.parse_cycle_number(label), text.parse_cycle_day(label)).alias(
            "label"
        ),
    )


def subjects(spark, sf):
    active = match.active_subjects(demand.prepare_subjects(frame(spark, sf, "subjects")))
    return match.fold_keys(match.normalise(active, match.NORMALISED))


def rules(spark, sf):
    return match.normalise(
        demand.prepare_rules(frame(spark, sf, "rules")), match.NORMALISED_RULES
    )


MATCHED = ["subject_number", "subject_status", "subject_country", "rule_no", "study_drug_dispensed"]


def scoped_match(spark, sf):
    return match.match_scoped(subjects(spark, sf), rules(spark, sf)).select(*MATCHED)


def generic_match(spark, sf):
    return match.match_generic(subjects(spark, sf), rules(spark, sf)).select(*MATCHED)


def match_union(spark, sf):
    both = rows.union_all(
        [
            match.match_scoped(subjects(spark, sf), rules(spark, sf)),
            match.match_generic(subjects(spark, sf), rules(spark, sf)),
        ]
    )
    return both.select(*MATCHED, "rule_scope")


def fallback_anti(spark, sf):
    s, r = subjects(spark, sf), rules(spark, sf)
    return match.match_generic(match.without_scoped_match(s, r), r).select(*MATCHED)


def scoped_override(spark, sf):
    matched = match.match_rules(match.unfold(subjects(spark, sf)), rules(spark, sf))
    return matched.select(*MATCHED, "rule_scope")


def scoped_override_null_base(spark, sf):
    """Drugs without a dose collide with scoped rules that name no study drug."""
    matched = match.match_rules(
        match.unfold(subjects(spark, sf)), rules(spark, sf), match_null_base=True
    )
    return matched.select(*MATCHED, "rule_scope")


def skewed_override(spark, sf):
    """The matches by shuffled joins, as beyond the broadcast bound. The first study holds a third
    of the subjects; its keys, and all others of over fifty rows, are cut into salts."""
    matched = match.match_rules(
        match.unfold(subjects(spark, sf)), rules(spark, sf), broadcast=False, rows_per_task=50
    )
    return matched.select(*MATCHED, "rule_scope")


def skewed_unmatched(spark, sf):
    """As ``skewed_override``, with generic rules for subjects without a scoped match only."""
    matched = match.match_rules(
        match.unfold(subjects(spark, sf)),
        rules(spark, sf),
        "unmatched",
        broadcast=False,
        rows_per_task=50,
    )
    return matched.select(*MATCHED, "rule_scope")


def with_need(spark, sf):
    return match.add_need(
        match.match_rules(match.unfold(subjects(spark, sf)), rules(spark, sf))
    )


def need_per_cycle(spark, sf):
    return frame(spark, sf, "rules").select(
        "rule_no",
        text.visits_per_cycle(F.col("visit_days")).alias("visits"),
        text.need_per_cycle(F.col("visit_days"), F.col("dispensing_quantity")).alias("need"),
    )


def choose_first(spark, sf):
    drug = text.choose_drug(F.col("study_drug_dispensed"), F.col("additional_study_drug_dispensed"))
    return (
        frame(spark, sf, "rules").select("rule_no", drug.alias("drug")).where("drug is not null")
    )


def rollup(spark, sf):
    matched = with_need(spark, sf)
    rolled = rollup_first_sum(
        matched,
        demand.PLAN_KEYS,
        [demand.NEED],
        demand.FIRST_VALUE,
        demand.FIRST_ROW,
        match.order_key(matched, ["rule_no"]),
    )
    return rolled.select(*ROLLED)


ROLLED = [
    "study_protocol", "subject_number", "drug_dispensed", "total_medicines_required_per_cycle",
    "randomized_treatment", "tpc", "subject_country", "parsed_last_visit_cycle",
    "parsed_last_visit_day", "parent_depot", "site_id", "subject_status",
    "last_study_visit_recorded", "last_study_visit_date", "extract_date", "visit_days",
    "dispensing_quantity", "dispensing_frequency_days", "max_cycles",
]


def exclude_status(spark, sf):
    return match.active_subjects(frame(spark, sf, "subjects")).select(
        "subject_number", "subject_status"
    )


REQUIRED = ("visit_days", "dispensing_quantity", "dispensing_frequency_days")


def require_columns(spark, sf):
    return rows.require(frame(spark, sf, "rules"), REQUIRED).select("rule_no", *REQUIRED)


def base_name_rule(spark, sf):
    return match.rule_base_names(rules(spark, sf)).select(
        "rule_no", "study_drug_dispensed", "base_name"
    )


def base_name_match(spark, sf):
    return frame(spark, sf, "rules").select(
        "rule_no", text.base_name_before_dose(F.col("study_drug_dispensed")).alias("base_name")
    )


def plan(spark, sf):
    return demand.plan_demand(
        frame(spark, sf, "subjects"),
        rows.require(frame(spark, sf, "rules"), REQUIRED),
        AS_OF,
        HORIZON,
        processed_at=STAMP,
    )


def flagship(spark, sf):
    return plan(spark, sf).drop("processed_timestamp")


def flagship_unmatched(spark, sf):
    """The plan where generic rules only serve subjects without a scoped match."""
    return demand.plan_demand(
        frame(spark, sf, "subjects"),
        rows.require(frame(spark, sf, "rules"), REQUIRED),
        AS_OF,
        HORIZON,
        fallback="unmatched",
        processed_at=STAMP,
    ).drop("processed_timestamp")


def sorted_plan(spark, sf):
    return demand.sort_plan(plan(spark, sf)).select(*demand.SORT_KEYS)


def run_summary(spark, sf):
    return snapshots.run_summary(plan(spark, sf))


def top_n(spark, sf):
    return demand.first_visits(plan(spark, sf), 10).select(*demand.SORT_KEYS, "drug_dispensed")


QUERIES = {
    "flagship_projection": flagship,
    "flagship_unmatched": flagship_unmatched,
    "project_visits": project,
    "project_current": project_current,
    "project_rollforward": project_rollforward,
    "project_future": project_future,
    "project_capped": project_capped,
    "project_defaults": project_defaults,
    "bad_period": bad_period,
    "projection_rejects": projection_faults,
    "project_faulty": project_faulty,
    "visit_label": visit_label,
    "scoped_match": scoped_match,
    "generic_match": generic_match,
    "fallback_anti": fallback_anti,
    "scoped_override": scoped_override,
    "scoped_override_null_base": scoped_override_null_base,
    "skewed_override": skewed_override,
    "skewed_unmatched": skewed_unmatched,
    "match_union": match_union,
    "need_per_cycle": need_per_cycle,
    "choose_first": choose_first,
    "rollup_first_sum": rollup,
    "exclude_status": exclude_status,
    "require_columns": require_columns,
    "base_name_rule": base_name_rule,
    "base_name_match": base_name_match,
    "sorted_plan": sorted_plan,
    "run_summary": run_summary,
    "top_n": top_n,
}

# --- the same in SQL -------------------------------------------------------------------

CYCLE = r"coalesce(try_cast(nullif(regexp_extract({0}, '(?i)(?:C|Cycle\s?)(\d+)', 1), '') as int), 0)"
DAY = r"coalesce(try_cast(nullif(regexp_extract({0}, '(?i)(?:D|Day\s?)(\d+)', 1), '') as int), 1)"
DAYS = (
    "coalesce([cast(trim(x) as int) for x in string_split({0}, ',') "
    "if regexp_full_match(trim(x), '[0-9]+')], cast([] as int[]))"
)
LABEL = (
    "concat(case when lower(coalesce({0}, '')) like '%crossover%' then 'Crossover ' "
    "when lower(coalesce({0}, '')) like '%tpc%' then 'TPC ' else '' end, "
    "'Cycle ', {1}, ' Day ', {2})"
)


def visit_ctes(source: str, cycle: str = CYCLE, day: str = DAY) -> str:
    """CTEs that end in ``visit``: the rows of ``source`` times their visits. Every cycle up to
    the horizon is written out, and past ones are filtered; no cycle is worked out in closed form.
    """
    recorded = "last_study_visit_recorded"
    return f""",
v1 as (
  select *, {cycle.format(recorded)} as c0, {day.format(recorded)} as d0,
    case when len({DAYS.format('visit_days')}) = 0 then [1] else list_sort({DAYS.format('visit_days')}) end as days,
    cast(coalesce(dispensing_frequency_days, 28) as int) as per,
    case when max_cycles >= 1 then cast(floor(max_cycles) as int) end as cap
  from {source} where last_study_visit_date is not null and subject_number is not null),
v2 as (select *, last_study_visit_date - (d0 - 1) as one from v1),
v3 as materialized (select *, row_number() over () as visit_row from v2),
ahead as (
  select visit_row, cast(unnest(generate_series(cast(one + per as timestamp), cast(date '{AS_OF}' + {HORIZON} as timestamp), to_days(per))) as date) as start,
    one + per as next_one from v3),
later as (
  select visit_row, start, row_number() over (partition by visit_row order by start) - 1 as k from ahead
  where start > date '{AS_OF}' or next_one >= date '{AS_OF}'),
v4 as (
  select *, one as start, cast(-1 as bigint) as k from v3
  union all select v3.*, later.start, later.k from v3 join later using (visit_row)),
v6 as (select *, unnest(days) as day from v4),
visit as (
  select *, cast(c0 + 1 + k as int) as cycle,
    cast(start + (day - 1) as date) as predicted_next_visit_date,
    {LABEL.format(recorded, 'cast(c0 + 1 + k as int)', 'day')} as predicted_study_visit
  from v6
  where (k >= 0 or day > d0)
    and start + (day - 1) <= date '{AS_OF}' + {HORIZON}
    and (cap is null or c0 + 1 + k <= cap))
"""


PROJECTED = "subject_number, predicted_study_visit, cycle, day, predicted_next_visit_date"
VISITS = cte("visit_input") + visit_ctes("visit_input")
VISITS_BARE = (
    cte("visit_input")
    + f", bare as (select * from visit_input where dispensing_frequency_days is null or len({DAYS.format('visit_days')}) = 0)"
    + visit_ctes("bare")
)

# Every cycle up to the horizon is written out and filtered; no last cycle is worked out.
FAULTY_VISITS = (
    cte("visit_input")
    + f""",
f1 as (
  select subject_number, last_study_visit_recorded as label, last_study_visit_date as last,
    {CYCLE.format('last_study_visit_recorded')} as c0, {DAY.format('last_study_visit_recorded')} as d0,
    case when subject_number % 53 = 0 then [1, 2147483647]
      when len({DAYS.format('visit_days')}) = 0 then [1] else {DAYS.format('visit_days')} end as days,
    cast(coalesce(dispensing_frequency_days, 28) as int) as per,
    case when max_cycles >= 1 then cast(floor(max_cycles) as int) end as cap
  from visit_input
  where last_study_visit_date is not null and subject_number % 59 <> 0 and subject_number % 50 <> 0),
f2 as (select *, last - (d0 - 1) as one from f1),
ahead as (
  select f2.*, i, one + cast(i * per as int) as start from f2,
    (select unnest(generate_series(1, 4000)) as i) where one + cast(i * per as int) <= date '{AS_OF}' + {HORIZON}),
later as (
  select *, row_number() over (partition by subject_number order by i) - 1 as k from ahead
  where start > date '{AS_OF}' or one + per >= date '{AS_OF}'),
cycles as (
  select subject_number, label, c0, d0, days, cap, one as start, -1 as k from f2
  union all select subject_number, label, c0, d0, days, cap, start, k from later),
dated as (select *, unnest(days) as day from cycles),
visit as (
  select *, cast(c0 + 1 + k as int) as cycle, cast(start + cast(day - 1 as int) as date) as predicted_next_visit_date,
    {LABEL.format('label', 'cast(c0 + 1 + k as int)', 'day')} as predicted_study_visit
  from dated where day < 1000000 and (k >= 0 or day > d0))
select subject_number, predicted_study_visit, cycle, day, predicted_next_visit_date from visit
where predicted_next_visit_date <= date '{AS_OF}' + {HORIZON} and (cap is null or cycle <= cap)"""
)

KEYS = ("study_protocol", "randomized_treatment", "tpc", "subject_status")
ON_KEYS = " and ".join(f"lower(s.{k}) is not distinct from lower(r.{k})" for k in KEYS)


def norm(column: str) -> str:
    quoted = f"replace(replace({column}, '‘', ''''), '’', '''')"
    return f"trim({quoted})"


def matched_ctes(rule_filter: str = "true") -> str:
    picked = {c: norm(c) for c in match.NORMALISED}
    s_cols = ", ".join(f"{e} as {c}" for c, e in picked.items())
    r_cols = ", ".join(f"{norm(c)} as {c}" for c in match.NORMALISED_RULES)
    return (
        cte("subjects", "rules")
        + f""",
s as (select * replace ({s_cols}) from subjects
  where subject_status is null or subject_status not in ('Screen Failed', 'Pre-Screened Failed', 'Treatment Discontinued', 'Crossover Treatment Discontinued')),
r as (select * replace ({r_cols}) from rules where {rule_filter}),
m as (
  select s.*, r.rule_no, r.study_drug_dispensed, r.additional_study_drug_dispensed, r.visit_days, r.dispensing_quantity,
    r.dispensing_frequency_days, r.max_cycles, s.country as subject_country, case when r.country is null then 1 else 0 end as rule_scope
  from s join r on {ON_KEYS} and (r.country is null or lower(r.country) = lower(s.country))),
names as (select '(?:' || string_agg(c, '|' order by length(c) desc, c) || ')' as alt from (select distinct country as c from r where country is not null)),
based as (
  select r.*, case when study_drug_dispensed is null then null else
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(regexp_replace(trim(regexp_replace(study_drug_dispensed, '\\d.*', '', 'g')), '\\b' || alt || '\\b-?', '', 'gi'), '-\\b' || alt || '\\b', '', 'gi'),
      '[()]', '', 'g'), '^[\\s\\-]+', ''), '[\\s\\-]+$', ''), '\\s{{2,}}', ' ', 'g')) end as base_name
  from r cross join names where country is not null)
"""
    )


BASE_MATCH = r"nullif(regexp_extract({0}, '^(.*?)\s\d', 1), '')"


def key_equal(a: str, b: str) -> str:
    return " and ".join(f"lower({a}.{k}) is not distinct from lower({b}.{k})" for k in KEYS)


def kept_ctes(
    rule_filter: str = "true", fallback: str = "all", equals: str = "="
) -> str:
    """CTEs that end in ``kept``: matches with overridden drugs removed.

    ``equals`` compares base names and drugs; "is not distinct from" lets nulls meet.
    """
    only = (
        ""
        if fallback == "all"
        else f""" and (m.rule_scope = 0 or not exists (select 1 from r where r.country is not null
             and {key_equal('r', 'm')} and lower(r.country) = lower(m.country)))"""
    )
    same = f"{key_equal('b', 'm')} and lower(b.country) = lower(m.country) and b.base_name {equals} {BASE_MATCH.format('m.study_drug_dispensed')}"
    return (
        matched_ctes(rule_filter)
        + f""",
kept as (
  select * from m
  where (not exists (select 1 from based b where {same})
     or exists (select 1 from based b where {same} and b.study_drug_dispensed {equals} m.study_drug_dispensed)){only})
"""
    )


def rolled_ctes(rule_filter: str = "true", fallback: str = "all") -> str:
    order = ", ".join(
        f"{c} asc nulls first"
        for c in (
            "rule_scope", "site_id", "parent_depot", "subject_status", "tpc",
            "randomized_treatment", "subject_country", "last_study_visit_date",
            "last_study_visit_recorded", "rule_no",
        )
    )
    firsts = ", ".join(f"arg_min({c}, rn) filter ({c} is not null) as {c}" for c in demand.FIRST_VALUE)
    row_firsts = ", ".join(f"max({c}) filter (rn = 1) as {c}" for c in demand.FIRST_ROW)
    recorded = "last_study_visit_recorded"
    return (
        kept_ctes(rule_filter, fallback)
        + f""",
needed as (
  select *, coalesce(study_drug_dispensed, additional_study_drug_dispensed) as drug_dispensed,
    len({DAYS.format('visit_days')}) * dispensing_quantity as need,
    {CYCLE.format(recorded)} as parsed_last_visit_cycle, {DAY.format(recorded)} as parsed_last_visit_day
  from kept where coalesce(study_drug_dispensed, additional_study_drug_dispensed) is not null),
ranked as (select *, row_number() over (partition by study_protocol, subject_number, drug_dispensed order by {order}) as rn from needed),
rolled as (
  select study_protocol, subject_number, drug_dispensed, cast(coalesce(sum(need), 0) as bigint) as total_medicines_required_per_cycle,
    {firsts}, {row_firsts}
  from ranked group by study_protocol, subject_number, drug_dispensed)
"""
    )


RULE_FILTER = " and ".join(f"{c} is not null" for c in REQUIRED)
MATCHED_SQL = ", ".join(MATCHED)


def plan_sql(select: str, fallback: str = "all", tail: str = "") -> str:
    return (
        rolled_ctes(RULE_FILTER, fallback)
        + visit_ctes("rolled", "parsed_last_visit_cycle", "parsed_last_visit_day")
        + f""",
plan as (
  select study_protocol as study_name, parent_depot, site_id, subject_number, subject_status, subject_country,
    randomized_treatment, tpc, drug_dispensed, cast(dispensing_quantity as int) as dispensing_quantity,
    predicted_study_visit, cycle, day, predicted_next_visit_date, extract_date
  from visit)
select {select} from plan {tail}"""
    )


SORTED = ", ".join(demand.SORT_KEYS)
SORT_SQL = ", ".join(f"{c} asc nulls last" for c in demand.SORT_KEYS)

ORACLES = {
    "flagship_projection": plan_sql("*"),
    "flagship_unmatched": plan_sql("*", "unmatched"),
    "project_visits": VISITS + f"select {PROJECTED} from visit",
    "project_current": VISITS + f"select {PROJECTED} from visit where k < 0",
    "project_future": VISITS + f"select {PROJECTED} from visit where k >= 0",
    "project_rollforward": VISITS
    + "select subject_number, min(predicted_next_visit_date) as first_date, min(cycle) as first_cycle from visit where k >= 0 group by subject_number",
    "project_capped": VISITS
    + "select subject_number, max_cycles, predicted_study_visit, cycle, day, predicted_next_visit_date from visit where max_cycles >= 1",
    "project_defaults": VISITS_BARE
    + "select subject_number, count(*) as visits, max(predicted_next_visit_date) as last_date from visit group by subject_number",
    "projection_rejects": cte("visit_input")
    + "select subject_number, case when subject_number % 59 = 0 then 'bad_period' else 'out_of_range' end as reason "
    "from visit_input where subject_number % 59 = 0 or subject_number % 50 = 0",
    "project_faulty": FAULTY_VISITS,
    "bad_period": cte("visit_input")
    + "select subject_number, 'bad_period' as reason from visit_input where dispensing_frequency_days - 30 <= 0",
    "visit_label": cte("visit_input")
    + f"select subject_number, {LABEL.format('last_study_visit_recorded', CYCLE.format('last_study_visit_recorded'), DAY.format('last_study_visit_recorded'))} as label from visit_input",
    "scoped_match": matched_ctes() + f"select {MATCHED_SQL} from m where rule_scope = 0",
    "generic_match": matched_ctes() + f"select {MATCHED_SQL} from m where rule_scope = 1",
    "match_union": matched_ctes() + f"select {MATCHED_SQL}, rule_scope from m",
    "fallback_anti": matched_ctes()
    + f"""select {MATCHED_SQL} from m where rule_scope = 1 and not exists (
        select 1 from r where r.country is not null and {key_equal('r', 'm')} and lower(r.country) = lower(m.country))""",
    "scoped_override_null_base": kept_ctes(equals="is not distinct from")
    + f"select {MATCHED_SQL}, rule_scope from kept",
    "scoped_override": kept_ctes() + f"select {MATCHED_SQL}, rule_scope from kept",
    "skewed_override": kept_ctes() + f"select {MATCHED_SQL}, rule_scope from kept",
    "skewed_unmatched": kept_ctes(fallback="unmatched")
    + f"select {MATCHED_SQL}, rule_scope from kept",
    "need_per_cycle": cte("rules")
    + f"select rule_no, cast(len({DAYS.format('visit_days')}) as int) as visits, len({DAYS.format('visit_days')}) * dispensing_quantity as need from rules",
    "choose_first": cte("rules")
    + "select rule_no, coalesce(study_drug_dispensed, additional_study_drug_dispensed) as drug from rules where coalesce(study_drug_dispensed, additional_study_drug_dispensed) is not null",
    "rollup_first_sum": rolled_ctes() + f"select {', '.join(ROLLED)} from rolled",
    "exclude_status": cte("subjects")
    + "select subject_number, subject_status from subjects where subject_status is null or subject_status <> 'Treatment Discontinued'",
    "require_columns": cte("rules")
    + f"select rule_no, {', '.join(REQUIRED)} from rules where {RULE_FILTER}",
    "base_name_rule": matched_ctes() + "select rule_no, study_drug_dispensed, base_name from based",
    "base_name_match": cte("rules")
    + f"select rule_no, {BASE_MATCH.format('study_drug_dispensed')} as base_name from rules",
    "sorted_plan": plan_sql(SORTED, tail=f"order by {SORT_SQL}"),
    "run_summary": plan_sql(
        "count(*) as total_visits, count(distinct subject_number) as unique_subjects, count(distinct drug_dispensed) as unique_drugs, "
        "min(predicted_next_visit_date) as first_visit_date, max(predicted_next_visit_date) as last_visit_date"
    ),
    "top_n": plan_sql(
        SORTED + ", drug_dispensed",
        tail=f"order by {SORT_SQL}, drug_dispensed, predicted_next_visit_date limit 10",
    ),
}

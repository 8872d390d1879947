"""Matching, override and rollup against plain Python, and the joins under skew."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from dosecast.functions import text
from dosecast.operators import joins, match
from dosecast.operators.rollup import rollup_first_sum
from dosecast.plans.demand import plan_demand

S_SCHEMA = (
    "study_protocol string, site_id int, country string, parent_depot int, subject_number bigint, "
    "tpc string, subject_status string, randomized_treatment string, last_study_visit_recorded string, "
    "last_study_visit_date date, extract_date date"
)
R_SCHEMA = (
    "rule_no bigint, study_protocol string, randomized_treatment string, subject_status string, tpc string, "
    "country string, study_drug_dispensed string, additional_study_drug_dispensed string, visit_days string, "
    "dispensing_quantity bigint, dispensing_frequency_days bigint, max_cycles double"
)
DAY = dt.date(2024, 1, 1)
PLACES = ["Korea", "South Korea", "Japan", None]
DRUGS = [
    None, "Alpha 10mg", "Alpha 20mg", "Alpha-Japan 10mg", "(South Korea) Alpha 10mg", "Korea-Alpha 5mg",
    "Beta", "Beta 5mg", "KoreaX 5mg", "Alpha - Japan 7mg",
]


def some_rows(seed, n_subjects=60, n_rules=120):
    rng = random.Random(seed)
    pick = rng.choice
    subjects = [
        (
            pick(["S1", "s1 ", "S2"]), pick([1, None]), pick([*PLACES, "JAPAN", "Peru"]), 1, rng.randint(1, 25),
            pick([None, "topo"]), pick([None, "On", "Screen Failed"]), pick(["Arm", "ARM", None]),
            pick([None, "Cycle 2 Day 3"]), pick([DAY, None]), DAY,
        )
        for _ in range(n_subjects)
    ]
    rules = [
        (
            i, pick(["S1", "S2"]), pick(["arm", None]), pick([None, "on"]), pick([None, "TOPO"]),
            pick([*PLACES, "south korea"]), pick(DRUGS), pick([None, "Add"]), pick(["1", "1,8", None]),
            pick([None, 1, 2]), 28, None,
        )
        for i in range(n_rules)
    ]
    return subjects, rules


def low(v):
    return None if v is None else v.strip().lower()


def base_of_rule(drug, places):
    if drug is None:
        return None
    s = re.sub(r"\d.*", "", drug.strip()).strip()
    for p in sorted(places, key=lambda p: (-len(p), p)):
        s = re.sub(rf"(?i)\b{re.escape(p)}\b-?", "", s)
        s = re.sub(rf"(?i)-\b{re.escape(p)}\b", "", s)
    s = re.sub(r"[()]", "", s)
    s = re.sub(r"^[\s\-]+|[\s\-]+$", "", s)
    return re.sub(r"\s{2,}", " ", s).strip()


def base_of_match(drug):
    found = drug and re.match(r"(.*?)\s\d", drug)
    return found.group(1) if found else None


def expected(subjects, rules, fallback="all", null_base=False):
    """Matched (subject index, rule number) pairs that survive the override."""
    active = [s for s in subjects if s[6] != "Screen Failed"]
    key_s = lambda s: (low(s[0]), low(s[7]), low(s[5]), s[6] and s[6].lower())
    key_r = lambda r: (low(r[1]), low(r[2]), low(r[4]), r[3] and r[3].lower())
    scoped = [r for r in rules if r[5] is not None]
    places = {r[5].strip() for r in scoped}
    listed = {}
    for r in scoped:
        base = base_of_rule(r[6], places)
        if base is not None or null_base:
            listed.setdefault((key_r(r), low(r[5]), base), set()).add(r[6])
    out = []
    for s in active:
        mine = [r for r in scoped if key_r(r) == key_s(s) and low(r[5]) == low(s[2])]
        use_generic = fallback == "all" or not mine
        theirs = mine + [r for r in rules if use_generic and r[5] is None and key_r(r) == key_s(s)]
        for r in theirs:
            base = base_of_match(r[6])
            drugs = listed.get((key_s(s), low(s[2]), base)) if base is not None or null_base else None
            if drugs is None or r[6] in drugs or s[2] is None:
                out.append((s[4], r[0], 0 if r[5] is not None else 1))
    return sorted(out)


def ready(spark, subjects, rules):
    s = match.normalise(match.active_subjects(spark.createDataFrame(subjects, S_SCHEMA)), match.NORMALISED)
    r = match.normalise(spark.createDataFrame(rules, R_SCHEMA), match.NORMALISED_RULES)
    return s, r


def pairs(df):
    return sorted((r.subject_number, r.rule_no, r.rule_scope) for r in df.collect())


@pytest.mark.parametrize(
    "seed,fallback,null_base", [(1, "all", False), (2, "unmatched", False), (3, "all", True)]
)
def test_match_equals_model(spark, seed, fallback, null_base):
    subjects, rules = some_rows(seed)
    s, r = ready(spark, subjects, rules)
    got = pairs(match.match_rules(s, r, fallback, null_base))
    assert got == expected(subjects, rules, fallback, null_base)


def test_large_rules_give_the_same(spark, monkeypatch):
    """Beyond the broadcast bound: salted joins and per-drug patterns, same rows."""
    subjects, rules = some_rows(5)
    s, r = ready(spark, subjects, rules)
    monkeypatch.setattr(match, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "is_small", lambda *a: False)
    assert pairs(match.match_rules(s, r, "unmatched")) == expected(subjects, rules, "unmatched")


def test_base_names_do_not_depend_on_how_many_places_there_are(spark):
    """The same names beside 3 and beside 3,000 countries."""
    named = [("Foo-New-X-Zealand 10 mg", "X"), ("Bar-iſtan 5", "İstan"), ("Foo-Κύπροσ", "ΚΎΠΡΟΣ"),
             ("Baz New-Zealand 3", "New-Zealand")]
    schema = "rule_no int, study_drug_dispensed string, country string"

    def names(extra):
        rows = [(i, d, c) for i, (d, c) in enumerate(named)]
        rows += [(100 + i, f"Drug{i}", f"Land{i}") for i in range(extra)]
        found = match.rule_base_names(spark.createDataFrame(rows, schema)).where("rule_no < 100")
        return {r.rule_no: r.base_name for r in found.collect()}

    few = names(3)
    assert few == names(3000)
    assert few[0] == "Foo" and few[3] == "Baz"


def test_unknown_fallback(spark):
    s, r = ready(spark, *some_rows(1, 1, 1))
    with pytest.raises(ValueError, match="fallback"):
        match.match_rules(s, r, "some")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise((F.col("id") % 50).cast("string")).alias("k")
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("4", 4), ("none", 5)], "k string, v int"
    )
    got = joins.salted_join(left, right, ["k"], ["id"], how, rows_per_task=100)
    want = left.join(right.withColumnRenamed("k", "r"), F.col("k").eqNullSafe(F.col("r")), how).drop("r")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.columns == want.columns


def test_salts_spread_a_hot_key(spark):
    left = spark.range(10_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan = joins.salted_join(left, right, ["k"], ["id"], rows_per_task=500)
    assert plan.count() == 3334
    text_plan = plan._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text_plan and "_salt" in text_plan


def test_is_small_counts_rows_and_bytes(spark):
    assert joins.is_small(spark.range(10), 10)
    assert not joins.is_small(spark.range(11), 10)
    assert not joins.is_small(spark.range(10), 10, 50)
    assert joins.is_small(spark.range(0), 0)


def test_rollup_takes_firsts_per_column(spark):
    df = spark.createDataFrame(
        [("a", 1, None, "x", 2), ("a", 2, "p", None, None), ("a", 0, None, None, 3), (None, 1, None, "n", None)],
        "k string, o int, v string, r string, q bigint",
    )
    got = rollup_first_sum(df, ["k"], ["q"], ["v"], ["r"], F.struct("o")).collect()
    # "r" follows the first row even where that is null; "v" skips nulls; no value sums to 0.
    assert sorted(got, key=str) == sorted([("a", 5, "p", None), (None, 0, None, "n")], key=str)


def test_empty_inputs_keep_the_schema(spark):
    subjects, rules = some_rows(1)
    none_s = spark.createDataFrame([], S_SCHEMA)
    none_r = spark.createDataFrame([], R_SCHEMA)
    some_s, some_r = spark.createDataFrame(subjects, S_SCHEMA), spark.createDataFrame(rules, R_SCHEMA)
    for s, r in ((none_s, some_r), (some_s, none_r)):
        plan = plan_demand(s, r, DAY)
        assert plan.count() == 0 and len(plan.columns) == 16
    generic_only = some_r.where("country is null")
    assert plan_demand(some_s, generic_only, DAY).count() > 0


def test_plan_has_no_cross_join(spark):
    subjects, rules = some_rows(1)
    plan = plan_demand(spark.createDataFrame(subjects, S_SCHEMA), spark.createDataFrame(rules, R_SCHEMA), DAY)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown and "Python" not in shown


@pytest.mark.parametrize(
    "raw,cycle,day",
    [("TPC C20D1", 20, 1), ("Cycle 46 Day 8", 46, 8), ("cycle46", 46, 1), ("Day3", 0, 3), ("x", 0, 1), (None, 0, 1), ("C99999999999D2", 0, 2)],
)
def test_visit_labels(spark, raw, cycle, day):
    df = spark.createDataFrame([(raw,)], "s string")
    assert tuple(df.select(text.parse_cycle_number(F.col("s")), text.parse_cycle_day(F.col("s"))).first()) == (cycle, day)


def test_strip_equals_python(spark):
    samples = ["  a b　", "\t\x1cx\x85", " ", "", "é "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(text.strip(F.col("s"))).collect()] == [s.strip() for s in samples]


def test_heavy_keys_are_the_heaviest(spark, monkeypatch):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") < 400, "hot").when(F.col("id") < 700, None).when(F.col("id") < 750, "warm")
        .otherwise(F.col("id").cast("string")).alias("k")
    )
    found = {r.k: r._salts for r in joins.heavy_keys(df, ["k"], 100).collect()}
    assert found == {"hot": 4, None: 3}
    assert joins.heavy_keys(df, ["k"], 400) is None and joins.heavy_keys(df.limit(0), ["k"], 1) is None
    monkeypatch.setattr(joins, "MAX_HEAVY_KEYS", 1)
    assert [r.k for r in joins.heavy_keys(df, ["k"], 40).collect()] == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salts_of_a_part_of_the_keys(spark, how):
    """Heavy keys known on fewer columns than the join's spread its rows as well."""
    left = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 > 0, None).otherwise("hot").alias("k"), (F.col("id") % 5).cast("int").alias("d")
    )
    right = spark.createDataFrame([("hot", 1, 1), (None, 2, 2), (None, None, 3), ("x", 4, 4)], "k string, d int, v int")
    heavy = joins.heavy_keys(left, ["k"], 100)
    got = joins.salted_join(left, right, ["k", "d"], ["id"], how, heavy=heavy)
    renamed = right.toDF("r", "e", "v")
    want = left.join(renamed, F.col("k").eqNullSafe(F.col("r")) & F.col("d").eqNullSafe(F.col("e")), how).drop("r", "e")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("fallback", ["all", "unmatched"])
@pytest.mark.parametrize("rows_per_task", [1, 4_000_000])
def test_shuffled_matches_equal_the_model(spark, fallback, rows_per_task):
    subjects, rules = some_rows(7)
    s, r = ready(spark, subjects, rules)
    got = match.match_rules(s, r, fallback, broadcast=False, rows_per_task=rows_per_task)
    assert pairs(got) == expected(subjects, rules, fallback)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (rows_per_task == 1) and "CartesianProduct" not in plan


def test_row_bytes_by_type(spark):
    df = spark.createDataFrame([("abc", 1, [1, 2], None), (None, 2, None, b"xy")], "`a.b` string, n int, l array<int>, z binary")
    assert [r[0] for r in df.select(joins.row_bytes(df)).collect()] == [3 + 8 + len('{"l":[1,2]}'), 8 + len("{}") + 2]


@pytest.mark.parametrize("fallback", ["all", "unmatched"])
def test_heavy_keys_are_counted_once(spark, monkeypatch, fallback):
    counted, count = [], joins.heavy_keys

    def watched(*args):
        counted.append(args[1])
        return count(*args)

    monkeypatch.setattr(joins, "heavy_keys", watched)
    monkeypatch.setattr(match, "heavy_keys", watched)
    s, r = ready(spark, *some_rows(7))
    match.match_rules(s, r, fallback, broadcast=False)
    assert counted == [match.FOLDED_KEYS]

"""The closed-form projection against a plain loop over days."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from dosecast.operators.project import bad_periods, project_visits

AS_OF = dt.date(2024, 5, 20)
SCHEMA = (
    "subject_number bigint, last_study_visit_date date, last_study_visit_recorded string, "
    "visit_days string, dispensing_frequency_days bigint, max_cycles double"
)


def model(row, horizon):
    """Walk cycle by cycle until one has no visit inside the horizon."""
    number, last, label, days_text, period, cap = row
    if last is None or number is None:
        return []
    period = 28 if period is None else period
    if period <= 0:
        return []
    days = sorted(int(t) for t in (days_text or "").split(",") if t.strip().isdigit()) or [1]
    words = (label or "").split()
    cycle, day = (int(words[-3]), int(words[-1])) if words else (0, 1)
    limit = int(cap) if cap is not None and cap >= 1 else None
    end = AS_OF + dt.timedelta(days=horizon)
    prefix = "Crossover " if "Crossover" in words else "TPC " if "TPC" in words else ""
    first = last - dt.timedelta(days=day - 1)
    out = []

    def add(c, d, start):
        date = start + dt.timedelta(days=d - 1)
        if date <= end and (limit is None or c <= limit):
            out.append((number, f"{prefix}Cycle {c} Day {d}", c, d, date))
        return date <= end

    for d in days:
        if d > day:
            add(cycle, d, first)
    start = first + dt.timedelta(days=period)
    if start < AS_OF:
        while start <= AS_OF:
            start += dt.timedelta(days=period)
    c = cycle + 1
    while limit is None or c <= limit:
        if not any([add(c, d, start) for d in days]):
            break
        start += dt.timedelta(days=period)
        c += 1
    return out


def compare(spark, rows, horizon):
    got = project_visits(spark.createDataFrame(rows, SCHEMA), AS_OF, horizon).collect()
    want = [v for r in rows for v in model(r, horizon)]
    assert sorted(tuple(g) for g in got) == sorted(want)


def test_random_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        days = rng.choice([None, "", "1", "1,8,15", "15, 1", "1,1,8", "a,b", "0,40", "90"])
        label = rng.choice([None, "Cycle {} Day {}", "TPC Cycle {} Day {}", "Crossover Cycle {} Day {}"])
        rows.append(
            (
                rng.choice([None, i, i]),
                rng.choice([None] + [AS_OF + dt.timedelta(days=rng.randint(-900, 200))] * 6),
                label and label.format(rng.randint(0, 20), rng.randint(1, 40)),
                days,
                rng.choice([None, 0, -3, 1, 7, 21, 28, 28, 400]),
                rng.choice([None, None, 0.0, 0.9, 1.0, 7.8, 25.0]),
            )
        )
    compare(spark, rows, 120)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 9),
            st.dates(dt.date(2023, 1, 1), dt.date(2024, 9, 1)),
            st.builds("Cycle {} Day {}".format, st.integers(0, 9), st.integers(1, 30)),
            st.lists(st.integers(0, 60), max_size=4).map(lambda d: ",".join(map(str, d))),
            st.integers(1, 60),
            st.none() | st.floats(0, 12),
        ),
        min_size=1,
        max_size=30,
    ),
    st.integers(0, 200),
)
def test_property(spark, rows, horizon):
    compare(spark, rows, horizon)


def test_day_of_run_is_not_rolled(spark):
    """A start on the very day stays; one day earlier moves by a whole period."""
    rows = [
        (1, AS_OF - dt.timedelta(days=28), "Cycle 1 Day 1", "1", 28, 2.0),
        (2, AS_OF - dt.timedelta(days=29), "Cycle 1 Day 1", "1", 28, 2.0),
    ]
    got = {r.subject_number: r.predicted_next_visit_date for r in
           project_visits(spark.createDataFrame(rows, SCHEMA), AS_OF, 60).collect()}
    assert got == {1: AS_OF, 2: AS_OF + dt.timedelta(days=27)}


def test_bad_periods_are_reported(spark):
    rows = [(1, AS_OF, "Cycle 1 Day 1", "1", 0, None), (2, AS_OF, "Cycle 1 Day 1", "1", None, None)]
    got = bad_periods(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.subject_number, r.reason) for r in got] == [(1, "bad_period")]


def test_projection_does_not_shuffle(spark):
    plan = project_visits(spark.createDataFrame([], SCHEMA), AS_OF)._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()

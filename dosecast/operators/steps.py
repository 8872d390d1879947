"""Rows in and out of each step of a job, counted by Spark while the job runs.

A count is an observed metric of the step's own rows, so nothing is computed twice for it. Spark
adds up the counts of tasks that ended; a stage that runs again after a lost executor may add its
rows again, so the counts inform and nothing is decided by them.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

STEP_SCHEMA = "run_at timestamp, job string, step_no int, step string, row_count long"
# A step that Spark planned away, since an input was empty, reports nothing.
WAIT_SECONDS = 30.0


def rows() -> Column:
    """Counts every row."""
    return F.count(F.lit(1))


class StepCounts:
    """Counts of the steps of one run, in the order in which they were asked for."""

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation | int]] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, with an aggregate of its rows counted under each step's name."""
        seen = Observation()
        self._steps += [(step, seen) for step in counts]
        return df.observe(seen, *[c.alias(step) for step, c in counts.items()])

    def add(self, step: str, count: int) -> None:
        """A count that is known."""
        self._steps.append((step, count))

    def counts(self, wait: float = WAIT_SECONDS) -> dict[str, int | None]:
        """Step -> rows, after the job's action; None for a step that did not run."""
        return {step: _result(found, step, wait) for step, found in self._steps}

    def table(self, spark: SparkSession, job: str, run_at: dt.datetime | None = None) -> DataFrame:
        """One row per step, in order."""
        stamp = run_at or dt.datetime.now()
        found = [(stamp, job, i, step, n) for i, (step, n) in enumerate(self.counts().items())]
        return spark.createDataFrame(found, STEP_SCHEMA)

    def write(self, spark: SparkSession, path: str, job: str, run_at: dt.datetime | None = None) -> None:
        """Append the counts of this run to the run table."""
        self.table(spark, job, run_at).coalesce(1).write.mode("append").parquet(path)


def unwatched(df: DataFrame, **counts: Column) -> DataFrame:
    """``StepCounts.watch`` that counts nothing."""
    return df


def _result(found: Observation | int, step: str, wait: float) -> int | None:
    if isinstance(found, int):
        return found
    got: list[int] = []
    asked = threading.Thread(target=lambda: got.append(found.get[step]), daemon=True)
    asked.start()
    asked.join(wait)
    return got[0] if got else None

"""Partitions that are replaced at once, and plans that must compile."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

import __spark_entry__ as entry_points
from dosecast.operators import steps, versions
from dosecast.sources import files

SCHEMA = StructType([StructField("id", LongType()), StructField("day", DateType())])
A, B, C = (dt.date(2025, 1, d) for d in (1, 2, 3))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def table(spark, path):
    return sorted((tuple(r) for r in versions.read_table(spark, path, SCHEMA, "day").collect()), key=repr)


def test_declared_values_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert table(spark, path) == []
    versions.replace_all(frame(spark, (1, A), (2, B), (3, None)), path, "day")
    versions.replace_values(frame(spark, (4, B)), path, "day", [A, B])
    assert table(spark, path) == [(3, None), (4, B)]
    versions.replace_values(frame(spark, (5, C)), path, "day", [C, None])
    assert table(spark, path) == [(4, B), (5, C)]
    versions.replace_values(frame(spark), path, "day", [B])
    assert table(spark, path) == [(5, C)]
    versions.replace_all(frame(spark), path, "day")
    assert table(spark, path) == []


def test_a_bad_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_all(frame(spark, (1, A)), path, "day")
    broken = frame(spark, (2, A)).withColumn("id", F.raise_error(F.lit("x")).cast("long"))
    with pytest.raises(PySparkException):
        versions.replace_values(broken, path, "day", [A])
    with pytest.raises(ValueError, match="not declared"):
        versions.replace_values(frame(spark, (2, A), (3, B)), path, "day", [A])
    with pytest.raises(ValueError, match="not declared"):
        versions.replace_values(frame(spark, (2, None)), path, "day", [A])
    assert table(spark, path) == [(1, A)]
    assert versions.commits(spark, path).agg(F.max("commit")).first()[0] == 1


def test_report_codes_follow_the_rules(spark):
    names = [
        ("Subject Visit Summary x.csv", ("Subject Visit Summary", None)),
        ("subject summary unblinded.CSV", ("Subject Summary (Unblinded)", None)),
        ("Participant Summary Unblinded.enc", ("Participant Summary (Unblinded)", None)),
        ("Participant Summary.csv", ("Subject Summary", None)),
        ("site and depot inventory summary.csv", ("Inventory Summary (Unblinded)", "Site Inventory Summary")),
        ("inventory levels.csv", ("Inventory Levels", None)),
        ("country site supply method.csv", ("Comparator Supply (Unblinded)", "Site Level Supply Method")),
        ("country comparator supply.csv", ("Comparator Supply (Unblinded)", "Country Level Supply Method")),
        ("comparator and supply method.csv", None),
        ("subject summary.txt", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(names)], "i int, n string")
    got = {r.i: r.r for r in df.select("i", files.classify_report(F.col("n")).alias("r")).collect()}
    assert [got[i] and tuple(got[i]) for i in range(len(names))] == [want for _, want in names]


@pytest.mark.parametrize("name", ["classify_reports", "latest_report_file", "study_status"])
def test_generated_code_compiles(spark, name):
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        entry_points.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)


def test_columns_that_change(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no table"):
        versions.read_table(spark, path, None, "day")
    versions.replace_all(frame(spark, (1, A), (2, B)), path, "day")
    wide = frame(spark, (3, B)).withColumn("note", F.lit("n"))
    typed = frame(spark, (3, B)).withColumn("id", F.lit("x"))
    for bad, drift in ((wide, "same"), (typed, "same"), (typed, "widen"), (frame(spark).drop("id"), "same")):
        with pytest.raises(ValueError, match="columns differ"):
            versions.replace_values(bad, path, "day", [B], drift=drift)
    with pytest.raises(ValueError, match="all rows"):
        versions.replace_values(typed, path, "day", [B], drift="replace")
    with pytest.raises(ValueError, match="drift"):
        versions.replace_all(typed, path, "day", drift="any")
    assert table(spark, path) == [(1, A), (2, B)]
    assert versions.replace_values(wide, path, "day", [B], drift="widen") == 1
    versions.replace_values(frame(spark, (4, C)).select("day", "id"), path, "day", [C], drift="widen")
    rows = versions.read_table(spark, path, None, "day").select("id", "day", "note").collect()
    assert sorted(map(tuple, rows)) == [(1, A, None), (3, B, "n"), (4, C, None)]
    versions.replace_all(typed, path, "day", drift="replace")
    found = versions.read_table(spark, path, None, "day")
    assert found.columns == ["id", "day"] and [r.id for r in found.collect()] == ["x"]


def test_steps_are_counted(spark):
    counts = steps.StepCounts()
    rows = counts.watch(spark.range(10), read=steps.rows(), even=F.count_if(F.col("id") % 2 == 0))
    kept = counts.watch(rows.where("id > 3"), kept=steps.rows())
    kept.groupBy().count().collect()
    counts.watch(spark.range(3), never=steps.rows())
    counts.add("known", 5)
    assert counts.counts(wait=0.5) == {"read": 10, "even": 5, "kept": 6, "never": None, "known": 5}


def test_values_with_and_without_folders_are_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_all(frame(spark, (1, A), (2, B), (3, None)), path, "day")
    assert versions.replace_values(frame(spark, (4, B), (5, C)), path, "day", [B, C, None], folders=False) == 2
    assert table(spark, path) == [(1, A), (4, B), (5, C)]
    with pytest.raises(ValueError, match="1 rows of values of day that were not declared"):
        versions.replace_values(frame(spark, (6, None), (7, A)), path, "day", [A], folders=False)
    versions.replace_values(frame(spark), path, "day", [B], folders=False)
    assert table(spark, path) == [(1, A), (5, C)]
    assert versions.table_schema(spark, path) == SCHEMA

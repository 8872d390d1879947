"""Floating-header CSV against pandas, header mapping, curation."""

import datetime as dt
import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dosecast.plans.curate import curate_reports, curate_rules
from dosecast.schemas import RULE_LABELS, RULES_SCHEMA, report_schema
from dosecast.sources import headers, reports

STAMP = dt.datetime(2025, 11, 6, 8, 0)


def parse(spark, texts):
    rows = [(f"f{i}", t if isinstance(t, (bytes, bytearray)) else t.encode()) for i, t in enumerate(texts)]
    return reports.parse_reports(spark.createDataFrame(rows, "name string, content binary"))


def expected(text, max_rows=10):
    """Header search by hand, then pandas for the table itself."""
    for i, line in enumerate(io.StringIO(text, newline=None)):
        if i >= max_rows:
            return None
        cells = [c.strip() for c in line.split(",")]
        if len(cells) > 1 and all(cells):
            try:
                return pd.read_csv(io.StringIO(text), dtype=str, skiprows=i, index_col=False)
            except pd.errors.ParserError:
                return None
    return None


def as_tables(parsed):
    rejected = {r["name"] for r in reports.report_rejects(parsed).collect()}
    header = {r["name"]: r["header"] for r in parsed.collect()}
    tables = {n: [] for n in header if n not in rejected}
    for r in reports.report_rows(parsed).orderBy("name", "row_no").collect():
        width = len(r["header"])
        tables[r["name"]].append((list(r["cells"]) + [None] * width)[:width])
    return header, tables, rejected


CASES = [
    "Report,,\nRun by,,x\nSite ID,Country,Nbr\n1,\"Nation, 4\",7\n2,X,8\n",
    "a,b\n1,2\n",
    "a,b\r\n1,2\r\n\r\n3,4",
    "a,b\n\"x\ny\",2\n3,\"q\"\"r\"\n",
    "﻿a,b\n1,2\n",
    "a,b,a,a\n1,2,3,4\n",
    "a,b,c\n1,2\n3\n,,\n",
    "a,b\nNA,n/a\nnone,-\nnull,\"\"\n",
    "a,b\n  ,x\n   \n 7 , 8\n",
    "a,b\n5\" pipe,x\n\"tail\"z,y\n",
    "a , b\n1,2\n",
    "\n\n,,\nx\na,b\n1,2\n",
    "a,b\n",
    "a,\"b\"\n1,2",
    "h1,h2,h3\n\"multi\n\nline, with \"\"quotes\"\"\",,end\n,\"\",\"z\"\n",
]


def test_cases_equal_pandas(spark):
    header, tables, rejected = as_tables(parse(spark, CASES))
    for i, text in enumerate(CASES):
        want = expected(text)
        assert want is not None and f"f{i}" not in rejected, text
        assert header[f"f{i}"] == list(want.columns), text
        rows = [[None if pd.isna(v) else v for v in r] for r in want.values.tolist()]
        assert tables[f"f{i}"] == rows, text


def test_rejects(spark):
    bad = {
        "only one line": "no_header",
        "x\n" * 10 + "a,b\n1,2\n": "no_header",
        "a,b\n1,2\n1,2,3\n": "long_row",
        "a,b\n1,\"2\n3,4\n": "open_quote",
        "": "no_header",
    }
    parsed = parse(spark, [*bad, b"a,b\n\xff,1\n"])
    got = {r["name"]: r["reason"] for r in reports.report_rejects(parsed).collect()}
    assert got == {f"f{i}": r for i, r in enumerate([*bad.values(), "not_utf8"])}


def test_header_on_tenth_line(spark):
    _, tables, rejected = as_tables(parse(spark, ["x\n" * 9 + "a,b\n1,2\n"]))
    assert tables == {"f0": [["1", "2"]]} and not rejected


def test_random_texts_equal_pandas(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(300):
        width = rng.randint(2, 4)
        lines = [",".join(["pre"] + [""] * (width - 1)) for _ in range(rng.randint(0, 3))]
        lines.append(",".join(f"c{i}" for i in range(width)))
        for _ in range(rng.randint(0, 6)):
            cells = []
            for _ in range(rng.randint(1, width)):
                raw = "".join(rng.choice("ab ,\n\"é7") for _ in range(rng.randint(0, 5)))
                quoted = any(c in raw for c in ',\n"') or rng.random() < 0.3
                cells.append('"' + raw.replace('"', '""') + '"' if quoted else raw)
            lines.append(",".join(cells))
        texts.append("\n".join(lines) + rng.choice(["", "\n"]))
    header, tables, rejected = as_tables(parse(spark, texts))
    assert not rejected
    for i, text in enumerate(texts):
        want = expected(text)
        rows = [[None if pd.isna(v) else v for v in r] for r in want.values.tolist()]
        assert (header[f"f{i}"], tables[f"f{i}"]) == (list(want.columns), rows), repr(text)


def test_long_file(spark):
    body = "a,b\n" + "".join(f"{i},\"v {i}, x\"\n" for i in range(50_000))
    rows = reports.report_rows(parse(spark, [body]))
    assert rows.count() == 50_000
    assert rows.where("row_no = 50000").select("cells").first()[0] == ["49999", "v 49999, x"]


def sheet(spark, rows, studies):
    columns = ", ".join(f"`{c}` string" for c in ["Column Header", *studies])
    return spark.createDataFrame(
        [(i, r[0], *[r[1]] * len(studies)) for i, r in enumerate(rows)], f"n int, {columns}"
    )


def test_header_map_rules(spark):
    rows = [
        ("Country", " Land "),
        ("Gender", "Sex"),
        ("TPC", "Sex"),
        ("Site ID", "Site, Centre"),
        ("Depot Type", "x=Main = 1 "),
        ("Investigator", "x=Main = 1 "),
        ("Location", "   "),
        ("Gender", "Sex"),
        (None, "Ghost"),
    ]
    long = headers.sheet_to_rows(sheet(spark, rows, ["S1"]), "site", "n")
    maps = headers.header_map(long).collect()
    assert len(maps) == 1
    # "Sex" goes to the last label that names it; the repeat of an earlier row does not count.
    assert maps[0]["specs"] == {
        "Country": "Land",
        "TPC": "Sex",
        "Site ID": "Site, Centre",
        "Depot Type": "x=Main = 1",
        "Investigator": "x=Main = 1",
    }


def test_label_with_two_columns_takes_the_last(spark):
    rows = [("Country", "Land"), ("Country", "Nation")]
    long = headers.sheet_to_rows(sheet(spark, rows, ["S1"]), "site", "n")
    assert headers.header_map(long).first()["specs"] == {"Country": "Nation"}


def test_sheet_needs_label_column(spark):
    with pytest.raises(ValueError, match="Column Header"):
        headers.sheet_to_rows(spark.createDataFrame([("a",)], "x string"), "site")


def files(spark, rows):
    return spark.createDataFrame(
        [(n, dt.date(2025, 11, 6), t.encode()) for n, t in rows],
        "file_name string, extract_date date, content binary",
    )


def test_curate_subjects(spark):
    rows = [
        ("Subject Number", "Subj"),
        ("Country", "Land, Region"),
        ("Gender", "x=unknown"),
        ("Year of Birth", "Born"),
        ("Date Randomized", None),
        ("Last Study Visit Date", "Seen"),
    ]
    long = headers.sheet_to_rows(sheet(spark, rows, ["AB-CD-1-2", "AB-CD-9-9"]), "subject", "n")
    # The second study's cells repeat the first's; blank them to get an empty map.
    long = long.withColumn("spec", F.when(F.col("study") == "AB-CD-1-2", F.col("spec")))
    good = "Title,\nSubj,Land,Region,Born,Date Randomized,Seen\n7,,East,5/11/1975,05-Nov-2025,1 Mar 2024\nx,West,East,1980,2025-11-05,\n"
    bare = "Subject Number,Country\n8,South\n"
    table, rejects = curate_reports(
        files(
            spark,
            [
                ("Co AB-CD-1-2_Subject Summary.csv", good),
                ("Co AB-CD-9-9_Subject Summary.csv", bare),
                ("Co AB-CD-5-5_Subject Summary.csv", bare),
                ("Co nothing.csv", bare),
                ("Co AB-CD-1-2_broken.csv", "x"),
            ],
        ),
        "subject",
        long,
        STAMP,
    )
    assert table.schema.simpleString() == report_schema("subject").simpleString()
    got = {
        (r.study_protocol, r.subject_number): (
            r.country, r.gender, r.year_of_birth, r.date_randomized, r.last_study_visit_date,
            r.source_file, r.extract_date,
        )
        for r in table.collect()
    }
    day, f1 = dt.date(2025, 11, 6), "Co AB-CD-1-2_Subject Summary.csv"
    assert got == {
        ("AB-CD-1-2", 7): ("East", "unknown", 1975, dt.date(2025, 11, 5), dt.date(2024, 3, 1), f1, day),
        ("AB-CD-1-2", None): ("West", "unknown", 1980, None, None, f1, day),
        ("AB-CD-9-9", 8): ("South", None, None, None, None, "Co AB-CD-9-9_Subject Summary.csv", day),
    }
    assert {(r.file_name, r.reason) for r in rejects.collect()} == {
        ("Co AB-CD-5-5_Subject Summary.csv", "no_header_mapping"),
        ("Co nothing.csv", "no_study_code"),
        ("Co AB-CD-1-2_broken.csv", "no_header"),
    }


def test_curate_depot_default_and_no_sheet(spark):
    none = "Depot ID,Country\n1,A\n2,B\n"
    some = "Depot ID,Country,Approved Countries\n3,A,\n4,B,C\n"
    table, rejects = curate_reports(
        files(spark, [("AB-CD-1-1 x.csv", none), ("AB-CD-1-2 x.csv", some)]), "depot", None, STAMP
    )
    assert {r.depot_id: r.approved_countries for r in table.collect()} == {1: "A", 2: "B", 3: None, 4: "C"}
    assert rejects.count() == 0


def test_curate_rules(spark):
    labels = [l for l, _, _ in RULE_LABELS]
    schema = ", ".join("`" + l + "` string" for l in labels) + ", extra string"
    row = [" TA ", "S", "Arm", None, " t\t", "Drug 1mg", None, None, None, "1,8", "2", "28", "x"]
    sheet_df = spark.createDataFrame([(*row, "e"), (*[None] * 13, "only extra")], schema)
    got = curate_rules(sheet_df)
    assert got.schema.simpleString() == RULES_SCHEMA.simpleString()
    assert [tuple(r) for r in got.collect()] == [
        ("TA", "S", "Arm", None, "t", "Drug 1mg", None, None, None, "1,8", 2, 28, None)
    ]


def test_default_if_all_null_keeps_null_groups(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", None, "y"), (None, "v", "z"), (None, None, "w")],
        "g string, c string, d string",
    )
    got = headers.default_if_all_null(df, "c", "d", ["g"]).collect()
    assert sorted((r.g or "", r.c or "", r.d) for r in got) == [
        ("", "", "w"), ("", "v", "z"), ("a", "x", "x"), ("a", "y", "y"),
    ]

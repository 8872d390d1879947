"""Reading in splits gives the rows of reading whole, whatever the split size."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from dosecast.plans import curate
from dosecast.sources import headers, lines, reports
from dosecast.sources.files import describe_paths


@pytest.fixture
def tiny_splits(spark, tmp_path):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def random_text(rng):
    width = rng.randint(2, 3)
    out = ["pre,"] * rng.randint(0, 2) + [",".join(f"c{i}" for i in range(width))]
    for _ in range(rng.randint(0, 40)):
        cells = []
        for _ in range(rng.randint(1, width)):
            raw = "".join(rng.choice("ab ,\n\"é") for _ in range(rng.randint(0, 12)))
            quoted = any(c in raw for c in ',\n"') or rng.random() < 0.3
            cells.append('"' + raw.replace('"', '""') + '"' if quoted else raw)
        out.append(",".join(cells))
    return "\n".join(out) + "\n"


def test_splits_equal_whole_files(spark, tmp_path, tiny_splits):
    rng = random.Random(11)
    texts = [random_text(rng) for _ in range(12)]
    texts += [
        "a,b\n1,5\" pipe\n2,\"x\"tail\n" * 9,
        "a,b\n1,\"open\n" + "2,3\n" * 40,
        "a,b\n" + "1,2\n" * 40 + "1,2,3\n" + "1,2\n" * 20,
        "nothing\n" * 30,
        "a,b\n\"" + "long\n\n" * 60 + "end\",z\n1,2\n",
    ]
    folder = tmp_path / "reports"
    folder.mkdir()
    for i, t in enumerate(texts):
        (folder / f"f{i:02}.csv").write_bytes(t.encode())
    rows, files = lines.read_large_reports(spark, [str(folder)])
    rows, rejects = rows.join(files, "file"), files.where("reason is not null")
    name = F.regexp_extract("file", "([^/]+)$", 1)
    got = {}
    for r in rows.withColumn("f", name).orderBy("f", "block", "no").collect():
        got.setdefault(r.f, []).append((r.header, r.cells))
    whole = reports.parse_reports(
        spark.read.format("binaryFile").load(str(folder)).select(
            F.regexp_extract("path", "([^/]+)$", 1).alias("f"), "content"
        )
    )
    want = {}
    for r in reports.report_rows(whole).orderBy("f", "row_no").collect():
        want.setdefault(r.f, []).append((r.header, r.cells))
    assert got == want
    reasons = {r.f: r.reason for r in rejects.withColumn("f", name).collect()}
    assert reasons == {r.f: r.reason for r in reports.report_rejects(whole).collect()}
    assert set(reasons.values()) == {"open_quote", "long_row", "no_header"}
    splits = spark.read.text(str(folder)).select("_metadata.file_path", "_metadata.file_block_start")
    assert splits.distinct().count() > 3 * len(os.listdir(folder))


def test_long_records_are_rejected(spark, tmp_path, tiny_splits):
    """Two stray quotes make a record of all between them; at the bound it is still read."""
    texts = {
        "stray": "a,b\n1,\"x\n" + "2,3\n" * 60 + "4\",5\n6,7\n",
        "line": "a,b\n1," + "y" * 199 + "\n2,3\n",
        "edge": "a,b\n\"" + "z\n" * 98 + "\",1\n",
        "open": "a,b\n1,\"x\n" + "2,3\n" * 60,
        "fine": "a,b\n" + "1,\"p\nq\"\n" * 60,
    }
    for name, t in texts.items():
        (tmp_path / f"{name}.csv").write_text(t)
    rows, files = lines.read_large_reports(spark, [str(tmp_path / f"{n}.csv") for n in texts], max_record_bytes=200)
    name = F.regexp_extract("file", "([^/]+)[.]csv$", 1).alias("f")
    reasons = {r.f: r.reason for r in files.select(name, "reason").collect()}
    assert reasons == {"stray": "long_record", "line": "long_record", "edge": None, "open": "open_quote", "fine": None}
    counts = {r.f: r["count"] for r in rows.groupBy(name).count().collect()}
    assert counts == {"edge": 1, "fine": 60}


def test_curated_in_splits(spark, tmp_path, tiny_splits):
    folder = tmp_path / "20251106" / "Co one+two"
    folder.mkdir(parents=True)
    good, bad = "Co AB-CD-1-2_Depot Inventory.csv", "Co nothing.csv"
    body = "Title,\nDepot ID,Land,FP Expiry Date\n" + "".join(f"{i},\"C\n{i}\",05-Nov-2025\n" for i in range(30))
    for n in (good, bad):
        (folder / n).write_text(body)
    sheet = headers.sheet_to_rows(
        spark.createDataFrame([(0, "Country", "Land")], "n int, `Column Header` string, `AB-CD-1-2` string"), "depot", "n"
    )
    stamp = dt.datetime(2025, 11, 6)
    rows, rejects = curate.curate_large_reports(spark, [str(folder)], "depot", sheet, stamp)
    files = describe_paths(spark.read.format("binaryFile").load(str(folder))).select("file_name", "extract_date", "content")
    want, want_rejects = curate.curate_reports(files, "depot", sheet, stamp)
    assert want.count() == 30
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
    assert [(r.file_name, r.reason) for r in rejects.collect()] == [(bad, "no_study_code")]
    assert [(r.file_name, r.reason) for r in want_rejects.collect()] == [(bad, "no_study_code")]

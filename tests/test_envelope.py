"""Decryption of every envelope, and that the key stays out of sight."""

import base64

import pytest
from pyspark.sql import functions as F

from dosecast.queries.reading import DUMMY_KEY
from dosecast.sources import envelope

KEY = base64.b64decode(DUMMY_KEY)
IV = bytes(range(16))


def seal(spark, data, mode, key=KEY):
    df = spark.createDataFrame([(data, key, IV)], "d binary, k binary, iv binary")
    args = ["d", "k", F.lit(mode), F.lit("PKCS")] + (["iv"] if mode == "CBC" else [])
    return bytes(df.select(F.aes_encrypt(*args)).first()[0])


def opened(spark, contents, key=DUMMY_KEY, names=None):
    names = names or [f"{i}.enc" for i in range(len(contents))]
    df = spark.createDataFrame(list(zip(names, map(bytearray, contents))), "file_name string, content binary")
    out = envelope.decrypt_files(df, envelope.key_frame(spark, key))
    return {r.file_name: r for r in out.collect()}


def b64(b):
    return base64.b64encode(b)


@pytest.mark.parametrize("size", [16, 24, 32])
def test_envelopes_and_key_sizes(spark, size):
    key = KEY[:size]
    text = "a,b\n1,é\n".encode()
    cbc, ecb = seal(spark, text, "CBC", key), seal(spark, text, "ECB", key)
    wrapped = b"\n".join(b64(ecb)[i : i + 10] for i in range(0, 60, 10))
    got = opened(
        spark,
        [b64(ecb), b"  " + b64(cbc[:16]) + b" : " + b64(cbc[16:]) + b"\n", ecb, wrapped],
        b64(key).decode(),
    )
    assert [bytes(got[f"{i}.enc"].content) for i in range(4)] == [text] * 4
    assert [got[f"{i}.enc"].mode for i in range(4)] == ["ECB", "CBC", "ECB", "ECB"]
    assert got["0.enc"].output_name == "0.csv" and got["0.enc"].output_size == len(text)


@pytest.mark.parametrize("tail", [b"", b"\x00", b"\x10\x00\x00", b"x\xa0"])
def test_zero_padding(spark, tail):
    plain = b"0123456789,abcde" + tail
    padded = plain + b"\x00" * (-len(plain) % 16)
    got = opened(spark, [b64(seal(spark, padded, "ECB")[:-16])])["0.enc"]
    assert got.success and bytes(got.content) == padded.rstrip(b"\x00")


def test_inner_base64(spark):
    inner = b64(b"PK\x03\x04rest")
    got = opened(spark, [b64(seal(spark, d, "ECB")) for d in (inner, b"abc,d", b"abcd\n", b"")])
    assert got["0.enc"].base64_decoded and got["0.enc"].file_type == "xlsx"
    assert [got[f"{i}.enc"].base64_decoded for i in (1, 2, 3)] == [False, True, True]
    assert got["3.enc"].output_size == 0 and got["3.enc"].file_type == "unknown"


def test_faults_keep_a_row(spark):
    good = seal(spark, b"a,b", "CBC")
    bad_iv = b64(good[:5]) + b":" + b64(good[16:])
    got = opened(spark, [bad_iv, b"\xff" * 17, b64(good[16:])[:-8]])
    assert [got[f"{i}.enc"].success for i in range(3)] == [False, False, False]
    assert all(r.content is None and r.file_type is None for r in got.values())


@pytest.mark.parametrize("key", ["a" * 16, "AA==", ""])
def test_key_length(spark, key):
    with pytest.raises(ValueError, match="bytes"):
        envelope.key_frame(spark, key)


def test_key_is_not_in_the_plan(spark):
    df = spark.createDataFrame([("x", bytearray(b"y" * 16))], "file_name string, content binary")
    out = envelope.decrypt_files(df, envelope.key_frame(spark, DUMMY_KEY))
    out.collect()
    shown = out._jdf.queryExecution().toString()
    for form in (KEY.decode(), KEY.hex(), KEY.hex().upper(), DUMMY_KEY):
        assert form not in shown


@pytest.mark.parametrize(
    "name,kind,want",
    [("r.enc", "csv", "r.csv"), ("r.csv.ENC", "xlsx", "r.xlsx"), ("r.b.enc", "unknown", "r.b"), (".enc", "csv", ".csv"), ("r", "xls", "r.xls")],
)
def test_output_names(spark, name, kind, want):
    df = spark.createDataFrame([(name, kind)], "n string, k string")
    assert df.select(envelope.output_name(F.col("n"), F.col("k"))).first()[0] == want


def test_sample_cut_inside_a_sign_is_unknown(spark):
    texts = [b"a," + b"x" * 197 + "é".encode(), b"a," + b"x" * 196 + "é".encode(), b"x" * 200 + b",", b"x\ty"]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "c binary")
    assert [r[0] for r in df.select(envelope.sniff_type(F.col("c"))).collect()] == ["unknown", "csv", "unknown", "csv"]

"""Decrypt report files as one Spark job.

A file is ``base64(iv):base64(text)`` (CBC), ``base64(text)`` (ECB), or binary with (CBC) or
without (ECB) a leading 16-byte IV. The cipher is Spark's own AES.

The key never becomes a literal of the plan: it travels as a one-row DataFrame that the job
reads by a scalar subquery, so ``explain`` and the UI do not show it.
"""

from __future__ import annotations

import base64
import binascii

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.functions.text import let

BLOCK = 16
# Leading bytes of the file types, in hex.
XLSX_MAGIC = "504B0304"
XLS_MAGIC = "D0CF11E0A1B11AE1"
SAMPLE_BYTES = 200


def check_key(key_base64: str) -> bytes:
    """The raw key; an error unless it has 16, 24 or 32 bytes."""
    try:
        key = base64.b64decode(key_base64)
    except binascii.Error as bad:
        raise ValueError("the key is not base64") from bad
    if len(key) not in (16, 24, 32):
        raise ValueError(f"the key has {len(key)} bytes, not 16, 24 or 32")
    return key


def key_frame(spark: SparkSession, key_base64: str) -> DataFrame:
    """One row with the key, to pass to ``decrypt_files``."""
    return spark.createDataFrame([(check_key(key_base64),)], "key binary")


def _base64(text: Column) -> Column:
    """Decoded bytes, null where the text is no base64; white space does not count."""
    tight = F.when(text.rlike(r"\s"), F.regexp_replace(text, r"\s+", "")).otherwise(text)
    return F.try_to_binary(tight, F.lit("base64"))


def detect_envelope(content: Column) -> Column:
    """``struct(mode, iv, body)`` of an encrypted file; ``iv`` is null for ECB."""
    text = content.cast("string")
    none = F.lit(None).cast("binary")

    def envelope(mode: str, iv: Column, body: Column) -> Column:
        return F.struct(F.lit(mode).alias("mode"), iv.alias("iv"), body.alias("body"))

    def read(colon: Column) -> Column:
        """The text envelope, null where it is none; ``colon`` is null for binary content."""
        iv = _base64(F.substring(text, F.lit(1), colon - 1))
        body = _base64(F.substring(text, colon + 1, F.length(text)))
        return (
            F.when(colon.isNull(), F.lit(None))
            .when(colon == 0, let(_base64(text), lambda b: F.when(b.isNotNull(), envelope("ECB", none, b))))
            .otherwise(
                let(
                    F.struct(iv.alias("iv"), body.alias("body")),
                    lambda p: F.when(
                        p["iv"].isNotNull() & p["body"].isNotNull(),
                        envelope("CBC", p["iv"], p["body"]),
                    ),
                )
            )
        )

    binary = F.when(F.length(content) % BLOCK == 0, envelope("ECB", none, content)).otherwise(
        envelope(
            "CBC",
            F.substring(content, 1, BLOCK),
            F.substring(content, F.lit(BLOCK + 1), F.length(content)),
        )
    )
    colon = F.when(F.is_valid_utf8(text), F.instr(text, ":"))
    return F.coalesce(let(colon, read), binary)


def _decrypt(mode: Column, iv: Column, body: Column, key: Column) -> Column:
    sealed = F.when(mode == "CBC", F.concat(iv, body)).otherwise(body)
    return F.try_aes_decrypt(sealed, key, mode, F.lit("PKCS"))


def _padding_block(mode: Column, last_block: Column, key: Column) -> Column:
    """An encrypted block of pure padding that fits behind the last block of the body.

    With it the cipher gives back the body's plain bytes whatever they end in.
    """
    nothing = F.lit(b"")
    chained = F.aes_encrypt(nothing, key, F.lit("CBC"), F.lit("PKCS"), last_block)
    return F.when(mode == "CBC", F.substring(chained, BLOCK + 1, BLOCK)).otherwise(
        F.aes_encrypt(nothing, key, F.lit("ECB"), F.lit("PKCS"))
    )


def drop_trailing_zeros(data: Column) -> Column:
    """Take off zero bytes at the end; a last digit 0 of another byte stays."""
    digits = F.rtrim(F.hex(data), F.lit("0"))
    return F.substring(data, F.lit(1), F.ceil(F.length(digits) / 2).cast("int"))


def decrypt_body(opened: DataFrame, key: Column) -> DataFrame:
    """Replace ``iv`` and ``body`` by the plain bytes ``plain``.

    The padding is taken off, or trailing zeros where the padding is not valid. Null where the
    body is not made of whole blocks or the IV is not one block.
    """
    others = [c for c in opened.columns if c not in ("iv", "body")]
    mode, iv, body = F.col("mode"), F.col("iv"), F.col("body")
    usable = (F.length(body) % BLOCK == 0) & ((mode == "ECB") | (F.length(iv) == BLOCK))
    padded = F.when(F.length(body) == 0, body).otherwise(_decrypt(mode, iv, body, key))
    tried = opened.withColumns({"_usable": usable, "_padded": F.when(usable, padded)})
    block = _padding_block(mode, F.substring(body, -BLOCK, BLOCK), key)
    raw = _decrypt(mode, iv, F.concat(body, block), key)
    retried = tried.select(
        *others,
        "_padded",
        F.when(F.col("_usable") & F.col("_padded").isNull(), raw).alias("_raw"),
    )
    plain = F.coalesce("_padded", drop_trailing_zeros(F.col("_raw")))
    return retried.select(*others, plain.alias("plain"))


def inner_base64(data: Column) -> Column:
    """Bytes behind a second base64 layer, null where there is none.

    Line breaks may wrap the layer; any other foreign sign means that the data is no base64.
    """
    text = data.cast("string")

    def decoded(tight: Column) -> Column:
        whole = tight.rlike(r"^(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?+$")
        return F.when(whole, F.try_to_binary(tight, F.lit("base64")))

    # Ordinary text ends the first test at its first space or comma.
    possible = text.rlike(r"^[A-Za-z0-9+/=\r\n]*+\z")
    return F.when(possible, let(F.regexp_replace(text, r"[\r\n]+", ""), decoded))


def sniff_type(data: Column) -> Column:
    """"xlsx", "xls", "csv" or "unknown" by the leading bytes."""
    sample = F.substring(data, 1, SAMPLE_BYTES).cast("string")
    return (
        F.when(F.hex(F.substring(data, 1, 4)) == XLSX_MAGIC, "xlsx")
        .when(F.hex(F.substring(data, 1, 8)) == XLS_MAGIC, "xls")
        .when(F.is_valid_utf8(sample) & (sample.contains(",") | sample.contains("\t")), "csv")
        .otherwise("unknown")
    )


def output_name(file_name: Column, file_type: Column) -> Column:
    """Name without ".enc" and with the extension of the type; an unknown type keeps its own."""
    name = F.regexp_replace(file_name, r"(?i)\.enc$", "")
    # A name that only starts with dots has no extension.
    stem = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")
    return F.when(file_type == "unknown", name).otherwise(
        F.concat(stem, F.lit("."), file_type)
    )


def decrypt_files(files: DataFrame, key: DataFrame) -> DataFrame:
    """Landing rows of encrypted files.

    Input ``file_name, content`` and any other columns, which are kept. Adds ``success, mode,
    base64_decoded, file_type, output_name, output_size`` and replaces ``content`` by the
    plain bytes. A file that cannot be decrypted keeps a row with ``success`` false.
    """
    others = [c for c in files.columns if c != "content"]
    secret = key.scalar()
    opened = files.select(*others, detect_envelope(F.col("content")).alias("_e")).select(
        *others, "_e.*"
    )
    plain = decrypt_body(opened, secret)
    decoded = plain.select(
        *others, "mode", "plain", inner_base64(F.col("plain")).alias("_inner")
    )
    final = decoded.select(
        *others,
        "mode",
        F.col("_inner").isNotNull().alias("base64_decoded"),
        F.coalesce("_inner", "plain").alias("content"),
    )
    typed = final.withColumn("file_type", F.when(F.col("content").isNotNull(), sniff_type(F.col("content"))))
    return typed.select(
        *others,
        F.col("content").isNotNull().alias("success"),
        "mode",
        "base64_decoded",
        "file_type",
        output_name(F.col("file_name"), F.col("file_type")).alias("output_name"),
        F.length("content").alias("output_size"),
        "content",
    )

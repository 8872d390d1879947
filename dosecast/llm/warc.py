"""A content-addressed web archive.

Payload bytes are stored once, under their SHA-256, and checked against it; the exact header
bytes of every record are stored apart, with the digest of their payload. A join of the two
gives back the original WARC records byte by byte. Equal payloads below a size are full
records all the same; of larger ones, that with the smallest page is the ``response`` and the
others are ``revisit`` records that refer to it.

Which payload to keep is decided on digests alone, so payload bytes move only if many of them
are repeats, and no group of copies meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.llm.common import materialise, scratch_dir

CRLF = "\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
DATE = "2024-01-01T00:00:00Z"
RECORD_END = f"{CRLF}{CRLF}"


@dataclass(frozen=True)
class Archive:
    """Folders of the two stores."""

    headers: str
    payloads: str


def payload_of(html: Column) -> Column:
    """The UTF-8 bytes of a page; a null page has none."""
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def record_id(page_id: Column) -> Column:
    """A stable URN per page."""
    hashed = F.md5(F.concat_ws("|", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    part = lambda start, n: F.substring(hashed, start, n)
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        F.lit(">"),
    )


def decide(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id``, ``url``, digest and size of each page, its record type and, for a revisit,
    the page it refers to.

    Rows that share the smallest ``page_id`` of a payload are all responses. A null
    ``page_id`` is larger than any; if all are null, all are responses.
    """
    measured = materialise(
        pages.select(
            "page_id",
            "url",
            F.sha2(payload_of(F.col("html")), 256).alias("payload_digest"),
            F.octet_length(payload_of(F.col("html"))).cast("long").alias("payload_bytes"),
        )
    )
    first = (
        measured.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"))
    )
    revisit = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return measured.join(first, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


def header_block(decided: DataFrame) -> Column:
    """The WARC and HTTP headers of a record, up to where its payload starts.

    A revisit holds the HTTP headers only, so its payload is not part of its block. Line ends
    and other control characters of a url are percent-encoded.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    for c in ("%0D\r", "%0A\n"):
        url = F.replace(url, F.lit(c[3:]), F.lit(c[:3]))
    http = F.concat(
        F.lit(f"{HTTP_HEAD}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2)
    )
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"{VERSION}{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", record_id(F.col("refers_to"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(pages: DataFrame, min_bytes: int = 100, path: str | None = None) -> Archive:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``; other columns are
    not archived). An empty table gives an empty archive."""
    path = path or scratch_dir(pages.sparkSession)
    archive = Archive(f"{path}/headers", f"{path}/payloads")
    decided = materialise(decide(pages, min_bytes))
    decided.select(
        "page_id",
        "refers_to",
        "payload_digest",
        F.encode(header_block(decided), "UTF-8").alias("header"),
    ).write.option("compression", "zstd").parquet(archive.headers)

    # Rows whose payload another row stores: revisits, and all copies but one of payloads that
    # stand more than once among the responses.
    responses = decided.where("record_type = 'response'")
    shared = materialise(
        responses.groupBy("payload_digest")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest")
    )
    revisits = materialise(
        decided.where("record_type = 'revisit'")
        .select("payload_digest", F.col("page_id").alias("_page"))
        .distinct()
    )
    payloads = pages.select("page_id", payload_of(F.col("html")).alias("payload")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    kept = payloads.join(
        revisits,
        (payloads["payload_digest"] == revisits["payload_digest"])
        & payloads["page_id"].eqNullSafe(revisits["_page"]),
        "left_anti",
    ).select("payload_digest", "payload")
    once = kept.join(shared, "payload_digest", "left_anti")
    # dropDuplicates drops within each task before it shuffles.
    many = kept.join(shared, "payload_digest", "left_semi").dropDuplicates(["payload_digest"])
    once.unionByName(many).write.option("compression", "zstd").parquet(archive.payloads)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Reconstruct the records: ``header``, ``payload`` (of a revisit that of its response),
    ``record``, the exact bytes of the WARC record, and ``verified``, whether the payload has
    the digest it is stored under."""
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads)
    joined = headers.join(payloads, "payload_digest", "left")
    whole = F.coalesce(F.col("payload"), F.encode(F.lit(""), "UTF-8"))
    is_revisit = F.instr(F.col("header").cast("string"), f"{CRLF}WARC-Type: revisit{CRLF}") > 0
    return joined.select(
        "page_id",
        "refers_to",
        "header",
        "payload",
        F.concat(
            "header",
            F.when(is_revisit, F.encode(F.lit(""), "UTF-8")).otherwise(whole),
            F.encode(F.lit(RECORD_END), "UTF-8"),
        ).alias("record"),
        (F.sha2("payload", 256) == F.col("payload_digest")).alias("verified"),
    )


def header_field(header: Column, name: str) -> Column:
    """The first value of a WARC header field, null if there is none."""
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def archived_pages(records: DataFrame) -> DataFrame:
    """What the records say of each page. Size and digest come from the payload's own bytes;
    a record whose payload is missing or altered raises an error."""
    head = F.col("header").cast("string")
    digest = F.sha2("payload", 256)
    declared = F.substring_index(header_field(head, "WARC-Payload-Digest"), ":", -1)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == declared, digest)
        .otherwise(F.raise_error(F.lit("payload differs from its digest")))
        .alias("payload_digest"),
        header_field(head, "WARC-Type").alias("record_type"),
        "refers_to",
    )

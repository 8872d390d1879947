"""Queries on report reading, header sheets, curation and decryption."""

from __future__ import annotations

import base64
import datetime as dt

from pyspark.sql import functions as F

from dosecast.operators import snapshots
from dosecast.plans.curate import curate_reports
from dosecast.queries.fixtures import scratch, table
from dosecast.sources import envelope, headers, lines, reports

DAY = dt.date(2025, 11, 6)
STAMP = dt.datetime(2025, 11, 6, 8, 0)


def customer(spark, sf):
    return table(spark, sf, "customer").withColumn("file_no", F.floor(F.col("c_custkey") / 50))


def csv_files(spark, sf, header, line, preamble="Report,,\nRun by,,x\n"):
    """One file per fifty customers: a preamble, a header line and a line per customer."""
    numbered = customer(spark, sf).select("file_no", "c_custkey", line.alias("line"))
    body = numbered.groupBy("file_no").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("c_custkey", "line"))), lambda x: x["line"]
            ),
            "\n",
        ).alias("body")
    )
    top = preamble if not isinstance(preamble, str) else F.lit(preamble)
    return body.select(
        "file_no", F.concat(top, F.lit(header + "\n"), F.col("body")).cast("binary").alias("content")
    )


PLAIN_HEADER = "Site ID,Country,Subject Nbr,Name"
PLAIN_LINE = (
    "concat(cast(c_custkey % 40 as string), ',\"Nation, ', cast(c_nationkey as string), '\",', "
    "case when c_custkey % 5 = 0 then 'NA' else cast(c_custkey as string) end, "
    "case when c_custkey % 9 = 0 then '' else concat(',\"', c_name, ' \"\"', c_mktsegment, '\"\"\nline 2\"') end)"
)


def floating_header_csv(spark, sf):
    rows = reports.report_rows(
        reports.parse_reports(csv_files(spark, sf, PLAIN_HEADER, F.expr(PLAIN_LINE)))
    )
    return rows.select(
        "file_no",
        "row_no",
        *[
            reports.cell(n).alias(a)
            for n, a in zip(PLAIN_HEADER.split(","), ("site", "country", "subject", "name"))
        ],
    )


def split_file_csv(spark, sf):
    """CSV files with quoted line ends, read in splits instead of whole."""
    folder = scratch(spark, "csv")
    written = customer(spark, sf).select(
        F.col("c_custkey").alias("Subject Nbr"),
        F.concat("c_name", F.lit(' "'), "c_mktsegment", F.lit('"\nline, 2')).alias("Name"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("Nation"),
    )
    snapshots.write_csv(written, folder)
    rows, files = lines.read_large_reports(spark, [folder])
    named = rows.join(files.select("file", "header"), "file")
    return named.select(
        *[
            reports.cell(n).alias(a)
            for n, a in (("Subject Nbr", "subject"), ("Name", "name"), ("Nation", "nation"))
        ]
    )


BROKEN_LINE = (
    "concat(cast(c_custkey as string), case when c_custkey % 50 = 17 and file_no % 4 = 1 then ',a,b' "
    "when c_custkey % 50 = 23 and file_no % 4 = 2 then ',\"a' else ',a' end)"
)


def file_rejects(spark, sf):
    top = F.when(F.col("file_no") % 4 == 3, F.repeat(F.lit("no header here\n"), 10)).otherwise("Report,\n")
    files = csv_files(spark, sf, "Subject,Value", F.expr(BROKEN_LINE), top)
    return reports.report_rejects(reports.parse_reports(files))


def sheet(spark, sf):
    """A wide header sheet: one row per part, one column per study."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("n"),
        F.when(F.col("p_partkey") % 40 != 0, F.concat(F.lit("Label "), (F.col("p_partkey") % 300).cast("string"))).alias(headers.LABEL),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit(" "), "p_name")).alias("ST-1"),
        F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.concat("p_brand", F.lit(", "), "p_type")).alias("ST-2"),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("x="), "p_brand")).otherwise(F.col("p_type")).alias("ST-3"),
        F.lit(None).cast("string").alias("ST-4"),
    )


def mapping_unpivot(spark, sf):
    return headers.sheet_to_rows(sheet(spark, sf), "site", "n")


def header_map_build(spark, sf):
    maps = headers.header_map(mapping_unpivot(spark, sf))
    return maps.select("study", F.explode_outer("specs").alias("label", "spec"))


CODE = "concat('AB-CD-', cast({0} % 5 as string), '-', cast({0} as string))"


def study_sheet(spark, sf, specs):
    """Long header rows for the study of each file: ``specs`` maps a label to its spec."""
    studies = customer(spark, sf).select(F.expr(CODE.format("file_no")).alias("study"), "file_no").distinct()
    rows = F.array(
        *[
            F.struct(F.lit(l).alias("label"), s.alias("spec"), F.lit(i).cast("long").alias("row_no"))
            for i, (l, s) in enumerate(specs.items())
        ]
    )
    return studies.select(F.lit("subject").alias("file_type"), "study", F.inline(rows))


def subject_files(spark, sf):
    line = F.expr(
        "concat(cast(c_custkey as string), ',', case when c_custkey % 3 = 0 then '' else concat('N', cast(c_nationkey as string)) end, "
        "',', c_mktsegment, ',', case when c_custkey % 4 = 0 then '1975' else '05/11/1980' end, "
        "',', case c_custkey % 4 when 0 then '05-Nov-2025' when 1 then '7 Mar 2024' when 2 then '2025-01-01' else 'n/a' end, "
        "',', case when c_custkey % 6 = 0 then 'x7' else cast(c_custkey % 40 as string) end)"
    )
    files = csv_files(spark, sf, "Subj,Land,Region,Born,Seen,Site ID", line)
    name = F.concat(F.lit("Sponsor "), F.expr(CODE.format("file_no")), F.lit("_Subject Summary.csv"))
    return files.select("file_no", name.alias("file_name"), F.lit(DAY).alias("extract_date"), "content")


def specs_for_subjects():
    odd = F.col("file_no") % 2 == 1
    return {
        "Subject Number": F.lit(" Subj "),
        "Country": F.when(odd, F.lit("Land, Nowhere, Region")).otherwise("Region"),
        "Gender": F.lit("x=not = told "),
        "Year of Birth": F.lit("Born"),
        "Last Study Visit Date": F.when(odd, F.lit("Seen")),
        "Investigator": F.lit("Nowhere"),
        "TPC": F.lit("Nowhere, Elsewhere"),
    }


def harmonised(spark, sf, labels):
    coded = subject_files(spark, sf).withColumn("study_code", F.expr(CODE.format("file_no"))).withColumn(
        "file_type", F.lit("subject")
    )
    parsed = reports.parse_reports(
        headers.with_specs(coded, study_sheet(spark, sf, specs_for_subjects()))
    )
    resolved = headers.resolve_labels(parsed, labels)
    return headers.harmonise(reports.report_rows(resolved), labels, ["file_no", "row_no"])


def harmonise_literal(spark, sf):
    return harmonised(spark, sf, ["Gender"])


def harmonise_coalesce(spark, sf):
    return harmonised(spark, sf, ["Country", "TPC"])


def harmonise_direct(spark, sf):
    return harmonised(spark, sf, ["Subject Number", "Site ID", "Investigator", "Last Study Visit Date"])


def curated(spark, sf):
    table_rows, _ = curate_reports(
        subject_files(spark, sf),
        "subject",
        study_sheet(spark, sf, specs_for_subjects()),
        STAMP,
    )
    return table_rows.select(
        "study_protocol", "site_id", "country", "subject_number", "year_of_birth", "gender", "tpc",
        "investigator", "last_study_visit_date", "extract_date", "source_file",
        F.date_format("processed_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
    )


def default_if_all_null(spark, sf):
    depots = customer(spark, sf).select(
        "file_no",
        F.col("c_custkey").alias("depot_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.when((F.col("file_no") % 2 == 0) & (F.col("c_custkey") % 10 == 0), "All").alias("approved"),
    )
    return headers.default_if_all_null(depots, "approved", "country", ["file_no"])


# An obvious dummy, for test data only.
DUMMY_KEY = base64.b64encode(b"0123456789abcdef0123456789abcdef").decode()


def key(spark):
    return envelope.key_frame(spark, DUMMY_KEY)


def documents(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("report "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".csv.ENC").otherwise(".enc")).alias("file_name"),
        "text",
    )


def sealed(spark, sf):
    """The documents encrypted in every envelope, with faults.

    By ``doc_id % 8``: text ECB, text CBC, binary ECB, cut binary, zero-padded ECB,
    zero-padded CBC, text ECB around base64, text CBC cut to a broken body.
    """
    secret = key(spark).scalar()
    kind = F.col("doc_id") % 8
    plain = F.col("text").cast("binary")
    iv = F.unhex(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 32))

    def seal(data, mode):
        if mode == "ECB":
            return F.aes_encrypt(data, secret, F.lit("ECB"), F.lit("PKCS"))
        return F.aes_encrypt(data, secret, F.lit("CBC"), F.lit("PKCS"), iv)

    def unpadded(cipher):
        return F.substring(cipher, F.lit(1), F.length(cipher) - 16)

    def enveloped(cipher):
        return F.concat(
            F.base64(F.substring(cipher, 1, 16)),
            F.lit(":"),
            F.base64(F.substring(cipher, F.lit(17), F.length(cipher))),
        )

    zeros = F.concat(plain, F.unhex(F.repeat(F.lit("00"), ((16 - F.length(plain) % 16) % 16).cast("int"))))
    cut = F.substring(seal(plain, "CBC"), F.lit(1), F.length(seal(plain, "CBC")) - 5)
    content = (
        F.when(kind == 0, F.base64(seal(plain, "ECB")).cast("binary"))
        .when(kind == 1, F.concat(F.lit("\n"), enveloped(seal(plain, "CBC")), F.lit("\n")).cast("binary"))
        .when(kind == 2, seal(plain, "ECB"))
        .when(kind == 3, cut)
        .when(kind == 4, F.base64(unpadded(seal(zeros, "ECB"))).cast("binary"))
        .when(kind == 5, enveloped(unpadded(seal(zeros, "CBC"))).cast("binary"))
        .when(kind == 6, F.base64(seal(F.regexp_replace(F.base64(plain), r"\s", "").cast("binary"), "ECB")).cast("binary"))
        .otherwise(enveloped(F.substring(seal(plain, "CBC"), F.lit(1), F.length(seal(plain, "CBC")) - 3)).cast("binary"))
    )
    return documents(spark, sf).select("doc_id", "file_name", content.alias("content"))


def decrypt_envelope(spark, sf):
    found = sealed(spark, sf).select("doc_id", envelope.detect_envelope(F.col("content")).alias("e"))
    return found.select(
        "doc_id", "e.mode", F.length("e.iv").alias("iv_length"), F.length("e.body").alias("body_length")
    )


def decrypt_job(spark, sf):
    opened = envelope.decrypt_files(sealed(spark, sf), key(spark))
    return opened.select(
        "doc_id", "success", "mode", "base64_decoded", "file_type", "output_name", "output_size",
        F.md5("content").alias("content_md5"),
    )


def sniff_type(spark, sf):
    kind = F.col("doc_id") % 3
    body = F.col("text").cast("binary")
    content = (
        F.when(kind == 0, F.concat(F.unhex(F.lit(envelope.XLSX_MAGIC)), body))
        .when(kind == 1, F.concat(F.unhex(F.lit(envelope.XLS_MAGIC)), body))
        .otherwise(body)
    )
    return documents(spark, sf).select("doc_id", envelope.sniff_type(content).alias("file_type"))


QUERIES = {
    "floating_header_csv": floating_header_csv,
    "split_file_csv": split_file_csv,
    "file_rejects": file_rejects,
    "mapping_unpivot": mapping_unpivot,
    "header_map_build": header_map_build,
    "harmonise_literal": harmonise_literal,
    "harmonise_coalesce": harmonise_coalesce,
    "harmonise_direct": harmonise_direct,
    "curate_reports": curated,
    "default_if_all_null": default_if_all_null,
    "decrypt_envelope": decrypt_envelope,
    "decrypt_job": decrypt_job,
    "sniff_type": sniff_type,
}

# --- the same in SQL -------------------------------------------------------------------

CUSTOMER = """with c as (
  select *, cast(floor(c_custkey / 50) as bigint) as file_no,
    cast(row_number() over (partition by floor(c_custkey / 50) order by c_custkey) as int) as row_no from customer)
"""
SQL_CODE = "concat('AB-CD-', file_no % 5, '-', file_no)"
SHEET = """, sheet as (
  select p_partkey as n, case when p_partkey % 40 <> 0 then concat('Label ', p_partkey % 300) end as label,
    case when p_size % 4 <> 0 then concat(' ', p_name) end as s1,
    case when p_size % 3 = 0 then '  ' else concat(p_brand, ', ', p_type) end as s2,
    case when p_size % 5 = 0 then concat('x=', p_brand) else p_type end as s3 from part),
long as (
  select 'site' as file_type, 'ST-1' as study, label, s1 as spec, n as row_no from sheet
  union all select 'site', 'ST-2', label, s2, n from sheet
  union all select 'site', 'ST-3', label, s3, n from sheet
  union all select 'site', 'ST-4', label, null, n from sheet)
"""
DOCS = r"""with d as (
  select doc_id, text, doc_id % 8 as kind, octet_length(encode(text)) as n,
    concat('report ', doc_id, case when doc_id % 2 = 0 then '.csv.ENC' else '.enc' end) as file_name,
    case when (octet_length(encode(text)) <= 200 or hex(encode(text)[201:201]) < '80' or hex(encode(text)[201:201]) > 'BF')
      and ((contains(text, ',') and octet_length(encode(split_part(text, ',', 1))) < 200)
        or (contains(text, chr(9)) and octet_length(encode(split_part(text, chr(9), 1))) < 200)) then 'csv' else 'unknown' end as sniffed
  from documents)
"""
PADDED = "(n // 16 + 1) * 16"
ZEROED = "(n + 15) // 16 * 16"
INNER = "((n + 2) // 3 * 4)"
LAND = "case when c_custkey % 3 <> 0 then concat('N', c_nationkey) end"

ORACLES = {
    "floating_header_csv": CUSTOMER
    + """select file_no, row_no, cast(c_custkey % 40 as varchar) as site, concat('Nation, ', c_nationkey) as country,
      case when c_custkey % 5 <> 0 then cast(c_custkey as varchar) end as subject,
      case when c_custkey % 9 <> 0 then concat(c_name, ' "', c_mktsegment, '"', chr(10), 'line 2') end as name from c""",
    "split_file_csv": CUSTOMER
    + """select cast(c_custkey as varchar) as subject, concat(c_name, ' "', c_mktsegment, '"', chr(10), 'line, 2') as name,
      case when c_custkey % 5 <> 0 then cast(c_nationkey as varchar) end as nation from c""",
    "file_rejects": CUSTOMER
    + """select distinct file_no, case file_no % 4 when 1 then 'long_row' when 2 then 'open_quote' else 'no_header' end as reason
      from c where file_no % 4 = 3 or (file_no % 4 = 1 and c_custkey % 50 = 17) or (file_no % 4 = 2 and c_custkey % 50 = 23)""",
    "mapping_unpivot": "with z as (select 1)" + SHEET + "select * from long",
    "header_map_build": "with z as (select 1)"
    + SHEET
    + """, once as (select study, label, trim(spec) as spec, min(row_no) as row_no from long where label is not null and trim(coalesce(spec, '')) <> '' group by all),
      by_column as (select study, spec, arg_max(label, row_no) as label, min(row_no) as row_no from once
        group by study, spec, case when contains(spec, '=') then label end),
      final as (select study, label, arg_max(spec, row_no) as spec from by_column group by study, label)
      select k.study, f.label, f.spec from (select distinct study from long) k left join final f on k.study = f.study""",
    "harmonise_literal": CUSTOMER + 'select file_no, row_no, \'not = told\' as "Gender" from c',
    "harmonise_coalesce": CUSTOMER
    + f'select file_no, row_no, case when file_no % 2 = 1 then coalesce({LAND}, c_mktsegment) else c_mktsegment end as "Country", cast(null as varchar) as "TPC" from c',
    "harmonise_direct": CUSTOMER
    + """select file_no, row_no, cast(c_custkey as varchar) as "Subject Number", case when c_custkey % 6 = 0 then 'x7' else cast(c_custkey % 40 as varchar) end as "Site ID",
      cast(null as varchar) as "Investigator",
      case when file_no % 2 = 1 then case c_custkey % 4 when 0 then '05-Nov-2025' when 1 then '7 Mar 2024' when 2 then '2025-01-01' end end as "Last Study Visit Date" from c""",
    "curate_reports": CUSTOMER
    + f"""select {SQL_CODE} as study_protocol, case when c_custkey % 6 <> 0 then cast(c_custkey % 40 as int) end as site_id,
      case when file_no % 2 = 1 then coalesce({LAND}, c_mktsegment) else c_mktsegment end as country, c_custkey as subject_number,
      cast(case when c_custkey % 4 = 0 then 1975 else 1980 end as int) as year_of_birth, 'not = told' as gender, cast(null as varchar) as tpc, cast(null as varchar) as investigator,
      case when file_no % 2 = 1 then case c_custkey % 4 when 0 then date '2025-11-05' when 1 then date '2024-03-07' end end as last_study_visit_date,
      date '{DAY}' as extract_date, concat('Sponsor ', {SQL_CODE}, '_Subject Summary.csv') as source_file, '2025-11-06 08:00:00' as processed_at from c""",
    "default_if_all_null": CUSTOMER
    + """, a as (select file_no, c_custkey as depot_id, concat('N', c_nationkey) as country, case when file_no % 2 = 0 and c_custkey % 10 = 0 then 'All' end as approved from c)
      select file_no, depot_id, country, case when max(approved) over (partition by file_no) is null then country else approved end as approved from a""",
    "decrypt_envelope": DOCS
    + f"""select doc_id, case when kind in (1, 3, 5, 7) then 'CBC' else 'ECB' end as mode, cast(case when kind in (1, 3, 5, 7) then 16 end as int) as iv_length,
      cast(case kind when 0 then {PADDED} when 1 then {PADDED} when 2 then {PADDED} when 3 then {PADDED} - 5 when 4 then {ZEROED} when 5 then {ZEROED}
        when 6 then ({INNER} // 16 + 1) * 16 else {PADDED} - 3 end as int) as body_length from d""",
    "decrypt_job": DOCS
    + r"""select doc_id, kind not in (3, 7) as success, case when kind in (1, 3, 5, 7) then 'CBC' else 'ECB' end as mode, kind = 6 as base64_decoded,
      case when kind not in (3, 7) then sniffed end as file_type,
      case when kind not in (3, 7) then case when sniffed = 'csv' then concat('report ', doc_id, '.csv') else regexp_replace(file_name, '(?i)\.enc$', '') end end as output_name,
      cast(case when kind not in (3, 7) then n end as int) as output_size, case when kind not in (3, 7) then md5(text) end as content_md5 from d""",
    "sniff_type": DOCS
    + "select doc_id, case doc_id % 3 when 0 then 'xlsx' when 1 then 'xls' else sniffed end as file_type from d",
}

"""Queries on text, dates, casts and row helpers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosecast.functions import rows, text
from dosecast.plans.curate import curate_rules
from dosecast.queries.fixtures import cte, frame
from dosecast.schemas import RULE_LABELS


def texts(spark, sf):
    return frame(spark, sf, "texts")


def rules(spark, sf):
    return frame(spark, sf, "rules")


def parse_cycle_day(spark, sf):
    label = F.col("raw_visit")
    return texts(spark, sf).select(
        "id", text.parse_cycle_number(label).alias("cycle"), text.parse_cycle_day(label).alias("day")
    )


def parse_int_list(spark, sf):
    numbers = text.parse_int_list(F.col("raw_days"))
    return texts(spark, sf).select(
        "id", F.array_join(numbers.cast("array<string>"), "|").alias("days"), F.size(numbers).alias("n")
    )


def extract_code(spark, sf):
    return texts(spark, sf).select("id", text.extract_code(F.col("raw_file")).alias("code"))


def strip_prefix(spark, sf):
    return texts(spark, sf).select("id", text.strip_prefix(F.col("raw_file"), "Sponsor").alias("rest"))


def normalise_text(spark, sf):
    return texts(spark, sf).select("id", text.normalise_text(F.col("raw_text")).alias("clean"))


def trim_strings(spark, sf):
    return rows.strip_strings(texts(spark, sf).select("id", "raw_text", "raw_number"))


def extract_year(spark, sf):
    return texts(spark, sf).select("id", text.extract_year(F.col("raw_year")).alias("year"))


def multi_format_dates(spark, sf):
    return texts(spark, sf).select("id", text.first_date(F.col("raw_date")).alias("day"))


def coerce_dates(spark, sf):
    return rows.coerce_dates(
        texts(spark, sf).select("id", "raw_date", F.col("raw_number").alias("Date of number"))
    )


def safe_cast(spark, sf):
    return texts(spark, sf).select("id", text.safe_cast(F.col("raw_number"), "bigint").alias("number"))


TARGET = T.StructType(
    [
        T.StructField("raw_number", T.LongType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("absent", T.DateType()),
        T.StructField("raw_year", T.IntegerType()),
    ]
)


def schema_cast(spark, sf):
    return rows.fit_schema(texts(spark, sf), TARGET)


def cast_failures(spark, sf):
    return rows.cast_failures(texts(spark, sf), TARGET)


def parse_rate(spark, sf):
    return rows.parse_rate(texts(spark, sf), ["raw_date", "raw_year"])


def dedupe_rows(spark, sf):
    return rows.dedupe(rules(spark, sf).select("study_protocol", "country", "visit_days"))


OPTIONAL = ("tpc", "country", "study_drug_dispensed", "additional_study_drug_dispensed", "visit_days", "max_cycles")


def drop_sparse(spark, sf):
    return rows.drop_sparse(rules(spark, sf).select(*OPTIONAL), 3)


def drop_all_null(spark, sf):
    return rows.drop_all_null(rules(spark, sf).select("tpc", "country", "max_cycles"))


def project_available(spark, sf):
    padded = rules(spark, sf).withColumnsRenamed({"country": " country ", "tpc": "tpc "})
    return rows.project_available(padded, ["country", "missing", "rule_no", "tpc"])


def rename_by_pattern(spark, sf):
    named = rules(spark, sf).select("rule_no", F.col("tpc").alias("Intended TPC choice"), "country")
    return rows.rename_first_like(named, "TPC", "tpc")


SITE_SAMPLE = ["Site ID", "FP Expiry Date", "Quantity Study Drug - Packaged (Unavailable)"]


def rename_reorder(spark, sf):
    labelled = texts(spark, sf).select(
        F.col("id").alias(SITE_SAMPLE[0]),
        F.col("raw_date").alias(SITE_SAMPLE[1]),
        F.col("raw_number").alias(SITE_SAMPLE[2]),
    )
    return rows.rename_labels(labelled, SITE_SAMPLE).select(
        "quantity_study_drug_packaged_unavailable", "site_id", "fp_expiry_date"
    )


def rules_sheet(spark, sf):
    """The rules as a sheet of text with the report labels."""
    r = rules(spark, sf)
    made = {
        "therapeutic_area": F.concat(F.lit(" Area "), (F.col("rule_no") % 9).cast("string")),
        "additional_study_drug_prefix": F.lit(None).cast("string"),
        "max_cycles": F.when(F.col("rule_no") % 3 == 0, F.lit("many")).otherwise(
            F.col("max_cycles").cast("int").cast("string")
        ),
        "visit_days": F.concat(F.lit(" "), "visit_days", F.lit("\t")),
    }
    empty = F.col("rule_no") % 10 == 0
    cells = [
        F.when(~empty, made.get(c, F.col(c).cast("string") if c in r.columns else F.lit(None))).alias(l)
        for l, c, _ in RULE_LABELS
    ]
    return r.select(*cells, F.lit("x").alias("comment"))


def rules_curate(spark, sf):
    return curate_rules(rules_sheet(spark, sf))


QUERIES = {
    "parse_cycle_day": parse_cycle_day,
    "parse_int_list": parse_int_list,
    "extract_code": extract_code,
    "strip_prefix": strip_prefix,
    "normalise_text": normalise_text,
    "trim_strings": trim_strings,
    "extract_year": extract_year,
    "multi_format_dates": multi_format_dates,
    "coerce_dates": coerce_dates,
    "safe_cast": safe_cast,
    "schema_cast": schema_cast,
    "cast_failures": cast_failures,
    "parse_rate": parse_rate,
    "dedupe_rows": dedupe_rows,
    "drop_sparse": drop_sparse,
    "drop_all_null": drop_all_null,
    "project_available": project_available,
    "rename_by_pattern": rename_by_pattern,
    "rename_reorder": rename_reorder,
    "rules_curate": rules_curate,
}

# --- the same in SQL -------------------------------------------------------------------

TEXTS = cte("texts")
RULES = cte("rules")
DATE = "cast(coalesce(try_strptime({0}, '%d-%b-%Y'), try_strptime({0}, '%d %b %Y')) as date)"
NUMBER = "case when regexp_full_match(trim(raw_number), '-?[0-9]+') then cast(trim(raw_number) as bigint) end"
FILLED = " + ".join(f"({c} is not null)::int" for c in OPTIONAL)

ORACLES = {
    "parse_cycle_day": TEXTS
    + r"""select id, coalesce(try_cast(nullif(regexp_extract(raw_visit, '(?i)(?:C|Cycle\s?)(\d+)', 1), '') as int), 0) as cycle,
      coalesce(try_cast(nullif(regexp_extract(raw_visit, '(?i)(?:D|Day\s?)(\d+)', 1), '') as int), 1) as day from texts""",
    "parse_int_list": TEXTS
    + """, n as (select id, coalesce([cast(cast(trim(x) as int) as varchar) for x in string_split(raw_days, ',') if regexp_full_match(trim(x), '[0-9]+')], cast([] as varchar[])) as d from texts)
      select id, array_to_string(d, '|') as days, cast(len(d) as int) as n from n""",
    "extract_code": TEXTS
    + r"select id, nullif(regexp_extract(raw_file, '[A-Z]{2}-[A-Z]{2}-\d+-\d+(?:-\d+_\d+)?', 0), '') as code from texts",
    "strip_prefix": TEXTS + r"select id, regexp_replace(raw_file, '^Sponsor\s+', '') as rest from texts",
    "normalise_text": TEXTS
    + "select id, trim(replace(replace(raw_text, '‘', ''''), '’', '''')) as clean from texts",
    "trim_strings": TEXTS
    + "select id, trim(raw_text) as raw_text, trim(raw_number) as raw_number from texts",
    "extract_year": TEXTS
    + """select id, case when regexp_full_match(raw_year, '[0-9]{4}') then cast(raw_year as int)
      else cast(year(coalesce(try_strptime(raw_year, '%d/%m/%Y'), try_strptime(raw_year, '%d %b %Y'))) as int) end as year from texts""",
    "multi_format_dates": TEXTS + f"select id, {DATE.format('raw_date')} as day from texts",
    "coerce_dates": TEXTS
    + f"select id, {DATE.format('raw_date')} as raw_date, cast(case when regexp_full_match(trim(raw_number), '[0-9]{{4}}') then trim(raw_number) || '-01-01' end as date) as \"Date of number\" from texts",
    "safe_cast": TEXTS + f"select id, {NUMBER} as number from texts",
    "schema_cast": TEXTS
    + f"select {NUMBER} as raw_number, cast(id as int) as id, cast(null as date) as absent, case when regexp_full_match(raw_year, '[0-9]+') then cast(raw_year as int) end as raw_year from texts",
    "cast_failures": TEXTS
    + f"""select 'raw_number' as column_name, count(raw_number) as present, count(*) filter (raw_number is not null and {NUMBER} is null) as failed from texts
      union all select 'id', count(id), 0 from texts
      union all select 'raw_year', count(raw_year), count(*) filter (not regexp_full_match(raw_year, '[0-9]+')) from texts""",
    "parse_rate": TEXTS
    + f"""select 'raw_date' as column_name, count(raw_date) as present, count({DATE.format('raw_date')}) as parsed from texts
      union all select 'raw_year', count(raw_year), count({DATE.format('raw_year')}) from texts""",
    "dedupe_rows": RULES + "select distinct study_protocol, country, visit_days from rules",
    "drop_sparse": RULES + f"select {', '.join(OPTIONAL)} from rules where {FILLED} > 3",
    "drop_all_null": RULES
    + "select tpc, country, max_cycles from rules where coalesce(tpc, country, cast(max_cycles as varchar)) is not null",
    "project_available": RULES + "select country, rule_no, tpc from rules",
    "rename_by_pattern": RULES + "select rule_no, tpc, country from rules",
    "rename_reorder": TEXTS
    + "select raw_number as quantity_study_drug_packaged_unavailable, id as site_id, raw_date as fp_expiry_date from texts",
    "rules_curate": RULES
    + """select concat('Area ', rule_no % 9) as therapeutic_area, study_protocol, randomized_treatment, subject_status, tpc, study_drug_dispensed,
      additional_study_drug_dispensed, cast(null as varchar) as additional_study_drug_prefix, country, visit_days, dispensing_quantity, dispensing_frequency_days,
      case when rule_no % 3 = 0 then null else floor(max_cycles) end as max_cycles from rules where rule_no % 10 <> 0""",
}

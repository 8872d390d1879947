"""Report labels, table schemas and table creation."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from dosecast.functions.rows import column_name

# The labels of each report and the type of the table column they fill.
SUBJECT_LABELS = (
    ("Study Protocol", "string"),
    ("Site ID", "int"),
    ("Country", "string"),
    ("Parent Depot", "int"),
    ("Investigator", "string"),
    ("Subject Number", "bigint"),
    ("Year of Birth", "int"),
    ("Gender", "string"),
    ("TPC", "string"),
    ("Date Randomized", "date"),
    ("Date Treatment Discontinued", "date"),
    ("Date Crossover Enrolled", "date"),
    ("Date Crossover Approved", "date"),
    ("Date Crossover Treatment Discontinued", "date"),
    ("Subject Status", "string"),
    ("Randomized Treatment", "string"),
    ("Last Study Visit Recorded", "string"),
    ("Last Study Visit Date", "date"),
    ("Last Study Visit Number", "string"),
    ("Next Min. Study Visit Date", "date"),
    ("Next Max. Study Visit Date", "date"),
    ("Additional Drug Status", "string"),
    ("Last Additional Drug Visit Recorded", "string"),
    ("Last Additional Drug Visit Date", "date"),
    ("Last Additional Drug Visit Number", "int"),
    ("Next Min. Additional Drug Visit Date", "date"),
    ("Next Max. Additional Drug Visit Date", "date"),
)
DEPOT_LABELS = (
    ("Study Protocol", "string"),
    ("Depot ID", "int"),
    ("Country", "string"),
    ("Depot Type", "string"),
    ("Study Drug Type", "string"),
    ("Unblinded Study Drug Name", "string"),
    ("Britestock Lot Number", "string"),
    ("Finished Lot Number", "string"),
    ("Part Number", "string"),
    ("FP Expiry Date", "date"),
    ("Quantity Study Drug - Requested", "bigint"),
    ("Quantity Study Drug - Available", "bigint"),
    ("Quantity Study Drug - Lost", "bigint"),
    ("Quantity Study Drug - Damaged", "bigint"),
    ("Quantity Study Drug - Quarantined", "bigint"),
    ("Quantity Study Drug - Rejected", "bigint"),
    ("Quantity Study Drug - Do Not Ship", "bigint"),
    ("Quantity Study Drug - Expired", "bigint"),
    ("Quantity Study Drug - Packaged (Unavailable)", "bigint"),
    ("Quantity Study Drug - Total", "bigint"),
    ("Approved Countries", "string"),
)
SITE_LABELS = (
    ("Study Protocol", "string"),
    ("Site ID", "int"),
    ("Country", "string"),
    ("Investigator", "string"),
    ("Location", "string"),
    ("Parent Depot", "int"),
    ("Site Status", "string"),
    ("Study Drug Type", "string"),
    ("Unblinded Study Drug Name", "string"),
    ("Britestock Lot Number", "string"),
    ("Finished Lot Number", "string"),
    ("Part Number", "string"),
    ("FP Expiry Date", "date"),
    ("Quantity Study Drug - Requested", "bigint"),
    ("Quantity Study Drug - Available", "bigint"),
    ("Quantity Study Drug - Assigned", "bigint"),
    ("Quantity Study Drug - Lost", "bigint"),
    ("Quantity Study Drug - Damaged", "bigint"),
    ("Quantity Study Drug - Quarantined", "bigint"),
    ("Quantity Study Drug - Rejected", "bigint"),
    ("Quantity Study Drug - Do Not Dispense", "bigint"),
    ("Quantity Study Drug - Expired", "bigint"),
    ("Quantity Study Drug - Total", "bigint"),
)
SITE_SUPPLY_LABELS = (
    ("Study Protocol", "string"),
    ("Country", "string"),
    ("Site ID", "string"),
    ("Comparator Name", "string"),
    ("Site Level Supply Method", "string"),
    ("Site Status", "string"),
)
COUNTRY_SUPPLY_LABELS = (
    ("Study Protocol", "string"),
    ("Country", "string"),
    ("Comparator Name", "string"),
    ("Country Level Supply Method", "string"),
)
# The label of the "tpc" column of the rules sheet spans four lines.
RULE_TPC_LABEL = (
    "TPC\nTreatment of Physician's Choice\nTopotecan OR Amrubicin Choice Of Drug\nIntended TPC"
)
RULE_LABELS = (
    ("Therapeutic Area", "therapeutic_area", "string"),
    ("Study Protocol", "study_protocol", "string"),
    ("Randomized Treatment", "randomized_treatment", "string"),
    ("Subject Status", "subject_status", "string"),
    (RULE_TPC_LABEL, "tpc", "string"),
    ("Study Drug Dispensed", "study_drug_dispensed", "string"),
    ("Additional Study Drug Dispensed", "additional_study_drug_dispensed", "string"),
    ("Additional Study Drug Prefix", "additional_study_drug_prefix", "string"),
    ("Country", "country", "string"),
    ("Visit Days", "visit_days", "string"),
    ("Dispensing Quantity", "dispensing_quantity", "bigint"),
    ("Dispensing Frequency (Days)", "dispensing_frequency_days", "bigint"),
    ("Max Cycles", "max_cycles", "double"),
)
STUDY_LIST_LABELS = (
    ("S. No", "s_no"),
    ("Study Name", "study_name"),
    ("UI Mode", "ui_mode"),
    ("Report Name", "report_name"),
    ("SubReport Name", "subreport_name"),
)
# File type -> (labels, table).
REPORTS = {
    "subject": (SUBJECT_LABELS, "clinical_subject_summary"),
    "depot": (DEPOT_LABELS, "clinical_depot_inventory"),
    "site": (SITE_LABELS, "clinical_site_inventory"),
    "slsm": (SITE_SUPPLY_LABELS, "clinical_supply_method_site_level"),
    "clsm": (COUNTRY_SUPPLY_LABELS, "clinical_supply_method_country_level"),
}
LINEAGE = (
    ("extract_date", "date"),
    ("source_file", "string"),
    ("processed_timestamp", "timestamp"),
)
PLAN_COLUMNS = (
    ("study_name", "string"),
    ("parent_depot", "int"),
    ("site_id", "int"),
    ("subject_number", "bigint"),
    ("subject_status", "string"),
    ("subject_country", "string"),
    ("randomized_treatment", "string"),
    ("tpc", "string"),
    ("drug_dispensed", "string"),
    ("dispensing_quantity", "int"),
    ("predicted_study_visit", "string"),
    ("cycle", "int"),
    ("day", "int"),
    ("predicted_next_visit_date", "date"),
    ("extract_date", "date"),
    ("processed_timestamp", "timestamp"),
)
STATUS_COLUMNS = (
    ("s_no", "int"),
    ("study_name", "string"),
    ("ui_mode", "string"),
    ("report_name", "string"),
    ("subreport_name", "string"),
    ("file_name", "string"),
    ("target_table", "string"),
    ("study_protocol", "string"),
    ("load_successful", "boolean"),
    ("extract_date", "date"),
)
STATUS_TABLE = "clinical_studylist_status"
RULES_TABLE = "clinical_treatment_groups"
PLAN_TABLE = "clinical_demand_plan"


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[t]) for name, t in columns])


def report_labels(file_type: str) -> list[str]:
    return [label for label, _ in REPORTS[file_type][0]]


def report_schema(file_type: str) -> T.StructType:
    """Schema of the table that one file type fills, lineage columns included."""
    columns = [(column_name(l), t) for l, t in REPORTS[file_type][0]]
    return _schema([*columns, *LINEAGE])


def report_date_columns(file_type: str) -> list[str]:
    return [column_name(l) for l, t in REPORTS[file_type][0] if t == "date"]


RULES_SCHEMA = _schema([(c, t) for _, c, t in RULE_LABELS])
PLAN_SCHEMA = _schema(PLAN_COLUMNS)
STATUS_SCHEMA = _schema(STATUS_COLUMNS)


def table_schemas() -> dict[str, tuple[T.StructType, str | None]]:
    """Table name -> (schema, partition column) of the eight tables."""
    curated = {table: (report_schema(ft), "extract_date") for ft, (_, table) in REPORTS.items()}
    return {
        **curated,
        RULES_TABLE: (RULES_SCHEMA, None),
        PLAN_TABLE: (PLAN_SCHEMA, "study_name"),
        STATUS_TABLE: (STATUS_SCHEMA, "extract_date"),
    }


def create_tables(spark: SparkSession, database: str, recreate: bool = False) -> None:
    """Create the database and its tables; ``recreate`` drops each table first."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, partition) in table_schemas().items():
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = f" PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{layout}")

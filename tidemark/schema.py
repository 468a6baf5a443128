"""Star-schema contracts: table keys, allowed values and seed rows.

Keys are natural keys (no surrogate ids); a nullable key column is made
NULL-safe by coalescing it to a blank value (``''``, or ``'0'`` for years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Natural keys of the published tables (column, blank used when NULL).
KEYS: dict[str, tuple[tuple[str, str | None], ...]] = {
    "fact_exchange_rate": (("rate_date", None), ("series_id", None)),
    "fact_student_enrolment": tuple(
        (c, None)
        for c in ("enrol_year", "enrol_month", "nationality", "state_code", "sector")
    ),
    "fact_job_vacancy": (("vacancy_period", None), ("anzsco_code", ""), ("state_code", None), ("measure", None)),
    "fact_occupation_shortage": (
        ("anzsco_code", None), ("anzsco_level", None), ("state_code", None), ("assessment_year", "0"),
    ),
    "ref_occupation_profile": (
        ("anzsco_code", None), ("profile_measure", None), ("dimension", None), ("profile_year", "0"),
    ),
    "ref_skilled_migration_by_cob_occupation": (
        ("financial_year", None), ("country_name", ""), ("anzsco_code", ""), ("visa_subclass", ""), ("measure", None),
    ),
    "fact_population_by_cob": (("erp_period", None), ("country_name", None), ("state_code", None)),
    "fact_overseas_migration": (
        ("nom_period", None), ("country_name", None), ("state_code", None), ("direction", None),
    ),
    "dim_provider": (("provider_id", None),),
    "dim_course": (("cricos_code", None),),
    "dim_provider_location": (("location_id", None),),
    "bridge_course_location": (("cricos_code", None), ("location_id", None)),
}

# Allowed values of the load-audit status column.
AUDIT_STATUSES = ("running", "completed", "failed", "partial")

# Fixed seed rows: Australian states and territories (code, name, is_territory).
STATE_SEEDS = (
    ("NSW", "New South Wales", 0),
    ("VIC", "Victoria", 0),
    ("QLD", "Queensland", 0),
    ("SA", "South Australia", 0),
    ("WA", "Western Australia", 0),
    ("TAS", "Tasmania", 0),
    ("ACT", "Australian Capital Territory", 1),
    ("NT", "Northern Territory", 1),
    ("AUS", "Australia (National)", 0),
)

# Fixed seed rows: visa subclasses (code, name, category, is_temporary, is_permanent).
VISA_SUBCLASS_SEEDS = (
    ("500", "Student Visa", "Student", 1, 0),
    ("485", "Temporary Graduate Visa", "Graduate", 1, 0),
    ("482", "Temporary Skill Shortage Visa", "Skilled", 1, 0),
    ("186", "Employer Nomination Scheme", "Skilled", 0, 1),
    ("189", "Skilled Independent Visa", "Skilled", 0, 1),
    ("190", "Skilled Nominated Visa", "Skilled", 0, 1),
    ("491", "Skilled Work Regional (Provisional)", "Skilled", 1, 0),
    ("494", "Skilled Employer Sponsored Regional", "Skilled", 1, 0),
    ("407", "Training Visa", "Training", 1, 0),
    ("408", "Temporary Activity Visa", "Temporary", 1, 0),
    ("600", "Visitor Visa", "Visitor", 1, 0),
)


def key_columns(table: str) -> list[str]:
    return [c for c, _ in KEYS[table]]


def state_seed_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATE_SEEDS), "state_code STRING, state_name STRING, is_territory INT")


def visa_seed_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(VISA_SUBCLASS_SEEDS),
        "subclass_code STRING, visa_name STRING, visa_category STRING, is_temporary INT, is_permanent INT",
    )


def insert_ignore(existing: DataFrame, seeds: DataFrame, key: list[str]) -> DataFrame:
    """Seed rows whose key is not present yet, appended to the existing rows."""
    new = seeds.join(existing.select(*key), key, "left_anti")
    return existing.unionByName(new)

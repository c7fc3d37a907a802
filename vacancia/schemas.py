"""Table schemas and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

LANDING = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("ordinal", T.LongType()),
    ]
)

# The landing table as stored: one directory per provider.
STORED_LANDING = T.StructType([*LANDING.fields, T.StructField("provider", T.StringType())])

ENRICHMENT = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("inferred_seniority", T.StringType()),
        T.StructField("role_archetype", T.StringType()),
        T.StructField("work_focus", T.StringType()),
        T.StructField("tech_stack_required", T.ArrayType(T.StringType())),
        T.StructField("tech_stack_preferred", T.ArrayType(T.StringType())),
        T.StructField("paradigms_required", T.ArrayType(T.StringType())),
        T.StructField("paradigms_preferred", T.ArrayType(T.StringType())),
        T.StructField("degree_requirement", T.StringType()),
        T.StructField("years_required_min", T.IntegerType()),
        T.StructField("years_required_max", T.IntegerType()),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("acknowledges_ai", T.BooleanType()),
        T.StructField("domain", T.StringType()),
        T.StructField("explicitly_encourages_applicants", T.BooleanType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("enriched_at", T.TimestampType()),
        T.StructField("model_version", T.StringType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("jsearch_rows", T.IntegerType()),
        T.StructField("theirstack_rows", T.IntegerType()),
        T.StructField("builtin_rows", T.IntegerType()),
        T.StructField("total_rows", T.IntegerType()),
    ]
)

USAGE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("credits_remaining", T.IntegerType()),
        T.StructField("credits_limit", T.IntegerType()),
        T.StructField("credits_used_cumulative", T.IntegerType()),
        T.StructField("credits_used_this_run", T.IntegerType()),
        T.StructField("reset_date", T.StringType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("run_date", T.DateType()),
        T.StructField("path", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

STAGING_COLUMNS = [
    "job_id", "source", "ingestion_query", "job_title", "company_name", "job_url",
    "date_posted", "description", "city", "state", "country", "latitude", "longitude",
    "work_model", "employment_type", "salary_min", "salary_max", "listed_seniority",
    "ingested_at",
]

MART_COLUMNS = [
    "job_id", "source", "ingestion_query", "job_title", "company_name", "job_url",
    "date_posted", "description", "city", "state", "country", "latitude", "longitude",
    "work_model", "employment_type", "listed_seniority", "early_career_tier",
    "title_role_bucket", "final_salary_min", "final_salary_max", "inferred_seniority",
    "role_archetype", "work_focus", "acknowledges_ai", "domain",
    "explicitly_encourages_applicants", "tech_stack_required", "tech_stack_preferred",
    "paradigms_required", "paradigms_preferred", "degree_requirement",
    "years_required_min", "years_required_max", "confidence_score", "enriched_at",
    "ingested_at",
]

ARRAY_COLUMNS = [
    "tech_stack_required", "tech_stack_preferred", "paradigms_required", "paradigms_preferred",
]

# Vocabularies that results must share with the data they describe.
PROVIDERS = ["jsearch", "theirstack", "builtin"]
PROVIDER_RANK = {"builtin": 1, "theirstack": 2, "jsearch": 3}
WORK_MODELS = ["remote", "hybrid", "onsite"]
EMPLOYMENT_TYPES = ["full_time", "part_time", "contract", "other"]
ROLES = ["Data Analyst", "Data Engineer", "Analytics Engineer", "Data Scientist"]
NO_ROLE = "no_match"
TIERS = ["entry_or_junior", "mid"]
SENIORITIES = ["entry", "junior", "mid", "senior"]
ARCHETYPES = [
    "data_analyst", "analytics_engineer", "data_engineer", "data_scientist", "hybrid",
    "software_engineer",
]
CHART_ARCHETYPES = ["data_analyst", "analytics_engineer", "data_engineer", "data_scientist", "hybrid"]
DEGREES = ["none", "bachelors", "masters", "equivalent_ok"]
SENIORITY_AXIS = ["Entry", "Junior", "Mid", "Senior"]
SENIORITY_NAMES = {
    "entry_level": "Entry", "entry": "Entry", "junior": "Junior",
    "mid_level": "Mid", "mid": "Mid", "senior": "Senior",
}
SENIORITY_NAMES_TWO_LEVEL = {"entry_level": "entry", "junior": "entry", "mid_level": "mid"}
QUERY_ARCHETYPE = {
    "Data Analyst": "data_analyst",
    "Analytics Engineer": "analytics_engineer",
    "Data Engineer": "data_engineer",
}
MODERN_SKILLS = ["dbt", "snowflake", "airflow", "spark", "kafka", "databricks"]
TRADITIONAL_SKILLS = ["excel", "tableau", "power bi", "sql server", "access", "sas", "stata"]
LISTED_SENIORITY_LABELS = ["Entry level", "Junior", "Mid level"]

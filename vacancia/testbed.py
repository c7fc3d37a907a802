"""Postings, labels and logs derived from the generic test tables.

Every field is arithmetic on the document or event id, so the same tables can be derived
in plain SQL for comparison. Rows grow with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .operators.usage import run_status
from .plans.mart import build_mart

TITLES = [
    "Data Analyst", "Data Analyst II", "Senior Data Engineer", "Data Engineer", "Analytics Engineer",
    "Lead Analyst", "Data Scientist", "Data Science Platform Engineer", "Data Quality Analyst",
    "Remote Data Engineer", "Hybrid Data Analyst", "Operations Associate",
]
TAGS = ["Data Analyst", "Analytics Engineer", "Data Engineer", "Data Scientist"]
LISTED = ["Entry level", "Junior", "Mid level", "not_found"]
ARCHETYPES = [
    "data_analyst", "data_engineer", "analytics_engineer", "data_scientist", "hybrid", "software_engineer",
]
TOOLS = ["sql", "python", "dbt", "excel", "spark", "tableau", "airflow", "sas"]
PARADIGMS = ["elt", "dimensional modeling", "experimentation", "forecasting", "agile"]
DOMAINS = ["finance", "healthcare", "retail", "media", "education", "energy"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: str) -> str:
    """SQL text: the element of a fixed list at a computed index, NULL past its end."""
    return "get(array(" + ", ".join(f"'{v}'" for v in values) + f"), int({index}))"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per landing of a posting, before it becomes a provider payload."""
    docs = table(spark, sf_dir, "documents")
    low = "double(60000 + (d % 50) * 1000)"
    scale = "if(d % 3 = 2 AND d % 13 = 0, 1000D, 1D)"
    return (
        docs.selectExpr("doc_id AS d", "text")
        .selectExpr("*", "explode(if(d % 5 = 0, array(0, 1), array(0))) AS landing")
        .selectExpr(
            "*",
            f"{pick(schemas.PROVIDERS, 'd % 3')} AS provider",
            "string(d) AS id",
            f"{pick(TITLES, '(d div 3 * 7) % 12')} AS title",
            "if(d % 41 != 0, concat('Company ', string(d % 37), '-', string(d div 900)), NULL) AS company",
            "date_add(DATE '2026-05-01', int(d % 90)) AS posted",
            f"if(d % 3 = 1 AND d % 2 = 0, NULL, {low} / {scale}) AS low",
            f"if(d % 3 = 1 AND d % 2 = 0, NULL, ({low} + 20000) / {scale}) AS high",
            f"{pick(LISTED, 'd % 4')} AS seniority",
            f"CASE WHEN landing = 1 THEN 'Data Engineer' WHEN d % 29 != 0 THEN {pick(TAGS, 'd % 4')} END AS label",
            "TIMESTAMP '2026-08-01 00:00:00' + make_dt_interval(int(d % 28) + landing * 3) AS ingested_at",
            "d * 2 + landing AS ordinal",
        )
    )


LATITUDE = "if(d % 6 != 0, double(40 + (d % 10) * 0.125), NULL)"
LONGITUDE = "if(d % 6 != 0, double(-74 + (d % 8) * 0.125), NULL)"
PAYLOADS = {
    "jsearch": f"""named_struct(
        'job_id', id, 'job_title', title, 'employer_name', company,
        'job_apply_link', concat('https://jobs.example/', id),
        'job_posted_at_datetime_utc', concat(string(posted), 'T00:00:00.000Z'), 'job_description', text,
        'job_city', 'New York', 'job_state', 'NY', 'job_country', 'US',
        'job_latitude', {LATITUDE}, 'job_longitude', {LONGITUDE}, 'job_is_remote', d % 7 = 3,
        'job_employment_type', {pick(["Full-time", "PARTTIME", "Contractor", "Intern"], "d % 4")},
        'job_min_salary', low, 'job_max_salary', high, 'job_salary_period', if(d % 11 = 0, 'HOUR', 'YEAR'))""",
    "theirstack": f"""named_struct(
        'id', d, 'job_title', title, 'company', company, 'url', concat('https://jobs.example/', id),
        'date_posted', string(posted), 'description', text, 'short_location', 'New York, NY',
        'state_code', 'NY', 'country_code', 'US', 'latitude', {LATITUDE}, 'longitude', {LONGITUDE},
        'remote', d % 6 = 1, 'hybrid', d % 5 = 2,
        'employment_statuses', array({pick(["full_time", "part_time", "contract", "temporary"], "d % 4")}),
        'min_annual_salary_usd', low, 'max_annual_salary_usd', high, 'seniority', seniority,
        'discovered_at', concat(string(date_add(posted, 1)), 'T06:00:00Z'))""",
    "builtin": f"""named_struct(
        'identifier', named_struct('value', id), 'title', title, 'hiringOrganization', named_struct('name', company),
        'source_url', concat('https://jobs.example/', id), 'datePosted', string(posted),
        'description', concat('<p>', text, '&amp;nbsp;</p>'),
        'jobLocation', named_struct(
            'address', named_struct('addressLocality', 'New York', 'addressRegion', 'NY', 'addressCountry', 'US'),
            'geo', named_struct('latitude', {LATITUDE}, 'longitude', {LONGITUDE})),
        'jobLocationType', if(d % 8 = 2, 'TELECOMMUTE', NULL),
        'employmentType', {pick(["FULL_TIME", "PART_TIME", "CONTRACTOR"], "d % 4")},
        'baseSalary', named_struct('value', named_struct('minValue', low, 'maxValue', high, 'unitText', if(d % 17 = 3, 'HOUR', 'YEAR'))),
        'seniority', seniority)""",
}


def landing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landing rows per provider."""
    rows = facts(spark, sf_dir)
    return {
        name: rows.where(f"provider = '{name}'").selectExpr(
            "concat_ws(':', provider, label) AS source", f"to_json({payload}) AS raw_payload", "ingested_at", "ordinal"
        )
        for name, payload in PAYLOADS.items()
    }


PLACES = [
    "New York, NY", "New York City Metropolitan Area", "Brooklyn, NY", "Jersey City, NJ", "Manhattan Beach, CA",
    "West New York, NJ", "Buffalo, New York", "MANHATTAN, NY", "Toronto, ON",
]
SEARCH_TITLES = [*TITLES, "Data Analyst (unpaid)", "Volunteer Data Engineer", "Data Engineer III", "Sr Data Engineer", "Data Engineer, Srini Labs"]
PUBLISHERS = [
    "LinkedIn", "Jooble", "Indeed", "Talent.com", "talent.com", "Sign In", "Trigyn", "Trigyn Inc", "Glassdoor",
    "Resume-Library.com", "United States Jobs Expertini", "Allied-IT Jobs", "BeBee",
]


def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as a provider's search sees them, with places, countries and publishers of many kinds."""
    return facts(spark, sf_dir).selectExpr(
        "id AS job_id",
        f"{pick(SEARCH_TITLES, 'd % 17')} AS job_title",
        f"{pick(PLACES, '(d div 17) % 10')} AS location",
        f"{pick(['US', 'CA', 'US', 'us', 'US'], 'd % 6')} AS country_code",
        f"{pick(['junior', 'mid_level', 'senior', 'c_level'], '(d div 5) % 5')} AS seniority",
        f"{pick(PUBLISHERS, '(d div 3) % 14')} AS job_publisher",
        f"{pick(['FULLTIME', 'PARTTIME', 'FULLTIME', 'CONTRACTOR', 'INTERN'], 'd % 6')} AS job_employment_type",
        "posted AS date_posted",
        "ingested_at AS discovered_at",
        "ingested_at",
    )


SEARCH_PAYLOAD = f"""named_struct(
    'id', d, 'job_title', {pick(SEARCH_TITLES, 'd % 17')}, 'company', company, 'url', concat('https://jobs.example/', id),
    'date_posted', string(posted), 'description', text, 'short_location', {pick(PLACES, '(d div 17) % 10')},
    'country_code', {pick(['US', 'CA', 'US', 'us', 'US'], 'd % 6')},
    'seniority', {pick(['junior', 'mid_level', 'senior', 'c_level'], '(d div 5) % 5')})"""


def search_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`search_rows` as landed payloads of the second provider, texts included."""
    return facts(spark, sf_dir).selectExpr(
        "concat_ws(':', 'theirstack', label) AS source", f"to_json({SEARCH_PAYLOAD}) AS raw_payload", "ingested_at", "ordinal"
    )


def run_of(values: list[str], start: str, n: int) -> str:
    """SQL text: ``n`` neighbours of a fixed list, wrapping around."""
    return "array(" + ", ".join(pick(values, f"({start} + {i}) % {len(values)}") for i in range(n)) + ")"


def typed(df: DataFrame, columns: dict[str, str], schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` from SQL texts, cast to its types."""
    return df.selectExpr(
        *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    )


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows, some of them labelled twice."""
    rows = table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS d", "quality", "toxic", "explode(if(doc_id % 7 = 0, array(0, 1), array(0))) AS older"
    )
    columns = {
        "job_id": "d",
        "source": pick(schemas.PROVIDERS, "d % 3"),
        "inferred_seniority": pick(schemas.SENIORITIES, "(d * 3) % 4"),
        "role_archetype": f"if(older = 1, 'hybrid', {pick(ARCHETYPES, '(d * 7) % 6')})",
        "work_focus": "concat('focus ', string(d % 5))",
        "tech_stack_required": run_of(TOOLS, "d % 8", 3),
        "tech_stack_preferred": f"if(d % 12 = 0, CAST(array() AS array<string>), {run_of(TOOLS, '(d + 3) % 8', 2)})",
        "paradigms_required": run_of(PARADIGMS, "d % 5", 2),
        "paradigms_preferred": run_of(PARADIGMS, "(d + 2) % 5", 1),
        "degree_requirement": f"if(d % 9 != 0, {pick(schemas.DEGREES, 'd % 4')}, NULL)",
        "years_required_min": "if(d % 6 != 5, d % 5, NULL)",
        "years_required_max": "if(d % 6 != 5, d % 5 + 2, NULL)",
        "salary_min": "if(d % 4 != 0, 70000 + (d % 20) * 500, NULL)",
        "salary_max": "if(d % 4 != 0, 90000 + (d % 20) * 500, NULL)",
        "acknowledges_ai": "if(d % 23 != 0, quality = 1, NULL)",
        "domain": f"if(d % 10 != 0, {pick(DOMAINS, 'd % 6')}, NULL)",
        "explicitly_encourages_applicants": "toxic = 1",
        "confidence_score": "(50 + d % 50) / 100D",
        "enriched_at": "TIMESTAMP '2026-08-20 00:00:00' + make_dt_interval(int(d % 3) - older * 10)",
        "model_version": "'v1'",
    }
    return typed(rows, columns, schemas.ENRICHMENT)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(landing(spark, sf_dir), enrichment(spark, sf_dir))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit log: one row per event, the event type as its source."""
    columns = {
        "run_id": "event_id",
        "run_at": "ts",
        "source": "event_type",
        "credits_remaining": "200 - (event_id div 5) % 190",
        "credits_limit": "if(event_id % 17 != 0, 200, NULL)",
        "credits_used_cumulative": "if(event_id % 13 != 0, (event_id div 5) % 190, NULL)",
        "credits_used_this_run": "if(event_id % 11 != 0, event_id % 7, NULL)",
        "reset_date": "if(event_id % 19 != 0, '2024-02-10T00:00:00', NULL)",
    }
    return typed(table(spark, sf_dir, "events"), columns, schemas.USAGE)


def hourly_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credit log with runs of one hour."""
    return usage(spark, sf_dir).withColumn("run_id", F.date_format("run_at", "yyyy-MM-dd HH"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: one run per hour of events."""
    events = table(spark, sf_dir, "events")
    kinds = {"jsearch_rows": "click", "theirstack_rows": "view", "builtin_rows": "purchase"}
    counted = events.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("run_id")).agg(
        F.min("ts").alias("run_at"),
        F.max(F.col("event_id") % 600).cast("double").alias("duration_seconds"),
        *[F.count_if(F.col("event_type") == kind).cast("int").alias(name) for name, kind in kinds.items()],
        F.count_if(F.col("event_type") == "error").alias("failures"),
    )
    total = (F.col("jsearch_rows") + F.col("theirstack_rows") + F.col("builtin_rows")).cast("int")
    out = counted.withColumn("total_rows", total)
    return out.select(
        "run_id", "run_at", "duration_seconds",
        run_status(F.col("failures"), F.col("total_rows")).alias("status"),
        *kinds, "total_rows",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses for the labelled documents, two attempts each, some of them bad."""
    rows = table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS d", "quality", "toxic", "explode(array(1, 2)) AS attempt"
    )
    answer = f"""named_struct(
        'inferred_seniority', if(attempt = 1 AND d % 10 = 1, 'Senior', {pick(schemas.SENIORITIES, "d % 4")}),
        'role_archetype', {pick(ARCHETYPES, "(d * 7) % 6")},
        'work_focus', if(attempt = 1 AND d % 10 = 2,
            'one two three four five six seven eight nine ten eleven', ' Builds  Reports '),
        'tech_stack_required', array(' SQL', {pick(TOOLS, "d % 8")}),
        'degree_requirement', {pick(schemas.DEGREES, "d % 4")},
        'years_required_min', d % 5,
        'years_required_max', if(attempt = 1 AND d % 10 = 3, d % 5 - 1, d % 5 + 1),
        'acknowledges_ai', quality = 1,
        'domain', if(d % 2 = 0, '', 'Finance '),
        'explicitly_encourages_applicants', toxic = 1,
        'confidence_score', if(d % 10 = 4, 1.5, 0.75))"""
    return rows.selectExpr(
        "string(d) AS job_id",
        "attempt",
        f"if(attempt = 1 AND d % 10 = 5, '{{not json', to_json({answer})) AS response",
    )

"""The frames of whole pages, taken from the page functions themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.posting_sql import ENRICHMENT, MART
from vacancia import testbed
from vacancia.plans import dashboard, findings

TIERED = "title_role_bucket, early_career_tier"


@query(
    "landscape_role_volume",
    MART
    + """SELECT value, n, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank
    FROM (SELECT title_role_bucket AS value, count(*) AS n FROM classified GROUP BY ALL)""",
)
def landscape_role_volume(spark, sf):
    return dashboard.landscape(testbed.mart(spark, sf))["role_volume"]


@query(
    "landscape_salary",
    MART + "SELECT title_role_bucket, median(salary_mid) AS median, count(*) AS n FROM paid GROUP BY ALL",
)
def landscape_salary(spark, sf):
    return dashboard.landscape(testbed.mart(spark, sf))["salary"]


@query(
    "landscape_salary_by_tier",
    MART
    + f"SELECT {TIERED}, median(salary_mid) AS median, count(*) AS n FROM paid WHERE early_career_tier IS NOT NULL GROUP BY ALL",
)
def landscape_salary_by_tier(spark, sf):
    return dashboard.landscape(testbed.mart(spark, sf))["salary_by_tier"]


@query(
    "landscape_years",
    MART
    + f"""SELECT {TIERED}, median(years_required_min) AS median, count(*) AS n FROM classified
    WHERE early_career_tier IS NOT NULL AND years_required_min IS NOT NULL GROUP BY ALL""",
)
def landscape_years(spark, sf):
    return dashboard.landscape(testbed.mart(spark, sf))["years"]


@query(
    "landscape_seniority_grid",
    MART
    + """, roles AS (SELECT DISTINCT title_role_bucket FROM classified WHERE early_career_tier IS NOT NULL),
    grid AS (SELECT title_role_bucket, early_career_tier FROM roles, (SELECT unnest(['entry_or_junior', 'mid']) AS early_career_tier)),
    n AS (SELECT title_role_bucket, early_career_tier, count(*) AS n FROM classified GROUP BY ALL)
    SELECT title_role_bucket, early_career_tier, coalesce(n, 0) AS n,
      round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY title_role_bucket), 6) AS pct
    FROM grid LEFT JOIN n USING (title_role_bucket, early_career_tier)""",
)
def landscape_seniority_grid(spark, sf):
    return dashboard.landscape(testbed.mart(spark, sf))["seniority"].withColumn("pct", F.round("pct", 6))


@query(
    "landscape_ai_rate",
    MART
    + """SELECT title_role_bucket, count(*) FILTER (acknowledges_ai) AS yes, count(*) AS total,
      round(count(*) FILTER (acknowledges_ai)::DOUBLE / count(*), 6) AS rate FROM classified GROUP BY ALL""",
)
def landscape_ai_rate(spark, sf):
    return dashboard.ai_rate(testbed.mart(spark, sf)).withColumn("rate", F.round("rate", 6))


@query(
    "health_confidence",
    MART
    + """SELECT bin, round(bin * 0.05, 6)::DOUBLE AS bin_start, count(*) AS n
    FROM (SELECT least(CAST(floor(confidence_score / 0.05) AS BIGINT), 19) AS bin FROM mart WHERE confidence_score BETWEEN 0 AND 1)
    GROUP BY ALL""",
)
def health_confidence(spark, sf):
    return dashboard.health(testbed.mart(spark, sf))["confidence"].withColumn("bin_start", F.round("bin_start", 6))


@query("health_source_split", MART + "SELECT source, count(*) AS n FROM mart GROUP BY ALL")
def health_source_split(spark, sf):
    return dashboard.health(testbed.mart(spark, sf))["sources"]


def shares(column: str) -> str:
    return (
        "WITH " + ENRICHMENT
        + f"""SELECT {column} AS value, count(*) AS n,
      round_even(100.0 * count(*) / (SELECT count(*) FROM enrichment), 1)::DOUBLE AS pct FROM enrichment GROUP BY ALL"""
    )


def preview(frame: str):
    return lambda spark, sf: findings.label_preview(testbed.enrichment(spark, sf))[frame]


for _column in ("inferred_seniority", "role_archetype", "degree_requirement", "domain"):
    query(f"label_preview_{_column}", shares(_column))(preview(_column))

for _flag in ("acknowledges_ai", "explicitly_encourages_applicants"):
    query(
        f"label_preview_{_flag}",
        "WITH " + ENRICHMENT
        + f"""SELECT count(*) FILTER ({_flag}) AS yes, count(*) AS total,
      count(*) FILTER ({_flag})::DOUBLE / count(*) AS rate FROM enrichment""",
    )(preview(_flag))

query(
    "label_preview_salary",
    "WITH " + ENRICHMENT
    + """SELECT count(model_salary_min) AS count, min(model_salary_min) AS min, max(model_salary_min) AS max,
      median(model_salary_min) AS median FROM enrichment""",
)(preview("salary"))

query(
    "label_preview_paradigms",
    "WITH " + ENRICHMENT
    + """SELECT value, count(*) AS n FROM (
      SELECT unnest(list_concat(paradigms_required, paradigms_preferred)) AS value FROM enrichment)
    GROUP BY ALL ORDER BY n DESC, value LIMIT 15""",
)(preview("paradigms"))

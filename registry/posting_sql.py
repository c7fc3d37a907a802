"""The posting tables of the test bed as plain SQL (no JSON)."""

from vacancia import testbed
from vacancia.functions.rules import SENIOR_TERMS


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


FACTS = f"""
facts AS (
  SELECT d, text, landing,
    ['jsearch', 'theirstack', 'builtin'][d % 3 + 1] AS source,
    CAST(d AS VARCHAR) AS job_id,
    {sql_list(testbed.TITLES)}[(d // 3 * 7) % 12 + 1] AS job_title,
    CASE WHEN d % 41 != 0
      THEN 'Company ' || CAST(d % 37 AS VARCHAR) || '-' || CAST(d // 900 AS VARCHAR) END AS company_name,
    DATE '2026-05-01' + CAST(d % 90 AS INTEGER) AS date_posted,
    CASE WHEN NOT (d % 3 = 1 AND d % 2 = 0) THEN CAST(60000 + (d % 50) * 1000 AS DOUBLE) END AS low,
    CASE WHEN d % 29 != 0 THEN {sql_list(testbed.TAGS)}[d % 4 + 1] END AS tag,
    {sql_list(testbed.LISTED)}[d % 4 + 1] AS seniority,
    CASE WHEN d % 6 != 0 THEN 40.0 + (d % 10) * 0.125 END::DOUBLE AS latitude,
    CASE WHEN d % 6 != 0 THEN -74.0 + (d % 8) * 0.125 END::DOUBLE AS longitude
  FROM (SELECT doc_id AS d, text FROM documents), (SELECT unnest([0, 1]) AS landing)
  WHERE landing = 0 OR d % 5 = 0
)"""

STAGED = FACTS + f""",
extracted AS (
  SELECT d, job_id, source, job_title, company_name, date_posted, seniority, latitude, longitude, landing,
    CASE WHEN landing = 1 THEN 'Data Engineer' ELSE tag END AS ingestion_query,
    'https://jobs.example/' || job_id AS job_url,
    CASE WHEN source = 'builtin' THEN
      trim(regexp_replace(regexp_replace(
        replace(replace(replace(replace('<p>' || text || '&amp;nbsp;</p>',
          '&amp;', '&'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
        '<[^>]+>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))
      ELSE text END AS description,
    'New York' AS city, 'NY' AS state, 'US' AS country,
    CASE source
      WHEN 'jsearch' THEN CASE WHEN job_title LIKE '%Remote%' THEN 'remote'
        WHEN job_title LIKE '%Hybrid%' THEN 'hybrid' WHEN d % 7 = 3 THEN 'remote' ELSE 'onsite' END
      WHEN 'theirstack' THEN CASE WHEN d % 6 = 1 THEN 'remote' WHEN d % 5 = 2 THEN 'hybrid' ELSE 'onsite' END
      ELSE CASE WHEN d % 8 = 2 THEN 'remote' WHEN job_title LIKE '%Remote%' THEN 'remote'
        WHEN job_title LIKE '%Hybrid%' THEN 'hybrid' ELSE 'onsite' END END AS work_model,
    ['full_time', 'part_time', 'contract', 'other'][d % 4 + 1] AS employment_type,
    CASE WHEN source = 'jsearch' AND d % 11 = 0 THEN NULL
      WHEN source = 'builtin' AND (d % 13 = 0 OR d % 17 = 3) THEN NULL ELSE low END AS salary_min,
    CASE WHEN source = 'jsearch' AND d % 11 = 0 THEN NULL
      WHEN source = 'builtin' AND (d % 13 = 0 OR d % 17 = 3) THEN NULL ELSE low + 20000 END AS salary_max,
    CASE WHEN source = 'jsearch' OR (source = 'builtin' AND seniority = 'not_found') THEN NULL
      ELSE replace(lower(seniority), ' ', '_') END AS listed_seniority,
    TIMESTAMP '2026-08-01' + to_days(CAST(d % 28 + landing * 3 AS INTEGER)) AS ingested_at
  FROM facts
),
newest AS (
  SELECT * FROM extracted
  QUALIFY row_number() OVER (PARTITION BY source, job_id
    ORDER BY ingested_at DESC NULLS FIRST, ingestion_query DESC NULLS FIRST) = 1
),
staged AS (
  SELECT * FROM newest
  WHERE job_title IS NOT NULL AND description IS NOT NULL
    AND NOT regexp_matches(lower(job_title), '({"|".join(SENIOR_TERMS)})')
)"""


def run_of(values: list[str], start: str, n: int) -> str:
    items = sql_list(values)
    return "[" + ", ".join(f"{items}[({start} + {i}) % {len(values)} + 1]" for i in range(n)) + "]"


ENRICHMENT = f"""
enrichment AS (
  SELECT CAST(doc_id AS VARCHAR) AS job_id,
    ['jsearch', 'theirstack', 'builtin'][doc_id % 3 + 1] AS source,
    ['entry', 'junior', 'mid', 'senior'][(doc_id * 3) % 4 + 1] AS inferred_seniority,
    CASE WHEN older = 1 THEN 'hybrid' ELSE {sql_list(testbed.ARCHETYPES)}[(doc_id * 7) % 6 + 1] END AS role_archetype,
    'focus ' || CAST(doc_id % 5 AS VARCHAR) AS work_focus,
    {run_of(testbed.TOOLS, "doc_id % 8", 3)} AS tech_stack_required,
    CASE WHEN doc_id % 12 = 0 THEN CAST([] AS VARCHAR[]) ELSE {run_of(testbed.TOOLS, "(doc_id + 3) % 8", 2)} END
      AS tech_stack_preferred,
    {run_of(testbed.PARADIGMS, "doc_id % 5", 2)} AS paradigms_required,
    {run_of(testbed.PARADIGMS, "(doc_id + 2) % 5", 1)} AS paradigms_preferred,
    CASE WHEN doc_id % 9 != 0 THEN ['none', 'bachelors', 'masters', 'equivalent_ok'][doc_id % 4 + 1] END
      AS degree_requirement,
    CAST(CASE WHEN doc_id % 6 != 5 THEN doc_id % 5 END AS INTEGER) AS years_required_min,
    CAST(CASE WHEN doc_id % 6 != 5 THEN doc_id % 5 + 2 END AS INTEGER) AS years_required_max,
    CAST(CASE WHEN doc_id % 4 != 0 THEN 70000 + (doc_id % 20) * 500 END AS DOUBLE) AS model_salary_min,
    CAST(CASE WHEN doc_id % 4 != 0 THEN 90000 + (doc_id % 20) * 500 END AS DOUBLE) AS model_salary_max,
    CASE WHEN doc_id % 23 != 0 THEN quality = 1 END AS acknowledges_ai,
    CASE WHEN doc_id % 10 != 0 THEN {sql_list(testbed.DOMAINS)}[doc_id % 6 + 1] END AS domain,
    toxic = 1 AS explicitly_encourages_applicants,
    CAST((50 + doc_id % 50) / 100.0 AS DOUBLE) AS confidence_score,
    TIMESTAMP '2026-08-20' + to_days(CAST(doc_id % 3 - older * 10 AS INTEGER)) AS enriched_at
  FROM labels, (SELECT unnest([0, 1]) AS older)
  WHERE older = 0 OR doc_id % 7 = 0
)"""

MART = (
    "WITH " + STAGED + "," + ENRICHMENT + """,
best AS (
  SELECT * FROM staged
  QUALIFY row_number() OVER (
    PARTITION BY lower(trim(job_title)) || ' | ' || lower(trim(company_name))
    ORDER BY CASE source WHEN 'builtin' THEN 1 WHEN 'theirstack' THEN 2 WHEN 'jsearch' THEN 3 END NULLS LAST,
      ingested_at DESC NULLS FIRST, job_id ASC NULLS LAST) = 1
),
newest_labels AS (
  SELECT * FROM enrichment
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY enriched_at DESC NULLS FIRST) = 1
),
mart AS (
  SELECT b.job_id, b.source, b.ingestion_query, b.job_title, b.company_name, b.job_url, b.date_posted,
    b.description, b.city, b.state, b.country, b.latitude, b.longitude, b.work_model, b.employment_type,
    b.listed_seniority,
    CASE WHEN b.source IN ('builtin', 'theirstack') AND b.listed_seniority IN ('entry_level', 'junior')
           THEN 'entry_or_junior'
         WHEN b.source IN ('builtin', 'theirstack') AND b.listed_seniority = 'mid_level' THEN 'mid' END
      AS early_career_tier,
    CASE WHEN b.job_title ILIKE '%analytics engineer%' THEN 'Analytics Engineer'
         WHEN b.job_title ILIKE '%data scientist%' OR b.job_title ILIKE '%data science%engineer%'
           THEN 'Data Scientist'
         WHEN b.job_title ILIKE '%data%engineer%' THEN 'Data Engineer'
         WHEN b.job_title ILIKE '%data%analyst%' OR b.job_title ILIKE '%data analytics%' THEN 'Data Analyst'
         ELSE 'no_match' END AS title_role_bucket,
    coalesce(b.salary_min, e.model_salary_min) AS final_salary_min,
    coalesce(b.salary_max, e.model_salary_max) AS final_salary_max,
    e.inferred_seniority, e.role_archetype, e.work_focus, e.acknowledges_ai, e.domain,
    e.explicitly_encourages_applicants, e.tech_stack_required, e.tech_stack_preferred,
    e.paradigms_required, e.paradigms_preferred, e.degree_requirement, e.years_required_min,
    e.years_required_max, e.confidence_score, e.enriched_at, b.ingested_at
  FROM best b LEFT JOIN newest_labels e USING (job_id)
  WHERE e.role_archetype != 'software_engineer' OR e.role_archetype IS NULL
),
classified AS (SELECT * FROM mart WHERE title_role_bucket != 'no_match'),
paid AS (
  SELECT *, (final_salary_min + final_salary_max) / 2 AS salary_mid FROM classified
  WHERE final_salary_min IS NOT NULL AND final_salary_max IS NOT NULL
)
"""
)

"""Queries that write tables to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.log_queries import USAGE
from registry.posting_queries import flat
from registry.posting_sql import ENRICHMENT, FACTS, MART
from vacancia import schemas, testbed
from vacancia.operators import metrics, profiling
from vacancia.operators.filters import ExplorerSpec
from vacancia.plans import explorer, findings
from vacancia.session import workspace
from vacancia.sources import landing as land
from vacancia.sources import snapshots, tables, text_index
from vacancia.testbed import table

# -- landing -----------------------------------------------------------------------------


def all_landing(spark, sf):
    frames = list(testbed.landing(spark, sf).values())
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "landing_counts",
    "WITH " + FACTS + "SELECT source AS provider, count(*) AS n FROM facts GROUP BY ALL",
)
def landing_counts(spark, sf):
    return land.land(all_landing(spark, sf), workspace(spark))


@query(
    "landing_stored",
    "WITH " + FACTS
    + """SELECT source AS provider, concat_ws(':', source, CASE WHEN landing = 1 THEN 'Data Engineer' ELSE tag END) AS source,
      d * 2 + landing AS ordinal, job_id, TIMESTAMP '2026-08-01' + to_days(CAST(d % 28 + landing * 3 AS INTEGER)) AS ingested_at
    FROM facts""",
)
def landing_stored(spark, sf):
    path = workspace(spark)
    land.land(all_landing(spark, sf), path)
    rows = land.with_payload(land.read_landing(spark, path))
    ids = [land.text_field(p) for p in ("$.job_id", "$.id", "$.identifier.value")]
    return rows.select("provider", "source", "ordinal", F.coalesce(*ids).alias("job_id"), "ingested_at")


@query(
    "landing_one_provider",
    "WITH " + FACTS + "SELECT job_id, count(*) AS landings FROM facts WHERE source = 'theirstack' GROUP BY job_id",
)
def landing_one_provider(spark, sf):
    path = workspace(spark)
    land.land(all_landing(spark, sf), path)
    rows = land.with_payload(land.read_landing(spark, path, "theirstack"))
    return rows.groupBy(land.text_field("$.id").alias("job_id")).agg(F.count("*").alias("landings"))


@query(
    "landing_documents",
    "SELECT CAST(doc_id AS BIGINT) AS id, lang, md5(text) AS text_md5 FROM documents",
)
def landing_documents(spark, sf):
    """Cached responses: records inside an envelope of a JSON file."""
    path = workspace(spark)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "text")
    envelope = docs.select(F.struct(F.array(F.struct("id", "lang", "text")).alias("jobs")).alias("data"))
    envelope.write.json(path)
    read = land.read_documents(spark, path, ("data", "jobs"), "data struct<jobs: array<struct<id: bigint, lang: string, text: string>>>")
    return read.select("id", "lang", F.md5("text").alias("text_md5"))


@query(
    "explorer_indexed_search",
    MART
    + """SELECT job_id, source, job_title, company_name, date_posted FROM mart
    WHERE regexp_matches(lower(job_title), 'data sci.*platform|lead an') OR regexp_matches(lower(company_name), 'data sci.*platform|lead an')""",
)
def explorer_indexed_search(spark, sf):
    """The explorer's regex search over stored files that hold ranges of titles."""
    path, index, columns = workspace(spark), workspace(spark), ["job_title", "company_name"]
    tables.write_mart(testbed.mart(spark, sf).repartitionByRange(8, "job_title"), path)
    text_index.index_files(spark.read.parquet(path), columns, index)
    spec = ExplorerSpec(search=(columns, "data sci.*platform|lead an"))
    return explorer.explore_stored(spark, path, index, spec).select(
        "job_id", "source", "job_title", "company_name", "date_posted"
    )


# -- mart, labels, logs ------------------------------------------------------------------


def loaded_sql(numbers_as_text=False):
    """Every column as a loaded mart has it: no NULL lists or flags, numbers as doubles."""
    def cell(c):
        if c in schemas.ARRAY_COLUMNS:
            return f"array_to_string(coalesce({c}, []), ',') AS {c}"
        if c in ("acknowledges_ai", "explicitly_encourages_applicants"):
            return f"coalesce({c}, false) AS {c}"
        if c in ("latitude", "longitude") and numbers_as_text:
            return f"CAST({c} AS VARCHAR) AS {c}"
        if c in ("years_required_min", "years_required_max"):
            return f"CAST({c} AS DOUBLE) AS {c}"
        return c

    return MART + "SELECT " + ", ".join(cell(c) for c in schemas.MART_COLUMNS) + " FROM mart"


@query("mart_stored", loaded_sql())
def mart_stored(spark, sf):
    path = workspace(spark)
    tables.write_mart(testbed.mart(spark, sf), path)
    return flat(tables.load_mart(spark, path))


@query("mart_coerced", loaded_sql(numbers_as_text=True))
def mart_coerced(spark, sf):
    """A mart of texts under upper-case names, as another store may hand it over."""
    mart = testbed.mart(spark, sf)
    texts = mart.select(
        *[F.to_json(c).alias(c.upper()) if c in schemas.ARRAY_COLUMNS else F.col(c).cast("string").alias(c.upper()) for c in mart.columns]
    )
    return flat(tables.coerce_mart(texts))


def label_cell(c):
    if c in schemas.ARRAY_COLUMNS:
        return f"array_to_string({c}, ',') AS {c}"
    names = {"salary_min": "model_salary_min AS salary_min", "salary_max": "model_salary_max AS salary_max"}
    return names.get(c, "'v1' AS model_version" if c == "model_version" else c)


@query("labels_stored", "WITH " + ENRICHMENT + "SELECT " + ", ".join(label_cell(c) for c in schemas.ENRICHMENT.names) + " FROM enrichment")
def labels_stored(spark, sf):
    """Labels appended in two runs."""
    path, labels = workspace(spark), testbed.enrichment(spark, sf)
    for first in (True, False):
        tables.append_enrichment(labels.where((F.col("source") == "jsearch") == first), path)
    return flat(tables.read_table(spark, path, schemas.ENRICHMENT))


@query(
    "usage_stored",
    USAGE + "SELECT run_id, run_at, source, credits_remaining, credits_limit, coalesce(reset_date, '—') AS reset_date FROM usage",
)
def usage_stored(spark, sf):
    path = workspace(spark)
    tables.append_usage(testbed.usage(spark, sf), path)
    rows = tables.read_usage(spark, path)
    return rows.select("run_id", "run_at", "source", "credits_remaining", "credits_limit", "reset_date")


@query(
    "runs_stored",
    """SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, min(ts) AS run_at,
      CAST(count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS INTEGER) AS total_rows FROM events GROUP BY ALL""",
)
def runs_stored(spark, sf):
    path = workspace(spark)
    tables.append_runs(testbed.runs(spark, sf), path)
    return tables.read_runs(spark, path).select("run_id", "run_at", "total_rows")


@query(
    "tables_copied",
    """SELECT 'orders' AS "table", count(*) AS old, count(*) AS new, 'ok' AS status FROM orders
    UNION ALL SELECT 'labels', count(*), count(*), 'ok' FROM labels""",
)
def tables_copied(spark, sf):
    path = workspace(spark)
    return tables.copy_tables(spark, {n: (f"{sf}/{n}.parquet", f"{path}/{n}") for n in ("orders", "labels")})


@query("adhoc_sql", "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part GROUP BY ALL")
def adhoc_sql(spark, sf):
    sql = "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM {part} GROUP BY p_brand"
    return tables.run_query(spark, sql, part=table(spark, sf, "part"))


@query("checkpoint_csv", "SELECT * FROM customer")
def checkpoint_csv(spark, sf):
    path, rows = workspace(spark), table(spark, sf, "customer")
    tables.write_checkpoint_csv(rows, path)
    return tables.read_checkpoint_csv(spark, path, rows.schema)


@query(
    "tables_existing",
    """SELECT 'stored_orders' AS name, true AS found, count(*) AS n FROM orders
    UNION ALL SELECT 'stored_labels', true, count(*) FROM labels
    UNION ALL SELECT 'stored_nothing', false, NULL""",
)
def tables_existing(spark, sf):
    """Which of a set of tables exist, with the rows of those that do."""
    for name in ("orders", "labels"):
        table(spark, sf, name).createOrReplaceTempView(f"stored_{name}")
    found = tables.existing_tables(spark, ["stored_orders", "stored_labels", "stored_nothing"])
    counted = [
        (spark.table(name).agg(F.count("*").alias("n")) if there else spark.range(1).selectExpr("CAST(NULL AS bigint) AS n"))
        .select(F.lit(name).alias("name"), F.lit(there).alias("found"), "n")
        for name, there in found.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# -- snapshots ---------------------------------------------------------------------------


@query(
    "snapshots_stored",
    MART
    + """, old AS (SELECT 'postings_by_role.' || title_role_bucket AS path, CAST(count(*) AS VARCHAR) AS old_value
      FROM classified WHERE source != 'builtin' GROUP BY title_role_bucket),
    new AS (SELECT 'postings_by_role.' || title_role_bucket AS path, CAST(count(*) AS VARCHAR) AS new_value
      FROM classified GROUP BY title_role_bucket)
    SELECT path, old_value, new_value FROM old FULL JOIN new USING (path) WHERE old_value IS DISTINCT FROM new_value""",
)
def snapshots_stored(spark, sf):
    """Three dated snapshots; today's is compared with the newest before it."""
    path, mart = workspace(spark), testbed.mart(spark, sf)

    def roles(df):
        return metrics.keyed_metrics(findings.postings_by_role(df), "postings_by_role", "title_role_bucket", "n")

    snapshots.write_snapshot(roles(mart.where("source = 'jsearch'")), "2026-08-01", path)
    snapshots.write_snapshot(roles(mart.where("source <> 'builtin'")), "2026-08-08", path)
    snapshots.write_snapshot(roles(mart), "2026-08-15", path)
    return snapshots.changes_since_previous(snapshots.read_snapshots(spark, path), "2026-08-15")


# -- profiles ----------------------------------------------------------------------------


@query(
    "payload_keys_filled",
    "WITH " + FACTS
    + """, t AS (SELECT count(*) AS total, count(low) AS paid, count(company_name) AS named, count(latitude) AS placed,
        count(*) FILTER (text != '') AS described FROM facts WHERE source = 'jsearch')
    SELECT key, non_null, total, round_even(100.0 * non_null / total, 1)::DOUBLE AS population_pct
    FROM (
      SELECT unnest(['job_id', 'job_title', 'job_apply_link', 'job_posted_at_datetime_utc', 'job_city', 'job_state',
        'job_country', 'job_is_remote', 'job_employment_type', 'job_salary_period']) AS key, total AS non_null, total FROM t
      UNION ALL SELECT unnest(['job_min_salary', 'job_max_salary']), paid, total FROM t
      UNION ALL SELECT unnest(['job_latitude', 'job_longitude']), placed, total FROM t
      UNION ALL SELECT 'job_description', described, total FROM t
      UNION ALL SELECT 'employer_name', named, total FROM t)""",
)
def payload_keys_filled(spark, sf):
    """Keys of a provider's payloads where empty texts and lists count as missing."""
    rows = testbed.landing(spark, sf)["jsearch"]
    profile = profiling.json_key_profile(rows, "raw_payload", "ordinal", empty_as_null=True)
    return profile.select("key", "non_null", "total", "population_pct")

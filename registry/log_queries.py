"""Queries over the run and credit logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from vacancia import testbed
from vacancia.operators import usage

USAGE = """WITH usage AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS run_at, event_type AS source,
    CAST(200 - (event_id // 5) % 190 AS INTEGER) AS credits_remaining,
    CASE WHEN event_id % 17 != 0 THEN 200 END AS credits_limit,
    CASE WHEN event_id % 13 != 0 THEN CAST((event_id // 5) % 190 AS INTEGER) END AS credits_used_cumulative,
    CASE WHEN event_id % 11 != 0 THEN CAST(event_id % 7 AS INTEGER) END AS credits_used_this_run,
    CASE WHEN event_id % 19 != 0 THEN '2024-02-10' END AS reset_date, strftime(ts, '%Y-%m-%d %H') AS hour
  FROM events) """


@query(
    "credit_burn",
    USAGE
    + """, lagged AS (SELECT *, lag(credits_remaining) OVER w AS r0, lag(credits_used_cumulative) OVER w AS c0,
      row_number() OVER w AS i FROM usage WINDOW w AS (PARTITION BY source ORDER BY run_at, run_id))
    SELECT run_id, source, CAST(CASE WHEN credits_used_cumulative IS NULL THEN 0
      WHEN i = 1 OR credits_remaining > r0 OR c0 IS NULL THEN credits_used_cumulative
      ELSE credits_used_cumulative - c0 END AS INTEGER) AS credits_used_this_run FROM lagged""",
)
def credit_burn(spark, sf):
    return usage.credit_burn(testbed.usage(spark, sf)).select("run_id", "source", "credits_used_this_run")


@query(
    "credit_status",
    USAGE
    + """, latest AS (SELECT source, arg_max(credits_remaining, (run_at, run_id)) AS credits_remaining,
      arg_max(credits_limit, (run_at, run_id)) FILTER (credits_limit IS NOT NULL) AS credits_limit,
      arg_max(credits_used_cumulative, (run_at, run_id)) FILTER (credits_used_cumulative IS NOT NULL)
        AS credits_used_cumulative
      FROM usage GROUP BY source)
    SELECT source, credits_remaining, credits_limit, credits_used_cumulative,
      round(credits_remaining / credits_limit, 6) AS pct_remaining,
      CASE WHEN credits_remaining / credits_limit > 0.5 THEN 'healthy'
        WHEN credits_remaining / credits_limit > 0.25 THEN 'monitor' ELSE 'low' END AS band FROM latest""",
)
def credit_status(spark, sf):
    status = usage.credit_status(testbed.usage(spark, sf)).drop("reset_date")
    return status.withColumn("pct_remaining", F.round("pct_remaining", 6))


@query(
    "latest_status",
    USAGE
    + """SELECT source, arg_max(credits_limit, (run_at, run_id)) FILTER (credits_limit IS NOT NULL) AS credits_limit,
      arg_max(credits_used_this_run, (run_at, run_id)) FILTER (credits_used_this_run IS NOT NULL)
        AS credits_used_this_run, arg_max(reset_date, (run_at, run_id)) FILTER (reset_date IS NOT NULL) AS reset_date
    FROM usage GROUP BY source""",
)
def latest_status(spark, sf):
    columns = ["credits_limit", "credits_used_this_run", "reset_date"]
    latest = usage.latest_nonnull(testbed.usage(spark, sf), ["source"], "run_at", columns, ["run_id"])
    return latest.withColumn("reset_date", F.substring("reset_date", 1, 10))


@query(
    "credit_forecast",
    USAGE
    + """, latest AS (SELECT * FROM usage QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_at DESC, run_id DESC) = 1),
    t AS (SELECT l.source, l.credits_remaining, coalesce(l.reset_date, '—') AS reset_date, count(*) AS runs,
      avg(u.credits_used_this_run) AS burn FROM latest l JOIN usage u ON u.source = l.source
        AND (l.reset_date IS NULL OR u.run_at >= CAST(l.reset_date AS DATE) - INTERVAL 1 MONTH)
      GROUP BY ALL HAVING count(*) >= 2)
    SELECT source, credits_remaining, reset_date, runs, round(burn, 6) AS avg_burn,
      CASE WHEN burn > 0 THEN CAST(floor(credits_remaining / burn) AS BIGINT) END AS runs_left FROM t""",
)
def credit_forecast(spark, sf):
    forecast = usage.credit_forecast(testbed.usage(spark, sf))
    return forecast.withColumn("avg_burn", F.round("avg_burn", 6))


RUNS = USAGE + """, runs AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, min(ts) AS run_at, CAST(max(event_id % 600) AS DOUBLE) AS duration_seconds,
    CAST(count(*) FILTER (event_type = 'click') AS INTEGER) AS jsearch_rows,
    CAST(count(*) FILTER (event_type = 'view') AS INTEGER) AS theirstack_rows,
    CAST(count(*) FILTER (event_type = 'purchase') AS INTEGER) AS builtin_rows,
    CAST(count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS INTEGER) AS total_rows,
    count(*) FILTER (event_type = 'error') AS failures FROM events GROUP BY 1) """
STATUS = "CASE WHEN failures > 0 AND total_rows = 0 THEN 'failure' WHEN failures > 0 THEN 'partial' ELSE 'success' END"


@query(
    "run_efficiency",
    RUNS
    + f"""SELECT r.run_id, r.run_at, r.duration_seconds, {STATUS} AS status, jsearch_rows, theirstack_rows,
      builtin_rows, total_rows,
      CAST(coalesce(sum(credits_used_this_run) FILTER (source = 'click'), 0) AS BIGINT) AS click_credits,
      CAST(coalesce(sum(credits_used_this_run) FILTER (source = 'view'), 0) AS BIGINT) AS view_credits
    FROM runs r LEFT JOIN usage u ON u.hour = r.run_id GROUP BY ALL""",
)
def run_efficiency(spark, sf):
    return usage.run_efficiency(testbed.runs(spark, sf), testbed.hourly_usage(spark, sf), ["click", "view"])


@query(
    "jobs_per_run",
    RUNS
    + """SELECT run_id, run_at, 'jsearch_rows' AS source, jsearch_rows AS rows FROM runs
    UNION ALL SELECT run_id, run_at, 'theirstack_rows', theirstack_rows FROM runs
    UNION ALL SELECT run_id, run_at, 'builtin_rows', builtin_rows FROM runs""",
)
def jobs_per_run(spark, sf):
    return usage.jobs_per_run(testbed.runs(spark, sf), ["jsearch_rows", "theirstack_rows", "builtin_rows"])


@query("usage_per_run", USAGE + "SELECT source, run_at, run_id, credits_used_this_run FROM usage")
def usage_per_run(spark, sf):
    return usage.usage_per_run(testbed.usage(spark, sf))


@query("run_status_counts", RUNS + f"SELECT {STATUS} AS status, count(*) AS n FROM runs GROUP BY ALL")
def run_status_counts(spark, sf):
    return testbed.runs(spark, sf).groupBy("status").agg(F.count("*").alias("n"))

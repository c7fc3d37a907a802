"""Run and credit logs: burn per run, status, forecast, efficiency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DASH
from .running import previous_rows

# Limit assumed when a source reports none, and the status bands.
DEFAULT_LIMIT = 200
HEALTHY_ABOVE = 0.5
MONITOR_ABOVE = 0.25


def credit_burn(usage: DataFrame, store_at: str | None = None) -> DataFrame:
    """Credits spent per run, from the cumulative counter.

    The counter itself is the cost on the first tracked run and when the remaining
    credits rise (a new billing period); an unknown counter costs 0. The log is written once
    in run order, to ``store_at`` or the session's shared folder.
    """
    columns = ["credits_remaining", "credits_used_cumulative"]
    rows = previous_rows(usage, ["source"], ["run_at", "run_id"], columns, store_at=store_at)
    used, before = F.col("credits_used_cumulative"), F.col("prev.credits_used_cumulative")
    reset = F.col("credits_remaining") > F.col("prev.credits_remaining")
    burn = (
        F.when(used.isNull(), 0)
        .when(F.col("prev").isNull() | F.coalesce(reset, F.lit(False)) | before.isNull(), used)
        .otherwise(used - before)
    )
    return rows.withColumn("credits_used_this_run", burn.cast("int")).drop("prev")


def latest_nonnull(
    df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Per group and column, the newest value that is not NULL."""
    order = F.struct(*[F.col(c) for c in (ts, *tiebreak)])
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*newest)


def reset_day(value: Column) -> Column:
    return F.coalesce(F.nullif(F.substring(value, 1, 10), F.lit("")), F.lit(DASH))


def credit_status(usage: DataFrame) -> DataFrame:
    """Current credits per source with a health band."""
    columns = ["credits_remaining", "credits_limit", "credits_used_cumulative", "reset_date"]
    usage = usage.withColumn("reset_date", reset_day(F.col("reset_date")))
    latest = latest_nonnull(usage, ["source"], "run_at", columns, ["run_id"])
    limit = F.coalesce(F.nullif(F.col("credits_limit"), F.lit(0)), F.lit(DEFAULT_LIMIT))
    left = F.col("credits_remaining") / F.col("credits_limit")
    band = F.when(left > HEALTHY_ABOVE, "healthy").when(left > MONITOR_ABOVE, "monitor").otherwise("low")
    return latest.withColumn("credits_limit", limit).withColumn("pct_remaining", left).withColumn("band", band)


def credit_forecast(usage: DataFrame) -> DataFrame:
    """Mean burn in the current billing window and the runs it leaves.

    The window starts one month before the reset date of the newest row; without a
    readable reset date every run counts. Sources with fewer than two runs in the window
    have no forecast. ``runs_left`` is NULL when the burn is not positive (no limit).
    """
    per_day = usage.groupBy("source", F.to_date("run_at").alias("day")).agg(
        F.max_by(
            F.struct("run_at", "run_id", "credits_remaining", "reset_date"), F.struct("run_at", "run_id")
        ).alias("last"),
        F.count("*").alias("runs"),
        F.sum("credits_used_this_run").alias("burn"),
        F.count("credits_used_this_run").alias("burns"),
    )
    latest = per_day.groupBy("source").agg(
        F.max_by("last", F.struct("last.run_at", "last.run_id")).alias("latest")
    )
    start = F.add_months(F.substring(F.col("latest.reset_date"), 1, 10).try_cast("date"), -1)
    latest = latest.select(
        "source", "latest.credits_remaining", reset_day(F.col("latest.reset_date")).alias("reset_date"),
        start.alias("window_start"),
    )
    in_window = F.col("window_start").isNull() | (F.col("day") >= F.col("window_start"))
    table = (
        per_day.select("source", "day", "runs", "burn", "burns")
        .join(latest, "source")
        .where(in_window)
        .groupBy("source", "credits_remaining", "reset_date")
        .agg(F.sum("runs").alias("runs"), F.try_divide(F.sum("burn"), F.sum("burns")).alias("avg_burn"))
        .where(F.col("runs") >= 2)
    )
    left = F.when(F.col("avg_burn") > 0, (F.col("credits_remaining") / F.col("avg_burn")).cast("bigint"))
    return table.withColumn("runs_left", left)


def usage_per_run(usage: DataFrame) -> DataFrame:
    """Credits per run and source, in run order within the source."""
    return usage.select("source", "run_at", "run_id", "credits_used_this_run")


def jobs_per_run(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows collected per run and source, long form."""
    return runs.unpivot([F.col("run_id"), F.col("run_at")], [F.col(c) for c in columns], "source", "rows")


def run_efficiency(runs: DataFrame, usage: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Run history with the credits each source spent (0 when it reported none)."""
    spent = usage.groupBy("run_id").pivot("source", list(sources)).agg(F.sum("credits_used_this_run"))
    spent = spent.select("run_id", *[F.col(s).alias(f"{s}_credits") for s in sources])
    joined = runs.join(spent, "run_id", "left").na.fill(0, [f"{s}_credits" for s in sources])
    return joined.withColumn("duration_seconds", F.bround("duration_seconds", 1))


def run_status(n_failed: Column, n_rows: Column) -> Column:
    return (
        F.when((n_failed > 0) & (n_rows == 0), "failure").when(n_failed > 0, "partial").otherwise("success")
    )


def run_row(
    landed: DataFrame, failures: DataFrame, run_id: str, run_at: Column, duration: float, providers: Sequence[str]
) -> DataFrame:
    """The run-log row for one run: rows per provider, total and status.

    ``landed`` has a ``provider`` column, ``failures`` one row per failed provider.
    """
    counts = [F.count_if(F.col("provider") == p).cast("int").alias(f"{p}_rows") for p in providers]
    tallied = landed.agg(*counts, F.count("*").cast("int").alias("total_rows"))
    n_failed = failures.agg(F.count("*").alias("n")).scalar()
    return tallied.select(
        F.lit(run_id).alias("run_id"),
        run_at.alias("run_at"),
        F.lit(float(duration)).alias("duration_seconds"),
        run_status(n_failed, F.col("total_rows")).alias("status"),
        *[f"{p}_rows" for p in providers],
        "total_rows",
    )

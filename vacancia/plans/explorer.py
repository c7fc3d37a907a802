"""Posting search: filtered rows, grid and detail layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.filters import ExplorerSpec, explorer_predicate, explorer_summary
from ..sources import tables, text_index

# Days of the date presets.
PRESETS = {"Past 3 Days": 3, "Past Week": 7, "Past Month": 30}


def explore(mart: DataFrame, spec: ExplorerSpec, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Matching postings, and the one-row count of matches and of all postings."""
    return mart.where(explorer_predicate(spec, as_of)), explorer_summary(mart, spec, as_of)


def explore_stored(
    spark: SparkSession, path: str, index: str, spec: ExplorerSpec, as_of: Column | None = None
) -> DataFrame:
    """Matching postings of a stored mart; files whose indexed texts cannot match are not opened."""
    mart = spark.read.parquet(path)
    if spec.search and spec.search[1]:
        mart = text_index.prune(mart, index, *spec.search, spec.literal_search)
    return tables.coerce_mart(mart).where(explorer_predicate(spec, as_of))


def or_dash(value: Column) -> Column:
    return F.coalesce(value, F.lit(text.DASH))


def grid(rows: DataFrame) -> DataFrame:
    return rows.select(
        or_dash(F.col("job_title")).alias("title"),
        or_dash(F.col("company_name")).alias("company"),
        or_dash(F.col("title_role_bucket")).alias("role"),
        or_dash(F.col("work_model")).alias("work_model"),
        or_dash(text.format_source("source")).alias("source"),
        F.col("final_salary_min").alias("sal_min"),
        F.col("final_salary_max").alias("sal_max"),
        F.col("date_posted").alias("posted"),
        "job_id",
    )


def detail(rows: DataFrame) -> DataFrame:
    """Display texts of the posting detail view."""

    def label(name: str) -> Column:
        return or_dash(F.nullif(text.format_label(name), F.lit("")))

    domain = F.nullif(F.col("domain"), F.lit(""))
    capitalised = F.concat(F.upper(F.substring(domain, 1, 1)), F.lower(F.substring(domain, 2, 1 << 30)))
    confidence = F.concat(F.bround(F.col("confidence_score") * 100, 0).cast("int").cast("string"), F.lit("%"))
    return rows.select(
        "job_id",
        or_dash(F.date_format("date_posted", "MMM dd, yyyy")).alias("posted"),
        text.format_salary("final_salary_min", "final_salary_max").alias("salary"),
        text.format_location("city", "state", "work_model").alias("location"),
        or_dash(capitalised).alias("industry"),
        label("role_archetype").alias("archetype"),
        label("work_focus").alias("work_focus"),
        text.format_seniority("inferred_seniority").alias("inferred_seniority"),
        text.format_seniority("listed_seniority").alias("listed_seniority"),
        text.format_degree("degree_requirement").alias("degree"),
        text.format_years("years_required_min", "years_required_max").alias("years"),
        or_dash(confidence).alias("confidence"),
    )

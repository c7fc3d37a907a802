"""Headline findings over the mart. Each function returns small, chart-sized frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.arrays import array_union_all, classify_by_sets, non_empty
from ..functions.text import map_values
from ..operators import aggregates as agg
from ..operators import metrics, ranking
from ..session import store

ROLE = "title_role_bucket"
HEADLINE_COLUMNS = [
    ROLE, "company_name", "source", "date_posted", "ingested_at", "final_salary_min", "final_salary_max",
    "early_career_tier", "role_archetype", "acknowledges_ai", "explicitly_encourages_applicants",
    "degree_requirement", "listed_seniority", "inferred_seniority", "years_required_min",
]


def classified(mart: DataFrame) -> DataFrame:
    """Postings whose title maps to one of the roles."""
    return mart.where(F.col(ROLE) != schemas.NO_ROLE)


def with_salary(mart: DataFrame) -> DataFrame:
    """Postings with both salary ends, and their midpoint."""
    both = F.col("final_salary_min").isNotNull() & F.col("final_salary_max").isNotNull()
    mid = (F.col("final_salary_min") + F.col("final_salary_max")) / 2
    return mart.where(both).withColumn("salary_mid", mid)


def with_tier(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("early_career_tier").isin(schemas.TIERS))


def top_level_snapshot(mart: DataFrame) -> DataFrame:
    """One row of key figures over the classified postings."""
    df = classified(mart)
    both = F.col("final_salary_min").isNotNull() & F.col("final_salary_max").isNotNull()
    has_labels = F.col("role_archetype").isNotNull()
    return df.agg(
        F.count("*").alias("total_postings"),
        F.count_distinct("company_name").alias("unique_companies"),
        F.count_distinct(ROLE).alias("role_types"),
        F.count_distinct("source").alias("sources"),
        F.count_if(both).alias("salary_disclosed_n"),
        F.avg(both.cast("int")).alias("salary_disclosed_rate"),
        F.count_if(has_labels).alias("llm_enriched_n"),
        F.avg(has_labels.cast("int")).alias("llm_enriched_rate"),
        F.min("date_posted").alias("date_min"),
        F.max("date_posted").alias("date_max"),
        F.to_date(F.max("ingested_at")).alias("last_ingested"),
    )


def postings_by_role(mart: DataFrame) -> DataFrame:
    return agg.counts(classified(mart), [ROLE])


def postings_by_source(mart: DataFrame) -> DataFrame:
    return agg.counts(classified(mart), ["source"])


def postings_by_role_source(mart: DataFrame) -> DataFrame:
    return agg.crosstab(classified(mart), ROLE, "source", schemas.PROVIDERS)


def work_model(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    return agg.counts(df, ["work_model"]), agg.crosstab(df, ROLE, "work_model", schemas.WORK_MODELS)


def early_career_tier(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    return (
        agg.counts(df, ["early_career_tier"]),
        agg.crosstab(df, ROLE, "early_career_tier", schemas.TIERS),
    )


def salary_by_role(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = with_salary(classified(mart))
    return (
        agg.stats5(df, [ROLE], "salary_mid"),
        agg.median_n(with_tier(df), [ROLE, "early_career_tier"], "salary_mid", 0),
    )


def ai_acknowledgment(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    return (
        agg.bool_rate(df, "acknowledges_ai"),
        agg.bool_rate(df, "acknowledges_ai", [ROLE], 3),
    )


def encourages_applicants(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    flag = "explicitly_encourages_applicants"
    return agg.bool_rate(df, flag), agg.bool_rate(df, flag, [ROLE], 3)


def title_vs_archetype(mart: DataFrame) -> dict[str, DataFrame]:
    """Confusion of title role and labelled archetype, with agreement rates."""
    df = classified(mart)
    return {
        "pivot_counts": agg.crosstab(df, ROLE, "role_archetype", schemas.ARCHETYPES),
        "pivot_pct": agg.crosstab_pct(df, ROLE, "role_archetype", schemas.ARCHETYPES, 2),
        "overall": agg.agreement(df, ROLE, "role_archetype"),
        "by_role": agg.agreement(df, ROLE, "role_archetype", [ROLE]),
    }


def top_skills(mart: DataFrame, overall_n: int = 20, per_role_n: int = 10) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    return (
        ranking.topk(df, "tech_stack_required", overall_n),
        ranking.topk_by(df, "tech_stack_required", ROLE, per_role_n),
    )


def top_paradigms(mart: DataFrame, per_role_n: int = 10) -> DataFrame:
    both = array_union_all("paradigms_required", "paradigms_preferred")
    return ranking.topk_by(classified(mart), both, ROLE, per_role_n)


def years_required(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart).where(F.col("years_required_min").isNotNull())
    return (
        agg.median_n(df, [ROLE], "years_required_min", 1),
        agg.median_n(with_tier(df), [ROLE, "early_career_tier"], "years_required_min", 1),
    )


def degree_requirements(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = classified(mart)
    return (
        agg.crosstab(df, ROLE, "degree_requirement", schemas.DEGREES),
        agg.crosstab_pct(df, ROLE, "degree_requirement", schemas.DEGREES, 3),
    )


def seniority_mismatch(mart: DataFrame) -> dict[str, DataFrame]:
    df = classified(mart)
    listed, inferred = "listed_seniority", "inferred_seniority"
    both = df.where(F.col(listed).isNotNull() & F.col(inferred).isNotNull())
    years = df.where(F.col("years_required_min").isNotNull())
    return {
        "pivot_counts": agg.crosstab(df, listed, inferred, schemas.SENIORITIES),
        "pivot_pct": agg.crosstab_pct(df, listed, inferred, schemas.SENIORITIES, 2),
        "n_both_populated": both.agg(F.count("*").alias("n")),
        "years_by_listed_seniority": agg.stats(
            years, [listed], "years_required_min", ("median", "min", "max", "count"), 1
        ),
    }


def headline_metrics(mart: DataFrame, store_at: str | None = None) -> DataFrame:
    """The headline document in long form (path, value).

    A dozen aggregates read the postings: with ``store_at`` their columns are written there
    once and read back, as for a mart that is not itself a stored table.
    """
    mart = mart.select(*HEADLINE_COLUMNS)
    if store_at is not None:
        mart = store(mart, store_at)
    snapshot = top_level_snapshot(mart).select(
        "total_postings", "unique_companies", "sources", "date_min", "date_max", "last_ingested",
        "salary_disclosed_rate",
    )
    consistency = title_vs_archetype(mart)
    salaries, _ = salary_by_role(mart)
    ai, ai_by_role = ai_acknowledgment(mart)
    _, degrees = degree_requirements(mart)
    encouraged, _ = encourages_applicants(mart)
    rate = F.col("rate").alias("overall_rate")
    return metrics.document(
        [
            metrics.scalar_metrics(snapshot, "dataset"),
            metrics.keyed_metrics(postings_by_role(mart), "postings_by_role", ROLE, "n"),
            metrics.scalar_metrics(consistency["overall"].select(rate), "title_self_consistency"),
            metrics.keyed_metrics(consistency["by_role"], "title_self_consistency.by_role", ROLE, "rate"),
            metrics.keyed_metrics(salaries, "median_salary_by_role", ROLE, "median"),
            metrics.scalar_metrics(ai.select(rate), "ai_acknowledgment"),
            metrics.keyed_metrics(ai_by_role, "ai_acknowledgment.by_role", ROLE, "rate"),
            metrics.keyed_metrics(degrees, "masters_degree_rate_by_role", ROLE, "masters"),
            metrics.table_metrics(
                seniority_mismatch(mart)["pivot_pct"], "listed_vs_inferred_seniority_pct", "listed_seniority"
            ),
            metrics.scalar_metrics(
                encouraged.select(F.col("rate").alias("encourages_applicants_overall_rate")), ""
            ),
        ]
    )


# -- further notebook findings -----------------------------------------------------------


def stack_type(column: str = "tech_stack_required"):
    """modern, then traditional, else neither."""
    return classify_by_sets(
        column,
        [("modern", schemas.MODERN_SKILLS), ("traditional", schemas.TRADITIONAL_SKILLS)],
        "neither",
    )


def stack_salary(mart: DataFrame) -> DataFrame:
    """Median salary by stack type."""
    df = with_salary(mart).withColumn("stack_type", stack_type())
    return agg.median_n(df, ["stack_type"], "salary_mid")


def seniority_ladder(mart: DataFrame) -> DataFrame:
    """Median years and salary per listed seniority."""
    return agg.medians(mart, ["listed_seniority"], ["years_required_min", "final_salary_min"])


def seniority_agreement(mart: DataFrame) -> DataFrame:
    """Agreement of listed (two-level) and inferred seniority; unmapped labels disagree."""
    both = mart.where(F.col("listed_seniority").isNotNull() & F.col("inferred_seniority").isNotNull())
    level = map_values("listed_seniority", schemas.SENIORITY_NAMES_TWO_LEVEL, F.lit(""))
    return agg.agreement(both, level, "inferred_seniority", normalise=False)


def query_divergence(mart: DataFrame) -> DataFrame:
    """Archetypes that differ from what the search query implies."""
    expected = map_values("ingestion_query", schemas.QUERY_ARCHETYPE)
    return agg.divergent(mart, "ingestion_query", "role_archetype", expected)


def presence_rate(mart: DataFrame, array: str, value: str) -> DataFrame:
    """Median of a value with and without entries in an array column."""
    df = mart.withColumn("present", non_empty(array))
    return agg.median_n(df, ["present"], value)


def label_preview(labels: DataFrame) -> dict[str, DataFrame]:
    """Overview of a batch of validated labels."""
    flags = ["acknowledges_ai", "explicitly_encourages_applicants"]
    return {
        "inferred_seniority": agg.distribution(labels, "inferred_seniority"),
        "role_archetype": agg.distribution(labels, "role_archetype"),
        "degree_requirement": agg.distribution(labels, "degree_requirement"),
        "domain": agg.distribution(labels, "domain"),
        **{flag: agg.bool_rate(labels, flag) for flag in flags},
        "confidence": agg.describe_by(labels, [], "confidence_score"),
        "salary": agg.stats(labels, [], "salary_min", ("count", "min", "max", "median")),
        "tools": ranking.topk(labels, array_union_all("tech_stack_required", "tech_stack_preferred"), 15),
        "paradigms": ranking.topk(labels, array_union_all("paradigms_required", "paradigms_preferred"), 15),
    }

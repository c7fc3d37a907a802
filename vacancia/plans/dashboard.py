"""The frames behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.arrays import array_union_all, non_empty
from ..functions.text import map_values
from ..operators import aggregates as agg
from ..operators import profiling, ranking
from .findings import ROLE, classified, with_salary, with_tier

FACETS = [
    ROLE, "listed_seniority", "inferred_seniority", "degree_requirement", "work_model", "domain",
    "employment_type", "source",
]


def landscape_kpis(mart: DataFrame) -> DataFrame:
    both = F.col("final_salary_min").isNotNull() & F.col("final_salary_max").isNotNull()
    return classified(mart).agg(
        F.count("*").alias("postings"),
        F.count_distinct(ROLE).alias("role_types"),
        F.count_distinct("company_name").alias("companies"),
        F.avg(both.cast("int")).alias("salary_disclosed"),
    )


def home_kpis(mart: DataFrame) -> DataFrame:
    """Key figures over the whole mart."""
    return mart.agg(
        F.count("*").alias("postings"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("company_name").alias("companies"),
        F.max("ingested_at").alias("latest_ingested"),
    )


def share_by_role(mart: DataFrame, column: str) -> DataFrame:
    """Counts and within-role share of a column."""
    return agg.share(agg.counts(classified(mart), [ROLE, column]), ROLE)


def share_grid(mart: DataFrame, column: str, values: list[str]) -> DataFrame:
    """:func:`share_by_role` for every role and every listed value, absent pairs zero."""
    rows = classified(mart).where(F.col(column).isin(values))
    grid = agg.complete_grid(rows, ROLE, column, values)
    return agg.share(grid, ROLE)


def frequency(mart: DataFrame, date: str = "date_posted", sources: list[str] | None = None) -> DataFrame:
    """Running postings per role and day."""
    where = F.col("source").isin(sources) if sources else None
    return agg.cumulative(classified(mart), date, [ROLE], where)


def landscape(mart: DataFrame) -> dict[str, DataFrame]:
    df = classified(mart)
    paid = with_salary(df)
    years = with_tier(df.where(F.col("years_required_min").isNotNull()))
    return {
        "kpis": landscape_kpis(mart),
        "role_volume": ranking.volume_rank(df, ROLE),
        "work_model": share_by_role(mart, "work_model"),
        "frequency": frequency(mart),
        "seniority": share_grid(mart, "early_career_tier", schemas.TIERS),
        "degree": share_grid(mart, "degree_requirement", schemas.DEGREES),
        "years": agg.median_n(years, [ROLE, "early_career_tier"], "years_required_min"),
        "salary": agg.median_n(paid, [ROLE], "salary_mid"),
        "salary_by_tier": agg.median_n(with_tier(paid), [ROLE, "early_career_tier"], "salary_mid"),
    }


def skill_heatmap(mart: DataFrame, kind: str = "both", k: int = 20) -> DataFrame:
    stacks = {
        "required": F.col("tech_stack_required"),
        "preferred": F.col("tech_stack_preferred"),
        "both": array_union_all("tech_stack_required", "tech_stack_preferred"),
    }
    return ranking.heatmap(classified(mart), stacks[kind], ROLE, schemas.ROLES, k)


def paradigm_heatmap(mart: DataFrame, k: int = 20) -> DataFrame:
    both = array_union_all("paradigms_required", "paradigms_preferred")
    return ranking.heatmap(classified(mart), both, ROLE, schemas.ROLES, k)


def title_archetype_matrix(mart: DataFrame) -> dict[str, DataFrame]:
    df = classified(mart).where(F.col("role_archetype").isin(schemas.CHART_ARCHETYPES))
    return {
        "counts": agg.crosstab(df, ROLE, "role_archetype", schemas.CHART_ARCHETYPES),
        "shares": agg.crosstab_pct(df, ROLE, "role_archetype", schemas.CHART_ARCHETYPES, None),
        "agreement": agg.agreement(df, ROLE, "role_archetype"),
    }


def seniority_matrix(mart: DataFrame) -> dict[str, DataFrame]:
    df = (
        classified(mart)
        .withColumn("listed", map_values("listed_seniority", schemas.SENIORITY_NAMES))
        .withColumn("inferred", map_values("inferred_seniority", schemas.SENIORITY_NAMES))
    )
    return {
        "counts": agg.crosstab(df, "listed", "inferred", schemas.SENIORITY_AXIS),
        "shares": agg.crosstab_pct(df, "listed", "inferred", schemas.SENIORITY_AXIS, None),
        "agreement": agg.agreement(df, "listed", "inferred", normalise=False),
    }


def ai_rate(mart: DataFrame) -> DataFrame:
    return agg.bool_rate(classified(mart), "acknowledges_ai", [ROLE])


def domain_mix(mart: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    df = classified(mart)
    return {
        "top": ranking.topk(df, "domain", k),
        "composition": ranking.topk_composition(df, "domain", ROLE, k),
    }


def facets(mart: DataFrame) -> DataFrame:
    """Every facet's options in one frame: facet, value, n."""
    techs = array_union_all("tech_stack_required", "tech_stack_preferred")
    options = [F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in FACETS]
    tech = F.transform(techs, lambda t: F.struct(F.lit("tech").alias("facet"), t.alias("value")))
    rows = mart.select(F.explode(F.concat(F.array(*options), tech)).alias("o")).select("o.*")
    return rows.where(F.col("value").isNotNull()).groupBy("facet", "value").agg(F.count("*").alias("n"))


# -- pipeline health ---------------------------------------------------------------------


def system_status(mart: DataFrame) -> DataFrame:
    def rate(condition):
        return F.coalesce(F.avg(condition.cast("int")), F.lit(0.0))

    unclassified = F.col(ROLE) == schemas.NO_ROLE
    return mart.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("source").alias("sources_active"),
        rate(F.col("enriched_at").isNotNull()).alias("enrichment_rate"),
        rate(F.col("final_salary_min").isNotNull()).alias("salary_rate"),
        rate(non_empty("tech_stack_required")).alias("tech_stack_rate"),
        F.max("ingested_at").alias("latest_ingestion"),
        F.count_if(unclassified).alias("no_match_n"),
        rate(unclassified).alias("no_match_pct"),
    )


FILL_FIELDS = {
    "Salary extracted": "final_salary_min",
    "Tech stack (required)": "tech_stack_required",
    "Role archetype": "role_archetype",
    "Work focus": "work_focus",
    "Inferred seniority": "inferred_seniority",
    "Degree requirement": "degree_requirement",
    "YoE (min)": "years_required_min",
    "Paradigms (required)": "paradigms_required",
}


def source_health(mart: DataFrame, by: str = "source") -> DataFrame:
    def pct(condition):
        return F.avg(condition.cast("int"))

    return mart.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count("*").alias("postings"),
        pct(F.col("enriched_at").isNotNull()).alias("enriched"),
        pct(F.col("final_salary_min").isNotNull()).alias("salary"),
        pct(non_empty("tech_stack_required")).alias("tech_stack"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.max("ingested_at").alias("latest_ingestion"),
    )


def unclassified_titles(mart: DataFrame) -> DataFrame:
    return mart.where(F.col(ROLE) == schemas.NO_ROLE).select("job_title", "source", "ingestion_query")


def health(mart: DataFrame) -> dict[str, DataFrame]:
    return {
        "status": system_status(mart),
        "trend": agg.cumulative(mart, "ingested_at"),
        "sources": agg.counts(mart, ["source"]),
        "fill_rates": profiling.fill_rates(mart, FILL_FIELDS),
        "confidence": agg.fixed_hist(mart, "confidence_score", 0.0, 1.0, 20),
        "source_health": source_health(mart),
        "title_classes": agg.distribution(mart, ROLE),
        "unclassified": unclassified_titles(mart),
        "query_reliability": agg.label_reliability(mart, "ingestion_query", ROLE),
    }

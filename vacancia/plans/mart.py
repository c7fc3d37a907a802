"""Staging of all providers to the posting mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..functions.text import dedup_key
from ..operators.dedupe import best_per_expression, latest_per_key
from ..operators.filters import drop_value_keep_null
from ..operators.joins import union_all
from ..session import store
from ..sources.landing import only_provider
from . import staging

LABELS = [
    "inferred_seniority", "role_archetype", "work_focus", "tech_stack_required",
    "tech_stack_preferred", "paradigms_required", "paradigms_preferred", "degree_requirement",
    "years_required_min", "years_required_max", "acknowledges_ai", "domain",
    "explicitly_encourages_applicants", "confidence_score", "enriched_at",
]


def split_landing(landing: DataFrame) -> dict[str, DataFrame]:
    """One landing frame as one frame per provider."""
    return {name: only_provider(landing, name) for name in schemas.PROVIDERS}


def stage_all(landing: Mapping[str, DataFrame], null_keys: str = "collapse") -> DataFrame:
    frames = [staging.stage(landing[name], staging.PROVIDERS[name], null_keys) for name in landing]
    return union_all(frames)


def best_source(staged: DataFrame, null_keys: str = "collapse") -> DataFrame:
    """One posting per (title, company) over all providers, best provider first."""
    return best_per_expression(
        staged,
        dedup_key("job_title", "company_name"),
        rules.provider_rank("source"),
        tiebreak=[F.col("ingested_at").desc_nulls_first(), "job_id"],
        null_keys=null_keys,
    )


def latest_labels(enrichment: DataFrame) -> DataFrame:
    """Newest label row per posting."""
    newest = latest_per_key(enrichment, ["job_id"], ["enriched_at"])
    return newest.select(
        "job_id",
        *LABELS,
        F.col("salary_min").alias("model_salary_min"),
        F.col("salary_max").alias("model_salary_max"),
    )


def build_mart(
    landing: Mapping[str, DataFrame],
    enrichment: DataFrame,
    on: Sequence[str] = ("job_id",),
    null_keys: str = "collapse",
) -> DataFrame:
    """The 36-column mart from landing rows and labels."""
    return mart_from_staging(stage_all(landing, null_keys), enrichment, on, null_keys)


def mart_from_staging(
    staged: DataFrame, enrichment: DataFrame, on: Sequence[str] = ("job_id",), null_keys: str = "collapse"
) -> DataFrame:
    """Labels join before the cross-provider choice: staging left its rows partitioned by
    ``job_id``, the key the labels join on, so the wide side is not shuffled again. The
    choice reads no label, so the order of the two steps does not change the result."""
    return mart_from_labelled(staged.join(latest_labels(enrichment), list(on), "left"), null_keys)


def mart_from_labelled(
    labelled: DataFrame, null_keys: str = "collapse", columns: Sequence[str] = tuple(schemas.MART_COLUMNS)
) -> DataFrame:
    """The cross-provider choice and the derived columns."""
    derived = best_source(labelled, null_keys).select(
        "*",
        rules.early_career_tier("source", "listed_seniority").alias("early_career_tier"),
        rules.title_role_bucket("job_title").alias("title_role_bucket"),
        F.coalesce("salary_min", "model_salary_min").alias("final_salary_min"),
        F.coalesce("salary_max", "model_salary_max").alias("final_salary_max"),
    )
    kept = drop_value_keep_null(derived, "role_archetype", "software_engineer")
    return kept.select(*columns)


def fuzzy_duplicates(mart: DataFrame, store_at: str | None = None) -> DataFrame:
    """Near-duplicate postings the exact key missed, with the one to drop."""
    from ..operators.similarity import fuzzy_pairs, pick_loser

    pairs = fuzzy_pairs(
        mart, "job_id", "job_title", "company_name", "date_posted", keep=("source", "final_salary_min"),
        store_at=store_at,
    )
    judged = pick_loser(
        pairs, "final_salary_min", rules.provider_rank("source_a"), rules.provider_rank("source_b")
    )
    out = []
    for side in ("a", "b"):
        out += [
            F.col(f"id_{side}").alias(f"job_id_{side}"),
            F.col(f"title_{side}"),
            F.col(f"company_{side}"),
            F.col(f"source_{side}"),
            F.col(f"day_{side}").alias(f"date_{side}"),
            F.col(f"final_salary_min_{side}").alias(f"salary_{side}"),
        ]
    return judged.select(*out, F.col("loser").alias("loser_job_id"))


def near_duplicate_classes(mart: DataFrame, store_at: str) -> DataFrame:
    """Every posting with its class of near duplicates (the least id reachable by links), its number
    of links, and in how many of them it is the one to drop."""
    from ..operators.similarity import fuzzy_links

    columns = ["job_id", "job_title", "company_name", "source", "date_posted", "final_salary_min"]
    slim = store(mart.select(*columns), f"{store_at}/mart")
    judged = slim.withColumn("unpaid", F.col("final_salary_min").isNull().cast("int")).withColumn("rank", rules.provider_rank("source"))
    links = fuzzy_links(
        judged, "job_id", "job_title", "company_name", "date_posted", ("unpaid", "rank"), f"{store_at}/links", ("unpaid", "rank")
    )
    out = slim.join(links.withColumnRenamed("id", "job_id"), "job_id", "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_links", "n_lost")]
    return out.select(*columns, F.coalesce("class_id", "job_id").alias("class_id"), *counts)

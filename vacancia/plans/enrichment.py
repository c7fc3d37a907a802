"""Labelling work list, response validation, label rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import quality
from ..operators.joins import union_all, unlabelled
from ..sources.landing import text_field, with_payload

PATHS = {
    "jsearch": ("$.job_id", "$.job_title", "$.job_description"),
    "theirstack": ("$.id", "$.job_title", "$.description"),
    "builtin": ("$.identifier.value", "$.title", "$.description"),
}


def raw_postings(landing: Mapping[str, DataFrame]) -> DataFrame:
    """Id, source tag, title and raw description of every landing row that has an id."""
    frames = []
    for name, rows in landing.items():
        id_path, title_path, text_path = PATHS[name]
        frames.append(
            with_payload(rows).select(
                text_field(id_path).alias("job_id"),
                "source",
                text_field(title_path).alias("job_title"),
                text_field(text_path).alias("description"),
                "ingested_at",
            )
        )
    return union_all(frames).where(F.col("job_id").isNotNull())


def work_list(
    landing: Mapping[str, DataFrame], enrichment: DataFrame, null_aware: bool = False, every_landing: bool = False
) -> DataFrame:
    """Postings that still need labels, in source and id order.

    A posting landed in several runs appears once (its newest landing), unless
    ``every_landing`` asks for each of them.
    """
    from ..operators.dedupe import latest_per_key

    todo = unlabelled(raw_postings(landing), enrichment, "job_id", null_aware)
    if not every_landing:
        todo = latest_per_key(todo, ["job_id"], ["ingested_at", "source"])
    return todo.select("job_id", "source", "job_title", "description").orderBy("source", "job_id")


def label_rows(
    jobs: DataFrame, responses: DataFrame, response: str, model_version: str, enriched_at: Column
) -> tuple[DataFrame, DataFrame]:
    """Enrichment rows for ``jobs`` and the quarantined responses.

    ``responses`` holds (job_id, attempt, response text); the first valid attempt counts.
    Postings without a description are skipped.
    """
    with_text = jobs.where(F.coalesce("description", F.lit("")) != "").select("job_id", "source")
    checked = quality.validate(responses.join(with_text, "job_id"), response)
    _, quarantined = quality.split_valid(checked)
    first = quality.first_valid_attempt(checked, "job_id", "attempt")
    stamped = first.withColumn("enriched_at", enriched_at).withColumn("model_version", F.lit(model_version))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ENRICHMENT.fields]
    return stamped.select(*typed), quarantined

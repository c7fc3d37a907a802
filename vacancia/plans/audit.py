"""Common audit layout over the raw payloads of all providers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profiling
from ..operators.joins import union_all
from ..sources.landing import field, text_field, with_payload


def audit_layout(landing: Mapping[str, DataFrame]) -> DataFrame:
    """Raw title, description, place, flags and salary of every landing row.

    Columns a provider lacks are NULL; providers without a location text use the city. Nested
    pay counts only when it is by the year.
    """
    yearly = text_field("$.baseSalary.value.unitText") == "YEAR"
    layouts = {
        "jsearch": {
            "job_title": text_field("$.job_title"),
            "description": text_field("$.job_description"),
            "city": text_field("$.job_city"),
            "state": text_field("$.job_state"),
            "location_string": text_field("$.job_location"),
            "latitude": field("$.job_latitude", "double"),
            "longitude": field("$.job_longitude", "double"),
            "is_remote": field("$.job_is_remote", "boolean"),
            "employment_type": text_field("$.job_employment_type"),
            "min_salary": field("$.job_min_salary", "double"),
            "max_salary": field("$.job_max_salary", "double"),
            "salary_period": text_field("$.job_salary_period"),
        },
        "theirstack": {
            "job_title": text_field("$.job_title"),
            "description": text_field("$.description"),
            "city": text_field("$.short_location"),
            "state": text_field("$.state_code"),
            "location_string": text_field("$.location"),
            "latitude": field("$.latitude", "double"),
            "longitude": field("$.longitude", "double"),
            "is_remote": field("$.remote", "boolean"),
            "is_hybrid": field("$.hybrid", "boolean"),
            "employment_type": text_field("$.employment_statuses[0]"),
            "min_salary": field("$.min_annual_salary_usd", "double"),
            "max_salary": field("$.max_annual_salary_usd", "double"),
        },
        "builtin": {
            "job_title": text_field("$.title"),
            "description": text_field("$.description"),
            "city": text_field("$.jobLocation.address.addressLocality"),
            "state": text_field("$.jobLocation.address.addressRegion"),
            "location_string": text_field("$.jobLocation.address.addressLocality"),
            "latitude": field("$.jobLocation.geo.latitude", "double"),
            "longitude": field("$.jobLocation.geo.longitude", "double"),
            "is_remote": F.coalesce(text_field("$.jobLocationType") == "TELECOMMUTE", F.lit(False)),
            "employment_type": text_field("$.employmentType"),
            "min_salary": F.when(yearly, field("$.baseSalary.value.minValue", "double")),
            "max_salary": F.when(yearly, field("$.baseSalary.value.maxValue", "double")),
            "salary_period": text_field("$.baseSalary.value.unitText"),
        },
    }
    frames = [
        with_payload(rows).select(
            F.lit(name).alias("source"), *[c.alias(k) for k, c in layouts[name].items()]
        )
        for name, rows in landing.items()
    ]
    return union_all(frames, allow_missing=True)


def geo_audit(layout: DataFrame) -> DataFrame:
    city = F.col("city").isNotNull() & (F.col("city") != "")
    return profiling.presence_audit(
        layout,
        {
            "has_lat_long": F.col("latitude").isNotNull(),
            "has_city": city,
            "has_state": F.col("state").isNotNull(),
            "has_location_string": F.col("location_string").isNotNull(),
        },
        ["source"],
    )


def title_keywords(layout: DataFrame) -> DataFrame:
    return profiling.keyword_matrix(
        layout, "job_title", profiling.SENIORITY_KEYWORDS, ["source"], profiling.NO_SENIORITY
    )


def work_model_audit(layout: DataFrame) -> DataFrame:
    place = F.col("location_string").isNotNull() & (F.col("location_string") != "")
    return profiling.tristate_audit(
        layout, ["is_remote", "is_hybrid"], ["source"], "min_salary", {"has_location_string": place}
    )


def title_work_model(layout: DataFrame) -> DataFrame:
    """Titles that name a work model, per provider."""
    return profiling.keyword_matrix(layout, "job_title", profiling.WORK_MODEL_KEYWORDS, ["source"])

"""Provider payloads to one staging layout of 19 columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..functions.text import html_to_text, snake
from ..operators.dedupe import latest_per_key
from ..operators.filters import exclude_titles, require
from ..sources.landing import date_field, field, text_field, with_payload


@dataclass(frozen=True)
class ProviderSpec:
    """Where a provider keeps each staging column; ``columns`` builds the expressions."""

    name: str
    columns: Callable[[], Mapping[str, Column]]


def _flat_one() -> dict[str, Column]:
    title, unit = text_field("$.job_title"), text_field("$.job_salary_period")
    return {
        "job_id": text_field("$.job_id"),
        "job_title": title,
        "company_name": text_field("$.employer_name"),
        "job_url": text_field("$.job_apply_link"),
        "date_posted": date_field("$.job_posted_at_datetime_utc"),
        "description": text_field("$.job_description"),
        "city": text_field("$.job_city"),
        "state": text_field("$.job_state"),
        "country": text_field("$.job_country"),
        "latitude": field("$.job_latitude", "double"),
        "longitude": field("$.job_longitude", "double"),
        "work_model": rules.first_match(
            [
                (rules.title_says(title, "remote"), "remote"),
                (rules.title_says(title, "hybrid"), "hybrid"),
                (field("$.job_is_remote", "boolean"), "remote"),
            ],
            "onsite",
        ),
        "employment_type": rules.employment_type(text_field("$.job_employment_type"), hyphenated=True),
        "salary_min": rules.annual_salary(field("$.job_min_salary", "double"), unit),
        "salary_max": rules.annual_salary(field("$.job_max_salary", "double"), unit),
        "listed_seniority": F.lit(None).cast("string"),
    }


def _flat_two() -> dict[str, Column]:
    return {
        "job_id": text_field("$.id"),
        "job_title": text_field("$.job_title"),
        "company_name": text_field("$.company"),
        "job_url": text_field("$.url"),
        "date_posted": date_field("$.date_posted"),
        "description": text_field("$.description"),
        "city": F.split_part(text_field("$.short_location"), F.lit(","), F.lit(1)),
        "state": text_field("$.state_code"),
        "country": text_field("$.country_code"),
        "latitude": field("$.latitude", "double"),
        "longitude": field("$.longitude", "double"),
        "work_model": rules.first_match(
            [(field("$.remote", "boolean"), "remote"), (field("$.hybrid", "boolean"), "hybrid")], "onsite"
        ),
        "employment_type": rules.employment_type(text_field("$.employment_statuses[0]")),
        "salary_min": field("$.min_annual_salary_usd", "double"),
        "salary_max": field("$.max_annual_salary_usd", "double"),
        "listed_seniority": snake(text_field("$.seniority")),
    }


# Fixed value: amounts below this are not yearly pay, whatever their unit says.
YEARLY_FLOOR = 1000


def _nested() -> dict[str, Column]:
    title, unit = text_field("$.title"), text_field("$.baseSalary.value.unitText")
    return {
        "job_id": text_field("$.identifier.value"),
        "job_title": title,
        "company_name": text_field("$.hiringOrganization.name"),
        "job_url": text_field("$.source_url"),
        "date_posted": date_field("$.datePosted"),
        "description": html_to_text(text_field("$.description")),
        "city": text_field("$.jobLocation.address.addressLocality"),
        "state": text_field("$.jobLocation.address.addressRegion"),
        "country": text_field("$.jobLocation.address.addressCountry"),
        "latitude": field("$.jobLocation.geo.latitude", "double"),
        "longitude": field("$.jobLocation.geo.longitude", "double"),
        "work_model": rules.first_match(
            [
                (rules.is_code(text_field("$.jobLocationType"), "TELECOMMUTE"), "remote"),
                (rules.title_says(title, "remote"), "remote"),
                (rules.title_says(title, "hybrid"), "hybrid"),
            ],
            "onsite",
        ),
        "employment_type": rules.employment_type(text_field("$.employmentType")),
        "salary_min": rules.annual_salary(field("$.baseSalary.value.minValue", "double"), unit, YEARLY_FLOOR),
        "salary_max": rules.annual_salary(field("$.baseSalary.value.maxValue", "double"), unit, YEARLY_FLOOR),
        "listed_seniority": snake(text_field("$.seniority"), ("not_found",)),
    }


PROVIDERS = {
    "jsearch": ProviderSpec("jsearch", _flat_one),
    "theirstack": ProviderSpec("theirstack", _flat_two),
    "builtin": ProviderSpec("builtin", _nested),
}


#: Flag column: the posting has a description.
DESCRIBED = "__described"

# Order of the landings of one posting, newest first.
NEWEST = ["ingested_at", "ingestion_query"]


def extract(landing: DataFrame, spec: ProviderSpec, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Typed staging columns of one provider's landing rows, nothing dropped; ``extra`` adds
    further ones from the payload."""
    docs = with_payload(landing)
    tag = F.split_part(F.col("source"), F.lit(":"), F.lit(2))
    columns = {
        "source": F.split_part(F.col("source"), F.lit(":"), F.lit(1)),
        "ingestion_query": F.nullif(tag, F.lit("")),
        "ingested_at": F.col("ingested_at"),
        **spec.columns(),
    }
    more = [column.alias(name) for name, column in (extra or {}).items()]
    return docs.select(*[columns[name].alias(name) for name in schemas.STAGING_COLUMNS], *more)


def stage(
    landing: DataFrame, spec: ProviderSpec, null_keys: str = "collapse", extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Newest landing per posting, then the row filters.

    Whether a posting is described is settled before the choice: a result without descriptions
    then shuffles a flag, not the texts.
    """
    return wanted(latest_per_key(described(extract(landing, spec, extra)), ["job_id"], NEWEST, null_keys))


def described(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DESCRIBED, F.col("description").isNotNull())


def wanted(newest: DataFrame) -> DataFrame:
    """The row filters of staging, on :func:`described` rows; the flag is dropped."""
    return exclude_titles(require(newest, ["job_title"]).where(DESCRIBED), "job_title").drop(DESCRIBED)

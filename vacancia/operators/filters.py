"""Row filters and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.arrays import any_of, array_union_all
from ..functions.text import as_column, contains_any


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def exclude_titles(
    df: DataFrame,
    column: str,
    terms: Sequence[str] = tuple(rules.SENIOR_TERMS),
    word_boundary: bool = False,
) -> DataFrame:
    """Drop rows whose title holds a listed term; a NULL title is dropped as well."""
    return df.where(~contains_any(column, list(terms), word_boundary))


def keep_titles(df: DataFrame, column: str, alternatives: Sequence[str]) -> DataFrame:
    """Keep rows whose title holds one of the phrases, ignoring case."""
    text = F.coalesce(F.col(column), F.lit(""))
    return df.where(text.rlike("(?i)" + "|".join(alternatives)))


def drop_value_keep_null(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where((F.col(column) != value) | F.col(column).isNull())


def exclude_value(df: DataFrame, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows without the value, and a one-row frame counting what was left out."""
    is_value = F.col(column).eqNullSafe(F.lit(value))
    return df.where(~is_value), df.agg(F.count_if(is_value).alias("n_excluded"))


def flag_regex(df: DataFrame, column: str, pattern: str, out: str) -> DataFrame:
    hit = F.col(column).rlike(f"(?i){pattern}")
    return df.withColumn(out, F.coalesce(hit, F.lit(False)))


def outliers(df: DataFrame, column: str, high: float) -> DataFrame:
    return df.where(F.col(column) > high)


def nulled_by_rule(df: DataFrame, raw: Column | str, clean: Column | str) -> DataFrame:
    """Rows whose raw value was present but did not survive cleaning."""
    return df.where(as_column(raw).isNotNull() & as_column(clean).isNull())


def filled_by_fallback(df: DataFrame, first: Column | str, second: Column | str) -> DataFrame:
    return df.where(as_column(first).isNull() & as_column(second).isNotNull())


def backfill_candidates(df: DataFrame, value: Column | str, ts: str) -> DataFrame:
    """Rows that lack the value, newest first."""
    return df.where(as_column(value).isNull()).orderBy(F.col(ts).desc_nulls_last())


def min_group_size(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of groups that have at least ``n`` rows."""
    big = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") >= n)
    return df.join(big.select(key), key, "left_semi")


@dataclass(frozen=True)
class SearchSpec:
    """Declarative posting search; empty parts do not filter."""

    title_any: Sequence[str] = ()
    title_none: Sequence[str] = ()
    location_any: Sequence[str] = ()
    allow: Mapping[str, Sequence[str]] = field(default_factory=dict)
    deny: Mapping[str, Sequence[str]] = field(default_factory=dict)
    max_age_days: int | None = None
    title: str = "job_title"
    location: str = "location"
    posted: str = "date_posted"
    discovered: str = "discovered_at"


# Default search of the second provider.
DEFAULT_TITLE_NONE = [
    "(?i)senior", r"(?i)\bsr\b", r"(?i)\bii\b", r"(?i)\biii\b", r"(?i)\biv\b", "(?i)lead",
    "(?i)principal", "(?i)staff", "(?i)manager", "(?i)director", "(?i)head of", "(?i)unpaid",
    "(?i)non.paid", "(?i)volunteer",
]
DEFAULT_LOCATION_ANY = ["(?i)^new york,", "(?i)new york city", "(?i)manhattan", "(?i)brooklyn"]
DEFAULT_SENIORITIES = ["junior", "mid_level"]
DEFAULT_COUNTRIES = ["US"]
DEFAULT_MAX_AGE_DAYS = 7

# Publishers the first provider is asked to leave out, and the employment it is asked for.
DENIED_PUBLISHERS = [
    "Talent.com", "Learn4Good", "JobLeads", "BeBee", "WhatJobs", "Jobilize", "Jooble", "Adzuna",
    "Ladders", "Snagajob", "Institute Of Data Jobs", "Tech Engineer Jobs", "Allied-IT Jobs",
    "United States Jobs Expertini", "Trigyn Technologies", "Trigyn", "Resume-Library.com", "Sign In",
]
WANTED_EMPLOYMENT = ["FULLTIME"]

# Title phrases worth landing.
RELEVANT_TITLES = ["data analyst", "data engineer", "analytics engineer", "data scientist"]


def default_search(title_any: Sequence[str]) -> SearchSpec:
    """The second provider's standing search for one role."""
    return SearchSpec(
        title_any=title_any,
        title_none=DEFAULT_TITLE_NONE,
        location_any=DEFAULT_LOCATION_ANY,
        allow={"seniority": DEFAULT_SENIORITIES, "country_code": DEFAULT_COUNTRIES},
        max_age_days=DEFAULT_MAX_AGE_DAYS,
    )


def publisher_search() -> SearchSpec:
    """The first provider's standing search: full-time postings of publishers that are not left out."""
    return SearchSpec(
        deny={"job_publisher": DENIED_PUBLISHERS}, allow={"job_employment_type": WANTED_EMPLOYMENT},
        discovered="ingested_at",
    )


def search_predicate(spec: SearchSpec, as_of: Column | None = None, since: Column | None = None) -> Column:
    out = F.lit(True)

    def any_pattern(column: str, patterns: Sequence[str]) -> Column:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | F.col(column).rlike(pattern)
        return hit

    if spec.title_any:
        out = out & any_pattern(spec.title, spec.title_any)
    if spec.title_none:
        out = out & ~any_pattern(spec.title, spec.title_none)
    if spec.location_any:
        out = out & any_pattern(spec.location, spec.location_any)
    for column, values in spec.allow.items():
        out = out & F.col(column).isin(list(values))
    for column, values in spec.deny.items():
        out = out & (F.col(column).isNull() | ~F.col(column).isin(list(values)))
    if spec.max_age_days is not None:
        today = F.current_date() if as_of is None else as_of
        out = out & (F.col(spec.posted) >= F.date_sub(today, spec.max_age_days))
    if since is not None:
        out = out & (F.col(spec.discovered) >= since)
    return out


def search(
    df: DataFrame, spec: SearchSpec, as_of: Column | None = None, since: Column | None = None,
    newest_first: bool = True,
) -> DataFrame:
    found = df.where(search_predicate(spec, as_of, since))
    return found.orderBy(F.col(spec.discovered).desc_nulls_last()) if newest_first else found


@dataclass(frozen=True)
class ExplorerSpec:
    """Facet selection over the mart; every part is optional and parts combine with AND."""

    facets: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags: Sequence[str] = ()
    required: Sequence[str] = ()
    ranges: Sequence[tuple[str, str, float, float]] = ()
    recent: tuple[str, int] | None = None
    any_of: tuple[Sequence[str], Sequence[str]] | None = None
    search: tuple[Sequence[str], str] | None = None
    literal_search: bool = False


def explorer_predicate(spec: ExplorerSpec, as_of: Column | None = None) -> Column:
    out = F.lit(True)
    for column, values in spec.facets.items():
        if values:
            out = out & F.col(column).isin(list(values))
    for column in spec.flags:
        out = out & F.coalesce(F.col(column), F.lit(False))
    for column in spec.required:
        out = out & F.col(column).isNotNull()
    for low_column, high_column, low, high in spec.ranges:
        out = out & (F.col(high_column) >= low) & (F.col(low_column) <= high)
    if spec.recent:
        column, days = spec.recent
        today = F.current_date() if as_of is None else as_of
        start, end = F.date_sub(today, days), F.date_add(today, 1)
        out = out & (F.col(column).isNull() | ((F.col(column) >= start) & (F.col(column) < end)))
    if spec.any_of and spec.any_of[1]:
        columns, values = spec.any_of
        out = out & any_of(array_union_all(*columns), list(values))
    if spec.search and spec.search[1]:
        columns, query = spec.search
        hit = F.lit(False)
        for column in columns:
            text = F.lower(F.col(column))
            found = text.contains(query) if spec.literal_search else text.rlike(query)
            hit = hit | F.coalesce(found, F.lit(False))
        out = out & hit
    return F.coalesce(out, F.lit(False))


def active_range(
    bounds: tuple[float, float], low_column: str, high_column: str, low: float, high: float
) -> list[tuple[str, str, float, float]]:
    """A range only filters when it is narrower than the bounds of the data."""
    if low > bounds[0] or high < bounds[1]:
        return [(low_column, high_column, low, high)]
    return []


def range_bounds(df: DataFrame, low_column: str, high_column: str, cap: float = 300_000) -> DataFrame:
    """One row: slider bounds over rows with both ends, the upper end capped."""
    both = F.col(low_column).isNotNull() & F.col(high_column).isNotNull()
    low = F.min(F.when(both, F.col(low_column))).cast("bigint")
    high = F.max(F.when(both, F.col(high_column))).cast("bigint")
    cap_col = F.lit(cap).cast("bigint")
    return df.agg(
        F.coalesce(low, F.lit(0).cast("bigint")).alias("low"),
        F.least(F.coalesce(high, cap_col), cap_col).alias("high"),
    )


def explorer_summary(df: DataFrame, spec: ExplorerSpec, as_of: Column | None = None) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"), F.count_if(explorer_predicate(spec, as_of)).alias("filtered")
    )

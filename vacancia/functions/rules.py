"""Ordered label rules: work model, employment type, salary gates, role buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from .text import as_column

# Title terms that mark a posting as senior.
SENIOR_TERMS = [
    "senior", r"sr\.?", "lead", "principal", "staff", "manager", "director", "vp",
    "vice president", "avp", "head of", "architect", "chief", "svp", "evp", "gvp",
    "president", "officer", "executive", "leader",
]

# Title terms that mark a posting as entry level.
ENTRY_TERMS = ["entry", "junior", r"jr\.?", "new.?grad", "early.?career"]
ENTRY_FLAG_TERMS = ["entry", "junior", r"jr\.?", "associate", "new.?grad", "early.?career"]

# Wildcard patterns per role, tested in this order.
ROLE_PATTERNS = [
    ("Analytics Engineer", ["%analytics engineer%"]),
    ("Data Scientist", ["%data scientist%", "%data science%engineer%"]),
    ("Data Engineer", ["%data%engineer%"]),
    ("Data Analyst", ["%data%analyst%", "%data analytics%"]),
]

# Spellings of the employment types.
FULL_TIME = ["FULL_TIME", "FULLTIME"]
PART_TIME = ["PART_TIME", "PARTTIME"]
CONTRACT = ["CONTRACT", "CONTRACTOR"]


def first_match(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Value of the first condition that holds; NULL conditions do not hold."""
    out: Column = F.lit(default)
    for condition, value in reversed(list(rules)):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def title_says(title: Column | str, word: str) -> Column:
    return F.lower(as_column(title)).contains(word)


def is_code(value: Column | str, code: str) -> Column:
    return F.upper(as_column(value)) == code


def employment_type(value: Column | str, hyphenated: bool = False) -> Column:
    """Employment type from its spelling; unknown or missing is ``other``."""
    code = F.upper(as_column(value))
    full = FULL_TIME + (["FULL-TIME"] if hyphenated else [])
    part = PART_TIME + (["PART-TIME"] if hyphenated else [])
    return first_match(
        [
            (code.isin(full), "full_time"),
            (code.isin(part), "part_time"),
            (code.isin(CONTRACT), "contract"),
        ],
        "other",
    )


def employment_type_loose(value: Column | str) -> Column:
    """Substring form of :func:`employment_type`; a missing value stays NULL."""
    text = F.lower(F.trim(as_column(value)))
    named = first_match(
        [
            (text.contains("full"), "full_time"),
            (text.contains("part"), "part_time"),
            (text.contains("contract"), "contract"),
        ],
        "other",
    )
    return F.when(as_column(value) != "", named)


def annual_salary(amount: Column | str, unit: Column | str | None = None, floor: float | None = None) -> Column:
    """Amount kept when its unit is a year (if a unit is given) and it reaches ``floor``."""
    c = as_column(amount)
    keep = F.lit(True)
    if unit is not None:
        keep = keep & is_code(unit, "YEAR")
    if floor is not None:
        keep = keep & (c >= floor)
    return F.when(keep, c)


def bucket_by_ilike(value: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    c = as_column(value)
    conditions = []
    for label, patterns in rules:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | c.ilike(pattern)
        conditions.append((hit, label))
    return first_match(conditions, default)


def bucket_by_regex(value: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose regex occurs in the value, ignoring case."""
    c = as_column(value)
    return first_match([(c.rlike(f"(?i){pattern}"), label) for label, pattern in rules], default)


def title_role_bucket(title: Column | str) -> Column:
    return bucket_by_ilike(title, ROLE_PATTERNS, schemas.NO_ROLE)


def title_level(title: Column | str) -> Column:
    """Senior / explicitly entry / unlabelled, from the title alone."""
    return bucket_by_regex(
        title,
        [("senior_filtered", "|".join(SENIOR_TERMS)), ("explicitly_entry", "|".join(ENTRY_TERMS))],
        "unlabeled_middle",
    )


def early_career_tier(source: Column | str, listed: Column | str) -> Column:
    """Two-level tier for providers that label seniority themselves, else NULL."""
    labelled = as_column(source).isin("builtin", "theirstack")
    level = as_column(listed)
    return first_match(
        [
            (labelled & level.isin("entry_level", "junior"), "entry_or_junior"),
            (labelled & (level == "mid_level"), "mid"),
        ],
        None,
    ).cast("string")


def provider_rank(source: Column | str) -> Column:
    """Preference order of the providers, best first; unknown providers are NULL."""
    c = as_column(source)
    out = F.lit(None).cast("int")
    for name, rank in schemas.PROVIDER_RANK.items():
        out = F.when(c == name, F.lit(rank)).otherwise(out)
    return out

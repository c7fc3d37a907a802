"""Array and semi-structured expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

STRINGS = "array<string>"


def empty_strings() -> Column:
    return F.array().cast(STRINGS)


def or_empty(value: Column | str) -> Column:
    return F.coalesce(as_column(value), empty_strings())


def array_union_all(*values: Column | str) -> Column:
    """Concatenate arrays, keeping repeats; a NULL array counts as empty."""
    return F.concat(*[or_empty(v) for v in values])


def non_empty(value: Column | str) -> Column:
    return F.coalesce(F.size(as_column(value)) > 0, F.lit(False))


def any_of(value: Column, wanted: list[str]) -> Column:
    return F.coalesce(
        F.arrays_overlap(value, F.array(*[F.lit(w) for w in wanted])), F.lit(False)
    )


def classify_by_sets(value: Column | str, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """Label of the first rule whose set meets the array, compared in lower case."""
    lowered = F.transform(or_empty(value), F.lower)
    out = F.lit(default)
    for label, members in reversed(rules):
        out = F.when(any_of(lowered, members), F.lit(label)).otherwise(out)
    return out


def parse_strings(value: Column | str) -> Column:
    """JSON text to an array of strings.

    Anything that is not a JSON array gives an empty array; elements that are not
    strings are dropped, as the counting operators skip them.
    """
    parsed = F.try_variant_get(F.try_parse_json(as_column(value)), "$", "array<variant>")
    kept = F.filter(parsed, lambda v: F.schema_of_variant(v) == "STRING")
    texts = F.transform(kept, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(texts, empty_strings())


def safe_cast(value: Column | str, to: str) -> Column:
    """Cast that yields NULL for malformed input instead of failing the job."""
    return as_column(value).try_cast(to)


def truthy(value: Column | str) -> Column:
    """TRUE, 1 and YES are true; everything else, NULL included, is false."""
    text = F.upper(F.trim(as_column(value).cast("string")))
    return F.coalesce(text.isin("TRUE", "1", "YES"), F.lit(False))

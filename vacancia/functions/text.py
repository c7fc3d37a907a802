"""Text expressions: cleaning, keys, regex tests, display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the full-width dollar sign used in salary ranges.
DOLLAR = "＄"
DASH = "—"

# Display names.
SOURCE_NAMES = {"builtin": "Built In NYC", "jsearch": "JSearch", "theirstack": "TheirStack"}
SENIORITY_LABELS = {
    "entry": "Entry Level", "entry_level": "Entry Level", "junior": "Junior",
    "mid": "Mid Level", "mid_level": "Mid Level", "senior": "Senior",
}
DEGREE_LABELS = {
    "none": "No Degree Required", "bachelors": "Bachelor's", "masters": "Master's",
    "equivalent_ok": "Experience Accepted",
}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_whitespace(value: Column | str) -> Column:
    """Strip every kind of whitespace at both ends; ``trim`` removes spaces only."""
    return F.regexp_replace(as_column(value), r"(?U)^\s+|\s+$", "")


def normal_text(value: Column | str) -> Column:
    return F.lower(F.trim(as_column(value)))


def dedup_key(title: Column | str, company: Column | str) -> Column:
    """``title | company`` lower-cased and trimmed; NULL when either part is NULL."""
    return F.concat(normal_text(title), F.lit(" | "), normal_text(company))


def role_key(value: Column | str) -> Column:
    """Role name as a lower-case identifier: ``Data Analyst`` -> ``data_analyst``."""
    return F.translate(F.lower(as_column(value)), " -", "__")


def snake(value: Column | str, sentinels: tuple[str, ...] = ()) -> Column:
    """Lower-case with underscores for spaces; listed sentinels become NULL."""
    out = F.replace(F.lower(as_column(value)), F.lit(" "), F.lit("_"))
    return F.when(~out.isin(list(sentinels)), out) if sentinels else out


def preview(value: Column | str, n: int = 120) -> Column:
    return F.substring(as_column(value).cast("string"), 1, n)


def html_to_text(value: Column | str, mode: str = "entities_first") -> Column:
    """HTML to plain text.

    ``entities_first`` decodes the four common entities (ampersand first, so text that
    was escaped twice decodes twice) and then drops tags; ``tags_first`` drops tags
    before it decodes.
    """
    text = as_column(value)

    def decode(c: Column) -> Column:
        # The entities and the order in which they are decoded.
        for entity, plain in (("&amp;", "&"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")):
            c = F.replace(c, F.lit(entity), F.lit(plain))
        return c

    def drop_tags(c: Column) -> Column:
        return F.regexp_replace(c, "<[^>]+>", " ")

    if mode == "entities_first":
        text = drop_tags(decode(text))
    elif mode == "tags_first":
        text = decode(drop_tags(text))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def regex_full_match(value: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Whole-string regex test, where ``rlike`` would accept a match anywhere."""
    flag = "(?i)" if ignore_case else ""
    return as_column(value).rlike(rf"{flag}\A(?:{pattern})\z")


def contains_any(value: Column | str, terms: list[str], word_boundary: bool = False) -> Column:
    """True when one of the regex ``terms`` occurs on the only line of ``value``."""
    body = "|".join(terms)
    body = rf"\b({body})\b" if word_boundary else f"({body})"
    return regex_full_match(F.lower(as_column(value)), f".*{body}.*")


def map_values(value: Column | str, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Dictionary lookup; values outside the dictionary become ``default`` (NULL)."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), as_column(value))
    return found if default is None else F.coalesce(found, default)


def title_case(value: Column | str) -> Column:
    """Upper-case the letter after every non-letter, lower-case the rest."""
    words = F.split(as_column(value), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(words, F.initcap), "")


def format_source(value: Column | str) -> Column:
    return map_values(value, SOURCE_NAMES, as_column(value))


def format_label(value: Column | str) -> Column:
    return title_case(F.replace(as_column(value), F.lit("_"), F.lit(" ")))


def format_seniority(value: Column | str) -> Column:
    c = as_column(value)
    known = map_values(c, SENIORITY_LABELS, format_label(c))
    return F.when(c.isNull() | (c == ""), F.lit(DASH)).otherwise(known)


def format_degree(value: Column | str) -> Column:
    c = as_column(value)
    return F.coalesce(map_values(c, DEGREE_LABELS, F.nullif(format_label(c), F.lit(""))), F.lit(DASH))


def format_salary(low: Column | str, high: Column | str) -> Column:
    def money(c: Column) -> Column:
        return F.concat(F.lit(DOLLAR), F.format_number(c.cast("bigint"), 0))

    lo, hi = money(as_column(low)), money(as_column(high))
    return F.coalesce(
        F.concat(lo, F.lit(" - "), hi),
        F.concat(lo, F.lit("+")),
        F.concat(F.lit("up to "), hi),
        F.lit("Not disclosed"),
    )


def format_years(low: Column | str, high: Column | str) -> Column:
    lo, hi = as_column(low).cast("int").cast("string"), as_column(high).cast("int").cast("string")
    return F.coalesce(
        F.concat(lo, F.lit("–"), hi, F.lit(" yrs")),
        F.concat(lo, F.lit("+ yrs")),
        F.concat(F.lit("up to "), hi, F.lit(" yrs")),
        F.lit("Not specified"),
    )


def format_location(city: Column | str, state: Column | str, work_model: Column | str) -> Column:
    def present(c: Column | str) -> Column:
        return F.nullif(as_column(c), F.lit(""))

    place = F.nullif(F.concat_ws(", ", present(city), present(state)), F.lit(""))
    remote = F.when(F.lower(as_column(work_model)) == "remote", F.lit("Remote"))
    return F.coalesce(place, remote, F.lit("Unknown"))

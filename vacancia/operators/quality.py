"""Data-quality rules and validation of model responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.arrays import empty_strings
from ..functions.text import strip_whitespace
from .dedupe import top_rows


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: Sequence[str]


@dataclass(frozen=True)
class Freshness:
    """Age limits of the newest row, in hours; ``as_of`` defaults to now."""

    column: str
    warn_hours: int = 72
    error_hours: int = 144
    as_of: Column | None = None


Rule = Unique | NotNull | Accepted

# The rules of the mart.
MART_RULES: list[Rule] = [
    Unique("job_id"),
    NotNull("job_id"),
    NotNull("source"),
    Accepted("source", schemas.PROVIDERS),
    NotNull("job_title"),
    Accepted("work_model", schemas.WORK_MODELS),
    Accepted("employment_type", schemas.EMPLOYMENT_TYPES),
    Accepted("title_role_bucket", [*schemas.ROLES, schemas.NO_ROLE]),
]


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: failures and pass/fail. Row rules share one pass over the table."""
    cells = []
    per_row = [r for r in rules if not isinstance(r, Unique)]
    for i, rule in enumerate(per_row):
        c = F.col(rule.column)
        bad = c.isNull() if isinstance(rule, NotNull) else c.isNotNull() & ~c.isin(list(rule.values))
        cells.append(F.count_if(bad).alias(f"__f{i}"))
    frames = []
    if cells:
        table = F.array(
            *[
                F.struct(
                    F.lit("not_null" if isinstance(r, NotNull) else "accepted_values").alias("rule"),
                    F.lit(r.column).alias("column"),
                    F.col(f"__f{i}").alias("failures"),
                )
                for i, r in enumerate(per_row)
            ]
        )
        frames.append(df.agg(*cells).select(F.explode(table).alias("r")).select("r.*"))
    for rule in rules:
        if isinstance(rule, Unique):
            bad = duplicate_values(df, rule.column).agg(F.count("*").alias("failures"))
            frames.append(bad.select(F.lit("unique").alias("rule"), F.lit(rule.column).alias("column"), "failures"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return per_value.where(F.col("n") > 1)


def failing_rows(df: DataFrame, rule: NotNull | Accepted) -> DataFrame:
    c = F.col(rule.column)
    return df.where(c.isNull() if isinstance(rule, NotNull) else c.isNotNull() & ~c.isin(list(rule.values)))


def freshness(df: DataFrame, rule: Freshness, by: Sequence[str] = ()) -> DataFrame:
    """Newest load time and pass / warn / error by its age; an empty table is an error."""
    now = F.current_timestamp() if rule.as_of is None else rule.as_of
    newest = df.groupBy(*by).agg(F.max(rule.column).alias("latest"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("latest")) / 3600.0
    status = (
        F.when(F.col("latest").isNull() | (age > rule.error_hours), "error")
        .when(age > rule.warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


def enum_drift(df: DataFrame, rules: Sequence[Accepted]) -> DataFrame:
    """Value counts of the ruled columns, with a flag for values outside the rule."""
    frames = []
    for rule in rules:
        c = F.col(rule.column)
        counted = df.groupBy(c.alias("value")).agg(F.count("*").alias("n"))
        known = F.col("value").isNull() | F.col("value").isin(list(rule.values))
        frames.append(counted.select(F.lit(rule.column).alias("column"), "value", "n", (~known).alias("drift")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def count_check(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of table copies: name, old, new, status."""
    out = None
    for name, old, new in pairs:
        n_old = old.agg(F.count("*").alias("n")).scalar()
        row = new.agg(F.count("*").alias("new")).select(F.lit(name).alias("table"), n_old.alias("old"), "new")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("old") == F.col("new"), "ok").otherwise("mismatch"))


def row_text(df: DataFrame) -> Column:
    """A row as one JSON text: columns by name, NULLs spelled out, times to the microsecond."""
    options = {"ignoreNullFields": "false", "timestampFormat": STAMP, "timestampNTZFormat": STAMP}
    return F.to_json(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in sorted(df.columns)]), options)


def content_digest(df: DataFrame) -> DataFrame:
    """One row of a table's content: ``rows`` and ``digest``, whatever the order and the files.

    The digest is the sum over all rows of both halves of the MD5 of the row's text, so a row
    that is missing, doubled or changed in any cell shows. It is one scan with a partial sum per
    task: one small row each is shuffled. An empty table has the digest ``0-0``.
    """
    md5 = F.md5(row_text(df))

    def half(start: int) -> Column:
        number = F.conv(F.substring(md5, start, 16), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("string")

    return df.agg(F.count("*").alias("rows"), F.concat_ws("-", half(1), half(17)).alias("digest"))


def content_check(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Counts and contents of table copies: table, old, new, old_digest, new_digest, status.

    ``status`` is ``ok``, ``mismatch`` where the counts differ, ``changed`` where only cells do.
    """
    out = None
    for name, old, new in pairs:
        before = content_digest(old).select(F.lit(name).alias("table"), F.col("rows").alias("old"), F.col("digest").alias("old_digest"))
        after = content_digest(new).select(F.lit(name).alias("table"), F.col("rows").alias("new"), F.col("digest").alias("new_digest"))
        row = before.join(after, "table")
        out = row if out is None else out.unionByName(row)
    status = (
        F.when(F.col("old") != F.col("new"), "mismatch")
        .when(F.col("old_digest") != F.col("new_digest"), "changed")
        .otherwise("ok")
    )
    return out.select("table", "old", "new", "old_digest", "new_digest", status.alias("status"))


# -- model responses ---------------------------------------------------------------------

# Limits of the response contract.
MAX_FOCUS_WORDS = 10
MAX_ATTEMPTS = 3
STRING_FIELDS = {
    "inferred_seniority": schemas.SENIORITIES,
    "role_archetype": schemas.ARCHETYPES,
    "degree_requirement": schemas.DEGREES,
}
INT_FIELDS = ["years_required_min", "years_required_max", "salary_min", "salary_max"]
BOOL_FIELDS = ["acknowledges_ai", "explicitly_encourages_applicants"]
# Texts accepted as booleans.
TRUE_TEXTS = ["true", "t", "yes", "y", "on", "1"]
FALSE_TEXTS = ["false", "f", "no", "n", "off", "0"]


def validate(df: DataFrame, response: str) -> DataFrame:
    """Check and normalise model responses held as JSON text.

    Adds the typed fields and ``errors`` (array of ``field: reason``, empty when valid).
    A missing array is empty while an explicit null is an error; unknown keys are ignored;
    numeric and boolean texts are converted; enumerations are case-sensitive.
    """
    scalars = [*STRING_FIELDS, "work_focus", *INT_FIELDS, *BOOL_FIELDS, "domain", "confidence_score"]
    doc = "__doc"

    def node(name: str) -> Column:
        return F.try_variant_get(doc, f"$.{name}", "variant")

    def strings(name: str) -> Column:
        """Elements as normalised texts, NULL for one that is not a text."""
        items = F.try_variant_get(doc, f"$.{name}", "array<variant>")
        item = lambda v: F.when(
            F.schema_of_variant(v) == "STRING", F.lower(strip_whitespace(F.try_variant_get(v, "$", "string")))
        )
        return F.transform(items, item)

    # Every field is taken out of the document once, as its kind and its text. The
    # generator keeps later filters on the result from repeating the extraction.
    taken = [F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)).alias("__object")]
    for name in (*scalars, *schemas.ARRAY_COLUMNS):
        taken.append(F.schema_of_variant(node(name)).alias(f"__kind_{name}"))
    for name in scalars:
        taken.append(F.try_variant_get(doc, f"$.{name}", "string").alias(f"__text_{name}"))
    for name in schemas.ARRAY_COLUMNS:
        taken.append(strings(name).alias(f"__strings_{name}"))
    parsed = df.withColumn(doc, F.try_parse_json(F.col(response)))
    parsed = parsed.select(*df.columns, F.inline(F.array(F.struct(*taken))))

    errors: list[Column] = [F.when(~F.col("__object"), F.lit("response: not a JSON object"))]
    fields: dict[str, Column] = {}

    def kind(name: str) -> Column:
        return F.col(f"__kind_{name}")

    def text(name: str) -> Column:
        return F.col(f"__text_{name}")

    def check(name: str, bad: Column, reason: str) -> None:
        failed = F.col("__object") & F.coalesce(bad, F.lit(True))
        errors.append(F.when(failed, F.lit(f"{name}: {reason}")))

    def is_text(name: str) -> Column:
        return F.coalesce(kind(name) == "STRING", F.lit(False))

    def is_bool(name: str) -> Column:
        return F.coalesce(kind(name) == "BOOLEAN", F.lit(False))

    def absent(name: str) -> Column:
        return kind(name).isNull() | (kind(name) == "VOID")

    for name, allowed in STRING_FIELDS.items():
        fields[name] = F.when(is_text(name), text(name))
        check(name, ~(is_text(name) & text(name).isin(allowed)), "not an allowed value")

    focus = strip_whitespace(text("work_focus"))
    words = F.when(focus == "", 0).otherwise(F.size(F.split(focus, r"(?U)\s+")))
    fields["work_focus"] = F.when(is_text("work_focus"), F.lower(focus))
    check("work_focus", ~is_text("work_focus"), "not a text")
    check("work_focus", is_text("work_focus") & (words > MAX_FOCUS_WORDS), "too many words")

    for name in schemas.ARRAY_COLUMNS:
        items = F.col(f"__strings_{name}")
        fields[name] = F.coalesce(items, empty_strings())
        is_list = kind(name).startswith("ARRAY") & F.forall(items, lambda v: v.isNotNull())
        check(name, ~F.when(kind(name).isNull(), True).otherwise(is_list), "not a list of texts")

    def number(name: str, to: str) -> Column:
        """Numbers and numeric texts; true and false count as 1 and 0."""
        flag = F.when(text(name) == "true", 1).otherwise(0).cast(to)
        return F.when(is_bool(name), flag).otherwise(strip_whitespace(text(name)).try_cast(to))

    for name in INT_FIELDS:
        exact = number(name, "decimal(38,6)")
        value = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
        fields[name] = F.when(~absent(name), value)
        check(name, ~absent(name) & value.isNull(), "not a whole number")

    for name in BOOL_FIELDS:
        word, amount = F.lower(text(name)), text(name).try_cast("double")
        numeric = ~is_text(name) & ~is_bool(name) & ~absent(name)
        fields[name] = (
            F.when(numeric & (amount == 1.0), True)
            .when(numeric & (amount == 0.0), False)
            .when(~numeric & word.isin(TRUE_TEXTS), True)
            .when(~numeric & word.isin(FALSE_TEXTS), False)
        )
        check(name, fields[name].isNull(), "not a boolean")

    stated = is_text("domain") & (text("domain") != "")
    fields["domain"] = F.when(stated, F.lower(strip_whitespace(text("domain"))))
    check("domain", ~absent("domain") & ~is_text("domain"), "not a text")

    score = number("confidence_score", "double")
    fields["confidence_score"] = score
    check("confidence_score", score.isNull(), "not a number")
    check("confidence_score", score.isNotNull() & ~score.between(0.0, 1.0), "outside 0.0-1.0")

    low, high = fields["years_required_min"], fields["years_required_max"]
    check("years_required", low.isNotNull() & high.isNotNull() & (low > high), "min above max")

    return parsed.select(
        *df.columns,
        *[fields[name].alias(name) for name in fields],
        F.array_compact(F.array(*errors)).alias("errors"),
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and quarantined rows with their reasons."""
    good = F.size("errors") == 0
    return checked.where(good).drop("errors"), checked.where(~good)


def first_valid_attempt(
    checked: DataFrame, key: str, attempt: str, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """The earliest valid response per posting among the allowed attempts."""
    valid = checked.where((F.size("errors") == 0) & (F.col(attempt) <= max_attempts))
    return top_rows(valid, [key], [F.col(attempt).asc()]).drop("errors")


def batch_outcome(
    jobs: DataFrame, valid: DataFrame, key: str = "job_id", description: str = "description"
) -> DataFrame:
    """One row: succeeded, failed, skipped, total and the verdict of a labelling batch."""
    done = valid.select(F.col(key).alias("__done")).distinct()
    joined = jobs.join(done, F.col(key) == F.col("__done"), "left")
    no_text = F.coalesce(F.col(description), F.lit("")) == ""
    tallied = joined.agg(
        F.count_if(~no_text & F.col("__done").isNotNull()).alias("succeeded"),
        F.count_if(~no_text & F.col("__done").isNull()).alias("failed"),
        F.count_if(no_text).alias("skipped"),
        F.count("*").alias("total"),
    )
    verdict = (
        F.when((F.col("failed") > 0) & (F.col("succeeded") == 0), "total_failure")
        .when(F.col("failed") > 0, "partial_failure")
        .otherwise("ok")
    )
    return tallied.withColumn("verdict", verdict)


def label_flips(old: DataFrame, new: DataFrame, key: str, flag: str) -> DataFrame:
    """Old true labels against their re-run: flipped, stayed or unexpected."""
    rerun = new.select(F.col(key).alias("__key"), F.col(flag).alias("new_value"))
    joined = old.where(F.col(flag)).select(key, F.col(flag).alias("old_value"))
    joined = joined.join(rerun, F.col(key) == F.col("__key"), "left").drop("__key")
    outcome = (
        F.when(~F.col("new_value"), "flipped").when(F.col("new_value"), "stayed").otherwise("unexpected")
    )
    return joined.withColumn("outcome", outcome)


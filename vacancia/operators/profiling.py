"""Data profiling: null and fill rates, key profiles of JSON, text and keyword audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import non_empty
from ..functions.text import as_column, preview
from ..session import store, workspace


def long_row(df: DataFrame, values: Mapping[str, Column], name: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Aggregate many named values in one pass and return them as rows."""
    labels = list(values)
    cells = F.array(
        *[F.struct(F.lit(k).alias(name), F.col(f"__v{i}").alias(value)) for i, k in enumerate(labels)]
    )
    wide = df.groupBy(*by).agg(*[values[k].alias(f"__v{i}") for i, k in enumerate(labels)])
    return wide.select(*by, F.explode(cells).alias("__cell")).select(*by, "__cell.*")


def filled(df: DataFrame, value: str | Column) -> Column:
    """Present; for an array, present and not empty."""
    column = as_column(value)
    kind = df.select(column.alias("x")).schema["x"].dataType
    return non_empty(column) if isinstance(kind, T.ArrayType) else column.isNotNull()


def rate(condition: Column) -> Column:
    return F.avg(condition.cast("int"))


def null_rates(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    names = list(columns or [c for c in df.columns if c not in by])
    return long_row(df, {c: rate(F.col(c).isNull()) for c in names}, "column", "null_rate", by)


def fill_rates(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    return long_row(df, {k: rate(filled(df, v)) for k, v in fields.items()}, "field", "fill_rate")


def empty_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_row(df, {c: rate(~non_empty(c)) for c in columns}, "column", "empty_rate")


def column_profile(
    df: DataFrame, by: str | None = None, skip: Sequence[str] = (), order: str | None = None
) -> DataFrame:
    """Per column: non-null count, rows, percentage filled and a sample of 120 characters.

    The sample is the first value by ``order``, or the smallest one without an order.
    """
    group = [by] if by else []
    names = [c for c in df.columns if c not in (*skip, *group)]

    def sample(c: str) -> Column:
        text = F.col(c)
        if not isinstance(df.schema[c].dataType, T.AtomicType):
            text = F.to_json(text)
        text = text.cast("string")
        if order is None:
            return preview(F.min(text))
        return preview(F.min_by(text, F.when(F.col(c).isNotNull(), F.col(order))))

    cells = {
        c: F.struct(
            F.count(c).alias("non_null"),
            F.count(F.lit(1)).alias("total"),
            sample(c).alias("sample"),
        )
        for c in names
    }
    table = long_row(df, cells, "column", "cell", group).select(*group, "column", "cell.*")
    pct = F.bround(F.try_divide(100.0 * F.col("non_null"), F.col("total")), 1)
    return table.select(*group, "column", "non_null", "total", pct.alias("population_pct"), "sample")


def json_key_profile(
    df: DataFrame, payload: str, order: str | None = None, empty_as_null: bool = False
) -> DataFrame:
    """Per top-level JSON key: non-null count, all rows, percentage, sample.

    Rows that are not JSON objects count in the total only.
    """
    spark = df.sparkSession
    keep = [F.col(order).alias("__order")] if order else []
    docs = df.select(F.try_parse_json(F.col(payload)).alias("__doc"), *keep)
    docs = docs.where(F.schema_of_variant("__doc").startswith("OBJECT"))
    members = docs.lateralJoin(spark.tvf.variant_explode(F.col("__doc").outer()))
    # Strings without their quotes, everything else as JSON text.
    text = F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value"))
    missing = F.is_variant_null("value")
    if empty_as_null:
        missing = missing | text.isin("", "[]")
    members = members.select("key", F.when(~missing, text).alias("text"), *(["__order"] if order else []))
    sample = F.min_by("text", F.when(F.col("text").isNotNull(), F.col("__order"))) if order else F.min("text")
    grouped = members.groupBy("key").agg(
        F.count("text").alias("non_null"), F.count("*").alias("present"), preview(sample).alias("sample")
    )
    total = df.agg(F.count("*").alias("n")).scalar()
    grouped = grouped.withColumn("total", total)
    pct = F.bround(100.0 * F.col("non_null") / F.col("total"), 1)
    return grouped.select("key", "non_null", "present", "total", pct.alias("population_pct"), "sample")


def json_path_presence(df: DataFrame, payload: str, paths: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How often each nested path holds a value."""
    docs = df.select(*by, F.try_parse_json(F.col(payload)).alias("__doc"))

    def present(path: str) -> Column:
        found = F.try_variant_get("__doc", path, "variant")
        return F.count_if(found.isNotNull() & ~F.is_variant_null(found))

    cells = {p: F.struct(present(p).alias("n"), F.count(F.lit(1)).alias("total")) for p in paths}
    return long_row(docs, cells, "path", "cell", by).select(*by, "path", "cell.*")


KINDS = ("array", "boolean", "number", "object", "string")


def _kind(value: Column) -> Column:
    """Kind of a variant, NULL for a JSON null."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name != "VOID", "number")
    )


def _one_level_down(rows: DataFrame) -> DataFrame:
    """Every row, with ``__open`` off, and the members of the open ones, of which containers are open."""
    both = F.when(F.col("__open"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("__member", F.explode(both))
    rows = rows.withColumn("__parent", F.when(F.col("__member"), F.col("__value")))
    rows = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("__parent").outer()))
    rows = rows.where(~F.col("__member") | F.col("pos").isNotNull())  # an empty container has no members
    plain = F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    step = (
        F.when(F.col("key").isNull(), "[*]")
        .when(plain, F.concat(F.lit("."), F.col("key")))
        .otherwise(F.concat(F.lit('["'), F.col("key"), F.lit('"]')))
    )
    kind = F.when(F.col("__member"), _kind(F.col("value"))).otherwise(F.col("__kind"))
    kept = [c for c in rows.columns if c not in ("__path", "__value", "__kind", "__open", "__member", "__parent", "pos", "key", "value")]
    return rows.select(
        *kept,
        F.when(F.col("__member"), F.concat("__path", step)).otherwise(F.col("__path")).alias("__path"),
        F.when(F.col("__member"), F.col("value")).otherwise(F.col("__value")).alias("__value"),
        kind.alias("__kind"),
        (F.col("__member") & F.coalesce(kind.isin("array", "object"), F.lit(False))).alias("__open"),
    )


def json_paths(
    df: DataFrame, payload: str, order: str | None = None, levels: int = 8, store_at: str | None = None
) -> DataFrame:
    """Every path inside JSON texts, to any depth: ``$.a.b``, ``$.tags[*]``, ``$["odd key"]``.

    Returns per path: ``kinds`` met there (joined by ``|``), ``docs`` (rows with a value other than
    null), ``n_values`` (such values; more than rows under an array), ``n_nulls`` (JSON nulls),
    ``total`` (all rows), ``population_pct`` (docs of total) and ``sample``, 120 characters of the
    first value by ``order``, or of the smallest one; containers have no sample. NULL and malformed
    texts, and texts that are neither object nor array, count in the total only.

    The walk is one narrow pipeline over one scan, ``levels`` deep. Its result, a row per path, is
    stored; only where containers were left unopened is it taken again, twice as deep.
    """
    keep = [F.col(order).alias("__order")] if order else []
    docs = df.select(F.try_parse_json(F.col(payload)).alias("__value"), *keep, F.monotonically_increasing_id().alias("__doc"))
    docs = docs.withColumn("__kind", _kind(F.col("__value"))).where(F.col("__kind").isin("array", "object"))
    docs = docs.select("*", F.lit("$").alias("__path"), F.lit(True).alias("__open"))
    path = store_at or workspace(df.sparkSession)
    while True:
        rows = docs
        for _ in range(levels):
            rows = _one_level_down(rows)
        found = store(_path_counts(rows, order is not None), path)
        if found.where(F.col("n_open") > 0).isEmpty():
            break
        levels *= 2
    total = df.agg(F.count("*").alias("n")).scalar()
    pct = F.bround(100.0 * F.col("docs") / F.col("total"), 1)
    out = found.where(F.col("path") != "$").withColumn("total", total)
    return out.select("path", "kinds", "docs", "n_values", "n_nulls", "total", pct.alias("population_pct"), "sample")


def _path_counts(rows: DataFrame, ordered: bool) -> DataFrame:
    # Without an array on the way a row has a path once; only the others are told apart by row.
    repeats = F.col("__path").contains("[*]")
    text = F.coalesce(F.try_variant_get("__value", "$", "string"), F.to_json("__value"))
    leaf = preview(F.when(F.col("__kind").isin("array", "object"), None).otherwise(F.when(F.col("__kind").isNotNull(), text)))
    rows = rows.select(
        F.col("__path").alias("path"),
        F.when(repeats, F.col("__doc")).alias("doc"),
        F.col("__kind").alias("kind"),
        F.col("__open").alias("open"),
        leaf.alias("leaf"),
        *(["__order"] if ordered else []),
    )
    first = F.when(F.col("leaf").isNotNull(), F.col("__order")) if ordered else F.col("leaf")
    per_doc = rows.groupBy("path", "doc").agg(
        F.count("kind").alias("n_values"),
        F.count_if(F.col("kind").isNull()).alias("n_nulls"),
        F.count_if("open").alias("n_open"),
        *[F.bool_or(F.col("kind") == k).alias(k) for k in KINDS],
        F.min(F.when(F.col("leaf").isNotNull(), F.struct(first.alias("at"), "leaf"))).alias("sample"),
    )
    in_docs = F.when(F.col("doc").isNull(), F.col("n_values")).otherwise((F.col("n_values") > 0).cast("long"))
    return per_doc.groupBy("path").agg(
        F.concat_ws("|", *[F.when(F.bool_or(k), k) for k in KINDS]).alias("kinds"),
        F.sum(in_docs).alias("docs"),
        F.sum("n_values").alias("n_values"),
        F.sum("n_nulls").alias("n_nulls"),
        F.sum("n_open").alias("n_open"),
        F.min("sample").getField("leaf").alias("sample"),
    )


def text_audit(df: DataFrame, column: str | Column, by: Sequence[str] = ()) -> DataFrame:
    c = as_column(column)
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count(c).alias("present"),
        F.count_if(c.isNull() | (c == "")).alias("missing"),
        F.avg(F.length(c)).alias("avg_length"),
        F.min(F.length(c)).alias("min_length"),
        F.max(F.length(c)).alias("max_length"),
    )


def keyword_matrix(
    df: DataFrame,
    column: str | Column,
    patterns: Mapping[str, str],
    by: Sequence[str] = (),
    none_of: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows per regex (ignoring case), and rows that hit none of a further pattern."""
    c = as_column(column)
    hits = [F.count_if(c.rlike(f"(?i){p}")).alias(name) for name, p in patterns.items()]
    if none_of:
        name, pattern = none_of
        hits.append(F.count_if(~c.rlike(f"(?i){pattern}")).alias(name))
    return df.groupBy(*by).agg(F.count("*").alias("total"), *hits)


# Title keywords audited per provider.
SENIORITY_KEYWORDS = {
    "has_junior": r"\bjunior\b",
    "has_entry": r"\bentry\b",
    "has_associate": r"\bassociate\b",
    "has_mid": r"\bmid\b",
    "has_senior": r"\bsenior\b",
    "has_sr": r"\bsr\b",
    "has_lead": r"\blead\b",
    "has_principal": r"\bprincipal\b",
    "has_manager": r"\bmanager\b",
    "has_director": r"\bdirector\b",
    "has_vp": r"\bvp\b|vice president",
    "has_roman_numeral": r"\bii\b|\biii\b|\biv\b",
}
NO_SENIORITY = (
    "no_seniority_signal",
    r"junior|entry|associate|senior|lead|principal|manager|director|\bvp\b|vice president",
)
WORK_MODEL_KEYWORDS = {
    "remote_in_title": "remote",
    "hybrid_in_title": "hybrid",
    "onsite_in_title": "on.?site|onsite|in.?office",
}


def presence_audit(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows per condition and their percentage of all rows."""
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    shares = [
        F.bround(100.0 * F.count_if(c) / F.count(F.lit(1)), 1).alias(f"{name}_pct")
        for name, c in conditions.items()
    ]
    return df.groupBy(*by).agg(F.count("*").alias("total"), *counts, *shares)


def tristate_audit(
    df: DataFrame,
    flags: Sequence[str],
    by: Sequence[str] = (),
    value: str | None = None,
    further: Mapping[str, Column] | None = None,
) -> DataFrame:
    """True, false and NULL tallies per flag; with ``value``, how often it is filled for
    true and for false; ``further`` conditions are counted along."""
    out = []
    for flag in flags:
        c = F.col(flag)
        out += [
            F.count_if(c).alias(f"{flag}_true"),
            F.count_if(~c).alias(f"{flag}_false"),
            F.count_if(c.isNull()).alias(f"{flag}_null"),
        ]
        if value:
            has = F.col(value).isNotNull()
            out += [
                F.count_if(c & has).alias(f"{flag}_true_with_{value}"),
                F.count_if(~c & has).alias(f"{flag}_false_with_{value}"),
            ]
    out += [F.count_if(c).alias(name) for name, c in (further or {}).items()]
    return df.groupBy(*by).agg(F.count("*").alias("total"), *out)


def blank_audit(df: DataFrame, column: str | Column, by: Sequence[str] = ()) -> DataFrame:
    c = as_column(column)
    return df.groupBy(*by).agg(
        F.count_if(c == "").alias("blank"),
        F.count_if(c != "").alias("non_blank"),
        F.count_if(c.isNull()).alias("missing"),
    )

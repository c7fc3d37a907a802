"""Raw landing tables: wrapping records, routing by provider, reading back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.arrays import safe_cast


def wrap_records(
    records: DataFrame,
    provider: str,
    label: Column | str | None,
    run_at: Column,
    ordinal: Column | str,
    node: str | None = None,
) -> DataFrame:
    """Records as landing rows ``provider:label``, JSON payload, run time.

    With ``node``, that struct column is spread over the other columns: its members win
    over scraper metadata of the same name.
    """
    if node is None:
        payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns if c != ordinal]))
    else:
        inner = records.schema[node].dataType.fieldNames()
        outer = [c for c in records.columns if c not in (node, ordinal) and c not in inner]
        payload = F.to_json(F.struct(*outer, f"{node}.*"))
    tag = F.lit(provider)
    if label is not None:
        tag = F.concat_ws(":", tag, F.lit(label) if isinstance(label, str) else label)
    position = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return records.select(
        tag.alias("source"),
        payload.alias("raw_payload"),
        run_at.alias("ingested_at"),
        position.cast("bigint").alias("ordinal"),
    )


def provider_of(source: Column) -> Column:
    """Provider whose name the source starts with; an unknown source fails the job."""
    out = F.raise_error(F.concat(F.lit("no landing table for source "), F.coalesce(source, F.lit("NULL"))))
    out = out.cast("string")
    for name in reversed(schemas.PROVIDERS):
        out = F.when(source.startswith(name), F.lit(name)).otherwise(out)
    return out


def route(rows: DataFrame) -> DataFrame:
    return rows.withColumn("provider", provider_of(F.col("source")))


def land(rows: DataFrame, path: str) -> DataFrame:
    """Append rows under ``provider=...`` and report the rows written per provider, counted
    while they are written."""
    written = Observation()
    counts = [F.count_if(F.col("provider") == p).alias(p) for p in schemas.PROVIDERS]
    routed = route(rows).observe(written, *counts)
    routed.write.mode("append").partitionBy("provider").parquet(path)
    report = [(p, n) for p, n in written.get.items() if n]
    return rows.sparkSession.createDataFrame(report, "provider string, n bigint")


def read_landing(spark: SparkSession, path: str, provider: str | None = None) -> DataFrame:
    """Landing rows; one provider reads only its own directory."""
    table = spark.read.schema(schemas.STORED_LANDING).parquet(path)
    return table if provider is None else table.where(F.col("provider") == provider).drop("provider")


def only_provider(landing: DataFrame, provider: str) -> DataFrame:
    return landing.where(F.col("source").startswith(provider))


def with_payload(landing: DataFrame) -> DataFrame:
    """Parse the payload once; malformed JSON gives a NULL document."""
    return landing.withColumn("doc", F.try_parse_json("raw_payload"))


def field(path: str, kind: str = "string", doc: str = "doc") -> Column:
    return F.try_variant_get(F.col(doc), path, kind)


def text_field(path: str, doc: str = "doc") -> Column:
    return field(path, "string", doc)


def date_field(path: str, doc: str = "doc") -> Column:
    """Date of a text field; malformed dates become NULL."""
    return safe_cast(field(path, "string", doc), "date")


def high_water_mark(landing: DataFrame, path: str = "$.discovered_at") -> DataFrame:
    """One row: newest value of a timestamp path, NULL for an empty table."""
    ts = safe_cast(F.try_variant_get(F.try_parse_json("raw_payload"), path, "string"), "timestamp")
    return landing.agg(F.max(ts).alias("high_water_mark"))


def read_documents(
    spark: SparkSession, path: str, envelope: Sequence[str] = (), schema: T.StructType | str | None = None
) -> DataFrame:
    """Cached JSON responses, one record per row: a top-level array, or an array inside
    an envelope such as ``("data", "jobs")``.

    With a schema the files are read once, and lines are documents; without one a first pass
    over whole files infers it.
    """
    reader = spark.read.option("multiLine", schema is None)
    docs = (reader if schema is None else reader.schema(schema)).json(path)
    if not envelope:
        return docs
    return docs.select(F.explode(".".join(envelope)).alias("record")).select("record.*")

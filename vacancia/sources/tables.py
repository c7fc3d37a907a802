"""Mart, enrichment and log tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.arrays import or_empty, parse_strings, safe_cast, truthy
from ..operators.quality import content_check, count_check
from ..operators.usage import reset_day


def append_table(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows with exactly the columns and types of ``schema``."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    typed.write.mode("append").parquet(path)


def append_enrichment(rows: DataFrame, path: str) -> None:
    append_table(rows, path, schemas.ENRICHMENT)


def append_runs(rows: DataFrame, path: str) -> None:
    append_table(rows, path, schemas.RUNS)


def append_usage(rows: DataFrame, path: str) -> None:
    append_table(rows, path, schemas.USAGE)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.RUNS).orderBy("run_at")


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    usage = read_table(spark, path, schemas.USAGE).orderBy("run_at", "source")
    return usage.withColumn("reset_date", reset_day(F.col("reset_date")))


def write_mart(mart: DataFrame, path: str) -> None:
    """Rebuild the mart. Partitioned by source: every page and facet can prune on it."""
    mart.write.mode("overwrite").partitionBy("source").parquet(path)


def coerce_mart(df: DataFrame) -> DataFrame:
    """Mart columns in their analysis types: lower-case names, dates, numbers, arrays that
    are never NULL, booleans where anything but a yes is false."""
    df = df.toDF(*[c.lower() for c in df.columns])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in schemas.ARRAY_COLUMNS:
            c = parse_strings(c) if isinstance(kinds[name], T.StringType) else or_empty(c)
        elif name == "date_posted":
            c = safe_cast(c, "date")
        elif name in ("ingested_at", "enriched_at"):
            c = safe_cast(c, "timestamp")
        elif name in (
            "final_salary_min", "final_salary_max", "years_required_min", "years_required_max",
            "confidence_score",
        ):
            c = safe_cast(c, "double")
        elif name in ("acknowledges_ai", "explicitly_encourages_applicants"):
            c = truthy(c)
        out.append(c.alias(name))
    return df.select(*out)


def load_mart(spark: SparkSession, path: str) -> DataFrame:
    return coerce_mart(spark.read.parquet(path))


def run_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Ad-hoc SQL; frames passed by name are usable as ``{name}`` in the text."""
    return spark.sql(sql, **frames)


def existing_tables(spark: SparkSession, names: list[str]) -> dict[str, bool]:
    return {name: spark.catalog.tableExists(name) for name in names}


def copy_tables(spark: SparkSession, pairs: Mapping[str, tuple[str, str]], content: bool = False) -> DataFrame:
    """Copy parquet tables and compare counts; a mismatch fails the call.

    Returns table, old, new, status. With ``content`` every cell is compared too, by a digest of
    either side, which reads all columns once more; the digests are returned along.
    """
    for old, new in pairs.values():
        spark.read.parquet(old).write.mode("overwrite").parquet(new)
    check = content_check if content else count_check
    report = check(
        [(name, spark.read.parquet(old), spark.read.parquet(new)) for name, (old, new) in pairs.items()]
    )
    bad = [r["table"] for r in report.where(F.col("status") != "ok").collect()]
    if bad:
        raise RuntimeError(f"{'contents' if content else 'row counts'} differ after the copy: {bad}")
    return report


def write_checkpoint_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_checkpoint_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)

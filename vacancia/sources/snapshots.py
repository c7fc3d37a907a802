"""Metric snapshots kept per run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.metrics import diff_metrics


def write_snapshot(doc: DataFrame, run_date: str, path: str) -> None:
    """Store a metric document under its date, replacing an earlier run of that date."""
    dated = doc.withColumn("run_date", F.lit(run_date).cast("date"))
    writer = dated.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_date").parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SNAPSHOT).parquet(path)


def previous_snapshot(store: DataFrame, run_date: str) -> DataFrame:
    """Snapshot of the greatest date other than ``run_date``."""
    others = store.where(F.col("run_date") != F.lit(run_date).cast("date"))
    newest = others.agg(F.max("run_date").alias("d")).scalar()
    return others.where(F.col("run_date") == newest)


def changes_since_previous(store: DataFrame, run_date: str) -> DataFrame:
    today = store.where(F.col("run_date") == F.lit(run_date).cast("date"))
    return diff_metrics(previous_snapshot(store, run_date), today)

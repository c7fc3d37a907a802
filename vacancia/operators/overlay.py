"""Corrections laid over existing rows: upserts, flag fixes, deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column


def overlay(df: DataFrame, patch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Take the patched value where the patch has one; the patch is unique per key."""
    renamed = patch.select(key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def upsert_json_field(
    df: DataFrame, patch: DataFrame, payload: str, key: Column, field: str, patch_key: str, patch_value: str
) -> DataFrame:
    """Set a top-level text field of a JSON payload for the listed keys.

    The payload is rewritten as a map of its top-level members, so members keep their
    own JSON text and a field that exists already is replaced.
    """
    names = patch.select(F.col(patch_key).alias("__key"), F.col(patch_value).alias("__value"))
    joined = df.withColumn("__id", key).join(names, F.col("__id") == F.col("__key"), "left")
    members = F.from_json(F.col(payload), "map<string,variant>")
    added = F.create_map(F.lit(field), F.try_parse_json(F.to_json(F.col("__value").cast("variant"))))
    kept = F.map_filter(members, lambda k, _: k != field)
    rewritten = F.to_json(F.map_concat(kept, added))
    patched = F.when(F.col("__key").isNotNull(), rewritten).otherwise(F.col(payload))
    return joined.withColumn(payload, patched).drop("__id", "__key", "__value")


def set_by_ids(df: DataFrame, ids: DataFrame, key: str, column: str, value: Column | str) -> DataFrame:
    """Set a column for the listed ids."""
    listed = ids.select(F.col(key).alias("__id")).distinct()
    joined = df.join(listed, F.col(key) == F.col("__id"), "left")
    fixed = F.when(F.col("__id").isNotNull(), as_column(value)).otherwise(F.col(column))
    return joined.withColumn(column, fixed).drop("__id")


def delete_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")

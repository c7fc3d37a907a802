"""Joins between postings, labels, profiles and logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    df: DataFrame, labels: DataFrame, on: Sequence[str] = ("job_id",), rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Left join of labels that are unique per key; ``rename`` resolves column clashes."""
    for old, new in (rename or {}).items():
        labels = labels.withColumnRenamed(old, new)
    return df.join(labels, list(on), "left")


def unlabelled(
    df: DataFrame, labels: DataFrame, key: str = "job_id", null_aware: bool = False
) -> DataFrame:
    """Rows without a label.

    Default: rows whose key is NULL never match, so they stay. ``null_aware`` follows SQL
    ``NOT IN``: one NULL key among the labels empties the result, and a NULL row key is
    kept only when there are no labels at all. Both are hash anti joins, so neither needs
    the label side to fit in one place.
    """
    known = labels.select(key)
    rest = df.join(known.where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    if not null_aware:
        return rest
    rest = rest.where(~known.where(F.col(key).isNull()).exists())
    return rest.where(F.col(key).isNotNull() | ~known.exists())


def coverage(df: DataFrame, labels: DataFrame, key: str, by: str) -> DataFrame:
    """Labelled and total rows per group."""
    return has_label(df, labels, key).groupBy(by).agg(
        F.count_if("has_label").alias("labelled"), F.count("*").alias("total")
    )


def has_label(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    known = labels.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(known, key, "left")
    return joined.withColumn("has_label", F.col("__hit").isNotNull()).drop("__hit")


def reconcile_ids(a: DataFrame, b: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Distinct ids in both, only left, only right (per group)."""
    group = [by] if by else []

    def side(df: DataFrame, in_a: bool) -> DataFrame:
        flags = (F.lit(in_a).alias("in_a"), F.lit(not in_a).alias("in_b"))
        return df.select(*group, F.col(key).alias("id"), *flags)

    merged = side(a, True).unionByName(side(b, False)).where(F.col("id").isNotNull())
    per_id = merged.groupBy(*group, "id").agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b")
    )
    left, right = F.col("in_a"), F.col("in_b")
    return per_id.groupBy(*group).agg(
        F.count_if(left).alias("n_left"),
        F.count_if(right).alias("n_right"),
        F.count_if(left & right).alias("matched"),
        F.count_if(left & ~right).alias("left_only"),
        F.count_if(~left & right).alias("right_only"),
    )


def compare_profiles(
    profiles: Mapping[str, DataFrame], key: str, value: str, gap_for: str | None = None
) -> DataFrame:
    """Profiles side by side, a field missing from one profile counting as zero.

    ``gap_for`` adds how far one profile lags behind the mean of the others, and keeps the
    fields that all profiles have.
    """
    long = None
    for name, profile in profiles.items():
        part = profile.select(F.col(key), F.lit(name).alias("__name"), F.col(value).alias("__value"))
        long = part if long is None else long.unionByName(part)
    names = list(profiles)
    table = long.groupBy(key).pivot("__name", names).agg(F.first("__value"))
    if gap_for is None:
        return table.na.fill(0, names)
    table = table.na.drop(subset=names)
    others = [n for n in names if n != gap_for]
    mean: Column = F.lit(0.0)
    for name in others:
        mean = mean + F.col(f"`{name}`")
    return table.withColumn("gap", F.bround(mean / len(others) - F.col(f"`{gap_for}`"), 1))


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=allow_missing)
    return out

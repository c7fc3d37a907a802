"""Orders, top-k, samples, facet values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_column
from .aggregates import row_total
from .dedupe import top_rows
from .running import ranked


def ordered(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns])


def exploded(df: DataFrame, value: str | Column, keep: Sequence[str] = (), out: str = "value") -> DataFrame:
    """``value`` as rows: array elements one by one, plain values as they are, no NULLs."""
    rows = df.select(*keep, as_column(value).alias(out))
    if isinstance(rows.schema[out].dataType, T.ArrayType):
        rows = rows.select(*keep, F.explode(out).alias(out))
    return rows.where(F.col(out).isNotNull())


def topk(df: DataFrame, value: str | Column, k: int) -> DataFrame:
    """Most frequent values; ties go to the smaller value."""
    grouped = exploded(df, value).groupBy("value").agg(F.count("*").alias("n"))
    return grouped.orderBy(F.col("n").desc(), F.col("value").asc()).limit(k)


def topk_by(df: DataFrame, value: str | Column, by: str, k: int) -> DataFrame:
    """Most frequent values per group with their rank."""
    rows = exploded(df, value, [by]).where(F.col(by).isNotNull())
    grouped = rows.groupBy(by, "value").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("value").asc()]
    window = Window.partitionBy(by).orderBy(*order)
    ranked = grouped.withColumn("rank", F.row_number().over(window))
    return ranked.where(F.col("rank") <= k)


def heatmap(
    df: DataFrame, value: str | Column, by: str, by_values: Sequence[str], k: int
) -> DataFrame:
    """Counts per group column of the ``k`` values most mentioned over all listed groups."""
    rows = exploded(df, value, [by])
    table = rows.where(F.col(by).isin(list(by_values))).groupBy("value").pivot(by, list(by_values)).count()
    table = table.na.fill(0, list(by_values)).withColumn("total", row_total(by_values))
    return table.orderBy(F.col("total").desc(), F.col("value").asc()).limit(k)


def restrict_topk(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent."""
    top = topk(df, column, k).select(F.col("value").alias(column))
    return df.join(top, column, "left_semi")


def topk_composition(df: DataFrame, column: str, by: str, k: int) -> DataFrame:
    """Counts by group within the ``k`` most frequent values of ``column``."""
    pairs = df.where(F.col(column).isNotNull()).groupBy(column, by).agg(F.count("*").alias("n"))
    totals = pairs.groupBy(column).agg(F.sum("n").alias("total"))
    top = totals.orderBy(F.col("total").desc(), F.col(column).asc()).limit(k)
    return pairs.join(top.select(column), column, "left_semi").where(F.col(by).isNotNull())


def facet_values(df: DataFrame, value: str | Column, by_frequency: bool = False) -> DataFrame:
    """Option list of a facet: sorted by name, or commonest first."""
    grouped = exploded(df, value).groupBy("value").agg(F.count("*").alias("n"))
    name = F.col("value").asc()
    return grouped.orderBy(F.col("n").desc(), name) if by_frequency else grouped.orderBy(name)


def volume_rank(df: DataFrame, column: str, store_at: str | None = None) -> DataFrame:
    """Values ranked by volume, however many there are."""
    grouped = exploded(df, column).groupBy("value").agg(F.count("*").alias("n"))
    placed = ranked(grouped, [F.col("n").desc(), F.col("value").asc()], store_at=store_at)
    return placed.withColumn("rank", F.col("rank").cast("int"))


def latest_row(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row per group (of the whole frame without keys)."""
    order = F.struct(*[F.col(c) for c in (ts, *tiebreak)])
    others = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*others), order).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*")


def sample_per_group(df: DataFrame, by: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    return top_rows(df, by, [F.col(c).asc_nulls_last() for c in order], n)

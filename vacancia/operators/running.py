"""Ranks, running counts and previous rows over a whole order, with no task that sees it all.

Rows are dealt out by ranges of the order, whose bounds Spark samples, and written once with the
number of their part. Inside a part a window does the work. What a part needs from the parts
before it is one small row per part, folded on the driver: there are as many of these as shuffle
partitions, whatever the data. The written table makes both readings see the same parts, and
survives lost executors.

The order must tell rows apart as far as possible: rows equal in all of it share a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store, workspace

PART = "__part"


def in_parts(df: DataFrame, order: Sequence[Column], store_at: str | None = None) -> DataFrame:
    """The rows with the number of their part: parts follow each other in the order."""
    dealt = df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id())
    return store(dealt, store_at or workspace(df.sparkSession))


def _with_carry(placed: DataFrame, carries: list[tuple], kind: T.StructType) -> DataFrame:
    """``placed`` with what each part takes over; parts without it keep NULLs."""
    table = placed.sparkSession.createDataFrame(carries, T.StructType([T.StructField(PART, T.IntegerType()), *kind.fields]))
    return placed.join(table, PART, "left")


def ranked(df: DataFrame, order: Sequence[Column], out: str = "rank", store_at: str | None = None) -> DataFrame:
    """Every row with its place in the order, from 1."""
    placed = in_parts(df, order, store_at)
    sizes = dict(placed.groupBy(PART).count().collect())
    carries, before = [], 0
    for part in sorted(sizes):
        carries.append((part, before))
        before += sizes[part]
    joined = _with_carry(placed, carries, T.StructType([T.StructField("__before", T.LongType())]))
    within = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    return joined.withColumn(out, within + F.col("__before")).select(*df.columns, out)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "number", store_at: str | None = None
) -> DataFrame:
    """Every row with its place within its key group, from 1; NULL keys are a group."""
    placed = in_parts(df, [*[F.col(k).asc_nulls_first() for k in keys], *order], store_at)
    key = F.struct(*keys)
    sizes = placed.groupBy(PART, *keys).count()
    ends = sizes.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.max_by("count", key).alias("n"))
    carries, previous, carried = [], None, 0
    for row in sorted(ends.collect()):
        taken = carried if previous is not None and previous == row.first else 0
        carries.append((row[PART], row.first, taken))
        carried = row.n + (taken if row.first == row.last else 0)
        previous = row.last
    kind = T.StructType([T.StructField("__first", placed.select(key.alias("k")).schema["k"].dataType), T.StructField("__before", T.LongType())])
    joined = _with_carry(placed, carries, kind)
    within = F.row_number().over(Window.partitionBy(PART, *keys).orderBy(*order))
    before = F.when(key.eqNullSafe(F.col("__first")), F.col("__before")).otherwise(0)
    return joined.withColumn(out, within + before).select(*df.columns, out)


def previous_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], out: str = "prev", store_at: str | None = None
) -> DataFrame:
    """Every row with the struct of ``columns`` of the row before it in its key group, NULL first."""
    every = [*keys, *order]
    rows = df.withColumn("__row", F.struct(*columns))
    placed = in_parts(rows, [F.col(c).asc_nulls_first() for c in every], store_at)
    key, place = F.struct(*keys), F.struct(*every)
    ends = placed.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.max_by("__row", place).alias("row"))
    carries, previous = [], None
    for row in sorted(ends.collect(), key=lambda r: r[PART]):
        carries.append((row[PART], row.first, previous.row if previous is not None and previous.last == row.first else None))
        previous = row
    types = placed.select(key.alias("k"), "__row").schema
    kind = T.StructType([T.StructField("__first", types["k"].dataType), T.StructField("__carry", types["__row"].dataType)])
    joined = _with_carry(placed, carries, kind)
    near = F.lag("__row").over(Window.partitionBy(PART, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    far = F.when(key.eqNullSafe(F.col("__first")), F.col("__carry"))
    return joined.withColumn(out, F.coalesce(near, far)).select(*df.columns, out)

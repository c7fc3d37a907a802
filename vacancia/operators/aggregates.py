"""Group counts, crosstabs, shares, rates and statistics.

Everything aggregates before it shuffles; windows and joins only ever see aggregated
rows. NULL group keys are left out unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_column, role_key
from .quantiles import group_quantiles


def all_present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in values], name, value)


# -- counts ------------------------------------------------------------------------------


def counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(all_present(keys)).groupBy(*keys).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence[str] | None = None) -> DataFrame:
    """Zero-filled counts of ``b`` per ``a``; ``b_values`` fixes columns and their order."""
    pivoted = df.where(all_present([a, b])).groupBy(a).pivot(b, list(b_values) if b_values else None)
    table = pivoted.count()
    return table.na.fill(0, [c for c in table.columns if c != a])


def row_total(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for name in columns:
        total = total + F.col(f"`{name}`")
    return total


def crosstab_pct(
    df: DataFrame, a: str, b: str, b_values: Sequence[str] | None = None, digits: int | None = 2
) -> DataFrame:
    """Row-normalised crosstab; rows without any counted value are zero."""
    table = crosstab(df, a, b, b_values)
    names = [c for c in table.columns if c != a]
    total = row_total(names)

    def rate(name: str) -> Column:
        share_of_row = F.coalesce(F.try_divide(F.col(f"`{name}`").cast("double"), total), F.lit(0.0))
        return share_of_row if digits is None else F.bround(share_of_row, digits)

    return table.select(a, *[rate(name).alias(name) for name in names])


def order_by_total(table: DataFrame, a: str, descending: bool = True) -> DataFrame:
    """Crosstab rows ordered by their total, then by label."""
    total = row_total([c for c in table.columns if c != a])
    return table.orderBy(total.desc() if descending else total.asc(), F.col(a).asc())


def share(df: DataFrame, group: str, n: str = "n", out: str = "pct") -> DataFrame:
    """Share of ``n`` within its group, for a frame of counts."""
    totals = df.groupBy(F.col(group).alias("__g")).agg(F.sum(n).alias("__total"))
    joined = df.join(totals, F.col(group).eqNullSafe(F.col("__g")))
    return joined.withColumn(out, F.col(n) / F.col("__total")).drop("__g", "__total")


def complete_grid(df: DataFrame, a: str, b: str, b_values: Sequence[str], fill: int = 0) -> DataFrame:
    """Counts for every ``a`` and every listed ``b``, absent pairs filled."""
    table = crosstab(df, a, b, b_values)
    long = unpivot(table, [a], [f"`{v}`" for v in b_values], b, "n")
    return long.withColumn("n", F.when(F.col("n") == 0, F.lit(fill)).otherwise(F.col("n")))


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    how = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[how(c).alias(c) for c in columns])


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), "n") for k, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bucket_counts(df: DataFrame, bucket: Column, out: str = "bucket") -> DataFrame:
    return df.groupBy(bucket.alias(out)).agg(F.count("*").alias("n"))


def distribution(df: DataFrame, value: Column | str, out: str = "value", digits: int = 1) -> DataFrame:
    """Value counts with their percentage; NULL is a value of its own, arrays are exploded."""
    column = as_column(value)
    rows = df.select(column.alias(out))
    if isinstance(rows.schema[out].dataType, T.ArrayType):
        rows = rows.select(F.explode(out).alias(out))
    grouped = rows.groupBy(out).agg(F.count("*").alias("n"))
    total = grouped.agg(F.sum("n").alias("n")).scalar()
    return grouped.withColumn("pct", F.bround(100.0 * F.col("n") / total, digits))


def rounded_hist(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(F.bround(column, digits).alias("bucket")).agg(F.count("*").alias("n"))


def fixed_hist(df: DataFrame, column: str, low: float, high: float, bins: int = 20) -> DataFrame:
    """Counts in equal bins; the last bin includes its upper edge, outside values are dropped."""
    c = F.col(column)
    width = (high - low) / bins
    index = F.least(F.floor((c - low) / width), F.lit(bins - 1).cast("bigint"))
    rows = df.where((c >= low) & (c <= high))
    counted = rows.groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    return counted.select("bin", (F.lit(low) + F.col("bin") * width).alias("bin_start"), "n")


# -- statistics --------------------------------------------------------------------------

QUANTILES = {"median": 0.5, "q25": 0.25, "q75": 0.75}
MOMENTS = {"count": F.count, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}


def stats(
    df: DataFrame,
    keys: Sequence[str],
    column: str | Column,
    which: Sequence[str] = ("median", "count"),
    digits: int | None = None,
    store_at: str | None = None,
) -> DataFrame:
    """Named statistics of one column per group, computed exactly; ``store_at`` as for
    :func:`group_quantiles`."""
    rows = df.where(all_present(keys)) if keys else df
    quantiles = {name: QUANTILES[name] for name in which if name in QUANTILES}
    moments = [MOMENTS[name]("__v").alias(name) for name in which if name in MOMENTS]
    if quantiles:
        table = group_quantiles(rows, keys, column, quantiles, moments, store_at)
    else:
        table = rows.withColumn("__v", as_column(column).cast("double")).groupBy(*keys).agg(*moments)
    if digits is None:
        return table.select(*keys, *which)
    rounded = [F.col(w) if w == "count" else F.bround(w, digits).alias(w) for w in which]
    return table.select(*keys, *rounded)


def median_n(df: DataFrame, keys: Sequence[str], column: str, digits: int | None = None) -> DataFrame:
    return stats(df, keys, column, ("median", "count"), digits).withColumnRenamed("count", "n")


def stats5(df: DataFrame, keys: Sequence[str], column: str, digits: int | None = 0) -> DataFrame:
    return stats(df, keys, column, ("median", "count", "min", "max", "std"), digits).withColumnRenamed(
        "count", "n"
    )


def describe_by(df: DataFrame, keys: Sequence[str], column: str, digits: int | None = None) -> DataFrame:
    return stats(df, keys, column, ("count", "mean", "std", "min", "q25", "median", "q75", "max"), digits)


def medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], store_at: str | None = None) -> DataFrame:
    """Median of several columns per group in one pass over a long form, which ``store_at`` keeps."""
    doubles = df.where(all_present(keys)).select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = unpivot(doubles, keys, columns, "__metric", "__value")
    per_metric = group_quantiles(long, [*keys, "__metric"], "__value", {"median": 0.5}, store_at=store_at)
    return per_metric.groupBy(*keys).pivot("__metric", list(columns)).agg(F.first("median"))


def box_summary(df: DataFrame, key: str, column: str, n_min: int = 10, cap: float | None = None) -> DataFrame:
    """Quartiles of groups with at least ``n_min`` rows, values above ``cap`` left out."""
    rows = df.where(F.col(column).isNotNull())
    if cap is not None:
        rows = rows.where(F.col(column) <= cap)
    table = stats(rows, [key], column, ("count", "min", "q25", "median", "q75", "max"))
    return table.where(F.col("count") >= n_min)


# -- rates -------------------------------------------------------------------------------


def bool_rate(
    df: DataFrame, flag: str | Column, by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """True count, rows and rate; a NULL flag counts as false."""
    yes = F.coalesce(as_column(flag).cast("boolean"), F.lit(False))
    rows = df.where(all_present(by)) if by else df
    rate = F.avg(yes.cast("int"))
    return rows.groupBy(*by).agg(
        F.count_if(yes).alias("yes"),
        F.count("*").alias("total"),
        (rate if digits is None else F.bround(rate, digits)).alias("rate"),
    )


def agreement(
    df: DataFrame, a: str | Column, b: str | Column, by: Sequence[str] = (), normalise: bool = True
) -> DataFrame:
    """How often two labels agree, over rows that have both."""
    left, right = as_column(a), as_column(b)
    same = (role_key(left) == F.lower(right)) if normalise else (left == right)
    rows = df.where(left.isNotNull() & right.isNotNull())
    rows = rows.where(all_present(by)) if by else rows
    return rows.groupBy(*by).agg(
        F.count_if(same).alias("agree"), F.count("*").alias("total"), F.avg(same.cast("int")).alias("rate")
    )


def label_reliability(df: DataFrame, query: str, bucket: str) -> DataFrame:
    """Per query label: rows, rows whose bucket equals it, and the share."""
    same = F.coalesce(F.col(query) == F.col(bucket), F.lit(False))
    grouped = df.where(F.col(query).isNotNull()).groupBy(query)
    return grouped.agg(
        F.count("*").alias("n"), F.count_if(same).alias("matches"), F.avg(same.cast("int")).alias("rate")
    )


def divergent(df: DataFrame, a: str, b: str, expected: Column) -> DataFrame:
    """Pairs of labels whose second differs from what the first implies, commonest first."""
    rows = df.where(all_present([a, b])).where(~F.coalesce(F.col(b) == expected, F.lit(False)))
    return counts(rows, [a, b]).orderBy(F.col("n").desc(), F.col(a), F.col(b))


def coverage_pct(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Percentage of rows where each column is filled."""
    rates = [
        F.bround(100.0 * F.count(c) / F.count(F.lit(1)), digits).alias(f"{c}_pct") for c in columns
    ]
    return df.groupBy(*by).agg(F.count("*").alias("n"), *rates)


def hit_rate(df: DataFrame, column: str, by: str, digits: int = 1) -> DataFrame:
    grouped = df.where(F.col(by).isNotNull()).groupBy(by)
    return grouped.agg(
        F.count("*").alias("total"),
        F.count(column).alias("filled"),
        F.bround(100.0 * F.count(column) / F.count(F.lit(1)), digits).alias("hit_rate_pct"),
    )


# -- running totals and trends -----------------------------------------------------------


def cumulative(
    df: DataFrame, date: str | Column, by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """New and running rows per day (and group). Counts per day come first, so the running
    window sees at most one row per calendar day and group."""
    rows = df if where is None else df.where(where)
    daily = rows.withColumn("day", F.to_date(as_column(date)))
    daily = daily.where(all_present(["day", *by])).groupBy("day", *by).agg(F.count("*").alias("n"))
    running = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative", F.sum("n").over(running))


def weekly_trend(df: DataFrame, week: Column, fill: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Rows per week label; ``fill`` adds the empty weeks between the first and the last."""
    rows = df.withColumn("week", week)
    rows = rows.where(all_present(["week", *by]))
    weekly = rows.groupBy(*by, "week").agg(F.count("*").alias("n"))
    if not fill:
        return weekly
    span = weekly.groupBy(*by).agg(F.min("week").alias("a"), F.max("week").alias("z"))
    step = F.expr("interval 7 days")
    grid = span.where(F.col("a").isNotNull()).select(
        *by, F.explode(F.sequence("a", "z", step)).alias("week")
    )
    zeroes = grid.withColumn("n", F.lit(0).cast("bigint"))
    return weekly.unionByName(zeroes).groupBy(*by, "week").agg(F.sum("n").alias("n"))

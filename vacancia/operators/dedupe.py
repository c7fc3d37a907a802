"""Row selection by key: latest, best, first, capped, marked.

All "one row per key" operators use ``row_number`` with a rank filter. Spark turns that
into a per-task limit before the shuffle, so a key that holds a third of all rows sends
one row per map task instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import or_empty
from ..functions.text import as_column, strip_whitespace
from .running import numbered

RANK = "__rank"
COUNT = "__count"

# Caps up to this are cut per task before the shuffle; larger ones are numbered in range order.
PER_TASK = 1000


def any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for key in keys:
        out = out | F.col(key).isNull()
    return out


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(RANK, F.row_number().over(window))
    return ranked.where(F.col(RANK) <= n).drop(RANK)


def _per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], null_keys: str) -> DataFrame:
    """``collapse``: NULL keys form one group; ``keep``: all stay; ``drop``: none stay."""
    if null_keys == "collapse":
        return top_rows(df, keys, order)
    picked = top_rows(df.where(~any_null(keys)), keys, order)
    if null_keys == "drop":
        return picked
    if null_keys == "keep":
        return picked.unionByName(df.where(any_null(keys)))
    raise ValueError(f"unknown null_keys {null_keys!r}")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    null_keys: str = "collapse",
) -> DataFrame:
    """One row per key, newest first. Column names sort descending with NULL first."""
    sort = [F.col(c).desc_nulls_first() if isinstance(c, str) else c for c in order]
    return _per_key(df, keys, sort, null_keys)


def best_per_key(
    df: DataFrame,
    keys: Sequence[str],
    rank: Column,
    tiebreak: Sequence[Column | str] = (),
    null_keys: str = "collapse",
) -> DataFrame:
    """One row per key: lowest ``rank`` wins, an unknown rank loses, then the tiebreak."""
    sort = [rank.asc_nulls_last()]
    sort += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    return _per_key(df, keys, sort, null_keys)


def best_per_expression(
    df: DataFrame,
    key: Column,
    rank: Column,
    tiebreak: Sequence[Column | str] = (),
    null_keys: str = "collapse",
) -> DataFrame:
    """:func:`best_per_key` over a computed key."""
    keyed = df.withColumn("__key", key)
    return best_per_key(keyed, ["__key"], rank, tiebreak, null_keys).drop("__key")


def first_per_key(
    df: DataFrame, keys: Sequence[str], ordinal: str | Sequence[str], null_keys: str = "collapse"
) -> DataFrame:
    """First arrival per key. A DataFrame has no order of its own: ``ordinal`` carries it."""
    columns = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    return _per_key(df, keys, [F.col(c).asc_nulls_last() for c in columns], null_keys)


def fingerprint(text_columns: Sequence[str], set_columns: Sequence[str]) -> Column:
    """Comparable identity of a record: lower-cased texts without outer whitespace of any kind,
    plus order-free sets."""
    texts = [F.lower(strip_whitespace(F.coalesce(F.col(c), F.lit("")))).alias(c) for c in text_columns]
    sets = [F.array_sort(F.array_distinct(or_empty(c))).alias(c) for c in set_columns]
    return F.struct(*texts, *sets)


def fingerprint_dedup(
    df: DataFrame, text_columns: Sequence[str], set_columns: Sequence[str], ordinal: str
) -> DataFrame:
    keyed = df.withColumn("__fp", fingerprint(text_columns, set_columns))
    return first_per_key(keyed, ["__fp"], ordinal).drop("__fp")


def fingerprint_groups(
    df: DataFrame, text_columns: Sequence[str], set_columns: Sequence[str], ordinal: str
) -> DataFrame:
    """Duplicate groups: how many records share a fingerprint and which came first."""
    keyed = df.select(fingerprint(text_columns, set_columns).alias("fp"), ordinal)
    grouped = keyed.groupBy("fp").agg(F.count("*").alias("n"), F.min(ordinal).alias("first"))
    return grouped.where(F.col("n") > 1).select("fp.*", "n", "first")


def cap_per_group(
    df: DataFrame, by: Sequence[str], n: int, ordinal: str | Sequence[str], store_at: str | None = None
) -> DataFrame:
    """At most ``n`` rows per group in arrival order.

    For a small ``n`` the rank filter leaves ``n`` rows of a group per task before the shuffle. A
    large ``n`` would let a hot group through whole, so its rows are dealt out by ranges of group
    and ordinal, written once (to ``store_at`` or the session's shared folder) and numbered there.
    """
    columns = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    order = [F.col(c).asc_nulls_last() for c in columns]
    if n <= PER_TASK:
        return top_rows(df, by, order, n)
    return numbered(df, by, order, COUNT, store_at).where(F.col(COUNT) <= n).drop(COUNT)


def cap_report(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Per group: rows seen, rows a cap of ``n`` keeps, rows it leaves."""
    total = df.groupBy(*by).agg(F.count("*").alias("total"))
    kept = F.least(F.col("total"), F.lit(n).cast("bigint"))
    return total.withColumn("kept", kept).withColumn("left_out", F.col("total") - kept)


def mark_duplicates(df: DataFrame, keys: Sequence[str], out: str = "is_duplicate") -> DataFrame:
    """Flag every row whose key occurs more than once; NULL keys equal each other.

    Counts are aggregated first and joined back: a window over the key would hold a hot
    group in one task, while the join can broadcast or split it.
    """
    counts = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.count("*").alias(COUNT))
    repeated = counts.where(F.col(COUNT) > 1)
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"__k_{key}"))
    joined = df.join(repeated, match, "left")
    flagged = joined.withColumn(out, F.col(COUNT).isNotNull())
    return flagged.select(*df.columns, out)


def duplicate_audit(df: DataFrame, key: Column | str) -> DataFrame:
    """One row: duplicated key groups, rows in them, rows a dedup would drop."""
    per_key = df.select(as_column(key).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    repeated = F.col("n") > 1
    named = repeated & F.col("k").isNotNull()
    return per_key.agg(
        F.count_if(named).alias("n_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_removed"),
    )


def step_counts(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row count after each named step, with the rows dropped since the step before."""
    rows = [
        df.agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "n")
        for i, (name, df) in enumerate(steps)
    ]
    counted = rows[0]
    for row in rows[1:]:
        counted = counted.unionByName(row)
    # One row per named step, so an unpartitioned window is safe here.
    before = F.lag("n").over(Window.orderBy("step"))
    return counted.withColumn("dropped", F.coalesce(before - F.col("n"), F.lit(0)))

"""Exact interpolated quantiles per group without collecting a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer. Here a
sketch finds, per group, a narrow bracket around each wanted rank, and edges inside it between
which lie about equally many rows, however the values are distributed. Every row falls into a
cell: between two edges of a bracket, or a region between brackets. Counts per cell tell
exactly which cells hold the wanted ranks, and only the values of those cells are counted and
put in order. The sketch decides how small these cells are, never the result: a rank that
lies outside its bracket is found in the region that holds it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store, workspace

ACCURACY = 10_000  # sketch rank error is at most n / ACCURACY
MARGIN = 5 / ACCURACY  # bracket half-width as a share of the group
SLOTS = 20  # slots of a bracket with equal shares of rows, of which only those holding a rank are sorted


def place(
    rows: DataFrame, keys: Sequence[str], ranks: Sequence[float], others: Sequence[Column] = ()
) -> tuple[DataFrame, list[str]]:
    """``keys, __v``, the group's sketch ``__s``, and the cell ``__region, __slot`` of every row; and
    the names of the other aggregates in the sketch."""
    brackets = [(max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)) for p in ranks]
    grid = sorted({low + (high - low) * i / SLOTS for low, high in brackets for i in range(SLOTS)} | {high for _, high in brackets})
    sketch = rows.groupBy(*keys).agg(
        F.count("__v").alias("__n"),
        F.percentile_approx("__v", grid, ACCURACY).alias("__edges"),
        *others,
    )
    names = [c for c in sketch.columns if c not in (*keys, "__n", "__edges")]
    sketch = sketch.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.struct("__n", "__edges", *names).alias("__s")
    )

    slim = rows.select(*keys, "__v")
    if keys:
        # Written first, so that its size is known when the join is planned: a small sketch is
        # broadcast and the rows stay where they are. Left to adaptive execution they would be
        # shuffled by key before that shows, a group in a task. Skewed keys of a large one are split.
        sketch = store(sketch, workspace(rows.sparkSession))
        match = F.lit(True)
        for key in keys:
            match = match & F.col(key).eqNullSafe(F.col(f"__k_{key}"))
        placed = slim.join(sketch, match)
    else:
        placed = slim.withColumn("__s", sketch.select("__s").scalar())

    def edge(p: float) -> Column:
        return F.col("__s.__edges")[grid.index(p)]

    value = F.col("__v")
    region, slot = F.lit(0), F.lit(-1)
    for low, high in brackets:
        region = region + F.when(value > edge(high), 1).otherwise(0)
    for low, high in reversed(brackets):
        # Only the few rows inside a bracket look for their slot.
        inner = F.slice("__s.__edges", grid.index(low) + 1, max(grid.index(high) - grid.index(low), 0))
        step = F.size(F.filter(inner, lambda e: e < value))
        here = F.when(value < edge(low), -1).otherwise(step)
        slot = F.when(value <= edge(high), here).otherwise(slot)
    return placed.select(*keys, "__v", "__s", region.alias("__region"), slot.alias("__slot")), names


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str | Column,
    quantiles: Mapping[str, float],
    others: Sequence[Column] = (),
    store_at: str | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles of ``column`` per group, NULL values left out.

    ``quantiles`` maps output names to probabilities; ``others`` are ordinary aggregates
    over the groups (they may refer to the value as ``__v``) computed in the same pass. Sketch,
    counts and values each read the rows: with ``store_at`` keys and values are written there
    once, and the source is read once.
    """
    source = F.col(column) if isinstance(column, str) else column
    rows = df.withColumn("__v", source.cast("double"))
    if store_at is not None:
        rows = store(rows.select(*keys, "__v"), store_at)
    ranks = sorted(set(quantiles.values()))
    placed, names = place(rows, keys, ranks, others)

    extras = [F.any_value(f"__s.{name}").alias(name) for name in ("__n", *names)]
    cells = placed.groupBy(*keys, "__region", "__slot").agg(F.count("__v").alias("__sum"), F.min("__v").alias("__first"), *extras)

    # Which cells hold a wanted rank: at most a few thousand rows per group to order.
    running = Window.partitionBy(*keys).orderBy(F.col("__first").asc_nulls_last())
    running = running.rowsBetween(Window.unboundedPreceding, 0)
    steps = cells.withColumn("__end", F.sum("__sum").over(running))
    wanted = F.col("__n") == 0
    for p in ranks:
        floor = F.floor((F.col("__n") - 1) * F.lit(p))
        for position in (floor, F.least(floor + 1, F.col("__n") - 1)):
            wanted = wanted | ((F.col("__end") > position) & (F.col("__end") - F.col("__sum") <= position))
    steps = steps.where(wanted).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__region").alias("__r"),
        F.col("__slot").alias("__t"),
        (F.col("__end") - F.col("__sum")).alias("__before"),
        "__n",
        *names,
    )
    if keys:
        steps = store(steps, workspace(df.sparkSession))
    match = (F.col("__region") == F.col("__r")) & (F.col("__slot") == F.col("__t"))
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"__k_{key}"))
    carried = ["__before", "__n", *names]
    values = placed.drop("__s").join(steps, match).groupBy(*keys, "__region", "__slot", F.col("__v").alias("__kept"))
    counted = values.agg(F.count("__v").alias("__c"), *[F.any_value(c).alias(c) for c in carried])
    within = Window.partitionBy(*keys, "__region", "__slot").orderBy(F.col("__kept").asc_nulls_last())
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("__upto", F.col("__before") + F.sum("__c").over(within))

    def at(position: Column) -> Column:
        covers = (F.col("__upto") > position) & (F.col("__upto") - F.col("__c") <= position)
        return F.max(F.when(covers, F.col("__kept")))

    picks, out = [], []
    for i, p in enumerate(ranks):
        position = (F.col("__n") - 1) * F.lit(p)
        floor = F.floor(position)
        picks += [
            at(floor).alias(f"__lo{i}"),
            at(F.least(floor + 1, F.col("__n") - 1)).alias(f"__hi{i}"),
        ]
    picked = counted.groupBy(*keys).agg(
        *picks, *[F.any_value(name).alias(name) for name in ("__n", *names)]
    )
    for name, p in quantiles.items():
        i = ranks.index(p)
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        position = (F.col("__n") - 1) * F.lit(p)
        between = F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))
        out.append(between.alias(name))
    return picked.select(*keys, *names, *out)

"""Metric documents in long form: one row per path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sanitize(value: Column, dtype: T.DataType) -> Column:
    """Value as text: NaN becomes NULL, fractions are rounded to four places."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        clean = F.when(~F.isnan(value), F.bround(value.cast("double"), 4))
        return clean.cast("string")
    return value.cast("string")


def scalar_metrics(row: DataFrame, prefix: str) -> DataFrame:
    """A one-row frame as ``prefix.column`` metrics."""
    cells = [
        F.struct(
            F.lit(f"{prefix}.{f.name}" if prefix else f.name).alias("path"),
            sanitize(F.col(f.name), f.dataType).alias("value"),
        )
        for f in row.schema.fields
    ]
    return row.select(F.explode(F.array(*cells)).alias("m")).select("m.*")


def keyed_metrics(df: DataFrame, prefix: str, label: str, value: str) -> DataFrame:
    """A label/value frame as ``prefix.label`` metrics."""
    kind = df.schema[value].dataType
    return df.select(
        F.concat(F.lit(f"{prefix}."), F.col(label)).alias("path"), sanitize(F.col(value), kind).alias("value")
    )


def table_metrics(df: DataFrame, prefix: str, label: str) -> DataFrame:
    """A crosstab as ``prefix.row.column`` metrics."""
    cells = [
        F.struct(
            F.concat(F.lit(f"{prefix}."), F.col(label), F.lit(f".{f.name}")).alias("path"),
            sanitize(F.col(f"`{f.name}`"), f.dataType).alias("value"),
        )
        for f in df.schema.fields
        if f.name != label
    ]
    return df.select(F.explode(F.array(*cells)).alias("m")).select("m.*")


def document(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def diff_metrics(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths whose value changed, appeared or vanished, in path order."""
    before = old.select("path", F.col("value").alias("old_value"))
    after = new.select("path", F.col("value").alias("new_value"))
    joined = before.join(after, "path", "full")
    changed = ~F.col("old_value").eqNullSafe(F.col("new_value"))
    return joined.where(changed).select("path", "old_value", "new_value").orderBy("path")


def as_json(doc: DataFrame) -> DataFrame:
    """The whole document as one JSON text; a metric document has tens of paths."""
    pairs = F.sort_array(F.collect_list(F.struct("path", "value")))
    return doc.agg(F.to_json(F.map_from_entries(pairs)).alias("document"))


def from_mapping(spark, values: Mapping[str, object], prefix: str = "") -> DataFrame:
    """A nested metric mapping (for example a parsed snapshot) in long form."""
    rows: list[tuple[str, str | None]] = []

    def walk(node: Mapping[str, object], path: str) -> None:
        for name, item in node.items():
            here = f"{path}.{name}" if path else name
            if isinstance(item, Mapping):
                walk(item, here)
            else:
                rows.append((here, None if item is None else str(item)))

    walk(values, prefix)
    return spark.createDataFrame(rows, "path string, value string")

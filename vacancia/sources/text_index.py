"""Trigram index over the files of a stored table: a text search opens only files that may hold a match.

The index is two tables: ``grams`` (file, column, gram), ranged by gram so that a lookup reads few
row groups, and ``files`` (file, column), written last. Files are taken to be immutable, as Spark
writes them; files that the index does not know are always read, so an old index costs time, never rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LENGTH = 3
FILE = "_metadata.file_path"
GRAMS, FILES = "file string, column string, gram string", "file string, column string"

# A pattern of these characters alone is literal text, any characters, repeats and alternatives.
SIMPLE = re.compile(r"[\w ,/&'@:;\-.*+?|]+")
BREAKS = re.compile(r".[*?][+?]*|\++|\.")


def needed_grams(query: str, literal: bool = False) -> list[set[str]] | None:
    """For each alternative of a query the trigrams that every match holds; None where one has none to tell."""
    if not literal and not SIMPLE.fullmatch(query):
        return None
    out = []
    for runs in [[query]] if literal else [BREAKS.split(a) for a in query.split("|")]:
        out.append({run[i : i + LENGTH] for run in runs for i in range(len(run) - LENGTH + 1)})
    return out if all(out) else None


def text_grams(text: Column) -> Column:
    """Trigrams of a text of at least three characters."""

    def of(chars: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(chars) - LENGTH)
        return F.array_distinct(F.transform(starts, lambda i: F.concat(*[chars[i + k] for k in range(LENGTH)])))

    # The characters are bound once; named inside the lambda they would be split again at every place.
    return F.transform(F.array(F.split(text, "")), of)[0]


def _known(spark: SparkSession, index: str, columns: Sequence[str]) -> DataFrame | None:
    """Files whose grams of all these columns are in the index; None where there is no index yet."""
    try:
        files = spark.read.schema(FILES).parquet(f"{index}/files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    counted = files.where(F.col("column").isin(list(columns))).groupBy("file")
    full = counted.agg(F.count_distinct("column").alias("n")).where(F.col("n") == len(set(columns)))
    return full.select("file")


def index_files(df: DataFrame, columns: Sequence[str], index: str) -> None:
    """Add the files of a stored table that the index does not know yet.

    ``df`` is the table as read, before any projection. Texts are indexed in lower case. A run that
    ends early leaves its files unknown; the next one adds them again, and repeated grams do no harm.
    """
    known = _known(df.sparkSession, index, columns)
    if known is not None:
        df = df.where(~F.col(FILE).isin([r.file for r in known.collect()]))
    texts = [F.struct(F.lit(c).alias("column"), F.lower(F.col(c)).alias("text")) for c in columns]
    rows = df.select(F.col(FILE).alias("file"), F.explode(F.array(*texts)).alias("t"))
    long_enough = rows.where(F.length("t.text") >= LENGTH)
    grams = long_enough.select("file", "t.column", F.explode(text_grams(F.col("t.text"))).alias("gram")).distinct()
    ordered = grams.repartitionByRange("gram").sortWithinPartitions("gram", "column", "file")
    ordered.write.mode("append").parquet(f"{index}/grams")
    rows.select("file", "t.column").distinct().write.mode("append").parquet(f"{index}/files")


def unmatched_files(
    spark: SparkSession, index: str, columns: Sequence[str], query: str, literal: bool = False
) -> list[str]:
    """Known files in which no column can match. The list is no longer than the table's own file listing."""
    needed = needed_grams(query, literal)
    known = _known(spark, index, columns)
    if needed is None or known is None:
        return []
    grams = spark.read.schema(GRAMS).parquet(f"{index}/grams")
    asked = grams.where(F.col("gram").isin(sorted(set().union(*needed))) & F.col("column").isin(list(columns)))
    held = asked.groupBy("file", "column").agg(F.collect_set("gram").alias("held"))
    fits = F.lit(False)
    for one in needed:
        fits = fits | (F.size(F.array_except(F.array(*[F.lit(g) for g in sorted(one)]), "held")) == 0)
    return [r.file for r in known.join(held.where(fits), "file", "left_anti").collect()]


def prune(df: DataFrame, index: str, columns: Sequence[str], query: str, literal: bool = False) -> DataFrame:
    """The stored table without files that hold no match; the filter acts when files are listed."""
    skipped = unmatched_files(df.sparkSession, index, columns, query, literal)
    return df.where(~F.col(FILE).isin(skipped)) if skipped else df

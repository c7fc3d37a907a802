"""A training-data pipeline over ``documents``: each stage works on what the one before kept.

1. ``language_id`` drops documents without a letter and those whose language is ambiguous.
2. ``line_dedup`` deletes later copies of repeated line runs of 50 words or more, and documents
   that have no words left after that.
3. ``ngram_join`` keeps one document, the one of least id, of each group of near duplicates.
4. ``decontamination`` drops documents that hold a window of a benchmark item.
5. ``byte_bpe`` encodes what is left and decodes it again.

Every stage takes and, but for the last, returns the columns of documents; further columns are
carried along. Every stage is written to the shared folder and read again by the next one.
Empty tables, NULLs in any column and repeated rows pass through as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import byte_bpe, decontamination, language_id, line_dedup, ngram_join
from vacancia.llm.common import read, stored

#: SQL cannot express the learned stage; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    if not model.languages:  # nothing to tell apart: only texts without a letter go
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = ("__lang", "__score", "__ambiguous")
    judged = language_id.predict(docs, model, names)
    return judged.where((F.col("__lang") != language_id.UNKNOWN) & ~F.col("__ambiguous")).drop(*names)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ("__n_lines", "__removed", "__emptied")
    cleaned = line_dedup.dedup_lines(docs, report=names[:2], emptied=names[2]).where(~F.col("__emptied"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.size("__removed") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ("__n_words", "__hits")
    scanned = decontamination.scan(docs, read(spark, sf_dir, "benchmark"), docs.columns, names)
    return scanned.where(F.size("__hits") == 0).drop(*names)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("line_dedup", dedup_lines),
    ("ngram_join", keep_one_of_each),
    ("decontamination", decontaminate),
    ("byte_bpe", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""What the operators of this package share: tables, folds, stored tables, Arrow passes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """``crc32`` of the id as text modulo ``folds``; NULL ids count as fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds, F.lit(0))


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back: a cut lineage that
    outlives executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def through(df: DataFrame, columns: list[str], schema: str, step: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """Send chosen columns through a function on Arrow batches, partition by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = step(batch)
            if out is not None and out.num_rows:
                yield out

    return df.select(*columns).mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, after which its worker keeps no freed memory: Spark lets idle workers live on beside the next stage."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped

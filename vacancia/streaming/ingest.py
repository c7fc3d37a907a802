"""New files once: landed as they are, or merged into the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..plans.increment import MartStore
from ..sources.landing import route

#: Files of a micro-batch that merges into the mart.
FILES_PER_BATCH = 1000


def land_new_files(spark: SparkSession, inbox: str, landing: str, state: str) -> None:
    """Append the files that arrived since the last call to the landing table.

    ``state`` is the query's checkpoint folder on shared storage; a rerun after a lost
    executor or driver continues from it, and each file lands exactly once.
    """
    arrivals = spark.readStream.schema(schemas.LANDING).json(inbox)
    query = (
        route(arrivals)
        .writeStream.format("parquet")
        .partitionBy("provider")
        .option("path", landing)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, landing: str) -> DataFrame:
    return spark.read.schema(schemas.STORED_LANDING).parquet(landing)


def stream_mart(spark: SparkSession, inbox: str, root: str, state: str, labels: DataFrame | None = None, buckets: int = 64) -> MartStore:
    """Merge the files that arrived since the last call into the mart under ``root``.

    Spark repeats the last micro-batch when a run died before its end was noted in ``state``; the
    store's ledger knows the batches it holds, so each one counts exactly once. ``labels`` are
    merged with the first batch of the call.
    """
    kept = MartStore(spark, root, buckets)
    pending = [labels]

    def merge(rows: DataFrame, batch: int) -> None:
        if kept.apply(batch, rows, pending[0]):
            pending[0] = None

    arrivals = spark.readStream.schema(schemas.LANDING).option("maxFilesPerTrigger", FILES_PER_BATCH).json(inbox)
    query = arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return kept

"""Session defaults shared by tests, the bench and ad-hoc use."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "vacancia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; every other size is the cluster's to set."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def local_session(app: str = "vacancia-local", cpus: int | None = None) -> SparkSession:
    """Single-JVM session for tests and the bench."""
    cpus = cpus or os.cpu_count() or 8
    return get_session(
        app,
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Call sites on every Column call cost more than small queries do.
        spark__python__sql__dataFrameDebugging__enabled="false",
    )


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a single-JVM session, as in a test, gets a temporary folder of its own;
    on a cluster that would be one machine's disk, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        application = spark.conf.get("spark.app.id")
        folder = _own_folders.setdefault(application, "") or tempfile.mkdtemp(prefix="vacancia-")
        _own_folders[application] = folder
    return folder.rstrip("/")


def workspace(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/vacancia-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a frame that several joins read to ``path`` and read it back.

    A written table survives lost executors and, unlike a checkpointed RDD, keeps column
    pruning and size statistics.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""The mart kept up to date batch by batch: only buckets that a batch touches are built anew.

Four tables are kept, each in buckets of a hash:

* ``newest``: the newest landing of every posting, typed, before the row filters; ``labels``: the
  newest labels of every posting. Both by posting id. Newest-of is associative, so merging a batch
  into them gives what all landings together would give, and no payload is parsed twice.
* ``staged``: filtered and labelled postings without their descriptions, the input of the
  cross-provider choice, and ``mart``. Both by the choice's key. A posting whose title or company changed leaves its old
  key, where another provider's posting may then win, so the old keys of all changed postings are
  chosen again too.

Descriptions are most of the bytes, and no choice reads them. They move once into ``newest`` and once
into ``mart``: from the mart's own old buckets where a posting was there before and has not changed, else
from the buckets of ``newest`` that hold the posting.

A batch writes the touched buckets as new files beside the old ones, and then one small ledger
file that names them. Until that file is there, readers see the state before the batch; a batch
whose number is in the ledger is not applied again. A job that dies half-way is therefore simply
repeated. Old versions stay readable until they are deleted.

NULL ids and NULL keys form one group each, as in the full build.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import dedup_key
from ..operators.dedupe import latest_per_key
from ..operators.joins import union_all
from ..session import store, workspace
from ..sources.landing import provider_of
from .mart import latest_labels, mart_from_labelled
from .staging import NEWEST, PROVIDERS, described, extract, wanted

LEDGER = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("rows", T.LongType()),
])
POSTING = ["provider", "job_id"]
ID_BUCKET, KEY_BUCKET = "id_bucket", "key_bucket"


def typed(landing: DataFrame) -> DataFrame:
    """Landing rows of any provider in the staging layout, with their provider."""
    routed = landing.withColumn("provider", provider_of(F.col("source")))
    parts = [
        extract(routed.where(F.col("provider") == name).drop("provider"), spec).withColumn("provider", F.lit(name))
        for name, spec in PROVIDERS.items()
    ]
    return described(union_all(parts))


def slim(rows: DataFrame) -> DataFrame:
    return rows.drop("description")


class MartStore:
    """The tables under ``root``; ``buckets`` is fixed when the store is first used."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def ledger(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def applied(self, batch: int) -> bool:
        return batch in self.versions().get("batch", {}).values()

    def versions(self) -> dict[str, dict[int, int | None]]:
        """Per table, each bucket's newest batch, None where that left it empty; under ``batch``,
        the applied batches. The driver receives a row per table, bucket and batch."""
        newest = F.when(F.col("rows") > 0, F.col("batch"))
        found = self.ledger().groupBy("name", F.when(F.col("bucket") < 0, F.col("batch")).otherwise(F.col("bucket")).alias("at"))
        out: dict[str, dict[int, int | None]] = {}
        for r in found.agg(F.max_by(F.struct(newest.alias("batch")), "batch").alias("last")).collect():
            out.setdefault(r["name"], {})[r["at"]] = r["at"] if r["name"] == "batch" else r["last"]["batch"]
        return out

    def current(
        self, name: str, schema: T.StructType, only: Sequence[int] | None = None, versions: dict | None = None
    ) -> DataFrame:
        """The newest version of a table's buckets; of some of them with ``only``."""
        found = (self.versions() if versions is None else versions).get(name, {})
        wanted = [(batch, b) for b, batch in found.items() if batch is not None and (only is None or b in only)]
        return self._read(name, schema, wanted)

    def _read(self, name: str, schema: T.StructType, places: Sequence[tuple[int, int]]) -> DataFrame:
        paths = [f"{self.root}/{name}/batch={batch}/bucket={b}" for batch, b in sorted(places)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, name: str, batch: int, df: DataFrame, bucket: str, touched: Sequence[int]) -> list[tuple]:
        """New versions of the touched buckets; returns their ledger rows."""
        path = f"{self.root}/{name}/batch={batch}"
        dealt = df.withColumnRenamed(bucket, "bucket")
        if "description" not in df.columns:
            # One file a bucket, but several where adaptive execution splits a large one. Tables with
            # texts are written as their tasks hold them, in more files, for one shuffle less.
            dealt = dealt.hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        rows = {}
        if touched:
            written = self.spark.read.schema(T.StructType([*df.drop(bucket).schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
            rows = dict(written.groupBy("bucket").count().collect())
        return [(batch, name, b, rows.get(b, 0)) for b in touched]

    def _commit(self, entries: list[tuple], batch: int) -> None:
        """One file: it is there or it is not. Bucket -1 marks the batch itself."""
        table = self.spark.createDataFrame([*entries, (batch, "batch", -1, 0)], LEDGER)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/{batch}")

    def mart(self) -> DataFrame:
        return self.current("mart", self._mart_schema()).select(*schemas.MART_COLUMNS)

    def _mart_schema(self) -> T.StructType:
        empty = self._labelled(typed(self.spark.createDataFrame([], schemas.LANDING)), self._no_labels())
        return mart_from_labelled(empty, columns=[*schemas.MART_COLUMNS, "provider"]).schema

    def _no_labels(self) -> DataFrame:
        return self.spark.createDataFrame([], schemas.ENRICHMENT)

    def _labelled(self, newest: DataFrame, labels: DataFrame) -> DataFrame:
        return wanted(newest).join(latest_labels(labels), "job_id", "left")

    def apply(self, batch: int, landing: DataFrame, labels: DataFrame | None = None) -> bool:
        """Merge newly landed rows and labels; False if this batch was applied before."""
        versions = self.versions()
        if batch in versions.get("batch", {}):
            return False
        new = store(typed(landing.select(*schemas.LANDING.fieldNames())).withColumn(ID_BUCKET, self._bucket(F.col("job_id"))), workspace(self.spark))
        new_labels = (self._no_labels() if labels is None else labels.select(*schemas.ENRICHMENT.fieldNames()))
        new_labels = store(new_labels.withColumn(ID_BUCKET, self._bucket(F.col("job_id"))), workspace(self.spark))
        touched = _values(new, ID_BUCKET) | _values(new_labels, ID_BUCKET)

        old = self.current("newest", new.drop(ID_BUCKET).schema, touched, versions)
        newest = latest_per_key(old.withColumn(ID_BUCKET, self._bucket(F.col("job_id"))).unionByName(new), POSTING, NEWEST)
        entries = self._write("newest", batch, newest, ID_BUCKET, sorted(touched))
        before = self.current("labels", new_labels.drop(ID_BUCKET).schema, touched, versions)
        both = before.withColumn(ID_BUCKET, self._bucket(F.col("job_id"))).unionByName(new_labels)
        entries += self._write("labels", batch, latest_per_key(both, ["job_id"], ["enriched_at"]), ID_BUCKET, sorted(touched))

        # Postings that landed or were labelled: as they were, and as they are now.
        everywhere = F.explode(F.array(*[F.lit(p) for p in PROVIDERS])).alias("provider")  # labels name no provider
        relabelled = new_labels.select(everywhere, "job_id").distinct()
        changed = store(new.select(*POSTING).unionByName(relabelled.select(*POSTING)).distinct(), workspace(self.spark))
        now = self._version("newest", batch, new.drop(ID_BUCKET).schema, entries)
        now_labels = self._version("labels", batch, new_labels.drop(ID_BUCKET).schema, entries)
        fresh = self._labelled(_matching(slim(now), changed, "left_semi"), now_labels)
        key = self._bucket(dedup_key("job_title", "company_name"))
        fresh = store(fresh.withColumn(KEY_BUCKET, key), workspace(self.spark))
        left = _matching(slim(old), changed, "left_semi").withColumn(KEY_BUCKET, key)
        keys = _values(fresh, KEY_BUCKET) | _values(left, KEY_BUCKET)

        layout = fresh.drop(KEY_BUCKET).schema
        stay = _matching(self.current("staged", layout, keys, versions), changed, "left_anti")
        entries += self._write("staged", batch, stay.withColumn(KEY_BUCKET, key).unionByName(fresh), KEY_BUCKET, sorted(keys))
        named = [c for c in schemas.MART_COLUMNS if c != "description"]
        chosen = mart_from_labelled(self._version("staged", batch, layout, entries), columns=[*named, "provider"])

        # Where each chosen posting's text is: in the mart as it was, or in the newest landings.
        before_ = self.current("mart", self._mart_schema(), keys, versions)
        same = _matching(before_.select(*POSTING), changed, "left_anti").withColumn("__kept", F.lit(True))
        chosen = _matching(chosen, same, "left").withColumn("__kept", F.coalesce("__kept", F.lit(False))).drop("__p", "__j")
        chosen = store(chosen, workspace(self.spark))
        ids = _values(chosen.where("not __kept").withColumn(ID_BUCKET, self._bucket(F.col("job_id"))), ID_BUCKET)
        latest = now if ids <= touched else now.unionByName(self.current("newest", now.schema, ids - touched, versions))
        texts = [rows.select(*POSTING, "description", F.lit(kept).alias("__from")) for rows, kept in ((before_, True), (latest, False))]
        mart = _matching(chosen, texts[0].unionByName(texts[1]), "inner", F.col("__kept") == F.col("__from"), ["__from", "description"])
        mart = mart.select(*schemas.MART_COLUMNS, "provider").withColumn(KEY_BUCKET, key)
        entries += self._write("mart", batch, mart, KEY_BUCKET, sorted(keys))
        self._commit(entries, batch)
        return True

    def _version(self, name: str, batch: int, schema: T.StructType, entries: list[tuple]) -> DataFrame:
        """Buckets that this batch has written."""
        return self._read(name, schema, [(batch, b) for _, n, b, rows in entries if n == name and rows])


def _values(df: DataFrame, bucket: str) -> set[int]:
    return {r[0] for r in df.select(bucket).distinct().collect()}


def _matching(
    df: DataFrame, postings: DataFrame, how: str, also: Column | None = None, carried: Sequence[str] = ("__kept",)
) -> DataFrame:
    """A join by posting, NULL ids equal; joins that widen ``df`` add the carried columns."""
    wide = [c for c in carried if c in postings.columns] if how in ("left", "inner") else []
    other = postings.select(F.col("provider").alias("__p"), F.col("job_id").alias("__j"), *wide)
    match = F.col("provider").eqNullSafe(F.col("__p")) & F.col("job_id").eqNullSafe(F.col("__j"))
    return df.join(other, match if also is None else match & also, how)

"""Exact quantiles: slots hold small shares of the rows, and the source is read once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.operators import aggregates, quantiles

DATA = {
    "log-normal": lambda rng, n: rng.lognormal(0, 4, n),
    "one heavy value": lambda rng, n: np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 1, n)),
    "equal values": lambda rng, n: np.full(n, 3.0),
    "two ends": lambda rng, n: np.where(rng.random(n) < 0.5, 1e-300, 1e300) * rng.random(n),
}


@pytest.mark.parametrize("kind", DATA)
def test_slots_are_small_and_results_exact(spark, kind):
    n = 100_000
    values = DATA[kind](np.random.default_rng(5), n)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("k", F.lit("a"))
    placed, _ = quantiles.place(df.withColumnRenamed("v", "__v"), ["k"], [0.25, 0.5, 0.75])
    inside = placed.where("__slot >= 0").groupBy("__region", "__slot").agg(F.count_distinct("__v").alias("values"))
    largest = inside.agg(F.max("values")).first()[0] or 0
    # A slot's share of the bracket, and the sketch's error on either side of it.
    assert largest <= n * (2 * quantiles.MARGIN / quantiles.SLOTS + 3 / quantiles.ACCURACY)
    wanted = {"q25": 0.25, "m": 0.5, "q75": 0.75}
    got = quantiles.group_quantiles(df, ["k"], "v", wanted).first()
    for name, p in wanted.items():
        assert got[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_medians_read_their_source_once(spark, tmp_path):
    rows = [(i % 3, float(i), float(i * i % 101)) for i in range(900)]
    source = str(tmp_path / "source")
    spark.createDataFrame(rows, "k int, a double, b double").write.parquet(source)
    out = aggregates.medians(spark.read.parquet(source), ["k"], ["a", "b"], store_at=str(tmp_path / "kept"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert source not in plan and "kept" in plan
    for k, a, b in out.collect():
        assert (a, b) == (np.median([r[1] for r in rows if r[0] == k]), np.median([r[2] for r in rows if r[0] == k]))


def test_rows_of_a_group_are_not_gathered(spark):
    """Few groups: rows meet the sketch and the wanted cells by broadcast, and are shuffled by neither."""
    rows = spark.range(3000).selectExpr("id % 3 AS k", "double(id) AS v")
    plan = quantiles.group_quantiles(rows, ["k"], "v", {"median": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 1

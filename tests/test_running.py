"""Ranks, numbers and previous rows in range order against plain versions, hot groups included."""

import random

import pytest
from pyspark.sql import functions as F

from vacancia.operators import dedupe, ranking, running, usage


@pytest.fixture(autouse=True)
def many_parts(spark):
    """Small tables would be joined into one part, which has nothing to carry over."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def table(spark, n=4000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b", None, None]), rng.choice([None, 0, 0, 0, 1, 2]), rng.randint(0, 9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, k string, t int, v int").repartition(16)


def first(x):
    return (x is not None, x)


def spread(frame):
    """Rows of the largest part as a share of all."""
    sizes = [r["count"] for r in frame.groupBy(running.PART).count().collect()]
    return max(sizes) / sum(sizes)


def test_rank_is_the_place_in_the_whole_order(spark):
    rows, df = table(spark)
    got = running.ranked(df, [F.col("v").desc(), F.col("id").asc()]).collect()
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[3], r[0])))}
    assert {r.id: r["rank"] for r in got} == want


def test_volume_rank_plans_no_single_task(spark):
    rng = random.Random(2)
    values = [str(int(rng.paretovariate(0.7))) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = ranking.volume_rank(df, "v")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    counted = {v: values.count(v) for v in set(values)}
    want = {v: i + 1 for i, (v, _) in enumerate(sorted(counted.items(), key=lambda x: (-x[1], x[0])))}
    assert {r.value: r["rank"] for r in out.collect()} == want


def test_numbers_within_groups_across_parts(spark):
    rows, df = table(spark)
    order = [F.col("t").asc_nulls_first(), F.col("id").asc()]
    got = {r.id: r.number for r in running.numbered(df, ["k"], order).collect()}
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (first(r[2]), r[0]))
        assert [got[r[0]] for r in group] == list(range(1, len(group) + 1))


def test_large_caps_spread_a_hot_group(spark):
    rows, df = table(spark)
    want = {n: sorted(r.id for r in dedupe.top_rows(df, ["k"], [F.col("id").asc_nulls_last()], n).collect()) for n in (1, 1500)}
    for n in want:
        assert sorted(r.id for r in dedupe.cap_per_group(df, ["k"], n, "id").collect()) == want[n]
    assert spread(running.in_parts(df, [F.col("k"), F.col("id")])) < 0.3  # the hot group holds two thirds
    assert dedupe.cap_per_group(df, ["k"], 5, "id")._jdf.queryExecution().optimizedPlan().toString().count("Window ") == 1


def test_previous_rows_when_all_rows_share_one_second(spark):
    rows, df = table(spark)
    got = {r.id: r.prev for r in running.previous_rows(df, ["k"], ["t", "id"], ["id", "v"]).collect()}
    assert len(got) == len(rows)
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (first(r[2]), r[0]))
        assert got[group[0][0]] is None
        assert [(got[b[0]].id, got[b[0]].v) for b in group[1:]] == [(a[0], a[3]) for a in group[:-1]]
    one = df.withColumn("k", F.lit("hot")).withColumn("t", F.lit(0))
    assert spread(running.in_parts(one, [F.col("k"), F.col("t"), F.col("id")])) < 0.3


def test_credit_burn_of_a_busy_source(spark):
    log = [("s", 0, f"{i:05}", 100 - i % 50, i) for i in range(2000)]
    df = spark.createDataFrame(log, "source string, t int, run_id string, credits_remaining int, credits_used_cumulative int")
    df = df.withColumn("run_at", F.expr("timestamp_seconds(t)"))
    got = {r.run_id: r.credits_used_this_run for r in usage.credit_burn(df).collect()}
    assert all(got[f"{i:05}"] == (i if i % 50 == 0 else 1) for i in range(2000))


def test_empty_tables_stay_empty(spark):
    _, df = table(spark, 0)
    assert running.ranked(df, [F.col("id")]).collect() == []
    assert running.numbered(df, ["k"], [F.col("id")]).collect() == []
    assert running.previous_rows(df, ["k"], ["id"], ["v"]).collect() == []

"""Operators against brute force on small data."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vacancia.operators import aggregates as agg
from vacancia.operators import dedupe, quantiles, running, similarity


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants(rng, n):
    out = []
    for _ in range(n):
        base = list(rng.choice(["Data Analyst", "data engineer II", "Analytics Engineer", "abc", "ab", "Acme Inc.", "a"]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(base) + 1)
            kind = rng.random()
            if kind < 0.4:
                base.insert(at, rng.choice("abxyZ é"))
            elif base and at < len(base):
                base[at : at + 1] = [] if kind < 0.7 else [rng.choice("abxyZ é")]
        out.append("".join(base))
    return out


@pytest.mark.parametrize("ratio", [0.15, 0.35])
def test_similar_texts_equals_brute_force(spark, ratio):
    texts = sorted({t for t in variants(random.Random(7), 250) if t})
    df = spark.createDataFrame([(t,) for t in texts] + [("",), (None,)], "t string")
    got = {(r.text_a, r.text_b) for r in similarity.similar_texts(df, "t", ratio).collect()}
    want = {
        (a, b) for a in texts for b in texts if edit_distance(a.lower(), b.lower()) / max(len(a), len(b)) <= ratio
    }
    assert got == want


def test_similar_text_plan_compares_no_cross_product(spark):
    df = spark.range(50).selectExpr("string(id) AS t")
    plan = similarity.similar_texts(df, "t", 0.15)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def quartiles(values):
    return [float(np.percentile(values, p)) for p in (25, 50, 75)]


@pytest.mark.parametrize("margin", [None, 0.0, -0.2])
def test_group_quantiles(spark, monkeypatch, margin):
    """Groups of all sizes; a bracket too narrow or beside its rank changes no result."""
    if margin is not None:
        monkeypatch.setattr(quantiles, "MARGIN", margin)
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.lognormal(10, 1, 60_000)]
    rows += [("flat", 5.0)] * 30_000 + [("steps", float(v)) for v in rng.integers(0, 4, 40_000)]
    rows += [("hot", None)] * 100 + [("two", 1.0), ("two", 2.0), ("one", 7.0), ("none", None)]
    rows += [("endless", float("inf"))] * 3 + [(None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    got = quantiles.group_quantiles(df, ["k"], "v", wanted, [F.count("__v").alias("n")]).collect()
    assert len(got) == 8
    for r in got:
        values = [v for k, v in rows if k == r.k and v is not None]
        assert r.n == len(values)
        if r.k == "endless":
            assert [r.q25, r.median, r.q75] == [float("inf")] * 3
        elif values:
            assert [r.q25, r.median, r.q75] == pytest.approx(quartiles(values), rel=1e-12)
        else:
            assert r.median is None
    finite = df.where("k <> 'endless'")
    whole = quantiles.group_quantiles(finite, [], "v", {"median": 0.5}).first().median
    assert whole == pytest.approx(float(np.median([v for k, v in rows if v is not None and k not in ("endless", None)])))


def test_quantile_cells_stay_small(spark):
    """Outside its bracket a large group keeps one row per region, whatever its size."""
    df = spark.range(200_000).selectExpr("0 AS k", "double(id) AS v")
    assert quantiles.group_quantiles(df, ["k"], "v", {"m": 0.5}).first().m == 99_999.5


def test_previous_row_equals_lag(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(0, 400_000), i, rng.randrange(9)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "k string, s long, id int, v int")
    df = df.withColumn("at", F.timestamp_seconds("s"))
    got = running.previous_rows(df, ["k"], ["at", "id"], ["v"])
    lag = F.lag("v").over(Window.partitionBy("k").orderBy("at", "id"))
    want = df.withColumn("want", lag).select("id", "want")
    both = got.select("id", F.col("prev.v").alias("got")).join(want, "id")
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
    assert both.count() == 2_000


def test_large_cap_equals_window(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS k", "id * 7919 % 20011 AS o")
    got = dedupe.cap_per_group(df, ["k"], 2_000, "o")
    rank = F.row_number().over(Window.partitionBy("k").orderBy("o"))
    want = df.withColumn("r", rank).where("r <= 2000").drop("r")
    assert sorted(got.collect()) == sorted(want.collect())


def test_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1_000).selectExpr("id % 3 AS k", "id AS o")
    plan = dedupe.first_per_key(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.rindex("Exchange")
    assert exchange < partial, "the limit must sit below the exchange"


def test_duplicate_marks_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "y"), (5, "y")], "id int, k string")
    marked = {r.id: r.is_duplicate for r in dedupe.mark_duplicates(df, ["k"]).collect()}
    assert marked == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_shares_sum_to_one(spark):
    df = spark.range(500).selectExpr("string(id % 5) AS g", "string(id % 7) AS v")
    sums = agg.share(agg.counts(df, ["g", "v"]), "g").groupBy("g").agg(F.sum("pct").alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in sums.collect())


def test_medians_keep_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, None)], "k string, x double, y double")
    got = {r.k: (r.x, r.y) for r in agg.medians(df, ["k"], ["x", "y"]).collect()}
    assert got == {"a": (2.0, None), "b": (None, None)}

"""describe() quartiles and top_k_distinct against brute force on small fixtures."""

from __future__ import annotations

import math
import random

import pytest

from shelfspark.operators.describe import describe, nearest_rank_quantiles
from shelfspark.operators.topk import top_k_distinct


def brute_quartiles(values):
    xs = sorted(v for v in values if v is not None)
    n = len(xs)
    return [xs[math.floor((n - 1) * q + 0.5)] for q in (0.25, 0.5, 0.75)] if n else [None] * 3


@pytest.mark.parametrize("seed,buckets", [(1, 3), (2, 1), (3, None), (4, 7)])
def test_quartiles_match_brute_force(spark, seed, buckets):
    rnd = random.Random(seed)
    values = [rnd.choice([None, round(rnd.uniform(-50, 50), 1), 7.0, 7.0]) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = nearest_rank_quantiles(df, "x", buckets=buckets).first()
    assert [got["q0"], got["q1"], got["q2"]] == brute_quartiles(values)


def test_describe_rows_and_order(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (10.0,)], "price double")
    rows = describe(df, "price").collect()
    stats = [r["statistic"] for r in rows]
    assert stats == ["count", "null_count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    got = {r["statistic"]: r["price"] for r in rows}
    assert got["count"] == 4 and got["null_count"] == 1 and got["mean"] == 4.25
    assert (got["min"], got["max"]) == (1.0, 10.0)
    assert [got["25%"], got["50%"], got["75%"]] == brute_quartiles([1.0, 2.0, None, 4.0, 10.0])


def test_describe_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "price double")
    got = {r["statistic"]: r["price"] for r in describe(df, "price").collect()}
    assert got["count"] == 0 and got["null_count"] == 2 and got["50%"] is None


def brute_top(rows, k):
    best = {}
    for name, v in rows:
        if name not in best:
            best[name] = v
        elif best[name] is None or v is None:
            best[name] = None
        else:
            best[name] = max(best[name], v)
    key = lambda kv: (kv[1] is not None, -(kv[1] or 0), kv[0] is not None, kv[0] or "")
    return sorted(best.items(), key=key)[:k]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_top_k_distinct_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l", None]),
             rnd.choice([None] + list(range(30))) if rnd.random() < 0.05 else rnd.randrange(30))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "name string, v bigint")
    got = [(r["name"], r["v"]) for r in top_k_distinct(df, "name", "v", 10).collect()]
    assert got == brute_top(rows, 10)


def test_top_k_distinct_hot_key(spark):
    """One name holds most rows."""
    rows = [("hot", i) for i in range(1000)] + [(f"n{i}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "name string, v bigint")
    got = [(r["name"], r["v"]) for r in top_k_distinct(df, "name", "v", 10).collect()]
    assert got == brute_top(rows, 10)


def test_quartiles_with_outlier_and_balanced_buckets(spark):
    from pyspark.ml.feature import Bucketizer

    from shelfspark.operators.describe import _histogram, _splits
    values = [float(i) for i in range(3000)] + [1e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = nearest_rank_quantiles(df, "x", buckets=30).first()
    assert [got["q0"], got["q1"], got["q2"]] == brute_quartiles(values)
    hist = _histogram(df, "x").where("v IS NOT NULL")
    splits = _splits(hist, 3001, 30)
    sizes = Bucketizer(splits=splits, inputCol="v", outputCol="b").transform(hist) \
        .groupBy("b").count().collect()
    assert max(r["count"] for r in sizes) < 3001 / 30 * 2  # no bucket swallows the rest


def test_quartiles_with_nan(spark):
    values = [1.0, float("nan"), 3.0, 2.0, float("nan"), None, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    xs = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    n = len(xs)
    expected = [xs[math.floor((n - 1) * q + 0.5)] for q in (0.25, 0.5, 0.75)]
    got = nearest_rank_quantiles(df, "x", buckets=2).first()
    for g, e in zip([got["q0"], got["q1"], got["q2"]], expected):
        assert (math.isnan(g) and math.isnan(e)) or g == e

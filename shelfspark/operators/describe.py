"""Column summary: count, null_count, mean, std, min, quartiles, max.

Quartiles are exact, "nearest" rank: the value at 0-based index
``floor((n - 1) * q + 0.5)`` of the sorted non-null values.

Plan: one pass over the rows, pre-aggregated before any shuffle.
  1. histogram ``(v, c)`` of distinct values, NULL included — partial
     aggregation in every task; every statistic is computed from it:
     count, null_count, min, max and mean directly, the sample std as
     ``sqrt(sum(c * (v - mean)^2) / (n - 1))`` (two-pass, numerically stable);
  2. value buckets cut at approximate quantiles of the distinct values
     (``percentile_approx``), assigned with ``Bucketizer`` (binary search):
     each bucket holds about the same number of distinct values whatever the
     distribution (an outlier cannot pile everything into one bucket). The
     bucket count grows with the distinct count (about ``VALUES_PER_BUCKET``
     each) between ``MIN_BUCKETS`` and ``MAX_BUCKETS``, so the bucket-total
     table has at most ``MAX_BUCKETS + 2`` rows: its broadcast has a proven
     bound;
  3. prefix sums: bucket offsets from the small bucket table, then running
     counts inside each bucket (a window partitioned by bucket) — no global
     sort and no single-partition window over rows;
  4. quantile = min value whose running count passes the target index.
The bucket cut points and the summary are two small driver-side results
(at most ``MAX_BUCKETS`` numbers).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statistic names, in output order.
STATISTICS = ("count", "null_count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)
MIN_BUCKETS, MAX_BUCKETS, VALUES_PER_BUCKET = 64, 100_000, 100_000


def _histogram(df: DataFrame, col: str) -> DataFrame:
    v = F.col(col).cast("double")
    return df.select(v.alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("c"))


def _summary(hist: DataFrame):
    """One small driver-side row over the histogram: lo, hi, n, nulls, d, mean."""
    c, v = F.col("c"), F.col("v")
    n = F.sum(F.when(v.isNotNull(), c))
    return hist.agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), n.alias("n"),
        F.coalesce(F.sum(F.when(v.isNull(), c)), F.lit(0)).alias("nulls"),
        F.count(v).alias("d"),
        (F.sum(v * c) / n).alias("mean")).first()


def _bucket_count(d: int, buckets: int | None) -> int:
    if buckets is None:
        buckets = max(MIN_BUCKETS, math.ceil(d / VALUES_PER_BUCKET))
    return max(1, min(int(buckets), MAX_BUCKETS, max(int(d), 1)))


def _splits(values: DataFrame, d: int, buckets: int | None) -> list[float]:
    """Strictly increasing cut points (-inf ... +inf) at approximate quantiles."""
    nb = _bucket_count(d, buckets)
    cuts: list[float] = []
    if nb > 1:
        probs = [i / nb for i in range(1, nb)]
        approx = values.agg(F.percentile_approx("v", probs, max(10_000, 4 * nb))).first()[0]
        cuts = sorted({x for x in approx or [] if x is not None and math.isfinite(x)})
    if not cuts:
        cuts = [0.0]
    return [-math.inf, *cuts, math.inf]


def _ranked(hist: DataFrame, d: int, buckets: int | None) -> DataFrame:
    """Non-null histogram rows with ``cum`` = running count through ``v``."""
    from pyspark.ml.feature import Bucketizer

    values = hist.where(F.col("v").isNotNull())
    splits = _splits(values, d, buckets)
    # NaN (greatest in Spark's order) goes to an extra last bucket
    bucketizer = Bucketizer(splits=splits, inputCol="v", outputCol="b", handleInvalid="keep")
    hb = bucketizer.transform(values).withColumn("b", F.col("b").cast("int"))

    totals = hb.groupBy("b").agg(F.sum("c").alias("bc"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("b", F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("offset"))

    within = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (hb.join(F.broadcast(offsets), "b")
            .select("v", "c", (F.col("offset") + F.sum("c").over(within)).alias("cum")))


def _quantile(n, q: float) -> Column:
    target = math.floor((n - 1) * q + 0.5) if n else -1
    return F.min(F.when(F.col("cum") > F.lit(target), F.col("v")))


def nearest_rank_quantiles(df: DataFrame, col: str, qs=QUARTILES,
                           buckets: int | None = None) -> DataFrame:
    """One row with one DOUBLE column ``q0, q1, ...`` per requested quantile."""
    hist = _histogram(df, col)
    s = _summary(hist)
    return _ranked(hist, s["d"], buckets).agg(
        *[_quantile(s["n"], q).alias(f"q{i}") for i, q in enumerate(qs)])


def describe(df: DataFrame, col: str, buckets: int | None = None) -> DataFrame:
    """``statistic STRING, <col> DOUBLE``: nine rows in a fixed order."""
    return describe_histogram(_histogram(df, col), col, buckets)


def describe_histogram(hist: DataFrame, col: str, buckets: int | None = None) -> DataFrame:
    """``describe`` of the rows whose distinct values and counts ``hist`` ``(v DOUBLE, c)``
    holds, NULL among them. A stored histogram spares the scans of the rows."""
    s = _summary(hist)
    n, mean = s["n"], s["mean"]
    dev = F.col("c") * F.pow(F.col("v") - F.lit(mean), 2)
    std = F.sqrt(F.sum(dev) / F.lit(n - 1)) if n and n > 1 else F.lit(None)
    agg = _ranked(hist, s["d"], buckets).agg(
        *[_quantile(n, q).alias(f"q{i}") for i, q in enumerate(QUARTILES)], std.alias("std"))
    values: list[Column] = [
        F.lit(n or 0), F.lit(s["nulls"]), F.lit(mean), F.col("std"), F.lit(s["lo"]),
        F.col("q0"), F.col("q1"), F.col("q2"), F.lit(s["hi"]),
    ]
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("statistic"), val.cast("double").alias(col))
        for i, (name, val) in enumerate(zip(STATISTICS, values))
    ])
    # nine rows from a one-row aggregate: ordered in place, no range shuffle
    return (agg.select(F.inline(rows)).coalesce(1).sortWithinPartitions("ord")
            .select("statistic", col))

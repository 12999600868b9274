"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, hot_rows: int = 1_000, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``keyed``: stored, one row per key, and in ``n``
    how many rows have the key.

    Keys of ``hot_rows`` or more, at most a ``hot_rows``-th of the rows, are
    joined apart and broadcast where their count proves them few, so that their
    rows stay spread over the tasks that read them.
    """
    hot = keyed.where(F.col("n") >= hot_rows).drop("n")
    rest = keyed.where(F.col("n") < hot_rows).drop("n")
    if hot.isEmpty():
        return rows.join(rest, key, how)
    hot = counted(hot)
    cold = rows.join(hot.select(key), key, "left_anti").join(rest, key, how)
    return cold.unionByName(rows.join(hot, key))


def _with_smallest(edges: DataFrame, hot_degree: int) -> DataFrame:
    """``(u, v, m)``: each link with the smallest neighbour of ``u`` (stored edges)."""
    low = stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "smallest")
    return spread_join(edges, low, "u", hot_degree)


def connected_components(edges: DataFrame, max_rounds: int = 100, hot_degree: int = 1_000) -> DataFrame:
    """``(u, v)`` links -> ``(node, component)``: for every node in a link, the
    smallest node it can reach.

    Each round links every larger neighbour to the smallest one (large star),
    then every smaller one (small star), until nothing changes; the number of
    rounds grows with the logarithm of the longest chain. The link table is
    written to the shared folder each round. Minima are pre-aggregated in each
    task; nodes of ``hot_degree`` or more links are joined apart (``spread_join``).
    """
    links = stored(edges.where(F.col("u") != F.col("v"))
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "links")
    before = _state(links)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_with_smallest(both, hot_degree).where(F.col("v") > F.col("u"))
                       .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                       .where(F.col("u") != F.col("v")).distinct(), "stars")
        small = (_with_smallest(large, hot_degree).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where(F.col("u") != F.col("v")).distinct())
        links = stored(small, "links")
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

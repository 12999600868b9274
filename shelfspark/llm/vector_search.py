"""Exact top-k inner products by vector-approximation files.

Every component is replaced by the number of its cell (quantile cells of that
dimension over all vectors). A query scans the cells: the least and greatest value
of a cell bound the component, hence the score. Vectors whose upper bound is below
the k-th greatest lower bound are out; the exact vectors of the others are read in
order of their upper bounds (for inner products the counterpart of lower distance
bounds), until the k-th best exact score beats every bound left. Cells decide what
is read, never what is found.

Equal vectors are searched once: per distinct vector only its k + 1 smallest ids can
be among the k best of any query. Distinct query vectors are searched for k + 1 rows,
the query's own row among them. Queries and vectors are dealt into blocks of bounded
size; each pair of blocks is one group, and its best rows meet in a ranking that Spark
prunes before its shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, register, ship_code, stored, table
from .vectors import bytes_column, dimension, integer_vectors, matrix, usable

TAIL = 0.001  # the outermost cells hold this share of the vectors: outliers widen no others


def cell_bounds(vectors: DataFrame, scale: int, d: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer of each cell: two (d, cells) arrays. Cells without
    values repeat the one before them. Quantiles over all vectors, one row of them."""
    shares = [TAIL, *(i / (cells - 2) for i in range(1, cells - 2)), 1 - TAIL]
    v = vectors.where(usable(F.col("v"))).select(F.transform("v", lambda x: F.floor(x * float(scale))).alias("v"))
    at = [F.col("v")[i] for i in range(d)]
    row = v.agg(*[F.array(F.min(x), F.max(x)) for x in at], *[F.percentile_approx(x, shares, 1000) for x in at]).first()
    low, high = np.zeros((d, cells), np.int64), np.zeros((d, cells), np.int64)
    for i in range(d):
        (least, most), cuts = row[i], row[d + i]
        begins = sorted({least, *(x for x in cuts if least < x <= most)})  # a cell begins at each cut
        ends = [*(x - 1 for x in begins[1:]), most]
        low[i] = begins + [begins[-1]] * (cells - len(begins))
        high[i] = ends + [ends[-1]] * (cells - len(ends))
    return low, high


def _cell_pass(low: np.ndarray):
    """Add the cells of each vector: one byte a component."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"))
            cells = np.empty(v.shape, np.uint8)
            for i in range(v.shape[1]):
                cells[:, i] = np.searchsorted(np.unique(low[i]), v[:, i], side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, bytes_column(cells)], names=[*batch.schema.names, "cells"])
    return run


def best_of(q: np.ndarray, v: np.ndarray, ids: np.ndarray, lower: np.ndarray, upper: np.ndarray, k: int,
            step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ``k`` best exact scores (ties to the smaller id) and the scores;
    exact vectors are read ``step`` at a time in order of their upper bounds."""
    left = np.arange(len(v))
    if len(v) > k:
        left = np.flatnonzero(upper >= np.partition(lower, len(v) - k)[len(v) - k])
    left = left[np.lexsort((ids[left], -upper[left]))]
    rows, scores = left[:0], np.zeros(0, np.int64)
    for at in range(0, len(left), step):
        read = left[at:at + step]
        rows = np.concatenate([rows, read])
        scores = np.concatenate([scores, v[read] @ q])
        best = np.lexsort((ids[rows], -scores))[:k]
        rows, scores = rows[best], scores[best]
        if len(rows) == k and at + step < len(left):
            bound = left[at + step]
            if (-upper[bound], ids[bound]) > (-scores[-1], ids[rows[-1]]):
                break
    return rows, scores


def _search(low: np.ndarray, high: np.ndarray, k: int, schema: pa.Schema, queries_at_once: int = 64):
    def bounds(q: np.ndarray, least: np.ndarray, most: np.ndarray):
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ least.T + down @ most.T, up @ most.T + down @ least.T

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query": [], "ids": [], "score": [], "same": []}
        if vectors.num_rows and queries.num_rows:
            v = matrix(vectors["v"]).astype(np.int64)
            q = matrix(queries["v"]).astype(np.int64)
            ids, number = vectors["ids"].combine_chunks(), queries["query"].to_numpy()
            first = vectors["first"].to_numpy()
            cells, dims = matrix(vectors["cells"], "u1"), np.arange(v.shape[1])
            least, most = low[dims, cells], high[dims, cells]
            # whole numbers below 2^53 are exact in doubles, whose products are far faster
            if np.abs(q).max() * max(np.abs(least).max(), np.abs(most).max()) * v.shape[1] < 1 << 53:
                least, most, exact = least.astype(float), most.astype(float), float
            else:
                exact = np.int64
            for at in range(0, len(q), queries_at_once):
                lower, upper = bounds(q[at:at + queries_at_once].astype(exact), least, most)
                for i in range(len(lower)):
                    rows, scores = best_of(q[at + i], v, first, lower[i].astype(np.int64),
                                           upper[i].astype(np.int64), k)
                    out["query"].append(np.full(len(rows), number[at + i]))
                    out["ids"].append(rows)
                    out["score"].append(scores)
                    out["same"].append((v[rows] == q[at + i]).all(axis=1))
        made = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in out.items()}
        return pa.table([pa.array(made["query"], pa.int64()),
                         ids.take(pa.array(made["ids"])) if out["ids"] else pa.array([], schema.field("ids").type),
                         pa.array(made["score"], pa.int64()), pa.array(made["same"], pa.bool_())], schema=schema)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64, cells: int = 32, block: int = 16_384,
          query_block: int = 1_024, most_broadcast: int = 100_000) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` rows of ``vectors`` (all, if fewer) of
    the highest integer inner product with each row of ``queries``, ties to the
    smaller id, rank from 1.

    Components are floor(scale * x). ``queries`` are rows of ``vectors`` or others; a
    row with the query's id and vector is the query itself and no result. Rows that
    repeat as a whole count once; an id on rows of different vectors names each of
    them. Rows without an id, and vectors that are NULL, empty or hold a NULL or
    non-finite component, take no part. No queries or no vectors give no rows. Ids
    are whole numbers; vectors of different lengths raise.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    for frame in (vectors, queries):
        if dict(frame.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint"):
            raise ValueError(f"{id_col} must hold whole numbers")
    schema = "query_id long, rank int, id long, score long"

    def whole(frame: DataFrame, tag: str) -> DataFrame:
        rows = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL")
        return stored(integer_vectors(rows, "v", scale, {"id": "id"}).distinct(), tag)
    rows, asked = whole(vectors, "topk-rows"), whole(queries, "topk-asked")
    d, d_asked = dimension(rows), dimension(asked)
    if not d or not d_asked:
        return spark.createDataFrame([], schema)
    if d != d_asked:
        raise ValueError(f"queries of {d_asked} components, vectors of {d}")
    low, high = cell_bounds(vectors.where(F.col(id_col).isNotNull()).select(
        F.col(vector_col).cast("array<double>").alias("v")), scale, d, cells)

    of_vector = Window.partitionBy("v").orderBy("id")
    classes = rows.withColumn("r", F.row_number().over(of_vector)).where(F.col("r") <= k + 1) \
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    file = stored(classes.select(F.monotonically_increasing_id().alias("number"), F.col("ids")[0].alias("first"),
                                 "ids", "v").mapInArrow(_cell_pass(low), "number long, first long, ids array<long>, "
                                                        "v binary, cells binary"), "topk-file")
    kinds = stored(asked.groupBy("v").agg(F.count("*").alias("n"))
                   .select(F.monotonically_increasing_id().alias("query"), "v", "n"), "topk-queries")
    n_blocks = max(1, -(-file.count() // block))
    n_asked = max(1, -(-kinds.count() // query_block))

    def dealt(number: str, blocks: int):
        return F.pmod(F.xxhash64(number), F.lit(blocks)).cast("int")

    def every(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = file.select("*", dealt("number", n_blocks).alias("b"), every(n_asked).alias("q"))
    right = kinds.select("query", "v", dealt("query", n_asked).alias("q"), every(n_blocks).alias("b"))
    found_schema = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.int64()),
                              ("same", pa.bool_())])
    found = left.groupBy("q", "b").cogroup(right.groupBy("q", "b")).applyInArrow(
        _search(low, high, k + 1, found_schema), "query long, ids array<long>, score long, same boolean")
    of_query = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    tops = found.select("query", F.explode("ids").alias("id"), "score", "same") \
        .withColumn("r", F.row_number().over(of_query)).where(F.col("r") <= k + 1) \
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score", "same"))).alias("tops"))
    tops = stored(tops.join(kinds, "query").select("v", "n", "tops"), "topk-tops")
    answers = join_counted(asked.withColumnRenamed("id", "query_id"), tops, ["v"], asked.count(), most_broadcast)
    others = F.slice(F.filter("tops", lambda t: ~(t["same"] & (t["id"] == F.col("query_id")))), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.id").alias("id"),
        F.col("t.score").alias("score"))


OP13_SQL = """
WITH kept AS MATERIALIZED (SELECT DISTINCT vec_id, list_transform(embedding,
        lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id,
        CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM kept q JOIN kept c ON q.vec_id % 20 = 0 AND (q.vec_id <> c.vec_id OR q.v <> c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


@register("op13_exact_top_k", OP13_SQL)
def op13(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 20 == 0)).withColumnRenamed("id", "vec_id")

"""Vector code compression: product codebooks by active-entry Lloyd rounds.

Vectors are cut into equal parts; each part position has a codebook, and a vector
is stored as the index of its nearest entry per part. Each round assigns all parts
and moves every entry to the floor of its parts' mean, in exact integers. A part's
squared distance to its entry is kept: where that entry stayed in place, only the
entries that moved are compared against the kept distance; other parts are compared
with the whole codebook. Of equally near entries the lowest index is taken.

The codebooks (parts x entries x components) are all the driver holds. Assignments
and distances live beside the vectors in a table in the shared folder, written once
a round without a shuffle; the round before it is deleted then. Means come from one
row per task and component, summed by Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import remove_folder
from .common import join_counted, register, scratch, ship_code, stored, table
from .vectors import bytes_column, dimension, integer_vectors, matrix


def distances(v: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to all entries (int64)."""
    most = max(int(np.abs(v).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * v.shape[1] * most * most < 1 << 53:  # whole numbers below 2^53 are exact in doubles
        a, b = v.astype(float), entries.astype(float)
        out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return out.astype(np.int64)
    return np.stack([((v - e) ** 2).sum(axis=1) for e in entries], axis=1)


def assign(v: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> None:
    """Nearest entries of one part of all vectors, entered into ``code`` and ``dist``,
    which hold the assignment to the entries before ``moved`` ones moved."""
    active = np.flatnonzero(moved)
    rescan = moved[code]
    if rescan.any():
        d = distances(v[rescan], entries)
        code[rescan] = near = d.argmin(axis=1)  # the first of equals
        dist[rescan] = d[np.arange(len(d)), near]
    held = np.flatnonzero(~rescan)
    if len(active) and len(held):
        d = distances(v[held], entries[active])
        best = d.argmin(axis=1)
        least, near = d[np.arange(len(d)), best], active[best]
        better = (least < dist[held]) | ((least == dist[held]) & (near < code[held]))
        code[held[better]], dist[held[better]] = near[better], least[better]


def _assign_pass(codebooks: np.ndarray, moved: np.ndarray):
    parts, _, width = codebooks.shape

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v")).astype(np.int64)
            if "code" in batch.schema.names:
                code = matrix(batch.column("code"), "u1").copy()
                dist = matrix(batch.column("dist"), "<i8").copy()
            else:
                code, dist = np.zeros((len(v), parts), np.uint8), np.zeros((len(v), parts), np.int64)
            for p in range(parts):
                c, d = code[:, p].astype(np.int64), dist[:, p].copy()
                assign(v[:, p * width:(p + 1) * width], codebooks[p], moved[p], c, d)
                code[:, p], dist[:, p] = c, d
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("v"), bytes_column(code),
                 bytes_column(dist), pa.array(dist.sum(axis=1))],
                names=["id", "label", "v", "code", "dist", "error"])
    return run


def _sum_pass(parts: int, entries: int, width: int):
    """Per task one row for each sum (component) and count (component -1)."""
    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, code = matrix(batch.column("v")).astype(float), matrix(batch.column("code"), "u1")
            for p in range(parts):
                own = (code[:, p, None] == np.arange(entries)).astype(float)
                total[p, :, 1:] += (own.T @ v[:, p * width:(p + 1) * width]).astype(np.int64)
                total[p, :, 0] += own.sum(axis=0).astype(np.int64)
        p, e, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int64()), pa.array(e, pa.int64()), pa.array(c - 1, pa.int64()),
             pa.array(total[p, e, c])], names=["part", "entry", "component", "total"])
    return run


def _moved_entries(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Entries at the floor of their parts' mean; unused ones where they were."""
    parts, entries, width = codebooks.shape
    sums = state.select("v", "code").mapInArrow(
        _sum_pass(parts, entries, width), "part long, entry long, component long, total long")
    total = np.zeros((parts, entries, width + 1), np.int64)
    for r in sums.groupBy("part", "entry", "component").agg(F.sum("total").alias("total")).collect():
        total[r["part"], r["entry"], r["component"] + 1] = r["total"]
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), codebooks)


def encode_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str | None = "label", scale: int = 4096, parts: int = 8, entries: int = 16,
                   rounds: int = 6) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` per kept row and the codebooks (parts, entries,
    components of a part).

    ``code``: one byte per part; ``error``: the summed squared distances of the
    parts to their entries, in steps of 1 / scale. Rows whose vector is NULL, empty
    or holds a NULL or non-finite component are left out. The first entries are the
    vectors of the smallest ids (NULL ids last, equal ids by vector); fewer rows
    give fewer entries. Repeated rows and ids are coded like any other. An empty
    table gives no rows and codebooks without entries. Vectors of different lengths,
    or of a length that is no multiple of ``parts``, raise.
    """
    spark = rows.sparkSession
    ship_code(spark)
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    keys = {"id": id_col, "label": label_col} if label_col else {"id": id_col}
    vectors = stored(integer_vectors(rows, vector_col, scale, keys).withColumns(
        {} if label_col else {"label": F.lit(None).cast("int")}).select("id", "label", "v"), "codes-vectors")
    d = dimension(vectors)
    if d % parts:
        raise ValueError(f"vectors of {d} components cannot be cut into {parts} equal parts")
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    codebooks = np.stack([np.frombuffer(r["v"], "<i4").astype(np.int64) for r in first]) \
        .reshape(len(first), parts, d // parts).transpose(1, 0, 2) if first else np.zeros((parts, 0, 0), np.int64)
    kinds = dict(vectors.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, v binary, code binary, dist binary, error long"
    if not first:
        return spark.createDataFrame([], schema).select("id", "label", "code", "error"), codebooks
    state, path = vectors, None
    moved = np.ones(codebooks.shape[:2], bool)
    for r in range(rounds + 1):
        last, path = path, scratch(spark, "codes")
        state.mapInArrow(_assign_pass(codebooks, moved), schema).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if last:
            remove_folder(spark, last)  # its successor is written in full
        if r == rounds:
            break
        new = _moved_entries(state, codebooks)
        moved, codebooks = (new != codebooks).any(axis=2), new
        if not moved.any():  # the rounds left would change nothing
            break
    return state.select("id", "label", "code", "error"), codebooks


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """Add ``label_error``: the error summed over equal labels, NULLs together."""
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")),
                    "codes-labels")
    return join_counted(coded, totals, ["label"], coded.count(), most_broadcast)


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same rounds as SQL: one table of assignments and one of entries a round."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""cut AS MATERIALIZED (SELECT r, p, list_slice(v, p * (len(v) // {parts}) + 1,
        (p + 1) * (len(v) // {parts})) AS part FROM kept, range({parts}) t(p))""",
             f"e0 AS MATERIALIZED (SELECT p, r - 1 AS j, part AS e FROM cut WHERE r <= {entries})"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, part, m % {entries} AS j, m // {entries} AS dist FROM (
        SELECT r, p, any_value(part) AS part, min(CAST(list_sum(list_transform(list_zip(part, e),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + j) AS m
        FROM cut JOIN e{i} USING (p) GROUP BY r, p))""")
        if i < rounds:
            steps.append(f"""e{i + 1} AS MATERIALIZED (SELECT o.p, o.j, COALESCE(n.e, o.e) AS e FROM e{i} o LEFT JOIN (
        SELECT p, j, list(mean ORDER BY k) AS e FROM (
            SELECT p, j, k, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
            FROM (SELECT p, j, unnest(part) AS x, generate_subscripts(part, 1) AS k FROM a{i}) GROUP BY p, j, k)
        GROUP BY p, j) n ON o.p = n.p AND o.j = n.j)""")
    return f"""WITH {', '.join(steps)},
    coded AS (SELECT r, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
              FROM a{rounds} GROUP BY r),
    book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, j, k)) AS codebooks_sha256
             FROM (SELECT p, j, unnest(e) AS x, generate_subscripts(e, 1) AS k FROM e{rounds}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), book"""


@register("op12_vector_codes", _oracle())
def op12(spark, sf_dir):
    coded, codebooks = encode_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"))

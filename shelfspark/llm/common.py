"""Small helpers shared by the operators: inputs, stored tables, registry."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()

# Rows hold whole texts: fewer of them per Arrow batch than Spark's 10,000, so
# that a batch is a few MB. Set only where the launch configuration does not.
WHOLE_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, so that
    executors need no installed copy of it."""
    sc = spark.sparkContext
    for key, value in WHOLE_TEXTS.items():
        if not sc.getConf().contains(key):
            spark.conf.set(key, value)
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfspark-"), "shelfspark_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared folder, another one for each call."""
    return shared_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor costs a re-read and not the work before it."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(keys: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """A stored key table, marked for broadcast when its count proves it small."""
    return F.broadcast(keys) if keys.count() <= most_broadcast else keys


def filter_rows(docs: DataFrame, keep: Callable) -> DataFrame:
    """Rows for which ``keep(batch)`` (a boolean array per Arrow batch) holds,
    with all columns, in place: no join and no shuffle."""
    def run(batches):
        for batch in batches:
            yield batch.filter(keep(batch))
    return docs.mapInArrow(run, docs.schema)


def drop_keys(rows: DataFrame, keys: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """Rows whose key columns are not in ``keys`` (NULL-safe), broadcast when the
    number of keys proves them small, else both sides shuffle."""
    keys = stored(keys.distinct(), "keys")
    names = keys.columns
    right = keys.toDF(*[f"_drop_{c}" for c in names])
    if keys.count() <= most_broadcast:
        right = F.broadcast(right)
    same = [F.col(c).eqNullSafe(F.col(f"_drop_{c}")) for c in names]
    out = rows
    for c in same[1:]:
        same[0] = same[0] & c
    return out.join(right, same[0], "left_anti")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL ids fall in fold 0 (held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(0))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def learning_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, y)``: 0 or 1 per id of the learning folds. Ids with both labels, without an
    id or without a label are left out; repeated rows count once."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")) \
        .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    return marks.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("_most")) \
        .where(F.col("y") == F.col("_most")).drop("_most")


def bounded_texts(docs: DataFrame, picked: DataFrame, most_bytes: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(id, y, text)`` of the ``picked`` ids ``(id, y)``, of which there is a bounded number:
    per class, in the order of a hash of the id, while the texts sum to at most ``most_bytes``.
    A text of more than 1/64 of that is passed over. Of rows that share an id one counts, that
    with the smallest text hash; NULL counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")) \
        .where(F.octet_length("text") <= most_bytes // 64).join(F.broadcast(picked), "id")
    one = stored(rows.groupBy("id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.sha2("text", 256)))
                                             .alias("text")), "sample")
    before = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    lengths = one.select("id", "y", F.octet_length("text").cast("long").alias("size"))  # as many rows as picked
    fits = lengths.withColumn("sum", F.sum("size").over(before)).where(F.col("sum") <= most_bytes).select("id")
    return one.join(F.broadcast(fits), "id")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def semi_join_ids(rows: DataFrame, ids: DataFrame, key: str, most_broadcast: int = 1_000_000) -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (distinct). The ids are broadcast when
    their count proves them small (8 bytes each), else both sides shuffle."""
    if ids.count() <= most_broadcast:
        ids = F.broadcast(ids)
    return rows.join(ids, key, "left_semi")


SPANS = "array<struct<kind:string,start:long,end:long>>"


def span_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of these kinds, by start, then kind as listed."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    rows = F.transform(F.filter(spans, lambda s: s["kind"].isin(kinds)), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.concat_ws(",", F.transform(F.array_sort(rows), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def span_digest(rows: DataFrame, base: list[str], own: list[str], spans: str = "spans") -> DataFrame:
    """Add ``n_<kind>`` per base kind, ``base_sha256`` and the joined ``spans``."""
    s = F.col(spans)

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in base]
    return rows.select(*[c for c in rows.columns if c != spans], *counts,
                       F.sha2(span_text(s, base).cast("binary"), 256).alias("base_sha256"),
                       span_text(s, base + own).alias("spans"))


def join_counted(rows: DataFrame, right: DataFrame, keys: list[str], total: int,
                 most_broadcast: int = 1_000_000) -> DataFrame:
    """``rows`` with the columns of ``right``, a stored table of unique ``keys``
    (NULLs equal) and ``n``, the number of the ``total`` rows that hold them.

    ``right`` is broadcast when its count proves it small. Else the keys of more
    than total / most_broadcast rows, fewer than ``most_broadcast`` of them, are
    joined apart by a broadcast, and only the others shuffle.
    """
    names = {k: f"_right_{k}" for k in keys}

    def same(table: DataFrame) -> Column:
        out = F.lit(True)
        for k, r in names.items():
            out = out & rows[k].eqNullSafe(table[r])
        return out
    right = right.withColumnsRenamed(names)
    if right.count() <= most_broadcast:
        return rows.join(F.broadcast(right), same(right)).drop(*names.values(), "n")
    hot = right.where(F.col("n") * most_broadcast > total)
    cold = right.where(F.col("n") * most_broadcast <= total)
    held = hot.select(*names.values())
    rest = rows.join(F.broadcast(held), same(held), "left_anti")
    return rows.join(F.broadcast(hot), same(hot)).drop(*names.values(), "n").unionByName(
        rest.join(cold, same(cold)).drop(*names.values(), "n"))

"""Exact deduplication by progressive refinement, in DataFrame functions only.

Rows are grouped by text length, the groups of more than one row by a hash of
the text's beginning, and only what is then still together by a hash of the
whole text. The first two steps work on a narrow stored table (id, length,
prefix hash). Full texts are hashed for the surviving rows alone; when those are
too many to broadcast their ids, hashing every row in the scan is cheaper than
shuffling texts, and the result is the same.

Counts are aggregated in each task before the shuffle, so a length or a text that
a third of all rows share costs one row per task. The keys of the groups are
broadcast where their count proves them small, so that rows stay where they are;
beyond that both sides shuffle and adaptive execution splits a skewed side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, counted, drop_keys, register, stored, table


def full_hash(text: Column) -> Column:
    """sha256 (lowercase hex) of the text with A-Z lower-cased; NULL counts as empty."""
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def _shared(rows: DataFrame, keys: list[str], most_broadcast: int) -> DataFrame:
    """Rows whose keys another row has too."""
    more = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1).select(*keys)
    return rows.join(counted(stored(more, "shared"), most_broadcast), keys, "left_semi")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix_chars: int = 128, most_broadcast: int = 1_000_000) -> DataFrame:
    """Rows that have a copy: ``(id, text_sha256, keep_id, group_size)``.

    Of equal texts the largest id stays; NULL ids are smaller than any. Rows
    without a copy are not returned.
    """
    text = F.col(text_col)
    narrow = stored(docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(F.coalesce(text, F.lit(""))).alias("len"),
        F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars))).alias("prefix")), "narrow")
    same_length = _shared(narrow, ["len"], most_broadcast)
    survivors = stored(_shared(same_length, ["len", "prefix"], most_broadcast).select("id").distinct(), "survivors")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    if survivors.count() <= most_broadcast:
        ids = F.broadcast(survivors.select(F.col("id").alias("sid")))
        hashed = rows.join(ids, F.col("id").eqNullSafe(F.col("sid")), "left_semi") \
            .select("id", full_hash(F.col("text")).alias("text_sha256"))
    else:
        hashed = rows.select("id", full_hash(F.col("text")).alias("text_sha256")) \
            .join(survivors.select(F.col("id").alias("sid")), F.col("id").eqNullSafe(F.col("sid")), "left_semi")
    hashed = stored(hashed, "hashed")
    groups = hashed.groupBy("text_sha256").agg(F.max("id").alias("keep_id"),
                                               F.count("*").alias("group_size")).where("group_size > 1")
    return hashed.join(counted(stored(groups, "groups"), most_broadcast), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 128, most_broadcast: int = 1_000_000) -> DataFrame:
    """``docs`` without the copies: of equal texts the row with the largest id stays.

    Equal rows that repeat the kept id are left once. All columns are returned.
    NULL and empty texts are equal; of copies without any id one stays.
    """
    groups = duplicate_groups(docs, id_col, text_col, prefix_chars, most_broadcast)
    is_kept = F.col("id").eqNullSafe(F.col("keep_id"))
    # a row is named by its id and its text, which also tells repeated ids apart
    lost = groups.where(~is_kept).select(F.col("id").alias(id_col), F.col("text_sha256").alias("_hash"))
    again = groups.where(is_kept).groupBy("id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    marked = docs.withColumn("_hash", full_hash(F.col(text_col)))
    out = drop_keys(marked, lost, most_broadcast)
    repeated = stored(again.select(F.col("id").alias(id_col), F.col("text_sha256").alias("_hash")), "repeated")
    if repeated.isEmpty():
        return out.drop("_hash")
    once = drop_keys(marked, lost, most_broadcast).join(
        repeated.toDF("_again_id", "_again_hash"),
        F.col(id_col).eqNullSafe(F.col("_again_id")) & (F.col("_hash") == F.col("_again_hash")),
        "left_semi").dropDuplicates([id_col, "_hash"])
    return drop_keys(out, repeated, most_broadcast).unionByName(once).drop("_hash")


OP8_SQL = """
WITH h AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""


@register("op8_exact_dedup", OP8_SQL)
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    groups = duplicate_groups(docs).select("id", "text_sha256", "keep_id", "group_size").distinct()
    # the digest of every row is asked for, copies or not
    rows = docs.select("doc_id", full_hash(F.col("text")).alias("text_sha256"))
    out = rows.join(groups.withColumnRenamed("text_sha256", "h"),
                    F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_sha256") == F.col("h")), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")

"""File writers: JSON, chunked batches, status log, Parquet tables.

Writes go through Spark's commit protocol, so a lost executor re-runs its
tasks and a failed job leaves no partial table behind. Batch writes replace
only their own partition folder: writing a batch twice gives the same table as
writing it once, and a batch without rows leaves an empty partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_SIZE = 2000


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1: JSON Lines dataset."""
    df.write.mode(mode).json(path)


def write_batch(df: DataFrame, path: str, batch_id: int, chunk_size: int = DEFAULT_CHUNK_SIZE,
                fmt: str = "json", column: str = "batch_id") -> None:
    """SNK2: write one batch as partition ``batch_id=<n>``, ``chunk_size`` rows per file.

    Re-running the same batch replaces it (idempotent), also by no rows at all;
    other batches stay.
    """
    (df.drop(column).write.mode("overwrite")
       .option("maxRecordsPerFile", int(chunk_size))
       .format(fmt).save(f"{path.rstrip('/')}/{column}={int(batch_id)}"))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK5: one Parquet table."""
    df.write.mode(mode).parquet(path)


def _chunks(rows: DataFrame, key: str, element, chunk_rows: int) -> DataFrame:
    """``(e)``: arrays of at most ``chunk_rows`` elements. Rows are dealt by a hash
    of the key, which a retried task repeats (a row number it might not)."""
    n = max(1, -(-rows.count() // int(chunk_rows)))
    lists = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("_chunk")).agg(F.collect_list(element).alias("e"))
    starts = F.sequence(F.lit(1), F.size("e"), F.lit(int(chunk_rows)))
    return lists.select(F.explode(F.transform(starts, lambda s: F.slice("e", s, int(chunk_rows)))).alias("e"))


def write_id_sets(ids: DataFrame, path: str, chunk_rows: int = DEFAULT_CHUNK_SIZE,
                  key: str = "app_id") -> None:
    """SNK4 in the catalog's JSON form: files of JSON arrays of id strings.

    The distinct ids are dealt by hash into chunks of about ``chunk_rows``, and
    each becomes ``["id", ...]`` lines of at most that many ids. Readable with
    ``sources.files.id_set``.
    """
    rows = ids.select(F.col(key).cast("string").alias("id")).distinct()
    lines = _chunks(rows, "id", F.col("id"), chunk_rows).select(F.to_json("e").alias("value"))
    lines.write.mode("overwrite").text(path)


def write_app_list(ids: DataFrame, path: str, chunk_rows: int = DEFAULT_CHUNK_SIZE,
                   key: str = "app_id") -> None:
    """App-list payloads ``{"applist": {"apps": [{"appid": ..}, ..]}}``, one per
    chunk of at most ``chunk_rows`` ids, one object per file line."""
    chunks = _chunks(ids.select(key).distinct(), key, F.struct(F.col(key).alias("appid")), chunk_rows)
    lines = chunks.select(F.to_json(F.struct(F.struct(F.col("e").alias("apps")).alias("applist"))).alias("value"))
    lines.write.mode("overwrite").text(path)

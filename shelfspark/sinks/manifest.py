"""Manifests of chunk files (SNK2): which chunks a batch has, with rows and digests.

A manifest is a Parquet table ``(file, rows, digest)`` written after the chunks, so a batch
without one was not finished. A digest is a sum of row hashes: it does not depend on the
order in which rows are read back, and rows that repeat count as often as they stand there.
Building and checking are one pass over the chunks each, with one row per file and task in
the shuffle; the driver sees no more than the first chunks that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import path_exists

SCHEMA = "file string, rows bigint, digest decimal(38,0)"
NAMED = 20


class ChunkError(ValueError):
    """Chunks of a batch are missing, altered or unknown to its manifest."""


def chunk_digests(rows: DataFrame) -> DataFrame:
    """``(file, rows, digest)`` of each file that the DataFrame reads. Files without rows have none."""
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    hashed = rows.select(F.col("_metadata.file_name").alias("file"), F.xxhash64(text).cast("decimal(28,0)").alias("h"))
    return hashed.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("digest"))


def _found(spark: SparkSession, chunks: str, schema=None) -> DataFrame:
    """Digests of the chunks that a folder holds now."""
    if path_exists(spark, chunks) is False:
        return spark.createDataFrame([], SCHEMA)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return chunk_digests(reader.parquet(chunks))


def write_manifest(spark: SparkSession, chunks: str, manifest: str, schema) -> None:
    """Write the manifest of the Parquet chunks in a folder, read with their ``schema``."""
    found = _found(spark, chunks, schema).select("file", "rows", F.col("digest").cast("decimal(38,0)").alias("digest"))
    found.write.mode("overwrite").parquet(manifest)


def differences(spark: SparkSession, chunks: str, manifest: str, schema) -> DataFrame:
    """``(file, problem)``: chunks that are missing, altered or not in the manifest."""
    listed = spark.read.schema(SCHEMA).parquet(manifest).select("file", F.struct("rows", "digest").alias("then"))
    found = _found(spark, chunks, schema).select("file", F.struct(
        "rows", F.col("digest").cast("decimal(38,0)").alias("digest")).alias("now"))
    problem = (F.when(F.col("now").isNull(), F.lit("missing")).when(F.col("then").isNull(), F.lit("not listed"))
               .when(F.col("then") != F.col("now"), F.lit("altered")))
    return listed.join(found, "file", "full").select("file", problem.alias("problem")).where(F.col("problem").isNotNull())


def check_manifest(spark: SparkSession, chunks: str, manifest: str, schema) -> None:
    """Raise ``ChunkError`` with the names of chunks that differ, or where no manifest was written."""
    if path_exists(spark, f"{manifest.rstrip('/')}/_SUCCESS") is False:
        raise ChunkError(f"{chunks}: not finished, it has no manifest {manifest}")
    wrong = differences(spark, chunks, manifest, schema).orderBy("file").limit(NAMED).collect()
    if wrong:
        raise ChunkError(f"{chunks}: " + ", ".join(f"{r['file']} {r['problem']}" for r in wrong))

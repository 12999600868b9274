"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before
it kept and returns a DataFrame; it is written as Parquet to the shared folder
and read again as the next one's input. All but the last return the columns of
``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from shelfspark.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score 0.3 or more). It learns from
    the labelled documents among ``docs``."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return ngram_join.one_per_component(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("packed_sequences", packed_sequences),
]

ORACLE_SQL = None  # a trained model and a tokenizer decide; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

"""Batch ingest over a partitioned landing zone: each run reads what it has not read.

The landing zone holds ``landed=<p>/`` folders of ``(app_id, body[, landed_at])``, whose
names sort in the order of their landing. Beside the outcomes a run keeps

  landing_marks/<run>       its landing zone and the last partition it read (JSON)
  landing_open/run=<run>/   apps that have landed but are not settled, with the
                            partitions that hold their bodies

A run reads the partitions after the last mark, and of the older ones those that the
index names for apps on its work list: an app that failed, was not on the list yet or is
looked at again finds its old bodies. Settled apps leave the index, so it grows with what
is open and not with history.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import files as sinks
from . import jobs, registry

OPEN_SCHEMA = "app_id string, landed string"


def partitions(spark: SparkSession, landing: str) -> list[str]:
    """Names ``p`` of the ``landed=<p>`` folders, ascending (a listing; no file is read)."""
    return sorted(n.split("=", 1)[1] for n in registry.names(spark, landing.rstrip("/")) if n.startswith("landed="))


def last_mark(spark: SparkSession, root: str, landing: str, before: int | None = None) -> tuple[int, str] | None:
    """The latest run (before ``before``) that read this landing zone, and how far."""
    root = root.rstrip("/")
    for run in sorted((int(n) for n in registry.names(spark, f"{root}/landing_marks") if n.isdigit()), reverse=True):
        if before is None or run < before:
            mark = json.loads(registry.read_text(spark, f"{root}/landing_marks/{run}"))
            if mark["landing"] == landing.rstrip("/"):
                return run, mark["upto"]
    return None


def bodies(spark: SparkSession, landing: str, names: list[str], landed_at: str = "BIGINT") -> DataFrame:
    """``(app_id, body, landed_at, landed)`` of some partitions."""
    schema = f"app_id string, body string, landed_at {landed_at}, landed string"
    landing = landing.rstrip("/")
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", landing).parquet(*[f"{landing}/landed={n}" for n in names])


def ingest_landed(spark: SparkSession, root: str, apps: DataFrame, landing: str, stats: DataFrame | None = None,
                  released: bool = True, run: int | None = None, landed_at: str = "BIGINT", **options) -> DataFrame:
    """One ingest run (``jobs.ingest_run``) over the unread part of a landing zone;
    returns the run summary. Running a number again reads what it read the first time."""
    root, landing = root.rstrip("/"), landing.rstrip("/")
    run = registry.claim_run(spark, root, jobs.next_run(spark, root) - 1) if run is None else run
    mark = last_mark(spark, root, landing, run)
    old = spark.createDataFrame([], OPEN_SCHEMA) if mark is None else \
        spark.read.schema(OPEN_SCHEMA).parquet(f"{root}/landing_open/run={mark[0]}")
    new = [p for p in partitions(spark, landing) if mark is None or p > mark[1]]
    work = jobs.status_table_as_of(spark, root, run).work_list(apps, released)
    # names of folders, as few as there are
    again = [r["landed"] for r in old.join(work, "app_id", "left_semi").select("landed").distinct().collect()]
    summary = jobs.ingest_run(spark, root, apps, bodies(spark, landing, sorted({*new, *again}), landed_at).drop("landed"),
                              stats, released, run=run, **options)
    landed = bodies(spark, landing, new, landed_at).select("app_id", "landed").distinct()
    known = jobs.status_table_as_of(spark, root, run + 1).marked(old.unionByName(landed).distinct())
    still_open = known.where(~(F.col("_processed") | F.col("_discarded"))).select("app_id", "landed")
    sinks.write_parquet(still_open, f"{root}/landing_open/run={run}")
    upto = max([*new, *([mark[1]] if mark else [])], default="")
    registry.put_if_absent(spark, f"{root}/landing_marks/{run}", json.dumps({"landing": landing, "upto": upto}))
    return summary

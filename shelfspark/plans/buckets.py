"""The merged catalog as a log-structured table of hash buckets.

  merged_buckets/data/<batch>/bucket=<b>/   records whose app_id falls in bucket b
  merged_buckets/log/<v>                    version v: the folder of each bucket and
                                            the runs folded in (JSON)

Folding new runs in rewrites only the buckets that their records fall in; a new version
names the new folders for these and the old ones for all others. A version is committed
by put-if-absent: of two writers one wins, the other folds its runs into the winner's
version. Readers take one version and are not disturbed by later ones; folders that no
kept version names are deleted. Runs are named one by one, not by a highest number, so a
run that ends after a later one is not passed over.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ingest
from ..sources.files import numbered_folders, remove_folder
from .registry import names, put_if_absent, read_text

DEFAULT_BUCKETS = 64


def _folder(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), "merged_buckets", *parts])


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in names(spark, _folder(root, "log")) if n.isdigit())


def version(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """A version's content; without a number the latest, or an empty one."""
    known = versions(spark, root)
    if number is None and not known:
        return {"version": 0, "n_buckets": None, "buckets": {}, "runs": []}
    number = known[-1] if number is None else number
    return {"version": number, **json.loads(read_text(spark, _folder(root, "log", str(number))))}


def _commit(spark: SparkSession, root: str, after: dict) -> bool:
    body = {k: v for k, v in after.items() if k != "version"}
    return put_if_absent(spark, _folder(root, "log", str(after["version"])), json.dumps(body))


def read(spark: SparkSession, root: str, schema: T.StructType, number: int | None = None,
         only: list[int] | None = None) -> DataFrame:
    """``(app_id, record, batch_id)`` of a version, or of some of its buckets."""
    held = version(spark, root, number)["buckets"]
    paths = [_folder(root, "data", batch, f"bucket={b}") for b, batch in held.items()
             if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucket(app_id: str, n_buckets: int):
    return F.pmod(F.xxhash64(app_id), F.lit(n_buckets)).cast("int")


def fold(spark: SparkSession, root: str, records: DataFrame, runs: list[int], n_buckets: int = DEFAULT_BUCKETS,
         keep_versions: int = 3, attempts: int = 20) -> dict:
    """Fold the ``records`` (app_id, record, batch_id) of ``runs`` into the latest version,
    the highest batch_id winning per app; returns the version that holds them.

    The number of buckets is fixed by the first version. ``records`` holds rows of
    many runs; only those of runs that the version lacks are taken.
    """
    for _ in range(attempts):
        now = version(spark, root)
        new = sorted(set(runs) - set(now["runs"]))
        if not new:
            return now
        n = now["n_buckets"] or n_buckets
        mine = records.where(F.col("batch_id").isin(new)).withColumn("bucket", bucket("app_id", n))
        touched = sorted(r["bucket"] for r in mine.select("bucket").distinct().collect())
        after = {"version": now["version"] + 1, "n_buckets": n, "buckets": dict(now["buckets"]),
                 "runs": sorted([*now["runs"], *new])}
        if touched:
            old = read(spark, root, records.schema, now["version"], touched) if now["version"] else None
            rows = mine.drop("bucket") if old is None else mine.drop("bucket").unionByName(old)
            batch = uuid.uuid4().hex
            merged = ingest.last_wins(rows, "app_id", "batch_id").withColumn("bucket", bucket("app_id", n))
            merged.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(
                _folder(root, "data", batch))
            after["buckets"].update({str(b): batch for b in touched})
        if _commit(spark, root, after):
            expire(spark, root, keep_versions)
            return after
        if touched:  # another writer was first: its version lacks these folders
            remove_folder(spark, _folder(root, "data", batch))
    raise RuntimeError(f"{attempts} versions of {root} were committed by others meanwhile")


def forget(spark: SparkSession, root: str, run: int) -> None:
    """Start over where the latest version holds ``run``, which is about to be written
    again: the next fold takes all runs."""
    now = version(spark, root)
    if run in now["runs"]:
        _commit(spark, root, {"version": now["version"] + 1, "n_buckets": now["n_buckets"], "buckets": {}, "runs": []})


def expire(spark: SparkSession, root: str, keep_versions: int) -> None:
    """Delete all but the last versions, and the folders that only they name."""
    known = versions(spark, root)
    kept, gone = known[-max(1, keep_versions):], known[:-max(1, keep_versions)]
    if not gone:
        return

    def folders(numbers: list[int]) -> set[str]:
        return {batch for v in numbers for batch in version(spark, root, v)["buckets"].values()}
    unused = folders(gone) - folders(kept)
    for v in gone:
        remove_folder(spark, _folder(root, "log", str(v)))
    for batch in unused:
        remove_folder(spark, _folder(root, "data", batch))


def finished_runs(spark: SparkSession, outcomes: str) -> list[int]:
    """Runs whose outcomes are committed (Spark's marker stands in their folder)."""
    done = []
    for n in numbered_folders(spark, outcomes, "run"):
        if "_SUCCESS" in names(spark, f"{outcomes}/run={n}"):
            done.append(n)
    return done

"""Status of every app as a bucketed table, so that no run shuffles the history (JN2, SET1-3).

A snapshot ``status_snapshot/upto=<r>/`` holds one row per app, ``(app_id, processed,
discarded, not_released)``, in hash buckets of ``app_id``, one file each; ``_buckets`` in
the folder names their number and is written last, so a snapshot without it was never
finished and is passed over. The runs after a snapshot are reduced to one row per app too
and dealt into as many partitions. Both sides of every join are then partitioned alike:

  work list     apps joined with the snapshot and the changes, no Exchange above the snapshot
  run summary   the same for the outcomes; the size of the sets from the joined flags
  compaction    the flags of both sides, written bucket by bucket where they are

Only what is new (apps asked for, outcomes of the runs since) is shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import ingest
from ..sources.files import numbered_folders, remove_folder
from . import registry

MAX_DEFAULT_BUCKETS = 1024
FLAGS = {"processed": S.PROCESSED, "discarded": S.DISCARDED, "not_released": S.NOT_RELEASED}
COLUMNS = "app_id STRING, processed BOOLEAN, discarded BOOLEAN, not_released BOOLEAN"


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as the session deals a join into, at most ``MAX_DEFAULT_BUCKETS``."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_DEFAULT_BUCKETS))


def _path(root: str, upto: int) -> str:
    return f"{root.rstrip('/')}/status_snapshot/upto={int(upto)}"


def _name(path: str, n_buckets: int) -> str:
    return f"shelfspark_status_{hashlib.sha256(path.encode()).hexdigest()[:24]}_{n_buckets}"


def snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished snapshots, ascending."""
    found = []
    for n in numbered_folders(spark, f"{root.rstrip('/')}/status_snapshot", "upto"):
        files = registry.names(spark, _path(root, n))
        if "_buckets" in files:
            found.append(n)
        elif "_SUCCESS" in files and "status" in spark.read.parquet(_path(root, n)).columns:
            raise ValueError(f"{_path(root, n)} is a status snapshot of another layout")
    return found


def read(spark: SparkSession, root: str, upto: int) -> tuple[DataFrame, int]:
    """A snapshot's rows, read by buckets, and their number. The catalog of the session
    gets an external table over the folder; the folder alone holds the data."""
    path = _path(root, upto)
    n = int(registry.read_text(spark, f"{path}/_buckets"))
    name, location = _name(path, n), path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
              f"CLUSTERED BY (app_id) SORTED BY (app_id) INTO {n} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(name)  # another session may have written the folder anew
    return spark.table(name), n


def write(spark: SparkSession, root: str, upto: int, rows: DataFrame, n_buckets: int) -> None:
    """Write ``(app_id, *FLAGS)``, one row per app. ``rows`` that are partitioned by
    ``app_id`` into ``n_buckets`` already give one file per bucket."""
    path = _path(root, upto)
    (rows.select("app_id", *FLAGS).write.mode("overwrite").format("parquet")
     .bucketBy(n_buckets, "app_id").sortBy("app_id").option("path", path).saveAsTable(_name(path, n_buckets)))
    registry.put_if_absent(spark, f"{path}/_buckets", str(n_buckets))


def forget(spark: SparkSession, root: str, run: int) -> None:
    """Drop the snapshots that hold run ``run``, the mark of each before its rows."""
    for n in numbered_folders(spark, f"{root.rstrip('/')}/status_snapshot", "upto"):
        if n >= run:
            path = _path(root, n)
            buckets = registry.read_text(spark, f"{path}/_buckets")
            remove_folder(spark, f"{path}/_buckets")
            if buckets:
                spark.sql(f"DROP TABLE IF EXISTS {_name(path, int(buckets))}")
            remove_folder(spark, path)


def changes(outcomes: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """What ``(app_id, outcome, run)`` change: ``(app_id, processed, discarded,
    not_released)``, one row per app, ``not_released`` NULL where no run touched it.

    A run holds an app once, so no key is hot. With ``n_buckets`` the rows are dealt like
    a snapshot's before they are reduced, which needs no other shuffle.
    """
    o, waits = F.col("outcome"), ingest.NOT_RELEASED_OUTCOME
    rows = outcomes.where(o != S.FAILED).select("app_id", "outcome", "run")
    if n_buckets:
        rows = rows.repartition(n_buckets, "app_id")
    return rows.groupBy("app_id").agg(
        F.bool_or(o == S.ADDED).alias("processed"), F.bool_or(o == ingest.DISCARDED_OUTCOME).alias("discarded"),
        F.max_by(o == waits, F.when(o.isin(S.ADDED, waits), F.col("run"))).alias("not_released"))


def flags_of(status: DataFrame) -> DataFrame:
    """Sets ``(app_id, status)`` as one row per app."""
    return status.groupBy("app_id").agg(*[F.bool_or(F.col("status") == s).alias(c) for c, s in FLAGS.items()])


@dataclass
class Status:
    """The sets at one moment: a snapshot (if any) and the changes after it."""

    snapshot: DataFrame | None
    later: DataFrame
    n_buckets: int | None

    def _flags(self) -> list[Column]:
        """The flags over a join of ``_s_*`` (snapshot) and ``_c_*`` (changes)."""
        old = {c: F.col(f"_s_{c}") if self.snapshot is not None else F.lit(False) for c in FLAGS}
        either = [F.coalesce(old[c], F.lit(False)) | F.coalesce(F.col(f"_c_{c}"), F.lit(False))
                  for c in ("processed", "discarded")]
        return [*either, F.coalesce(F.col("_c_not_released"), old["not_released"], F.lit(False))]

    def _joined(self, rows: DataFrame, how: str) -> DataFrame:
        if self.snapshot is not None:
            side = self.snapshot.select("app_id", *[F.col(c).alias(f"_s_{c}") for c in FLAGS])
            rows = rows.join(side, "app_id", how)
        return rows

    def _later(self) -> DataFrame:
        return self.later.select("app_id", *[F.col(c).alias(f"_c_{c}") for c in FLAGS])

    def marked(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``app_id``) and the flags of their apps as ``_processed``,
        ``_discarded`` and ``_not_released``. The rows are dealt like the snapshot, which
        stays in its buckets; give rows that hold an app a bounded number of times."""
        names = list(rows.columns)
        if self.n_buckets:
            rows = rows.repartition(self.n_buckets, "app_id")
        joined = self._joined(rows, "left").join(self._later(), "app_id", "left")
        return joined.select(*names, *[f.alias(f"_{c}") for c, f in zip(FLAGS, self._flags())])

    def table(self) -> DataFrame:
        """``(app_id, *FLAGS)`` of every app that ever had a status."""
        joined = self._joined(self._later(), "full")
        return joined.select("app_id", *[f.alias(c) for c, f in zip(FLAGS, self._flags())])

    def rows(self) -> DataFrame:
        """The sets as ``(app_id, status)``."""
        named = F.array(*[F.when(F.col(c), F.lit(s)) for c, s in FLAGS.items()])
        return self.table().select("app_id", F.explode(F.filter(named, lambda s: s.isNotNull())).alias("status"))

    def work_list(self, apps: DataFrame, released: bool = True) -> DataFrame:
        """``ingest.work_list`` against these sets."""
        known = F.col("_processed") | F.col("_discarded")
        if released:
            known = known | F.col("_not_released")
        asked = apps.select(F.col("app_id").cast("string").alias("app_id")).distinct()
        return self.marked(asked).where(~known).select("app_id")

    def run_summary(self, apps: DataFrame, outcomes: DataFrame) -> DataFrame:
        """``ingest.run_summary`` against these sets."""
        size = sum((F.col(c).cast("bigint") for c in FLAGS), F.lit(0))
        n_known = self.table().agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).scalar()
        marked = self.marked(outcomes).withColumn("_known_nr", F.when(F.col("_not_released"), F.lit(True)))
        return ingest.summary_of(apps, n_known, marked)


def as_of(spark: SparkSession, root: str, outcomes: DataFrame, run: int | None = None) -> Status:
    """The sets before run ``run`` (None: after all): the last snapshot before it and
    the outcomes logged since."""
    before = [n for n in snapshots(spark, root) if run is None or n < run]
    if run is not None:
        outcomes = outcomes.where(F.col("run") < run)
    if not before:
        return Status(None, changes(outcomes), None)
    snapshot, n = read(spark, root, before[-1])
    return Status(snapshot, changes(outcomes.where(F.col("run") > before[-1]), n), n)

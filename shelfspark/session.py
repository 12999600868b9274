"""Session and shared-folder helpers.

Cluster deployments pass their own session; these helpers only fill in what
is missing, so a cluster's settings always win.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings a local run needs; a cluster session keeps whatever it was given.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for large runs (hundreds of TB, ~1000 executors). Shuffles start
# wide and AQE coalesces them to ~256 MB partitions, splits skewed join
# partitions, and scans split files at 256 MB. Broadcasts stay behind Spark's
# measured-size threshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune_for_scale(spark: SparkSession, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Apply ``SCALE_CONF`` to keys the launch configuration does not name.

    Keys given at launch (``--conf`` / ``spark-defaults``) win; returns what
    was set. Call once at the start of a large job.
    """
    sc = _context(spark)
    launched = sc.getConf() if sc is not None else None
    wanted = {**SCALE_CONF, **(overrides or {})}
    applied = {}
    for key, value in wanted.items():
        if launched is None or not launched.contains(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "shelfspark") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cpus == "*" else max(int(cpus), 1) * 2
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SHELFSPARK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Reads the session's setting; only a local session that names none (tests, bench)
    gets one under its warehouse directory. On a cluster that folder may be one machine's
    own, so a session there that names none raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is not None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        # unset (local runs): a folder under the warehouse. ``spark.checkpoint.dir``
        # is a launch setting and cannot be changed at runtime; the context's
        # checkpoint folder can (it adds a per-application subfolder).
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shelfspark_checkpoints"
        if sc is not None:
            sc.setCheckpointDir(path)
            path = sc.getCheckpointDir()
    return path.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def session_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "session")


def parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return max(sc.defaultParallelism, 1)
    return int(spark.conf.get("spark.default.parallelism", "8"))


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), *parts])

"""The incremental ingest over a landing folder, with Structured Streaming.

New primary bodies arrive as files ``(app_id, body[, landed_at])`` in a landing folder.
Every micro-batch is one ingest run (``plans.jobs.ingest_run``), whose number the run
registry gives to this stream's epoch:

* the stream's checkpoint records which files each epoch consumed, so after a
  lost executor or driver restart an epoch is replayed with the same files;
* a replayed epoch gets its old run number, rewrites only that run's partitions
  (partition overwrite) and reads only earlier runs' status, so the output is
  exactly-once;
* a stream is named by the id in its checkpoint. Several streams, a stream with a new
  checkpoint and batch runs share one root: each epoch has a number of its own.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs, registry
from ..session import shared_path

LANDED_SCHEMA = "app_id STRING, body STRING"


def ingest_stream(spark: SparkSession, landing: str, root: str, fmt: str = "parquet",
                  stats: DataFrame | None = None, released: bool = True,
                  checkpoint: str | None = None, merge_each_batch: bool = True,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  landed_at: str = "BIGINT") -> StreamingQuery:
    """Start the ingest stream; ``available_now`` processes what is landed, then stops.

    ``stats`` is a (batch) table of statistics bodies used for enrichment.
    ``checkpoint`` defaults to a folder under the session's shared folder, one for
    each pair of landing folder and root. ``landed_at`` is the type of that column in
    the landed files (NULL in files without it): of several deliveries in one batch the
    latest counts.
    """
    reader = spark.readStream.schema(f"{LANDED_SCHEMA}, landed_at {landed_at}").format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    bodies = reader.load(landing)
    if checkpoint is None:
        pair = hashlib.sha256(f"{landing.rstrip('/')}\n{root.rstrip('/')}".encode()).hexdigest()[:32]
        checkpoint = shared_path(spark, "streams", f"ingest-{pair}")

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        # written by Spark when the checkpoint begins; the same after a restart
        source = json.loads(registry.read_text(session, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        jobs.ingest_run(session, root, batch.select("app_id"), batch, stats, released,
                        source=source, epoch=epoch_id)
        if merge_each_batch:
            # only the buckets that this run's records fall in are written
            jobs.merge_incremental(session, root, enriched=stats is not None)

    writer = (bodies.writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

"""End-to-end jobs: incremental ingest (DF2), merge (SNK3), flatten (DF3),
publish (DF5) and load (DF6).

Ingest folder layout under ``root`` (a shared folder):

  outcomes/run=<n>/   every work-list app of run n: outcome, and the record
                      when added — ``chunk_size`` rows per file (the chunk
                      files of SNK2); the one log every other view reads
  summary/run=<n>/    run counters (Parquet)
  manifests/run=<n>/  the chunk files of run n with their rows and digests (see ``sinks.manifest``)
  merged/             last-wins records over all runs (Parquet)
  status_snapshot/upto=<r>/  status sets as of run r, bucketed (``compact``, see ``status_table``)
  merged_buckets/     last-wins records in hash buckets (``merge_incremental``, see ``buckets``)
  runs/, claims/      run numbers and the sources they were given to (see ``registry``)

The status sets (processed / discarded / notreleased) and the record batches
are views over ``outcomes``: a status read prunes the record column away, a
merge reads only added rows. Each run writes its outcomes once; the summary
is derived from that written table (lineage cut there), and re-running run n
replaces only run n's partitions.

Compaction keeps the per-run reads bounded as runs accumulate: a run reads the
latest status snapshot taken before it plus the outcomes logged after that
snapshot (partition-pruned), never the whole log; ``merge_incremental`` folds
only runs it has not folded yet into the buckets they touch. Snapshots go to their
own paths, so no job overwrites what it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import ingest
from ..operators.flatten import flatten_struct
from ..sinks import files as sinks
from ..sinks import manifest
from ..sources.files import numbered_folders, read_or_empty
from . import buckets, fused, registry, status_table

OUTCOME_KEYS = T.StructType([T.StructField("app_id", T.StringType()),
                             T.StructField("outcome", T.StringType()),
                             T.StructField("run", T.LongType())])
# a chunk's columns, as its digest takes them: runs without enrichment lack some record fields
CHUNK_SCHEMA = T.StructType([OUTCOME_KEYS["app_id"], OUTCOME_KEYS["outcome"],
                             T.StructField("record", S.ENRICHED_RECORD)])


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _record_type(enriched: bool) -> T.StructType:
    return S.ENRICHED_RECORD if enriched else S.RECORD


def record_batches(spark: SparkSession, root: str, enriched: bool = True) -> DataFrame:
    """Added records of every run: ``(app_id, record, batch_id)``."""
    schema = T.StructType([OUTCOME_KEYS["app_id"], OUTCOME_KEYS["outcome"],
                           T.StructField("record", _record_type(enriched)), OUTCOME_KEYS["run"]])
    o = read_or_empty(spark, _p(root, "outcomes"), schema)
    record = _with_defaults(F.col("record")) if enriched else F.col("record")
    return o.where(F.col("outcome") == S.ADDED).select(
        "app_id", record.alias("record"), F.col("run").alias("batch_id"))


def _with_defaults(record):
    """Runs without enrichment store no statistics fields: they get the base
    table's defaults. Enriched records have no NULL in these fields."""
    defaults = {name: default for name, _, default in S.BASE_COLUMNS}
    fields = [F.col(f"record.{f.name}") for f in S.RECORD.fields]
    for name, kind in S.STATS_FIELDS:
        value = record[name]
        fields.append(F.coalesce(value, F.lit(defaults[name]).cast(kind)).alias(name) if name in defaults
                      else value.alias(name))
    return F.struct(*fields)


def seed_status(spark: SparkSession, root: str, status: DataFrame,
                n_buckets: int | None = None) -> None:
    """Start a new catalog from existing sets ``(app_id, status)``, as ``id_set``
    reads them: they count as known before run 1."""
    n_buckets = n_buckets or status_table.default_buckets(spark)
    rows = status_table.flags_of(status).repartition(n_buckets, "app_id")
    status_table.write(spark, root, 0, rows, n_buckets)


def _forget_snapshots(spark: SparkSession, root: str, run: int) -> None:
    """Drop the snapshots that hold run ``run``: it is about to be written again."""
    status_table.forget(spark, root, run)
    buckets.forget(spark, root, run)


def status_table_as_of(spark: SparkSession, root: str, run: int | None = None) -> status_table.Status:
    """The sets seen by run ``run`` (all runs before it; None = all runs): the latest
    snapshot taken before it and the changes logged after that one."""
    return status_table.as_of(spark, root, read_or_empty(spark, _p(root, "outcomes"), OUTCOME_KEYS), run)


def status_as_of(spark: SparkSession, root: str, run: int | None = None) -> DataFrame:
    """``status_table_as_of`` as rows ``(app_id, status)``."""
    return status_table_as_of(spark, root, run).rows()


def current_status(spark: SparkSession, root: str) -> DataFrame:
    return status_as_of(spark, root, None)


def compact(spark: SparkSession, root: str, n_buckets: int | None = None) -> int:
    """Write the status sets as of the last run as ``status_snapshot/upto=<r>``: the last
    before which no run is claimed or begun that has not ended (another source's run
    with a smaller number must not be passed over)."""
    ended = set(buckets.finished_runs(spark, _p(root, "outcomes")))
    begun = {*registry.claimed(spark, root), *numbered_folders(spark, _p(root, "outcomes"), "run")}
    r = min(begun - ended, default=max(ended, default=0) + 1) - 1
    if r > 0 and r not in status_table.snapshots(spark, root):
        _snapshot_status(spark, root, r, n_buckets)
    return r


def _snapshot_status(spark: SparkSession, root: str, r: int, n_buckets: int | None) -> None:
    """The first snapshot deals the rows into ``n_buckets``; later ones keep the buckets
    of the one before and are written where its rows are."""
    state = status_table_as_of(spark, root, r + 1)
    rows, n = state.table(), state.n_buckets
    if n is None:
        n = n_buckets or status_table.default_buckets(spark)
        rows = rows.repartition(n, "app_id")
    status_table.write(spark, root, r, rows, n)


def next_run(spark: SparkSession, root: str) -> int:
    """One past the highest run written (1 for a new folder). Every run leaves its
    folders, also one without outcomes or with failed ones alone."""
    runs = numbered_folders(spark, _p(root, "outcomes"), "run")
    return (runs[-1] if runs else 0) + 1


def ingest_run(spark: SparkSession, root: str, apps: DataFrame, primary: DataFrame,
               stats: DataFrame | None = None, released: bool = True,
               chunk_size: int = sinks.DEFAULT_CHUNK_SIZE, run: int | None = None,
               compact_every: int = 10, source: str | None = None, epoch: int = 0) -> DataFrame:
    """DF2: one incremental run over landed payloads; returns the run summary.

    apps: ``(app_id)``; primary/stats: ``(app_id, body)``. ``stats=None``
    turns enrichment off; ``released`` skips apps known as not released.
    ``seed_status`` gives a new folder the sets of an existing catalog. Writing a
    run again drops the snapshots that hold it. The run number comes from the
    registry: an ``epoch`` of a ``source`` that is run again keeps its number.
    Every ``compact_every`` runs (0 = never) the status sets are snapshotted,
    so no run reads more than that many runs of the outcome log.
    """
    if run is None:
        run = registry.claim_run(spark, root, next_run(spark, root) - 1, source, epoch)
    else:
        registry.note_run(spark, root, run)
    _forget_snapshots(spark, root, run)
    # only earlier runs count: re-running run n sees what run n saw the first time
    status = status_table_as_of(spark, root, run)
    work = status.work_list(apps, released)
    outcomes = ingest.classify(work, primary, stats)
    if stats is None:
        outcomes = outcomes.select("app_id", "outcome", F.col("record").cast(S.RECORD).alias("record"))

    out_path = _p(root, "outcomes")
    sinks.write_batch(outcomes, out_path, run, fmt="parquet", column="run", chunk_size=chunk_size)
    manifest.write_manifest(spark, _p(out_path, f"run={run}"), _p(root, "manifests", f"run={run}"), CHUNK_SCHEMA)
    # the schema is named: an empty first run leaves no file to infer it from
    written = spark.read.schema(OUTCOME_KEYS).parquet(out_path).where(F.col("run") == run).select("app_id", "outcome")
    summary = status.run_summary(apps, written)
    sinks.write_batch(summary, _p(root, "summary"), run, fmt="parquet", column="run")
    if compact_every and run % compact_every == 0:
        compact(spark, root)
    return spark.read.parquet(_p(root, "summary")).where(F.col("run") == run)


def verify_chunks(spark: SparkSession, root: str) -> None:
    """Compare the chunks of every run with its manifest; raises ``ChunkError`` naming
    chunks that are missing, altered or not listed, and runs that were not finished."""
    runs = {*numbered_folders(spark, _p(root, "outcomes"), "run"), *numbered_folders(spark, _p(root, "manifests"), "run")}
    for n in sorted(runs):
        manifest.check_manifest(spark, _p(root, "outcomes", f"run={n}"), _p(root, "manifests", f"run={n}"), CHUNK_SCHEMA)


def merge(spark: SparkSession, root: str, enriched: bool = True, verify: bool = False) -> DataFrame:
    """SNK3: last run wins per app over all added records; writes ``merged``.
    ``verify`` reads all chunks once more first and compares them with their manifests."""
    if verify:
        verify_chunks(spark, root)
    merged = ingest.last_wins(record_batches(spark, root, enriched), "app_id", "batch_id")
    sinks.write_parquet(merged, _p(root, "merged"))
    return spark.read.parquet(_p(root, "merged"))


def merge_incremental(spark: SparkSession, root: str, enriched: bool = True,
                      n_buckets: int = buckets.DEFAULT_BUCKETS) -> DataFrame:
    """SNK3 without re-reading old runs: the runs not folded yet go into the buckets
    of ``merged_buckets`` that their records fall in; the others stay as they are.
    Returns the version then current; equal to ``merge`` over all ended runs.
    """
    records = record_batches(spark, root, enriched)
    ended = buckets.finished_runs(spark, _p(root, "outcomes"))
    now = buckets.fold(spark, root, records, ended, n_buckets)
    return buckets.read(spark, root, records.schema, now["version"] or None)


def catalog_from_merged(spark: SparkSession, root: str) -> DataFrame:
    """DF3 over ingested data: merged records -> 29-column base table."""
    return flatten_struct(spark.read.parquet(_p(root, "merged")))


def transform(spark: SparkSession, root: str, out: str, base_name: str = "catalog") -> dict[str, str]:
    """DF3 + DF5 over ingested data: merged records -> base table -> reports."""
    return publish(catalog_from_merged(spark, root), out, base_name)


def publish(base: DataFrame, out: str, base_name: str = "catalog",
            concurrent_jobs: int = 4) -> dict[str, str]:
    """DF5: write the base table, then every report computed from the written copy.

    The copy is scanned twice: once for the groups that eleven reports share, once for the
    lists of single rows (see ``fused``). Both are stored beside the tables, and the
    reports are written from them, up to ``concurrent_jobs`` at once (one driver thread each).
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = base.sparkSession
    base_path = _p(out, base_name)
    sinks.write_parquet(base, base_path)
    plans = fused.fused_reports(spark, spark.read.parquet(base_path), _p(out, "report_inputs"))
    paths = {base_name: base_path, **{name: _p(out, name) for name in plans}}
    with ThreadPoolExecutor(max_workers=max(int(concurrent_jobs), 1)) as pool:
        futures = [pool.submit(sinks.write_parquet, df, paths[name]) for name, df in plans.items()]
        for f in futures:
            f.result()
    return paths


def load(spark: SparkSession, parquet_root: str, options: dict[str, str],
         base_name: str = "catalog", mode: str = "overwrite") -> None:
    """DF6: base table then the reports, each into the SQL table of its name."""
    from ..sinks.jdbc import load_all
    from .reports import REPORTS
    names = [base_name, *REPORTS]
    load_all({n: spark.read.parquet(_p(parquet_root, n)) for n in names}, options, mode)

"""Run numbers as a log of claims, taken by put-if-absent.

  runs/<n>                     one entry per run number: its source and epoch (JSON)
  claims/<source>/<epoch>      the number that an epoch of a source was given

A number is claimed by creating its entry, which only one writer can do, so sources
that ingest into one root at the same time get different numbers, after all numbers
that older runs left behind. An epoch that is replayed finds its claim and gets its
old number back; its run then replaces itself. Where a writer is lost between the two
files, the number stays unused: its run wrote nothing yet.

Creating a file that must not exist is atomic on HDFS and local file systems, and on
object stores with conditional writes.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False where it exists already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception:  # another writer was first: the file system says so in its own way
        if fs.exists(p):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none for a missing folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def claimed(spark: SparkSession, root: str) -> list[int]:
    """Run numbers claimed so far, ascending."""
    return sorted(int(n) for n in names(spark, f"{root.rstrip('/')}/runs") if n.isdigit())


def claim_run(spark: SparkSession, root: str, used: int, source: str | None = None, epoch: int = 0) -> int:
    """The run number of ``epoch`` of ``source``: its old one, or a new one above
    ``used`` and above every claim. Without a source each call gets a new number."""
    root = root.rstrip("/")
    own = source if source is not None else f"call-{uuid.uuid4().hex}"
    claim = f"{root}/claims/{hashlib.sha256(own.encode()).hexdigest()[:32]}/{int(epoch)}"
    known = read_text(spark, claim)
    if known:
        return int(known)
    entry = json.dumps({"source": own, "epoch": int(epoch)})
    run = max([used, *claimed(spark, root)]) + 1
    while not put_if_absent(spark, f"{root}/runs/{run}", entry):
        run += 1
    if source is not None and not put_if_absent(spark, claim, str(run)):
        return int(read_text(spark, claim))  # the same epoch was claimed meanwhile
    return run


def note_run(spark: SparkSession, root: str, run: int) -> None:
    """Enter a run whose number the caller chose."""
    put_if_absent(spark, f"{root.rstrip('/')}/runs/{int(run)}", json.dumps({"source": "caller", "epoch": 0}))

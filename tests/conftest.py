from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a scratch shared folder when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfspark-test-"))
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared folder, one per test."""
    import uuid
    from shelfspark.session import shared_path
    path = shared_path(spark, "tests", uuid.uuid4().hex)
    # tests also create files with os calls: use a plain path for local folders
    return path[len("file:"):] if path.startswith("file:") else path

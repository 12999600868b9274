"""Flattening (PRJ1/PRJ2), publish (DF5), JDBC preparation and the stream."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from driver_tables import SF_SMALL
from shelfspark import schema as S
from shelfspark.operators.flatten import flatten_records
from shelfspark.plans import jobs
from shelfspark.plans.reports import REPORTS
from shelfspark.sinks.jdbc import connection_options, sql_ready
from shelfspark.sources import payloads, testdata


def test_flatten_missing_default_null_kept(spark):
    recs = spark.createDataFrame([
        ("1", json.dumps({"name": "A", "required_age": None, "genres": ["Action", "RPG"],
                          "developers": None, "price": 9.5, "windows": True})),
        ("2", json.dumps({})),
    ], "app_id string, record string")
    rows = {r["app_id"]: r for r in flatten_records(recs).collect()}
    a, b = rows["1"], rows["2"]
    assert a["name"] == "A" and a["required_age"] is None and a["genres"] == "Action, RPG"
    assert a["developers"] == "" and a["price"] == 9.5 and a["windows"] is True
    assert b["name"] == "" and b["required_age"] == 0 and b["price"] == 0.0
    assert b["genres"] == "" and b["support_email"] is False and b["estimated_owners"] == ""
    got = [(f.name, f.dataType) for f in flatten_records(recs).schema.fields]
    assert got == [(f.name, f.dataType) for f in S.BASE_SCHEMA.fields]


def test_publish_writes_base_and_reports(spark, scratch):
    base = testdata.catalog(spark, SF_SMALL)
    paths = jobs.publish(base, scratch)
    assert set(paths) == {"catalog", *REPORTS}
    assert spark.read.parquet(paths["catalog"]).count() == base.count()
    assert spark.read.parquet(paths["price_distribution"]).count() == 9


def test_jdbc_preparation():
    opts = connection_options(user="u")
    assert opts["url"].startswith("jdbc:postgresql://") and opts["user"] == "u"


def test_jdbc_sql_ready_casts_nested_to_text(spark):
    df = spark.createDataFrame([("1", ["a"], {"k": 1})], "id string, l array<string>, m map<string,int>")
    out = sql_ready(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string", "string"]
    assert out.first()["l"] == '["a"]'


def test_stream_equals_batch(spark, scratch):
    """Two landed files, two micro-batches: same statuses as one batch run."""
    from shelfspark.streaming.landing import ingest_stream
    _, primary, stats = payloads.landed(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    k = F.col("app_id").cast("bigint")
    primary.where(k % 2 == 0).write.mode("overwrite").parquet(f"{landing}/part=0")
    q = ingest_stream(spark, landing + "/part=*", f"{scratch}/stream", stats=stats,
                      checkpoint=f"{scratch}/ckpt")
    q.awaitTermination()
    primary.where(k % 2 == 1).write.mode("overwrite").parquet(f"{landing}/part=1")
    q = ingest_stream(spark, landing + "/part=*", f"{scratch}/stream", stats=stats,
                      checkpoint=f"{scratch}/ckpt")
    q.awaitTermination()
    streamed = {tuple(r) for r in jobs.current_status(spark, f"{scratch}/stream").collect()}

    apps = testdata.catalog(spark, SF_SMALL).select("app_id")
    jobs.ingest_run(spark, f"{scratch}/batch", apps, primary, stats)
    batched = {tuple(r) for r in jobs.current_status(spark, f"{scratch}/batch").collect()}
    assert streamed == batched and len(batched) > 0
    assert os.path.isdir(f"{scratch}/stream/merged_buckets".replace("file:", ""))
    merged = jobs.merge_incremental(spark, f"{scratch}/stream")
    added = {r[0] for r in jobs.current_status(spark, f"{scratch}/stream").collect() if r[1] == "processed"}
    assert {r["app_id"] for r in merged.collect()} == added


def test_tune_for_scale_keeps_launch_settings(spark):
    from shelfspark.session import tune_for_scale
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = tune_for_scale(spark)
    try:
        assert "spark.sql.shuffle.partitions" not in applied  # set at launch by the fixture
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for key in applied:
            spark.conf.unset(key)


class _CapturingWriter:
    """Stands in for DataFrameWriter: records options instead of connecting."""

    def __init__(self, log):
        self.log = log

    def format(self, f):
        self.log["format"] = f
        return self

    def options(self, **kw):
        self.log.update(kw)
        return self

    def option(self, k, v):
        self.log[k] = v
        return self

    def mode(self, m):
        self.log["mode"] = m
        return self

    def save(self):
        self.log["saved"] = True


def test_write_jdbc_options(spark, monkeypatch):
    from shelfspark.sinks import jdbc
    log = {}
    df = spark.createDataFrame([("1", ["a"])], "id string, tags array<string>")
    monkeypatch.setattr(type(df), "write", property(lambda self: _CapturingWriter(log)))
    jdbc.write_jdbc(df, "genre_counts", jdbc.connection_options(user="u", password="p"),
                    batchsize=500, num_partitions=3)
    assert log["format"] == "jdbc" and log["dbtable"] == "genre_counts"
    assert (log["batchsize"], log["numPartitions"], log["truncate"], log["mode"]) == \
        ("500", "3", "true", "overwrite")
    assert log["user"] == "u" and log["saved"]


def test_load_writes_base_then_reports(spark, scratch, monkeypatch):
    from shelfspark.sinks import jdbc
    jobs.publish(testdata.catalog(spark, SF_SMALL), scratch)
    seen = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, name, options, mode="overwrite": seen.append(name))
    jobs.load(spark, scratch, {"url": "jdbc:postgresql://db/catalog"})
    assert seen == ["catalog", *REPORTS]


def test_write_batch_is_idempotent_and_keeps_other_batches(spark, scratch):
    from shelfspark.sinks.files import write_batch
    df = spark.createDataFrame([(str(i),) for i in range(7)], "app_id string")
    write_batch(df, f"{scratch}/b", 1, fmt="parquet")
    write_batch(df.limit(3), f"{scratch}/b", 2, fmt="parquet")
    write_batch(df, f"{scratch}/b", 1, fmt="parquet")  # replayed batch 1
    got = {r["batch_id"]: r["count"] for r in spark.read.parquet(f"{scratch}/b").groupBy("batch_id").count().collect()}
    assert got == {1: 7, 2: 3}

"""Run numbers over several sources, bucketed merges and the landing watermark."""

from __future__ import annotations

import json
import os

import pytest

from shelfspark.plans import buckets, jobs, landing_zone, registry
from shelfspark.streaming.landing import ingest_stream


def body(app, name="n", date="1 Jan, 2020"):
    data = {"type": "game", "name": name, "is_free": True, "developers": ["d"], "release_date": {"date": date}}
    return json.dumps({str(app): {"success": True, "data": data}})


def land(spark, folder, apps, name="n", landed_at=1):
    rows = [(str(a), body(a, name), landed_at) for a in apps]
    spark.createDataFrame(rows, "app_id string, body string, landed_at bigint").write.mode("append").parquet(folder)


def stream(spark, scratch, landing, checkpoint, root="out", **options):
    ingest_stream(spark, f"{scratch}/{landing}", f"{scratch}/{root}", checkpoint=f"{scratch}/{checkpoint}",
                  **options).awaitTermination()


def processed(spark, root):
    return {int(r.app_id) for r in jobs.current_status(spark, root).collect() if r.status == "processed"}


def test_sources_share_a_root(spark, scratch):
    """Two streams, one of them after a batch run; a new checkpoint; nothing is lost."""
    root = f"{scratch}/out"
    first = spark.createDataFrame([("1", body(1)), ("2", body(2))], "app_id string, body string")
    jobs.ingest_run(spark, root, first.select("app_id"), first)
    land(spark, f"{scratch}/l1", [3, 4])
    land(spark, f"{scratch}/l2", [5])
    stream(spark, scratch, "l1", "c1")
    stream(spark, scratch, "l2", "c2")
    land(spark, f"{scratch}/l1", [6])
    stream(spark, scratch, "l1", "c1")
    assert processed(spark, root) == {1, 2, 3, 4, 5, 6}
    stream(spark, scratch, "l1", "c3")  # all files of l1 once more, as new runs
    assert processed(spark, root) == {1, 2, 3, 4, 5, 6}
    assert registry.claimed(spark, root) == [1, 2, 3, 4, 5]
    got = {int(r.app_id): r.batch_id for r in jobs.merge_incremental(spark, root, enriched=False).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 4}
    assert got == {int(r.app_id): r.batch_id for r in jobs.merge(spark, root, enriched=False).collect()}


def test_latest_delivery_of_a_stream_batch(spark, scratch):
    for at, name in ((2, "late"), (1, "early")):
        land(spark, f"{scratch}/l1", [1], name, at)
    stream(spark, scratch, "l1", "c1")
    assert jobs.merge(spark, f"{scratch}/out", False).first()["record"]["name"] == "late"


def test_claims(spark, scratch):
    assert registry.claim_run(spark, scratch, 0, "a", 0) == 1
    assert registry.claim_run(spark, scratch, 0, "b", 0) == 2
    assert registry.claim_run(spark, scratch, 0, "a", 0) == 1  # replayed
    assert registry.claim_run(spark, scratch, 7, "a", 1) == 8
    assert registry.claim_run(spark, scratch, 0) == 9
    registry.note_run(spark, scratch, 12)
    assert registry.claim_run(spark, scratch, 0, "b", 1) == 13
    assert not registry.put_if_absent(spark, f"{scratch}/runs/13", "x")


def test_lost_writer_leaves_a_gap(spark, scratch):
    """A number whose claim was not written stays unused; the replay gets another."""
    registry.put_if_absent(spark, f"{scratch}/runs/1", json.dumps({"source": "a", "epoch": 0}))
    assert registry.claim_run(spark, scratch, 0, "a", 0) == 2
    assert registry.claim_run(spark, scratch, 0, "a", 0) == 2


def record_rows(spark, rows):
    return spark.createDataFrame([(str(a), (name,), run) for a, name, run in rows],
                                 "app_id string, record struct<name:string>, batch_id bigint")


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_bucketed_merge(spark, scratch):
    """Only touched buckets are written; an old version stays readable; replays start over."""
    all_rows = [(a, f"n{a}", 1) for a in range(200)]
    schema = record_rows(spark, all_rows).schema
    buckets.fold(spark, scratch, record_rows(spark, all_rows), [1], n_buckets=16)
    before = files(f"{scratch}/merged_buckets/data")
    old = buckets.read(spark, scratch, schema, 1)
    all_rows += [(7, "new", 3)]
    buckets.fold(spark, scratch, record_rows(spark, all_rows), [1, 3])
    assert len(files(f"{scratch}/merged_buckets/data") - before) == 1
    all_rows += [(7, "between", 2), (900, "n900", 2)]  # an earlier run that ends later
    buckets.fold(spark, scratch, record_rows(spark, all_rows), [1, 2, 3])
    got = {r.app_id: r.record.name for r in buckets.read(spark, scratch, schema).collect()}
    assert got["7"] == "new" and got["900"] == "n900" and len(got) == 201
    assert {r.app_id: r.record.name for r in old.collect()} == {str(a): f"n{a}" for a in range(200)}
    assert buckets.version(spark, scratch)["runs"] == [1, 2, 3]
    now = buckets.version(spark, scratch)["version"]
    assert buckets.fold(spark, scratch, record_rows(spark, all_rows), [1, 2, 3])["version"] == now
    all_rows = [r for r in all_rows if r[2] != 3] + [(8, "again", 3)]  # run 3 is written anew
    buckets.forget(spark, scratch, 3)
    buckets.fold(spark, scratch, record_rows(spark, all_rows), [1, 2, 3])
    got = {r.app_id: r.record.name for r in buckets.read(spark, scratch, schema).collect()}
    assert got["7"] == "between" and got["8"] == "again"
    assert len(buckets.versions(spark, scratch)) == 3


def test_two_writers_of_one_version(spark, scratch, monkeypatch):
    """The writer that comes second folds its run into the winner's version."""
    rows = record_rows(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 2)])
    commit, raced = buckets._commit, []

    def late(session, root, after):
        if not raced:
            raced.append(1)
            buckets.fold(session, root, rows, [2], n_buckets=4)
        return commit(session, root, after)
    monkeypatch.setattr(buckets, "_commit", late)
    buckets.fold(spark, scratch, rows, [1], n_buckets=4)
    assert buckets.version(spark, scratch)["runs"] == [1, 2]
    got = {r.app_id: r.record.name for r in buckets.read(spark, scratch, rows.schema).collect()}
    assert got == {"1": "b", "2": "c"}


def test_runs_read_only_new_partitions(spark, scratch, monkeypatch):
    root, zone = f"{scratch}/out", f"{scratch}/zone"
    apps = spark.createDataFrame([(str(a),) for a in range(1, 8)], "app_id string")
    read = []
    bodies = landing_zone.bodies
    monkeypatch.setattr(landing_zone, "bodies", lambda s, z, names, t: (read.append(list(names)), bodies(s, z, names, t))[1])
    land(spark, f"{zone}/landed=2024-01-01", [1, 2])
    spark.createDataFrame([("3", "no json", 1)], "app_id string, body string, landed_at bigint") \
        .write.parquet(f"{zone}/landed=2024-01-02")
    land(spark, f"{zone}/landed=2024-01-02", [9])  # not on the list yet
    landing_zone.ingest_landed(spark, root, apps, zone)
    land(spark, f"{zone}/landed=2024-01-03", [4])
    landing_zone.ingest_landed(spark, root, apps, zone)
    assert read[0] == ["2024-01-01", "2024-01-02"] and read[2] == ["2024-01-02", "2024-01-03"]
    assert processed(spark, root) == {1, 2, 4}
    more = apps.unionByName(spark.createDataFrame([("9",)], "app_id string"))
    landing_zone.ingest_landed(spark, root, more.where("app_id <> '3'"), zone)
    assert read[4] == ["2024-01-02"] and processed(spark, root) == {1, 2, 4, 9}
    land(spark, f"{zone}/landed=2024-01-04", [3, 5])
    landing_zone.ingest_landed(spark, root, more, zone)
    assert read[6] == ["2024-01-02", "2024-01-04"] and processed(spark, root) == {1, 2, 3, 4, 5, 9}
    landing_zone.ingest_landed(spark, root, more, zone)
    assert read[8] == [] and processed(spark, root) == {1, 2, 3, 4, 5, 9}
    plan = landing_zone.bodies(spark, zone, ["2024-01-04"], "BIGINT")
    assert [f for f in plan.inputFiles() if "2024-01-04" not in f] == []


@pytest.mark.parametrize("missing", ["x/y", "runs"])
def test_missing_folders_are_empty(spark, scratch, missing):
    assert registry.names(spark, f"{scratch}/{missing}") == [] and registry.read_text(spark, f"{scratch}/{missing}/1") is None

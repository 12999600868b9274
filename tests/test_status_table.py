"""Bucketed status: equal to the sets of the whole log, without a shuffle of the history."""

from __future__ import annotations

import json
import os
import random
import re

import pytest

from shelfspark.operators import ingest
from shelfspark.plans import jobs, status_table

STATUS_OF = {"added": "processed", "not_released": "notreleased", "discarded": "discarded"}


def log(spark, root, run, rows):
    """A finished run's outcomes as ``ingest_run`` leaves them."""
    df = spark.createDataFrame(rows, "app_id string, outcome string")
    df.write.mode("overwrite").parquet(f"{root}/outcomes/run={run}")
    return df


def replay(logged):
    """The sets by the rules of SET1-3, one outcome at a time."""
    sets = {"processed": set(), "discarded": set(), "notreleased": set()}
    for rows in logged:
        for app, outcome in rows:
            if outcome in STATUS_OF:
                sets[STATUS_OF[outcome]].add(app)
            if outcome == "added":
                sets["notreleased"].discard(app)
    return {(a, s) for s, ids in sets.items() for a in ids}


def test_snapshots_and_log_equal_a_replay(spark, scratch):
    rnd = random.Random(1)
    logged = []
    for run in range(1, 7):
        apps = rnd.sample(range(30), 12)
        logged.append([(str(a), rnd.choice(["added", "not_released", "discarded", "failed"])) for a in apps])
        log(spark, scratch, run, logged[-1])
        if run in (2, 5):
            assert jobs.compact(spark, scratch, n_buckets=4) == run
        if run not in (1, 3, 6):  # no snapshot, one with a run after it, two
            continue
        want = replay(logged)
        assert {tuple(r) for r in jobs.current_status(spark, scratch).collect()} == want
        every = spark.createDataFrame([(str(a),) for a in [*range(40), 7, 7]], "app_id string")
        state = jobs.status_table_as_of(spark, scratch)
        plain = spark.createDataFrame(sorted(want), "app_id string, status string")
        outcomes = spark.createDataFrame([(str(a), rnd.choice(["added", "not_released", "failed"]))
                                          for a in range(40)], "app_id string, outcome string")
        for released in (True, False):
            assert {r[0] for r in state.work_list(every, released).collect()} \
                == {r[0] for r in ingest.work_list(every, plain, released).collect()}
        assert state.run_summary(every, outcomes).first() == ingest.run_summary(every, plain, outcomes).first()
    # what a run saw stays what it saw
    for run in range(1, 7):
        assert {tuple(r) for r in jobs.status_as_of(spark, scratch, run).collect()} == replay(logged[:run - 1])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles_above(plan: str, table: str) -> list[str]:
    """Exchanges on the way from the scan of ``table`` up to the root."""
    def depth(line: str) -> int:
        return len(re.match(r"[ :]*(?:[+:]- )?", line).group())

    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            at = depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < at:
                    at = depth(up)
                    if "Exchange" in up:
                        found.append(up.strip())
    return found


def test_history_is_not_shuffled(spark, scratch):
    log(spark, scratch, 1, [(str(a), "added" if a % 2 else "not_released") for a in range(200)])
    jobs.compact(spark, scratch, n_buckets=4)
    log(spark, scratch, 2, [("0", "added"), ("500", "discarded")])
    apps = spark.range(600).selectExpr("cast(id as string) as app_id")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = jobs.status_table_as_of(spark, scratch)
        for df in (state.work_list(apps), state.table(), state.marked(apps)):
            plan = plan_of(df)
            assert "Bucketed: true" in plan, plan
            assert shuffles_above(plan, "shelfspark_status") == [], plan
            assert "SortMergeJoin" in plan
        assert state.work_list(apps).count() == 600 - 201
        jobs.compact(spark, scratch)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # the second snapshot keeps the buckets of the first, one file each
    files = [f for f in os.listdir(f"{scratch}/status_snapshot/upto=2") if f.startswith("part-")]
    assert 0 < len(files) <= 4
    assert jobs.current_status(spark, scratch).where("status = 'processed'").count() == 101


def test_unfinished_snapshot_is_passed_over(spark, scratch):
    log(spark, scratch, 1, [("1", "added")])
    jobs.compact(spark, scratch, n_buckets=2)
    log(spark, scratch, 2, [("2", "added")])
    jobs.compact(spark, scratch, n_buckets=2)
    os.remove(f"{scratch}/status_snapshot/upto=2/_buckets")
    assert status_table.snapshots(spark, scratch) == [1]
    assert {r[0] for r in jobs.current_status(spark, scratch).collect()} == {"1", "2"}
    jobs.compact(spark, scratch, n_buckets=2)
    assert status_table.snapshots(spark, scratch) == [1, 2]


def test_snapshot_of_another_layout_raises(spark, scratch):
    spark.createDataFrame([("1", "processed")], "app_id string, status string") \
        .write.parquet(f"{scratch}/status_snapshot/upto=0")
    with pytest.raises(ValueError, match="another layout"):
        jobs.current_status(spark, scratch)


def test_another_session_reads_the_snapshot_written_anew(spark, scratch):
    log(spark, scratch, 1, [("1", "not_released")])
    jobs.compact(spark, scratch, n_buckets=2)
    assert jobs.current_status(spark, scratch).count() == 1
    other = spark.newSession()
    game = {"type": "game", "developers": ["D"], "is_free": True, "release_date": {"date": "Jan 1, 2020"}}
    apps = other.createDataFrame([("1",)], "app_id string")
    body = other.createDataFrame([("1", json.dumps({"1": {"success": True, "data": game}}))], "app_id string, body string")
    jobs.ingest_run(other, scratch, apps, body, run=1)
    jobs.compact(other, scratch, n_buckets=2)
    assert {tuple(r) for r in jobs.current_status(spark, scratch).collect()} == {("1", "processed")}

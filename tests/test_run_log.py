"""The run log of the ingest: deliveries, run numbers, replays, seeds, defaults."""

from __future__ import annotations

import json

from shelfspark.operators import ingest
from shelfspark.plans import jobs
from shelfspark.plans.reports import top_10_peak_ccu
from shelfspark.sinks import files as sinks
from shelfspark.sources.files import app_list, id_set

GAME = {"type": "game", "developers": ["D"], "is_free": True, "release_date": {"date": "Jan 1, 2020"}}


def body(app_id: str, **data) -> str:
    return json.dumps({app_id: {"success": True, "data": {**GAME, **data}}})


def apps(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "app_id string")


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), "app_id string, body string, landed_at int")


def bodies(spark, *rows):
    return spark.createDataFrame(list(rows), "app_id string, body string")


def status(spark, root):
    return {tuple(r) for r in jobs.current_status(spark, root).collect()}


def test_latest_delivery_counts(spark):
    rows = landed(spark, ("1", body("1", name="old zz"), 1), ("1", body("1", name="new"), 2), ("1", "junk", 3),
                  ("2", body("2", name="full"), 2), ("2", '{"2": {"success": true}}', 1), ("3", None, 5))
    stats = landed(spark, ("1", '{"developer": "z", "userscore": 9}', 1),
                   ("1", '{"developer": "a", "userscore": "85", "ccu": 500.0}', 2))
    got = {r["app_id"]: r for r in ingest.classify(apps(spark, "1", "2", "3"), rows, stats).collect()}
    assert got["1"]["record"]["name"] == "new" and got["2"]["record"]["name"] == "full"
    assert (got["1"]["record"]["user_score"], got["1"]["record"]["peak_ccu"]) == (85, 500)
    assert got["3"]["outcome"] == "failed"


def test_a_body_with_data_counts_where_nothing_orders_deliveries(spark):
    rows = bodies(spark, ("1", '{"1": {"success": true}}'), ("1", body("1", name="full")))
    assert ingest.classify(apps(spark, "1"), rows).first()["record"]["name"] == "full"


def test_failed_only_run_keeps_its_number(spark, scratch):
    jobs.ingest_run(spark, scratch, apps(spark, "1", "2"), bodies(spark, ("1", "x")))
    second = jobs.ingest_run(spark, scratch, apps(spark, "1", "2"),
                             bodies(spark, ("1", body("1")), ("2", body("2")))).first()
    assert (second["run"], second["added"]) == (2, 2)
    assert spark.read.parquet(f"{scratch}/summary").count() == 2
    assert jobs.next_run(spark, scratch) == 3


def test_replay_without_rows_empties_the_run(spark, scratch):
    jobs.ingest_run(spark, scratch, apps(spark, "1"), bodies(spark, ("1", body("1"))), run=1)
    jobs.ingest_run(spark, scratch, apps(spark), bodies(spark), run=1)
    assert status(spark, scratch) == set() and jobs.next_run(spark, scratch) == 2


def test_replay_drops_the_snapshots_that_hold_it(spark, scratch):
    jobs.ingest_run(spark, scratch, apps(spark, "1"), bodies(spark, ("1", '{"1": {"success": false}}')), run=1)
    jobs.compact(spark, scratch)
    jobs.ingest_run(spark, scratch, apps(spark, "1"), bodies(spark, ("1", body("1", name="a"))), run=1)
    assert status(spark, scratch) == {("1", "processed")}
    jobs.merge_incremental(spark, scratch, enriched=False)
    jobs.ingest_run(spark, scratch, apps(spark, "1"), bodies(spark, ("1", body("1", name="b"))), run=1)
    assert jobs.merge_incremental(spark, scratch, enriched=False).first()["record"]["name"] == "b"


def test_seed_sets_are_known_before_the_first_run(spark, scratch):
    sinks.write_id_sets(apps(spark, "1", "1", "2"), f"{scratch}/seed")
    jobs.seed_status(spark, f"{scratch}/root", id_set(spark, f"{scratch}/seed", status="processed"))
    rows = bodies(spark, *[(i, body(i)) for i in "123"])
    run = jobs.ingest_run(spark, f"{scratch}/root", apps(spark, "1", "2", "3"), rows).first()
    assert (run["run"], run["added"], run["total"]) == (1, 1, 1)
    assert status(spark, f"{scratch}/root") == {(i, "processed") for i in "123"}


def test_runs_without_statistics_get_defaults(spark, scratch):
    jobs.ingest_run(spark, scratch, apps(spark, "1"), bodies(spark, ("1", body("1", name="plain"))))
    jobs.ingest_run(spark, scratch, apps(spark, "2"), bodies(spark, ("2", body("2", name="rich"))),
                    bodies(spark, ("2", '{"developer": "d", "ccu": 500}')))
    jobs.merge(spark, scratch)
    got = [(r["name"], r["peak_ccu"]) for r in top_10_peak_ccu(jobs.catalog_from_merged(spark, scratch)).collect()]
    assert got == [("rich", 500), ("plain", 0)]


def test_chunks_hold_every_id_once(spark, scratch):
    ids = spark.range(1000).selectExpr("cast(id as string) as app_id").repartition(7)
    sinks.write_id_sets(ids, f"{scratch}/ids", chunk_rows=64)
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{scratch}/ids").collect()]
    assert sorted(int(i) for x in lines for i in x) == list(range(1000)) and max(map(len, lines)) <= 64
    sinks.write_app_list(ids, f"{scratch}/apps", chunk_rows=64)
    assert app_list(spark, f"{scratch}/apps").distinct().count() == 1000


def test_whole_numbers_above_the_doubles(spark):
    from pyspark.sql import functions as F

    from shelfspark.functions.text import whole_number
    row = spark.range(1).select(whole_number(F.lit("9007199254740993")).alias("a"),
                                whole_number(F.lit("17.9")).alias("b"), whole_number(F.lit("x")).alias("c")).first()
    assert tuple(row) == (9007199254740993, 17, 0)

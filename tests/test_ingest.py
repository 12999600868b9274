"""Ingest operators on literal payloads (FIXTURES F1-F5, F7, F9) and properties."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelfspark import schema as S
from shelfspark.operators import ingest
from shelfspark.plans import jobs
from shelfspark.sources import files as sources

F1 = {
    "type": "game",
    "name": "Test Game",
    "release_date": {"date": "2023-01-01", "coming_soon": False},
    "required_age": 18,
    "is_free": False,
    "price_overview": {"final_formatted": "$19.99"},
    "dlc": ["1", "2"],
    "detailed_description": "Test description",
    "about_the_game": "About the game",
    "short_description": "Short description",
    "platforms": {"windows": True, "mac": False, "linux": True},
    "metacritic": {"score": 85},
    "achievements": {"total": 50},
    "recommendations": {"total": 1000},
    "content_descriptors": {"notes": "Test notes"},
    "supported_languages": "English*, French, German*",
    "developers": ["Dev1", "Dev2"],
    "publishers": ["Pub1"],
    "categories": [{"description": "Single-player"}, {"description": "Multi-player"}],
    "genres": [{"description": "Action"}, {"description": "Adventure"}],
    "package_groups": [{"title": "<b>Buy</b>", "description": "Pack", "subs": [
        {"option_text": "Std  <i>ed</i>", "option_description": "d", "price_in_cents_with_discount": 1999},
        {"option_text": "Dlx", "price_in_cents_with_discount": 599}]}],
}


def body(app_id, data, success=True):
    return json.dumps({app_id: {"success": success, "data": data}})


def bodies(spark, rows):
    return spark.createDataFrame(rows, "app_id string, body string")


def test_normalise_f1(spark):
    p = ingest.parse_primary(bodies(spark, [("123", body("123", F1))]))
    r = p.select(ingest.normalise(F.col("data")).alias("r")).first()["r"]
    assert r["name"] == "Test Game"
    assert r["release_date"] == "2023-01-01"
    assert r["required_age"] == 18
    assert r["price"] == 19.99
    assert r["dlc_count"] == 2
    assert (r["windows"], r["mac"], r["linux"]) == (True, False, True)
    assert (r["metacritic_score"], r["achievements"], r["recommendations"]) == (85, 50, 1000)
    assert r["supported_languages"] == ["English", "French", "German"]
    assert r["full_audio_languages"] == ["English", "German"]
    assert r["developers"] == ["Dev1", "Dev2"]
    assert r["publishers"] == ["Pub1"]
    assert r["categories"] == ["Single-player", "Multi-player"]
    assert r["genres"] == ["Action", "Adventure"]
    pkg = r["packages"][0]
    assert pkg["title"] == "Buy"
    assert [s["text"] for s in pkg["subs"]] == ["Std ed", "Dlx"]
    assert [s["price"] for s in pkg["subs"]] == [19.99, 5.99]
    assert [s["description"] for s in pkg["subs"]] == ["d", ""]


def test_normalise_defaults_for_missing_and_null(spark):
    data = {"type": "game", "developers": ["D"], "metacritic": None, "genres": None,
            "release_date": {"coming_soon": True, "date": "Soon"}}
    p = ingest.parse_primary(bodies(spark, [("1", body("1", data))]))
    r = p.select(ingest.normalise(F.col("data")).alias("r")).first()["r"]
    assert r["name"] == "" and r["release_date"] == "" and r["price"] == 0.0
    assert r["metacritic_score"] == 0 and r["genres"] == [] and r["dlc_count"] == 0
    assert r["supported_languages"] == [] and r["packages"] == []


def test_eligibility_f2(spark):
    ok = {"type": "game", "is_free": False, "price_overview": {"final_formatted": "$9.99"},
          "developers": ["Test Developer"]}
    rows = [
        ("1", body("1", ok)),
        ("2", body("2", {**ok, "type": "dlc"})),
        ("3", body("3", {**ok, "price_overview": {"final_formatted": ""}})),
        ("4", body("4", {**ok, "is_free": True, "price_overview": {"final_formatted": ""}})),
        ("5", body("5", {**ok, "developers": []})),
        ("6", body("6", ok, success=False)),
        ("7", body("7", {k: v for k, v in ok.items() if k != "price_overview"})),
    ]
    p = ingest.parse_primary(bodies(spark, rows))
    got = {r["app_id"]: r["ok"] for r in
           p.select("app_id", ingest.eligible(F.col("success"), F.col("data")).alias("ok")).collect()}
    assert got == {"1": True, "2": False, "3": False, "4": True, "5": False, "6": False, "7": True}


def test_stats_validity_f3(spark):
    rows = [("1", '{"developer": "Test Developer", "userscore": 80}'), ("2", "Too many connections"),
            ("3", "   "), ("4", "{not json"), ("5", '{"developer": ""}'), ("6", '{"userscore": 1}')]
    got = {r["app_id"] for r in ingest.parse_stats(bodies(spark, rows)).collect()}
    assert got == {"1"}


def test_classify_f3(spark):
    game = {"type": "game", "developers": ["D"], "release_date": {"date": "2022-01-01"},
            "name": "Test Game"}
    primary = bodies(spark, [
        ("1", body("1", game)),
        ("2", body("2", {**game, "release_date": {"date": ""}})),
        ("3", body("3", game, success=False)),
        ("4", "Service Unavailable"),
    ])
    stats = bodies(spark, [("1", '{"developer": "x", "userscore": 80, "owners": "20,000 .. 50,000", '
                                 '"tags": {"a": 1}}')])
    work = spark.createDataFrame([(str(i),) for i in range(1, 6)], "app_id string")
    out = {r["app_id"]: r for r in ingest.classify(work, primary, stats).collect()}
    assert {k: v["outcome"] for k, v in out.items()} == {
        "1": "added", "2": "not_released", "3": "discarded", "4": "failed", "5": "failed"}
    rec = out["1"]["record"]
    assert rec["user_score"] == 80 and rec["estimated_owners"] == "20000 - 50000"
    assert rec["tags"] == {"a": 1} and rec["positive"] == 0 and rec["score_rank"] == ""
    assert out["2"]["record"] is None


def test_enrich_defaults_when_unmatched(spark):
    recs = spark.createDataFrame([("9", ("n",))], "app_id string, record struct<name:string>")
    stats = ingest.parse_stats(bodies(spark, [("1", '{"developer": "x"}')]))
    r = ingest.enrich(recs, stats).first()["record"]
    assert (r["user_score"], r["estimated_owners"], r["tags"], r["peak_ccu"]) == (0, "0 - 0", {}, 0)


def test_app_list_f4(spark, scratch):
    p = f"{scratch}/applist.json"
    spark.createDataFrame([('{"applist": {"apps": [{"appid": 1}, {"appid": 2}, {"appid": 3}]}}',)],
                          "value string").coalesce(1).write.text(p)
    assert sorted(r["app_id"] for r in sources.app_list(spark, p).collect()) == ["1", "2", "3"]
    pretty = f"{scratch}/applist_pretty.json"
    import os
    os.makedirs(scratch, exist_ok=True)
    with open(pretty, "w") as fh:
        json.dump({"applist": {"apps": [{"appid": 7}, {"appid": 8}]}}, fh, indent=4)
    assert sorted(r[0] for r in sources.app_list(spark, pretty, multiline=True).collect()) == ["7", "8"]


def test_chunks_f5_numeric_last_wins(spark, scratch):
    import os
    os.makedirs(scratch, exist_ok=True)
    for n, obj in [(1, {"1": {"name": "Game 1"}, "3": {"name": "old"}}),
                   (2, {"2": {"name": "Game 2"}, "3": {"name": "mid"}}),
                   (10, {"3": {"name": "new"}})]:
        with open(f"{scratch}/chunk_{n}.json", "w") as fh:
            json.dump(obj, fh)
    scanned = sources.keyed_objects(spark, scratch)
    merged = ingest.last_wins(scanned.select("app_id", "record", "chunk_no"), "app_id", "chunk_no")
    got = {r["app_id"]: json.loads(r["record"])["name"] for r in merged.collect()}
    assert got == {"1": "Game 1", "2": "Game 2", "3": "new"}
    one_shuffle = {r["app_id"]: json.loads(r["record"])["name"]
                   for r in sources.merge_chunks(spark, scratch).collect()}
    assert one_shuffle == got


def test_keyed_object_last_duplicate_key_wins(spark, scratch):
    import os
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/catalog.json", "w") as fh:
        fh.write('{"1": {"name": "a"}, "1": {"name": "b"}}')
    rows = sources.keyed_objects(spark, f"{scratch}/catalog.json").collect()
    assert [(r["app_id"], json.loads(r["record"])["name"]) for r in rows] == [("1", "b")]
    merged = sources.merge_chunks(spark, f"{scratch}/catalog.json").collect()
    assert [(r["app_id"], json.loads(r["record"])["name"]) for r in merged] == [("1", "b")]


def test_id_sets_f7(spark, scratch):
    p = f"{scratch}/metadata.json"
    spark.createDataFrame([('["1", "2", "3", "3"]',)], "value string").coalesce(1).write.text(p)
    assert sorted(r["app_id"] for r in sources.id_set(spark, p).collect()) == ["1", "2", "3"]
    assert sources.id_set(spark, f"{scratch}/missing.json").count() == 0
    with open(f"{scratch}/discarded.json", "w") as fh:
        json.dump(["4", "5"], fh, indent=4)
    assert sorted(r[0] for r in sources.id_set(spark, f"{scratch}/discarded.json", multiline=True)
                  .collect()) == ["4", "5"]
    old = spark.createDataFrame([("1", S.PROCESSED), ("2", S.PROCESSED), ("5", S.NOT_RELEASED)],
                                "app_id string, status string")
    outcomes = spark.createDataFrame([("3", "added"), ("4", "added"), ("5", "added"), ("6", "failed")],
                                     "app_id string, outcome string")
    new = {(r["app_id"], r["status"]) for r in ingest.update_status(old, outcomes).collect()}
    assert new == {("1", "processed"), ("2", "processed"), ("3", "processed"),
                   ("4", "processed"), ("5", "processed")}


def test_work_list_excludes_known(spark):
    apps = spark.createDataFrame([(str(i),) for i in range(1, 7)], "app_id string")
    status = spark.createDataFrame([("1", S.PROCESSED), ("2", S.DISCARDED), ("3", S.NOT_RELEASED)],
                                   "app_id string, status string")
    assert sorted(r[0] for r in ingest.work_list(apps, status).collect()) == ["4", "5", "6"]
    assert sorted(r[0] for r in ingest.work_list(apps, status, released=False).collect()) == \
        ["3", "4", "5", "6"]


def test_ingest_twice_equals_once_and_statuses_partition(spark, scratch):
    game = {"type": "game", "developers": ["D"], "release_date": {"date": "Jan 1, 2020"}}
    primary = bodies(spark, [
        ("1", body("1", game)), ("2", body("2", {**game, "release_date": {"date": ""}})),
        ("3", body("3", {**game, "type": "dlc"})), ("4", "oops")])
    apps = spark.createDataFrame([(str(i),) for i in range(1, 5)], "app_id string")
    s1 = jobs.ingest_run(spark, scratch, apps, primary, None).first()
    assert (s1["added"], s1["not_released"], s1["discarded"], s1["failed"]) == (1, 1, 1, 1)
    s2 = jobs.ingest_run(spark, scratch, apps, primary, None).first()
    assert (s2["added"], s2["not_released"], s2["discarded"], s2["failed"]) == (0, 0, 0, 1)
    # replaying run 2 changes nothing
    jobs.ingest_run(spark, scratch, apps, primary, None, run=2)
    status = {(r["app_id"], r["status"]) for r in jobs.current_status(spark, scratch).collect()}
    assert status == {("1", "processed"), ("2", "notreleased"), ("3", "discarded")}
    merged = jobs.merge(spark, scratch, enriched=False)
    assert [r["app_id"] for r in merged.collect()] == ["1"]
    base = jobs.catalog_from_merged(spark, scratch)
    assert base.columns == [n for n, _, _ in S.BASE_COLUMNS]
    assert base.first()["release_date"] == "Jan 1, 2020"


def test_compaction_and_incremental_merge_equal_full(spark, scratch):
    def game(name, date="Jan 1, 2020"):
        return {"type": "game", "developers": ["D"], "release_date": {"date": date}, "name": name}
    apps = spark.createDataFrame([(str(i),) for i in range(1, 5)], "app_id string")
    run1 = bodies(spark, [("1", body("1", game("a"))), ("2", body("2", game("b", ""))),
                          ("3", "oops")])
    run2 = bodies(spark, [("2", body("2", game("b2"))), ("3", body("3", game("c"))),
                          ("4", body("4", {**game("d"), "type": "dlc"}))])
    for root, compact in ((f"{scratch}/plain", False), (f"{scratch}/compact", True)):
        jobs.ingest_run(spark, root, apps, run1, None)
        if compact:
            assert jobs.compact(spark, root) == 1
            jobs.merge_incremental(spark, root, enriched=False)
        jobs.ingest_run(spark, root, apps, run2, None, released=False)
    plain = {tuple(r) for r in jobs.current_status(spark, f"{scratch}/plain").collect()}
    compacted = {tuple(r) for r in jobs.current_status(spark, f"{scratch}/compact").collect()}
    assert plain == compacted == {("1", "processed"), ("2", "processed"), ("3", "processed"),
                                  ("4", "discarded")}
    full = {(r["app_id"], r["record"]["name"]) for r in jobs.merge(spark, f"{scratch}/plain", False).collect()}
    inc = {(r["app_id"], r["record"]["name"])
           for r in jobs.merge_incremental(spark, f"{scratch}/compact", False).collect()}
    assert full == inc == {("1", "a"), ("2", "b2"), ("3", "c")}


def test_not_released_counter_counts_only_new(spark, scratch):
    """With released=False a known unreleased app is fetched again; if still
    unreleased it stays in the set but is not counted as news."""
    game = {"type": "game", "developers": ["D"], "release_date": {"date": ""}}
    primary = bodies(spark, [("1", body("1", game)), ("2", body("2", game))])
    apps = spark.createDataFrame([("1",), ("2",)], "app_id string")
    s1 = jobs.ingest_run(spark, scratch, apps.where("app_id = '1'"), primary, None).first()
    assert s1["not_released"] == 1
    s2 = jobs.ingest_run(spark, scratch, apps, primary, None, released=False).first()
    assert s2["not_released"] == 1  # app 2 is new, app 1 was known
    status = {tuple(r) for r in jobs.current_status(spark, scratch).collect()}
    assert status == {("1", "notreleased"), ("2", "notreleased")}


def test_json_lines_records_flatten(spark, scratch):
    from shelfspark.operators.flatten import flatten_records
    lines = ['{"app_id": "7", "name": "A", "genres": ["X", "Y"], "price": 1.5}',
             '{"app_id": "8", "name": "B"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{scratch}/jl")
    recs = sources.json_lines_records(spark, f"{scratch}/jl")
    got = {r["app_id"]: (r["name"], r["genres"], r["price"]) for r in flatten_records(recs).collect()}
    assert got == {"7": ("A", "X, Y", 1.5), "8": ("B", "", 0.0)}


def test_id_set_bad_json_raises(spark, scratch):
    """A line that is no array is not read as the empty set: the file is named."""
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{scratch}/bad")
    with pytest.raises(Exception, match="not an array of ids: .*/bad/"):
        sources.id_set(spark, f"{scratch}/bad").count()
    assert sources.app_list(spark, f"{scratch}/bad").count() == 0


def test_auto_compaction_keeps_results(spark, scratch):
    game = {"type": "game", "developers": ["D"], "release_date": {"date": "Jan 1, 2020"}}
    apps = spark.createDataFrame([(str(i),) for i in range(1, 5)], "app_id string")
    for i in range(1, 5):
        primary = bodies(spark, [(str(i), body(str(i), game))])
        jobs.ingest_run(spark, scratch, apps, primary, None, compact_every=2)
    import os
    assert sorted(os.listdir(f"{scratch}/status_snapshot")) == ["upto=2", "upto=4"]
    status = {tuple(r) for r in jobs.current_status(spark, scratch).collect()}
    assert status == {(str(i), "processed") for i in range(1, 5)}


def test_duplicate_stats_bodies_do_not_multiply_records(spark):
    stats = bodies(spark, [("1", '{"developer": "a", "userscore": 5}'),
                           ("1", '{"developer": "b", "userscore": 7}'),
                           ("1", "Too many connections")])
    parsed = ingest.parse_stats(stats).collect()
    assert len(parsed) == 1 and parsed[0]["stats"]["developer"] == "b"  # the greatest, every time
    recs = spark.createDataFrame([("1", ("n",))], "app_id string, record struct<name:string>")
    assert ingest.enrich(recs, ingest.parse_stats(stats)).count() == 1


def test_run_outcomes_are_chunked(spark, scratch):
    """SNK2: at most ``chunk_size`` rows per file of a run."""
    import glob
    game = {"type": "game", "developers": ["D"], "release_date": {"date": "Jan 1, 2020"}}
    primary = bodies(spark, [(str(i), body(str(i), game)) for i in range(1, 6)]).coalesce(1)
    apps = spark.createDataFrame([(str(i),) for i in range(1, 6)], "app_id string")
    jobs.ingest_run(spark, scratch, apps, primary, None, chunk_size=2)
    files = glob.glob(f"{scratch.replace('file:', '')}/outcomes/run=1/*.parquet")
    counts = [spark.read.parquet(f).count() for f in files]
    assert sum(counts) == 5 and max(counts) <= 2


def test_merge_chunks_is_one_shuffle(spark, scratch):
    import os
    os.makedirs(scratch, exist_ok=True)
    for n, obj in [(1, {"1": {"name": "a"}, "2": {"name": "b"}}), (2, {"1": {"name": "c"}})]:
        with open(f"{scratch}/chunk_{n}.json", "w") as fh:
            json.dump(obj, fh)
    df = sources.merge_chunks(spark, scratch)
    assert {r["app_id"]: json.loads(r["record"])["name"] for r in df.collect()} == {"1": "c", "2": "b"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in final


def test_transform_publishes_the_ingested_catalog(spark, scratch):
    from shelfspark.plans.reports import REPORTS
    game = {"type": "game", "developers": ["D"], "release_date": {"date": "Oct 1, 2021"},
            "genres": [{"description": "Action"}, {"description": "RPG"}]}
    primary = bodies(spark, [("1", body("1", game)), ("2", body("2", game))])
    apps = spark.createDataFrame([("1",), ("2",)], "app_id string")
    jobs.ingest_run(spark, f"{scratch}/ing", apps, primary, None)
    jobs.merge(spark, f"{scratch}/ing", enriched=False)
    paths = jobs.transform(spark, f"{scratch}/ing", f"{scratch}/out")
    assert set(paths) == {"catalog", *REPORTS}
    assert spark.read.parquet(paths["catalog"]).count() == 2
    counts = {r["genre"]: r["count"] for r in spark.read.parquet(paths["genre_counts"]).collect()}
    assert counts == {"Action": 2, "RPG": 2}
    years = {r["release_year"]: r["game_count"] for r in spark.read.parquet(paths["games_per_year"]).collect()}
    assert years == {2021: 2}


def test_empty_first_run(spark, scratch):
    from shelfspark.plans import jobs
    apps = spark.createDataFrame([], "app_id string")
    bodies = spark.createDataFrame([], "app_id string, body string")
    row = jobs.ingest_run(spark, f"{scratch}/root", apps, bodies).first()
    assert (row["added"], row["failed"], row["total"]) == (0, 0, 0)

"""Splittable scans of keyed-object files against the reader of whole files."""

from __future__ import annotations

import json
import os
import random

import pytest

from shelfspark.sources import keyed
from shelfspark.sources.files import id_set, keyed_objects, read_or_empty


def catalog(n, seed=0):
    """Records whose strings hold separators, braces, quotes and escapes."""
    rnd = random.Random(seed)
    nasty = ['},', '"},', '\\', '\\"', '{"a": "},"}', "\n    },", "[[{", "é\U0001F600", "", '\\\\"},{']
    out = {}
    for i in range(n):
        out[str(i)] = {"name": "".join(rnd.choice(nasty) for _ in range(rnd.randint(0, 6))),
                       "list": [{"k": rnd.choice(nasty)}, [], {}], "deep": {"a": {"b": [1, {"c": rnd.choice(nasty)}]}}}
        if i % 7 == 0:
            out[f"s{i}"] = rnd.choice([None, 5, "text },", [], {}, [{"x": "},"}]])
    return out


def write(scratch, name, text):
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return f"{scratch}/{name}"


def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    return old


@pytest.fixture()
def many_tasks(spark):
    old = small_splits(spark)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def last(rows):
    """Per (file, app) the last record in file order, parsed."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.file, r.pos)):
        out[os.path.basename(r.file), r.app_id] = r.record
    return out


def whole(spark, path):
    return {(os.path.basename(r.file), r.app_id): r.record for r in keyed_objects(spark, path).collect()}


@pytest.mark.parametrize("indent", [4, 2, "\t"])
def test_indented(spark, scratch, many_tasks, indent):
    write(f"{scratch}/in", "a.json", json.dumps(catalog(300), indent=indent))
    write(f"{scratch}/in", "b.json", json.dumps(catalog(40, 1), indent=indent, ensure_ascii=False))
    rows = keyed.indented_catalog(spark, f"{scratch}/in")
    assert rows.rdd.getNumPartitions() > 3
    assert last(rows.collect()) == whole(spark, f"{scratch}/in")


@pytest.mark.parametrize("separators", [(", ", ": "), (",", ":")])
def test_one_line(spark, scratch, many_tasks, separators):
    write(f"{scratch}/in", "a.json", json.dumps(catalog(300), separators=separators))
    write(f"{scratch}/in", "b.json", json.dumps(catalog(40, 1), separators=separators, ensure_ascii=False) + "\n")
    assert spark.read.text(f"{scratch}/in/a.json", lineSep=keyed.CUT).rdd.getNumPartitions() > 3
    assert last(keyed.one_line_catalog(spark, f"{scratch}/in").collect()) == whole(spark, f"{scratch}/in")


def test_small_files_and_repeats(spark, scratch):
    for i, text in enumerate(('{}', '{"1": {}}', '{"1": 5}', '{"1": {"a": 1}, "1": {"a": 2}}', ' {"1": {"a": {}}, "2": 3} ')):
        path = write(f"{scratch}/{i}", "x.json", text)
        assert last(keyed.one_line_catalog(spark, path).collect()) == whole(spark, path), text
    for i, text in enumerate(('{\n  "1": {}\n}', '{\n    "1": {\n        "a": 1\n    },\n    "1": {\n        "a": 2\n    }\n}\n',
                              '{\r\n  "1": {\r\n    "a": 1\r\n  },\r\n  "2": 3\r\n}')):
        path = write(f"{scratch}/i{i}", "x.json", text)
        assert last(keyed.indented_catalog(spark, path).collect()) == whole(spark, path), text
    assert keyed.one_line_catalog(spark, f"{scratch}/none*").collect() == []
    assert keyed.indented_catalog(spark, f"{scratch}/none*").collect() == []


def test_truncated_files_raise(spark, scratch):
    pretty, line = json.dumps(catalog(30), indent=4), json.dumps(catalog(30))
    cuts = [len(pretty) // 2, pretty.rindex("\n    },") + 7, len(pretty) - 2]
    for i, cut in enumerate(cuts):
        path = write(f"{scratch}/p{i}", "x.json", pretty[:cut])
        with pytest.raises(Exception, match="x.json"):
            keyed.indented_catalog(spark, path).collect()
    for i, cut in enumerate((len(line) // 2, len(line) - 1, line.rindex("},") + 2)):
        path = write(f"{scratch}/l{i}", "x.json", line[:cut])
        with pytest.raises(Exception, match="x.json"):
            keyed.one_line_catalog(spark, path).collect()


def test_readers_do_not_lose_silently(spark, scratch):
    path = write(f"{scratch}/ids", "x.json", '["1", "2"]\n["3", "4"')
    with pytest.raises(Exception, match="x.json"):
        id_set(spark, path).collect()
    path = write(f"{scratch}/lines", "y.json", '{"a": 1}\n{"a": 2\n')
    schema = spark.createDataFrame([], "a int").schema
    with pytest.raises(Exception, match="(?i)malformed|y.json"):
        read_or_empty(spark, path, schema, "json").collect()

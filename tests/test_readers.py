"""Readers: both JSON layouts by default, globs, broken files; linear trimming."""
from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import text as X
from shelfspark.sinks.jdbc import sql_ready
from shelfspark.sources import files as sources


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_indented_id_set_and_app_list(spark, scratch):
    put(scratch, "ids.json", json.dumps(["10", "20", "x y"], indent=4))
    put(scratch, "numbers.json", json.dumps([1, 2], indent=4))
    put(scratch, "apps.json", json.dumps({"applist": {"apps": [{"appid": 7, "name": "a"}, {"appid": 8}]}}, indent=4))
    assert sorted(r[0] for r in sources.id_set(spark, f"{scratch}/ids.json").collect()) == ["10", "20", "x y"]
    assert sorted(r[0] for r in sources.app_list(spark, f"{scratch}/numbers.json").collect()) == ["1", "2"]
    assert sorted(r[0] for r in sources.app_list(spark, f"{scratch}/apps.json").collect()) == ["7", "8"]


def test_globs_are_read(spark, scratch):
    put(scratch, "me1.json", '["1"]')
    put(scratch, "me2.json", '["2"]')
    assert sources.id_set(spark, f"{scratch}/me*.json").count() == 2
    assert sources.id_set(spark, f"{scratch}/no*.json").count() == 0
    spark.range(5).write.parquet(f"{scratch}/pq/a")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sources.read_or_empty(spark, f"{scratch}/pq/*", schema).count() == 5


def test_truncated_chunk_raises(spark, scratch):
    put(scratch, "chunk_1.json", '{"1": {"name": "a"}}')
    put(scratch, "chunk_2.json", '{"2": {"name": "b"')
    with pytest.raises(Exception, match="chunk_2.json"):
        sources.merge_chunks(spark, scratch).collect()


def test_trim_is_linear(spark):
    long = "a" + " " * 1_000_000 + "b "
    df = spark.createDataFrame([(long,)], "s string")
    begin = time.time()
    assert df.select(F.length(X.strip_ws("s"))).first()[0] == len(long) - 1
    assert time.time() - begin < 30


def test_scalars_without_sql_type_become_text(spark):
    row = spark.sql("SELECT INTERVAL '1' DAY AS d, array(1) AS a, 1 AS n")
    out = sql_ready(row)
    assert dict(out.dtypes) == {"d": "string", "a": "string", "n": "int"}
    assert out.first()["a"] == "[1]"


def test_record_that_is_no_object_raises(spark):
    """Neither junk nor a missing record becomes a row of defaults."""
    from shelfspark.operators.flatten import flatten_records
    for junk in ('{"name": "cut o', "[1]", "null", None):
        recs = spark.createDataFrame([("1", '{"name": "a"}'), ("2", junk)], "app_id string, record string")
        with pytest.raises(Exception, match="record of app 2"):
            flatten_records(recs).collect()

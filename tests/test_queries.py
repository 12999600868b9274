"""Every registered query against its DuckDB oracle, plus plan checks."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from driver_tables import SF_SMALL
from oracle_check import compare, duck
from shelfspark.plans import queries as own  # the training-data queries are tested in tests/llm

NAMES = sorted(own.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(own.ORACLE) == set(own.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "count"]
    assert df.count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


TOP_K = ["top_10_peak_ccu", "top_10_languages", "top_10_developers",
         "games_highest_ownership", "top_developers_user_score", "top_10_dlc"]


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_plans_take_ordered(spark, name):
    from shelfspark.plans.reports import REPORTS
    from shelfspark.sources.testdata import catalog
    df = REPORTS[name](catalog(spark, SF_SMALL))
    df.collect()
    assert "TakeOrderedAndProject" in _plan(df)


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udf_in_plans(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in plan, (name, node)


def test_describe_has_no_single_partition_window_over_rows(spark):
    """Windows run per value bucket; the only unpartitioned one is over bucket totals."""
    from shelfspark.plans.reports import price_distribution
    from shelfspark.sources.testdata import catalog
    df = price_distribution(catalog(spark, SF_SMALL))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [ln.split("Window ", 1)[1] for ln in plan.splitlines() if "Window [" in ln]
    assert windows
    for w in windows:
        partitioned_by_bucket = "], [b#" in w
        over_bucket_totals = w.startswith("[sum(bc#")
        assert partitioned_by_bucket or over_bucket_totals, w


def test_scan_prunes_columns(spark):
    from shelfspark.plans.reports import genre_counts
    from shelfspark.sources.testdata import catalog
    df = genre_counts(catalog(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_size:int>" in plan


def test_last_wins_pre_aggregates_per_task(spark):
    """A key repeated in every batch costs one row per task before the shuffle."""
    from shelfspark.operators.ingest import last_wins
    df = spark.range(0, 1000).selectExpr("id % 3 AS k", "id AS batch", "CAST(id AS STRING) AS v")
    out = last_wins(df, "k", "batch")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert {r["k"]: r["v"] for r in out.collect()} == {0: "999", 1: "997", 2: "998"}


@pytest.mark.parametrize("name", ["genre_counts", "top_10_developers", "games_per_year",
                                  "age_distribution"])
def test_report_aggregations_are_partial(spark, name):
    from shelfspark.plans.reports import REPORTS
    from shelfspark.sources.testdata import catalog
    df = REPORTS[name](catalog(spark, SF_SMALL))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in plan


def test_classify_cuts_to_the_work_list_before_it_aggregates_bodies(spark):
    """The semi-join sits below the aggregation of the deliveries, whose partial
    half leaves one candidate per app and task."""
    from shelfspark.operators.ingest import classify
    bodies = spark.createDataFrame([("1", f'{{"1": {{"success": true, "data": {{"n": {i}}}}}}}')
                                    for i in range(300)] + [("2", "x")], "app_id string, body string")
    work = spark.createDataFrame([("1",), ("2",)], "app_id string")
    df = classify(work, bodies)
    assert {r["app_id"]: r["outcome"] for r in df.collect()} == {"1": "discarded", "2": "failed"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    # children print after their parents
    assert "LeftSemi" in plan[plan.index("partial_max_by"):]

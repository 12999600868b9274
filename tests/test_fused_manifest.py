"""Fused reports, chunk manifests and the cached app list."""

from __future__ import annotations

import glob
import os

import pytest
from driver_tables import SF_SMALL
from pyspark.sql import functions as F

from shelfspark import schema as S
from shelfspark.plans import fused, jobs, reports
from shelfspark.plans.app_list_cache import cached_list, publish_list, resolve_app_list
from shelfspark.sinks.manifest import ChunkError
from shelfspark.sources import payloads, testdata


def rows_of(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]


def odd_base(spark):
    """NULL lists, flags, prices, ages and figures, ties, an empty list and a repeated name."""
    def row(i, **kw):
        plain = {n: d if not isinstance(d, list) else "" for n, _, d in S.BASE_COLUMNS}
        return {**plain, "app_id": str(i), "name": f"n{i}", "release_date": "Jan 1, 2020", "genres": "A, B", **kw}
    odd = [row(1, genres=None, developers=None, price=None, windows=None), row(2, name="n1", dlc_count=None),
           row(3, required_age=None, estimated_owners=None, peak_ccu=None, supported_languages=None),
           row(4, name=None, release_date=None, recommendations=None), row(5, price=float("nan"), dlc_count=7),
           *[row(i, positive=i, negative=1, price=i / 3, mac=True, developers="d, e;f", peak_ccu=i % 3) for i in range(6, 40)]]
    return spark.createDataFrame([tuple(r[n] for n, _, _ in S.BASE_COLUMNS) for r in odd], S.BASE_SCHEMA)


@pytest.mark.parametrize("make", [lambda s: testdata.catalog(s, SF_SMALL), odd_base,
                                  lambda s: odd_base(s).limit(0)], ids=["tables", "odd", "empty"])
def test_fused_reports_equal_single_ones(spark, scratch, make):
    base = make(spark)
    found = fused.fused_reports(spark, base, scratch)
    assert list(found) == list(reports.REPORTS)
    for name, single in reports.generate_reports(base).items():
        assert found[name].dtypes == single.dtypes, name
        assert str(rows_of(found[name])) == str(rows_of(single)), name  # as text: NaN equals NaN


def test_publish_scans_the_base_table_twice(spark, scratch):
    testdata.catalog(spark, SF_SMALL).write.parquet(f"{scratch}/base")
    base = spark.read.parquet(f"{scratch}/base")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    groups, ranked = plan(fused.report_groups(base)), plan(fused.ranked_rows(base))
    assert groups.count("FileScan") == ranked.count("FileScan") == 1
    assert groups.count("partial_count(1)") == 1 and groups.count("Exchange") == 1
    assert "WindowGroupLimit" in ranked and "Partial" in ranked  # ten rows a task before the shuffle
    found = fused.fused_reports(spark, base, f"{scratch}/inputs")
    assert all(f"{scratch}/base" not in str(df.inputFiles()) for df in found.values())


def ingest_once(spark, root, **kw):
    apps, primary, stats = payloads.landed(spark, SF_SMALL)
    jobs.ingest_run(spark, root, apps, primary, stats, chunk_size=20, **kw)


def chunk_files(root, run):
    return sorted(glob.glob(f"{root}/outcomes/run={run}/part-*.parquet"))


def test_whole_chunks_pass_and_runs_without_rows_too(spark, scratch):
    ingest_once(spark, scratch)
    apps, primary, _ = payloads.landed(spark, SF_SMALL)
    jobs.ingest_run(spark, scratch, apps, primary)            # without enrichment
    jobs.ingest_run(spark, scratch, apps.limit(0), primary)   # no rows at all
    assert len(chunk_files(scratch, 1)) > 2
    checked = rows_of(jobs.merge(spark, scratch, verify=True).select("app_id", "record.name").orderBy("app_id"))
    assert checked == rows_of(jobs.merge(spark, scratch).select("app_id", "record.name").orderBy("app_id"))


def test_lost_altered_and_strange_chunks_are_named(spark, scratch):
    ingest_once(spark, scratch)
    ingest_once(spark, scratch)
    lost = chunk_files(scratch, 1)[0]
    body = open(lost, "rb").read()
    os.remove(lost)
    with pytest.raises(ChunkError, match=f"{os.path.basename(lost)} missing"):
        jobs.merge(spark, scratch, verify=True)
    open(lost, "wb").write(open(chunk_files(scratch, 1)[1], "rb").read())
    crc = os.path.join(os.path.dirname(lost), f".{os.path.basename(lost)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ChunkError, match=f"{os.path.basename(lost)} altered"):
        jobs.verify_chunks(spark, scratch)
    open(lost, "wb").write(body)
    jobs.verify_chunks(spark, scratch)
    strange = f"{scratch}/outcomes/run=1/part-99999-more.parquet"
    open(strange, "wb").write(body)
    with pytest.raises(ChunkError, match="part-99999-more.parquet not listed"):
        jobs.verify_chunks(spark, scratch)


def test_half_written_run_has_no_manifest(spark, scratch):
    ingest_once(spark, scratch)
    spark.createDataFrame([("1", "added")], "app_id string, outcome string").write.parquet(f"{scratch}/outcomes/run=2")
    with pytest.raises(ChunkError, match="run=2.*not finished"):
        jobs.verify_chunks(spark, scratch)


def test_replayed_run_replaces_its_manifest(spark, scratch):
    ingest_once(spark, scratch, run=1)
    apps, primary, stats = payloads.landed(spark, SF_SMALL)
    jobs.ingest_run(spark, scratch, apps.limit(5), primary, stats, run=1)
    jobs.verify_chunks(spark, scratch)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "app_id string")


def listed(df):
    return sorted(r[0] for r in df.collect())


def test_cache_wins_over_a_later_payload(spark, scratch):
    calls = []

    def landed(*names):
        def read():
            calls.append(names)
            return ids(spark, *names)
        return read
    assert listed(resolve_app_list(spark, scratch, landed("1", "2"))) == ["1", "2"]
    assert listed(resolve_app_list(spark, scratch, landed("3"))) == ["1", "2"]
    assert calls == [("1", "2")]
    assert listed(publish_list(spark, scratch, ids(spark, "4"))) == ["4"]
    assert listed(cached_list(spark, scratch)) == ["4"]


def test_two_writers_leave_one_whole_list(spark, scratch, monkeypatch):
    """The second writer commits while the first has its list written but not named."""
    from shelfspark.plans import app_list_cache as A
    write, done = A.write_id_sets, []

    def slow(rows, path, chunk_rows):
        write(rows, path, chunk_rows)
        if not done:
            done.append(path)
            publish_list(spark, scratch, ids(spark, "second"))
    monkeypatch.setattr(A, "write_id_sets", slow)
    assert listed(publish_list(spark, scratch, ids(spark, "first"))) == ["second"]
    assert len(glob.glob(f"{scratch}/lists/*")) == 1 and not os.path.exists(done[0])


def test_list_that_is_not_whole_is_landed_again(spark, scratch):
    publish_list(spark, scratch, ids(spark, "1"))
    for mark in glob.glob(f"{scratch}/lists/*/_SUCCESS"):
        os.remove(mark)
    assert cached_list(spark, scratch) is None
    assert listed(resolve_app_list(spark, scratch, lambda: ids(spark, "2"))) == ["2"]


def test_old_lists_expire(spark, scratch):
    for n in range(6):
        publish_list(spark, scratch, ids(spark, str(n)).where(F.col("app_id") != ""), keep_versions=2)
    assert len(glob.glob(f"{scratch}/lists/*")) == 2 and listed(cached_list(spark, scratch)) == ["5"]

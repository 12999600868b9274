"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""
from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from shelfspark.llm import (decontaminate, exact_dedup, licenses, ngram_join, packing, pii, quality, secrets,
                            token_shards, toxicity)
from shelfspark.llm.common import scratch

MODEL = quality.AttentionMIL(quality.FEATURES)
WORDS = toxicity.PULearner(np.zeros(0, np.uint64), 0.1)
ROWWISE = {
    "components": lambda d: ngram_join.jaccard_components(d, width=3, percent=90),
    "secrets": secrets.find_secrets,
    "licenses": licenses.scan_licenses,
    "pii": pii.find_personal_data,
    "quality": lambda d: quality.score_quality(d, MODEL),
    "toxicity": lambda d: toxicity.score_toxicity(d, WORDS),
    "packing": packing.pack_documents,
    "shards": lambda d: token_shards.read_shards(token_shards.write_shards(d, scratch(d.sparkSession, "t"),
                                                                           shard_ids=3000)),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_one_row_per_row(spark, make_docs, odd_rows, name):
    got = [r.id for r in ROWWISE[name](make_docs(odd_rows)).collect()]
    want = Counter(i for i, _ in odd_rows)
    assert set(got) == set(want)
    if name != "packing":  # long documents are several pieces there
        assert Counter(got) == want


@pytest.mark.parametrize("name", ROWWISE)
def test_empty_table(spark, make_docs, name):
    assert ROWWISE[name](make_docs([])).collect() == []


def test_components_of_odd_rows(spark, make_docs, odd_rows):
    rows = ngram_join.jaccard_components(make_docs(odd_rows), width=3, percent=90).collect()
    low = {r.id: r.component_id for r in rows if r.id is not None}
    size = {r.id: r.n_shingles for r in rows if r.id is not None}
    assert low[5] == low[6] == 5 and low[1] == 1 and low[2] == 2 and low[9] == 9
    assert size[1] == size[2] == size[9] == 0 and size[3] == size[4] == size[8] == 1
    assert all(r.component_id is None for r in rows if r.id is None)


def test_large_lists_are_dealt_in_blocks(spark, make_docs):
    """Near copies by the hundred, with lists and blocks small enough to split."""
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 5), replace=False):
            w[k] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k:k + 3]) for k in range(118)} for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    got = ngram_join.jaccard_components(make_docs(rows), width=3, percent=90, list_size=4, block=16).collect()
    assert {r.id: r.component_id for r in got} == dict(enumerate(group))


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_dedup_of_odd_rows(spark, make_docs, odd_rows, most):
    out = exact_dedup.deduplicate(make_docs(odd_rows), most_broadcast=most)
    rows = out.select("doc_id", "text").collect()
    assert len(out.columns) == 11
    ids = Counter(r.doc_id for r in rows)
    # 5 and 6 are equal, 6 comes twice; NULL and empty texts are equal and 2 is the largest id
    assert ids == Counter([2, 3, 4, 6, 7, 8, None, 9, 10, 11, 12, 13])


def test_filters_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    bench = spark.createDataFrame([(1, "a b c d e f g h"), (2, None), (3, "")], "item_id long, text string")
    out = decontaminate.drop_contaminated(docs, bench)
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in odd_rows if i not in (5, 6))
    # an item under five words is found where all its words stand together: "one" and "one two" hold it
    short = bench.unionByName(spark.createDataFrame([(4, "one")], bench.schema))
    out = decontaminate.drop_contaminated(docs, short)
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in odd_rows if i not in (3, 4, 5, 6))
    none = decontaminate.drop_contaminated(docs, bench.limit(0))
    assert none.count() == len(odd_rows)
    assert ngram_join.one_per_component(docs, width=5).columns == docs.columns
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, quality.fit_quality(docs, labels)).count() == len(odd_rows)
    model = toxicity.fit_toxicity(docs, labels)
    assert all(r.score < 0.5 for r in toxicity.score_toxicity(docs, model).collect())


def test_shard_lookup(tmp_path):
    keys = [None, 3, 3, 5, -9, 2**62] + list(range(100, 4000))
    keys = [None] + sorted(k for k in keys if k is not None)
    data = [np.arange(i % 7, dtype="<u4").tobytes() for i in range(len(keys))]
    path = tmp_path / "s.bin"
    path.write_bytes(token_shards.shard_bytes(keys, data, wide=False))
    shard = token_shards.open_shard(str(path))
    row, times = shard.find(np.array([3, -9, 2**62, 77, 4000, 150]))
    assert times.tolist() == [2, 1, 1, 0, 0, 1] and row[3] == row[4] == -1
    assert all(keys[r] == k for r, k in zip(row, [3, -9, 2**62]) if r >= 0)
    assert shard.ids(int(row[0])).tobytes() == data[int(row[0])]
    # minimal and perfect: n slots for n distinct keys
    distinct = np.array(sorted({k for k in keys if k is not None}))
    assert sorted(token_shards.slots(distinct, shard.levels, shard.ranks)) == list(range(len(distinct)))


def test_tokens_of_odd_texts():
    import random
    from shelfspark.llm.tokens import Encoder, vocabulary_path
    e, r = Encoder(vocabulary_path(), most_cached=50), random.Random(3)
    parts = list("abzAZ09 '\n\t.!-<|>_sdtm") + ["'s", "'ll", "é", "É", "ß", "×", "ÿ", "µ", "́", "’", "İ", "Σ", "ς",
                                                "日", "²", " ", "\x1c", "\U0001F600", "<|endoftext|>", "K", "\x00"]
    for _ in range(500):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        want = np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert e.one(text) == want, repr(text)


def test_checksums():
    import zlib
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = f"ghp_{body}{secrets.base62(zlib.crc32(body.encode()))}"
    assert ("github", 2, 2 + len(good)) in secrets.scan(f"x {good} y")
    assert not secrets.scan(f"x ghp_{body}000000 y")


def test_revealing_terms(spark, make_docs):
    """A word that always stands by an address is removed, ordinary words stay."""
    rows = [(i, f"Filler number {i} says zebraword mail ann@example.org often enough {i}") for i in range(3)]
    rows += [(10 + i, f"Filler number says often enough other {i}") for i in range(40)]
    docs = make_docs(rows)
    found = pii.find_personal_data(docs).where("id = 1").first()
    text = rows[1][1]
    own = {text[s.start:s.end]: s.kind for s in found.spans}
    assert own["zebraword"] == "term_removed" and "Filler" not in own and "often" not in own
    from pyspark.sql import functions as F
    clean = docs.join(pii.find_personal_data(docs).select(F.col("id").alias("doc_id"), F.col("spans").alias("own")),
                      "doc_id").where("doc_id = 1").select(pii.sanitise(F.col("text"), F.col("own"))).first()[0]
    assert "zebraword" not in clean and "[EMAIL]" in clean and "Filler number 1" in clean


def test_pii_counts_rows_without_id(spark, make_docs):
    """Texts of rows without id count as occurrences of a term near an entity."""
    rows = [(None, f"Mister Zworykin can be reached at a.b@example.org {w}") for w in ("now", "today", "soon")]
    docs = make_docs(rows + [(i, f"plain words {i}") for i in range(40)])
    found = pii.find_personal_data(docs).where("id IS NULL").collect()
    assert len(found) == 3
    assert all(any(s["kind"] == "term_removed" and s["start"] == 7 for s in r["spans"]) for r in found)

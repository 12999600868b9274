"""Memory and skew bounds give the results of the unbounded form."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from shelfspark.llm import decontaminate as D
from shelfspark.llm import shingles as S
from shelfspark.llm.components import connected_components


def _brute_components(edges):
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_hubs_are_joined_apart(spark):
    r = random.Random(3)
    edges = [(0, i) for i in range(1, 40)] + [(900, i) for i in range(100, 140)] + [(139, 39)]
    edges += [(r.randint(200, 400), r.randint(200, 400)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(20)]
    want = _brute_components([e for e in edges if e[0] != e[1]])
    df = spark.createDataFrame(edges + edges[:5], "u long, v long")
    for hot in (2, 8, 1_000):
        got = {x["node"]: x["component"] for x in connected_components(df, hot_degree=hot).collect()}
        assert got == want, hot


def test_repeated_phrases_are_found():
    """Weighted similarity just above the threshold, a repeated phrase changed in the text."""
    r = random.Random(9)
    n = [0]

    def fresh(k):
        n[0] += k
        return " ".join(f"u{n[0] - i}" for i in range(k))
    missed = total = 0
    for times, words in ((3, 5), (5, 6), (2, 9), (4, 7)):
        for _ in range(150):
            phrase, other = fresh(words), fresh(words)
            lines = [fresh(r.randint(40, 60))] + [phrase] * times
            item = " ".join([lines[0]] + lines[1:])
            for cut in range(1, times + 1):  # as many repeats changed as the threshold allows
                text = " ".join([lines[0]] + [phrase] * (times - cut) + [other] * cut)
                a, b = (Counter(zip(*[t.split()[i:] for i in range(5)])) for t in (item, text))
                sim = sum((a & b).values()) / sum((a | b).values())
                if not 0.8 <= sim < 0.9:
                    continue
                found = list(D.search_batch(pa.array(["x y z " + text + " tail"]), D.item_groups([(1, item)], 5), 0.8))
                total += 1
                missed += not found
    assert total > 150 and missed <= total * 0.01


def test_items_shorter_than_a_shingle():
    groups = D.item_groups([(1, "Three small words"), (2, "one"), (3, "..."), (4, "a b c d e f")], 5)
    texts = pa.array(["has three SMALL, words in it", "three small other words", "one", "A b c d e f", None, ""])
    assert sorted((r, i, s) for r, i, s, *_ in D.search_batch(texts, groups, 0.8)) == [
        (0, 1, 1.0), (2, 2, 1.0), (3, 4, 1.0)]


def test_repeats_count_in_windows():
    h = np.array([5, 7, 5, 5, 9, 7, 5], np.uint64)
    rep = D.Repeats(h)
    for span in range(1, 8):
        assert rep.up_to(span).tolist() == [int((h[max(0, p - span + 1):p + 1] == h[p]).sum()) for p in range(7)]
        assert rep.onward(span).tolist() == [int((h[p:p + span] == h[p]).sum()) for p in range(7)]
    assert rep.closest == 1


def test_equal_rows_are_packed_in_many_groups(spark, make_docs):
    from shelfspark.llm import packing
    docs = make_docs([(None, "the same text")] * 300)
    rows = packing.pack_documents(docs, size=16, group_rows=20).collect()
    per_group = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 300 and len(per_group) > 8 and max(per_group.values()) < 60


def test_one_per_component_names_rows_by_id_and_text(spark, make_docs):
    from shelfspark.llm import ngram_join
    base = [f"w{i}" for i in range(60)]
    near = base[:59] + ["other"]
    clean = " ".join(f"c{i}" for i in range(40))
    rows = [(1, " ".join(base)), (2, " ".join(near)), (2, clean), (3, " ".join(base[1:])), (3, " ".join(base[2:])),
            (None, " ".join(base)), (4, None), (4, "")]
    kept = ngram_join.one_per_component(make_docs(rows))
    assert len(kept.columns) == 11
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, " ".join(base)), (2, clean), (None, " ".join(base)), (4, None), (4, "")], key=str)


def test_stretches_find_the_same_windows():
    r = random.Random(4)
    word = lambda: f"w{r.randint(0, 300)}"
    bench = [(i, " ".join(word() for _ in range(r.choice((9, 14, 30))))) for i in range(12)]
    items = D.Items(bench, 5)
    for _ in range(6):
        parts = [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(8)]
        leaks = [b[1] for b in r.sample(bench, 4)]
        leaks[0] = leaks[0].replace("w1", "w2", 1)
        text = " ".join(x for pair in zip(parts, leaks + leaks) for x in pair)
        w, first = S.words(*S.text_bytes(pa.array([text], pa.large_string())), S.NOT_ALNUM)
        h, _ = S.shingles(w, first, 5)
        hits = np.flatnonzero(items.holds(h))
        whole = sorted(D.search_text(h, hits, items, 0.8))
        assert len(whole) >= 3
        for stretch in (1, 7, 64):
            assert sorted(D.search_text(h, hits, items, 0.8, stretch=stretch)) == whole

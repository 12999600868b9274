"""Vector codes and exact top-k against brute force; odd rows and hot keys."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import oracle_check
import pytest

from shelfspark.llm import vector_codes as C
from shelfspark.llm import vector_search as T
from shelfspark.llm.vectors import LIMIT

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_exact_top_k"])
def test_oracle(spark, name):
    r = oracle_check.compare(spark, name, SF)
    assert r["cols_match"] and r["hash_match"], r


def frame(spark, rows):
    """Rows ``(vec_id, vector, label)`` with columns named like the operators' own."""
    schema = ("vec_id long, embedding array<float>, label int, id long, v string, code string, error long, n long, "
              "query long, ids string, score double, first long, number long")
    return spark.createDataFrame([(*r, 7, "x", "x", 7, 7, 7, "x", 0.5, 7, 7) for r in rows], schema)


def odd(rng, d=16, n=90):
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, d)], int(i) % 3) for i in range(n)]
    same = [float(x) for x in rng.normal(0, 0.2, d)]
    rows += [(200 + i, same, None) for i in range(60)]          # one very common vector
    rows += [rows[3], rows[3], (5, rows[9][1], 1)]              # repeated rows, an id on two vectors
    rows += [(300, None, 1), (301, [], 1), (302, [None] + [0.1] * (d - 1), 1), (303, [NAN] + [0.1] * (d - 1), 1),
             (304, [-INF] + [0.1] * (d - 1), 1), (None, [0.05] * d, 2), (-40, [0.0] * d, 2), (-60, [0.5] * d, 2)]
    return rows


def usable(rows):
    return [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]


def ints(vector, scale):
    return [math.floor(scale * float(np.float32(x))) for x in vector]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(((i, ints(v, 4096), lab) for i, v, lab in usable(rows)),
                  key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in rows]
    book = [[cut[r][p] for r in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book[p]))
    for _ in range(rounds):
        at = [[nearest(c[p], p)[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for j in range(len(book[p])):
                own = [c[p] for c, a in zip(cut, at) if a[p] == j]
                if own:
                    book[p][j] = [sum(x) // len(own) for x in zip(*own)]
    found = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    total = {}
    for (_, _, lab), f in zip(rows, found):
        total[lab] = total.get(lab, 0) + sum(d for d, _ in f)
    return sorted(((i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), total[lab])
                   for (i, _, lab), f in zip(rows, found)), key=str), digest


@pytest.mark.parametrize("most", [0, 2, 1_000_000])
@pytest.mark.parametrize("n", [3, 90])
def test_codes_of_odd_rows(spark, n, most):
    rows = odd(np.random.default_rng(n), n=max(n, 12))
    rows = rows if n > 3 else [rows[0], rows[1], (None, rows[2][1], None)]
    coded, books = C.encode_vectors(frame(spark, rows))
    got = C.with_label_error(coded, most).collect()
    want, digest = brute_codes(rows)
    assert sorted(((r.id, bytes(r.code).hex(), r.error, r.label_error) for r in got), key=str) == want
    assert C.codebook_digest(books) == digest


def test_active_entries_give_the_full_scan():
    """Ties and moved entries: kept distances against a scan of all entries."""
    rng = np.random.default_rng(1)
    v = rng.integers(-3, 4, (500, 2))
    book = rng.integers(-3, 4, (6, 2))
    code, dist = np.zeros(500, np.int64), np.zeros(500, np.int64)
    C.assign(v, book, np.ones(6, bool), code, dist)
    for _ in range(30):
        moved = rng.random(6) < 0.4
        book = np.where(moved[:, None], rng.integers(-3, 4, (6, 2)), book)
        C.assign(v, book, moved, code, dist)
        full = ((v[:, None] - book) ** 2).sum(axis=2)
        assert (code == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
    big = np.array([[LIMIT - 1] * 8, [1 - LIMIT] * 8])
    assert C.distances(big, big).tolist() == [[0, 8 * (2 * LIMIT - 2) ** 2], [8 * (2 * LIMIT - 2) ** 2, 0]]


def test_codes_without_rows_and_bad_lengths(spark):
    coded, books = C.encode_vectors(frame(spark, [(1, None, 1)]))
    assert C.with_label_error(coded).collect() == [] and books.size == 0
    for rows in ([(1, [0.1] * 8, 1), (2, [0.1] * 16, 1)], [(1, [0.1] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(Exception, match="components|component times"):
            C.encode_vectors(frame(spark, rows))


def brute_top(rows, k, every):
    kept = {(i, tuple(ints(v, 64))) for i, v, _ in usable(rows) if i is not None}
    out = []
    for q in kept:
        if q[0] % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in kept if (i, v) != q)
            out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("k,block,query_block,most", [(20, 16_384, 1_024, 100_000), (3, 16, 4, 2), (1_000, 40, 5, 0)])
def test_top_k_of_odd_rows(spark, k, block, query_block, most):
    rows = odd(np.random.default_rng(7))
    df = frame(spark, rows)
    got = T.top_k(df, df.where("vec_id % 20 = 0"), k, block=block, query_block=query_block, most_broadcast=most)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, k, 20)


def test_top_k_of_few_or_no_rows(spark):
    one = frame(spark, [(20, [0.5] * 4, 1)])
    none = frame(spark, [])
    assert T.top_k(one, one).collect() == T.top_k(none, none).collect() == T.top_k(one, none).collect() == []
    assert T.top_k(none, one).collect() == []
    outlier = [(i, [1.0, i / 64], 0) for i in range(50)] + [(99, [9e5, -9e5], 0)]
    df = frame(spark, outlier)
    assert sorted(map(tuple, T.top_k(df, df.where("vec_id = 40"), 5, cells=4).collect())) == \
        [r for r in brute_top(outlier, 5, 20) if r[0] == 40]


def test_bounds_hold_the_score_and_cut_reading():
    """Exact reads stop early, with the results of reading everything."""
    rng = np.random.default_rng(2)
    v, q = rng.integers(-30, 31, (4000, 32)), rng.integers(-30, 31, 32)
    exact = v @ q
    lower, upper = exact - 200, exact + 200
    ids = rng.permutation(4000)
    want = np.lexsort((ids, -exact))[:9]
    rows, scores = T.best_of(q, v, ids, lower, upper, 9, step=8)
    assert (rows == want).all() and (scores == exact[want]).all()
    zero = np.zeros(4000, np.int64)
    rows, _ = T.best_of(q * 0, v, ids, zero, zero, 9)
    assert sorted(ids[rows]) == list(range(9))

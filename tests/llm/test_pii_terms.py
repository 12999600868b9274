"""Own spans of the personal-data operator against brute force; linear time."""

from __future__ import annotations

import math
import re
import time
import unicodedata
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import pii

ENTITY = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def words(text):
    """``(start, end, lower-cased word)`` of the runs of letters, marks and digits."""
    out, at = [], None
    for i, c in enumerate(text + " "):
        if unicodedata.category(c)[0] in "LMN":
            at = i if at is None else at
        elif at is not None:
            out.append((at, i, text[at:i].lower()))
            at = None
    return out


def brute(rows, least=2, generalise=0.7, remove=0.95):
    n_t, n_e, n_te, texts = (defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set))
    plain = []
    for _, text in rows:
        text = text or ""
        blank = ENTITY.sub(lambda m: " " * len(m[0]), text)
        found = words(blank)
        plain.append(found)
        own, ents = {w for _, _, w in found}, {m[0].lower() for m in ENTITY.finditer(text)}
        for w in own:
            n_t[w] += 1
        for e in ents:
            n_e[e] += 1
            for w in own:
                n_te[e, w] += 1
                texts[e, w].add(text)
    n, score = len(rows), defaultdict(float)
    for (e, w), m in n_te.items():
        if len(texts[e, w]) >= least and n_e[e] < n:
            score[w] = max(score[w], math.log(n * m / (n_t[w] * n_e[e])) / math.log(n / n_e[e]))
    return [sorted(("term_removed" if score[w] >= remove else "term_generalised", a, b)
                   for a, b, w in found if score[w] >= generalise) for found in plain]


def corpus():
    """Names that go with an address, and others that do not; long texts and repeats."""
    rng = np.random.default_rng(5)
    common = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(120):
        text = list(rng.choice(common, rng.integers(3, 30)))
        person = int(rng.integers(0, 8))
        if i % 3 == 0:
            text.insert(0, f"p{person}@mail.example")
            text += [f"Näme{person}", "X1" if person == 3 else "or", f"{person}{person}7"]
        if i % 5 == 0:
            text += [f"näme{person}", f"NÄME{(person + 1) % 8},", f"Näme{person}s"]
        rows.append((i, " ".join(text)))
    rows += [rows[0], rows[3], (None, rows[6][1]), (7, None), (8, ""),
             (900, "Näme1 " * 3000 + "p1@mail.example" + " Näme2 é" * 200)]
    return rows


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_own_spans(spark, make_docs, most):
    rows = corpus()
    want = sorted((str(i), str(t), own) for (i, t), own in zip(rows, brute(rows)))
    texts = {}
    for _, t in rows:
        key = spark.range(1).select(F.xxhash64(F.lit(t or "")).alias("k")).first()["k"] if t not in texts else texts[t]
        texts[t] = key
    got = pii.find_personal_data(make_docs(rows), most_broadcast=most).collect()
    named = defaultdict(list)
    for r in got:
        named[r.id, r.text_key].append(sorted((s.kind, s.start, s.end) for s in r.spans if s.kind in pii.OWN_KINDS))
    found = []
    for i, t in rows:
        found.append((str(i), str(t), named[i, texts[t]].pop()))
    assert sorted(found) == want
    kinds = {s[0] for _, _, own in want for s in own}
    assert kinds == set(pii.OWN_KINDS) and sum(len(own) for _, _, own in want) > 3000


def test_running_sums(spark):
    for n in (0, 1, 31, 32, 33, 1024, 1025, 5000):
        values = [(i * 7) % 11 for i in range(n)]
        df = spark.createDataFrame([(values,)], "v array<long>")
        got = df.select(pii.running_sums(F.col("v")).alias("s")).first()["s"]
        assert got == [sum(values[:i]) for i in range(n)]


def test_blank_and_sanitise_across_blocks(spark):
    text = "é" * 4090 + "a@b.cc 1.2.3.4 x" + "z" * 5000 + " a@b.cc"
    spans = [("email", 4090, 4100), ("ip", 4099, 4110), ("term_removed", 4105, 8300), ("email", 9107, 9113)]
    df = spark.createDataFrame([(text, spans), ("", []), (text, [])],
                               "text string, spans array<struct<kind:string,start:long,end:long>>")
    rows = df.select(pii._blanked(F.col("text"), F.col("spans")).alias("b"),
                     pii.sanitise(F.col("text"), F.col("spans")).alias("s")).collect()
    chars = list(text)
    for _, a, b in spans:
        chars[a:b] = " " * (b - a)
    assert rows[0].b == "".join(chars) and rows[1].b == "" and rows[2].b == rows[2].s == text
    assert rows[0].s == text[:4090] + "[EMAIL]" + text[8300:9107] + "[EMAIL]" + text[9113:]


@pytest.mark.parametrize("text", ["word " * 20000, "a@b.cc 1.2.3.4 4111 1111 1111 1111 " * 5000])
def test_long_texts_in_linear_time(spark, text):
    df = spark.createDataFrame([(text,)], "text string").cache()
    both = df.select(F.size(pii.matches(F.col("text"), pii.TERM)).alias("n"), F.length(
        pii._blanked(F.col("text"), pii.entity_spans(F.col("text")))).alias("m"))
    both.collect()
    began = time.time()
    assert both.first()["m"] == len(text)
    assert time.time() - began < 5

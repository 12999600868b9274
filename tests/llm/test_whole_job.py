"""Cases that a cut in the work would lose, against what the whole job gives."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from shelfspark.llm import decontaminate as D
from shelfspark.llm import pii as P


def test_items_with_words_dropped_are_found(spark, make_docs):
    """A document that is an item less one or two words is a window of its own."""
    item = [f"w{i}" for i in range(30)]
    docs = make_docs([(1, " ".join(item[:-1])), (2, " ".join(item[2:])), (3, " ".join(item)),
                      (4, " ".join(item[:20])), (5, " ".join(item[:14] + item[15:])), (6, "w1 w2 w3 w4"), (7, None),
                      (8, "x " + " ".join(item[1:-1]))])
    bench = spark.createDataFrame([(9, " ".join(item)), (10, " ".join(f"v{i}" for i in range(200)))],
                                  "item_id long, text string")
    got = {r.id: (r.item_id, round(r.similarity, 6), r.start_word, r.n_words)
           for r in D.contaminated(docs, bench).collect()}
    # 26 shingles an item; dropping a word inside it (5) loses 5 shingles and makes 4 new ones: 21 of 30
    assert got == {1: (9, round(25 / 26, 6), 0, 29), 2: (9, round(24 / 26, 6), 0, 28), 3: (9, 1.0, 0, 30),
                   8: (9, round(24 / 27, 6), 0, 29)}
    assert {r.doc_id for r in D.drop_contaminated(docs, bench).collect()} == {4, 5, 6, 7}


def _own(docs, **kw):
    """Per id the terms marked, each ``(start, word, kind)``, by start."""
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    return {r.id: [(s.start, texts[r.id][s.start:s.end], s.kind) for s in sorted(r.spans, key=lambda s: s.start)
                   if s.kind.startswith("term_")] for r in P.find_personal_data(docs, **kw).collect()}


def test_revealing_terms_are_marked_wherever_they_stand(spark, make_docs):
    """Far from the address, and in a text without one, at any length of text."""
    far = "plain words here " * 30
    rows = [(i, f"Zworykin a.b@example.org {far}{i} Zworykin, zworykin-Zworykin") for i in range(6)]
    rows += [(20, f"{far} ask Zworykin"), (21, "Zworykins ask")] + [(30 + i, f"{far} {i}") for i in range(400)]
    got = _own(make_docs(rows))
    for i, text in rows:
        want = [m.start() for m in re.finditer(r"(?i)\bzworykin\b", text)]
        assert [s for s, w, k in got[i] if w.lower() == "zworykin" and k == "term_removed"] == want, i
    assert len(got[0]) >= 4 and got[20] and not got[21] and not got[30]


def test_terms_are_counted_over_whole_texts(spark, make_docs):
    """Far from the entity, short, in CJK characters or of digits; scores are
    those of the definition over all pairs of a text's terms and entities."""
    r = random.Random(7)
    far = "plain words here " * 20
    rows = [(i, f"Li 李明 4711 {far} {r.randint(0, 30)} near ann@example.org {r.randint(0, 30)}") for i in range(4)]
    rows += [(10 + i, f"{far} {r.randint(0, 30)} near bob@example.org Bo {r.randint(0, 30)}") for i in range(3)]
    rows += [(20 + i, f"{far} {r.randint(0, 30)} {r.randint(0, 30)}") for i in range(300)]
    rows += [(20, f"{far} 4 4"), (None, f"{far} near bob@example.org Bo"), (0, rows[0][1]), (400, f"{far} Bo")]
    got = {}
    for x in P.find_personal_data(make_docs(rows)).collect():
        for i, t in rows:
            if i == x.id:
                got.update({t[s.start:s.end].lower(): s.kind for s in x.spans if s.kind.startswith("term_")
                            and re.fullmatch(r"\w+", t[s.start:s.end])})
    n, n_t, n_e, n_te, texts = len(rows), Counter(), Counter(), Counter(), defaultdict(set)
    for _, t in rows:
        entities = set(re.findall(r"\w+@\w+\.\w+", t))
        terms = set(re.findall(r"\w+", re.sub(r"\w+@\w+\.\w+", " ", t).lower()))
        n_t.update(terms)
        n_e.update(entities)
        for pair in ((e, w) for e in entities for w in terms):
            n_te[pair] += 1
            texts[pair].add(t)
    want = {}
    for (e, w), k in n_te.items():
        score = math.log(n * k / (n_t[w] * n_e[e])) / math.log(n / n_e[e])
        if len(texts[e, w]) >= 2 and score >= 0.7:
            want[w] = max(want.get(w, ""), "term_removed" if score >= 0.95 else "term_generalised")
    assert got == want and {"li", "李明", "4711"} <= {w for w in want if want[w] == "term_removed"}
    assert {"bo", "near"} <= set(want) and "plain" not in want

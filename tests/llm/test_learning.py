"""The learning samples' bounds, odd labels, and the threshold over all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import common, quality, toxicity

LEARN = [i for i in range(1, 400) if __import__("zlib").crc32(str(i).encode()) % 5]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, y int")


def test_learning_labels_leave_out_conflicts_and_the_held_out_fold(spark):
    a, b, c = LEARN[:3]
    held = next(i for i in range(1, 400) if i not in LEARN)
    rows = labels_of(spark, [(a, 1), (a, 0), (b, 1), (b, 1), (c, None), (None, 1), (held, 1), (LEARN[3], 7)])
    assert [tuple(r) for r in common.learning_labels(rows, "y").collect()] == [(b, 1)]


def test_sample_is_bounded_in_bytes_and_takes_one_row_per_id(spark):
    docs = docs_of(spark, [(i, "w" * 100) for i in LEARN[:50]] + [(LEARN[0], f"other {n}") for n in range(200)]
                   + [(LEARN[50], "x" * 101), (LEARN[51], None)])
    labels = labels_of(spark, [(i, i % 2) for i in LEARN[:52]])
    got = quality.labelled_sample(docs, labels, "y", 1000, 6400).collect()
    assert len(got) == 51  # all but the text of more than 1/64 of the bound
    assert sum(r.text is not None and r.text == "" for r in got) == 1
    few = quality.labelled_sample(docs.where(F.length("text") == 100), labels, "y", 1000, 6400 + 63).collect()
    assert len(few) == 50
    docs = docs_of(spark, [(i, "w" * 10) for i in LEARN[:200]])
    labels = labels_of(spark, [(i, i % 2) for i in LEARN[:200]])
    bounded = quality.labelled_sample(docs, labels, "y", 1000, 645).collect()
    assert sorted({r.y for r in bounded}) == [0, 1] and len(bounded) == 128  # 64 texts of ten bytes a class
    assert len(quality.labelled_sample(docs, labels, "y", 7, 1 << 20).collect()) == 14


def toxic_rows(n):
    """Every sixth document holds words that no other one has."""
    r = np.random.default_rng(3)
    plain, bad = [f"word{i}" for i in range(300)], [f"vile{i}" for i in range(5)]
    out = []
    for i in range(1, n):
        words = list(r.choice(plain, 30))
        if i % 6 == 0:
            words[:3] = r.choice(bad, 3)
        out.append((i, " ".join(words), int(i % 6 == 0)))
    return out


@pytest.mark.parametrize("labelled", [0.2, 0.6, 1.0])
def test_any_label_coverage_finds_the_toxic_documents(spark, labelled):
    rows = toxic_rows(1500)
    docs = docs_of(spark, [(i, t) for i, t, _ in rows])
    keep = np.random.default_rng(1).random(len(rows)) < labelled
    labels = labels_of(spark, [(i, y) for (i, _, y), k in zip(rows, keep) if k])
    model = toxicity.fit_toxicity(docs, labels, "y")
    truth = {i: y for i, _, y in rows}
    scores = toxicity.score_toxicity(docs, model).collect()
    found = {r.id for r in scores if r.score >= 0.5}
    toxic = {i for i, y in truth.items() if y}
    assert len(found & toxic) >= 0.97 * len(toxic) and len(found - toxic) <= 0.03 * len(truth)


def test_margins_of_all_rows_are_counted(spark):
    rows = toxic_rows(900)
    docs = docs_of(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, "")]).repartition(7)
    model = toxicity.fit_toxicity(docs, labels_of(spark, [(i, y) for i, _, y in rows[::2]]), "y")
    steps, counts = toxicity.margin_counts(docs, model)
    margins = [np.log(r.score / (1 - r.score)) for r in toxicity.score_toxicity(docs, model).collect()]
    assert counts.sum() == len(rows) + 2 and (np.diff(steps) > 0).all()
    near = np.histogram(margins, bins=np.append(steps, steps[-1] + 1) / toxicity.GRID)[0]
    assert np.abs(np.cumsum(near) - np.cumsum(counts)).max() <= max(3, 0.01 * len(rows))


def test_threshold_matches_the_share_and_keeps_empty_texts_below():
    model = toxicity.PULearner(np.zeros(0, np.uint64), 0.1)
    model.bias = np.float32(-1.0)
    grid = toxicity.GRID
    model.calibrate(np.array([-grid, grid, 2 * grid, 3 * grid]), np.array([70, 10, 15, 5]), 0.2)
    # 20 of 100 lie above the cut between 1 and 2
    assert model.bias == pytest.approx(-1.0 - (grid + 1 + 2 * grid) / 2 / grid)
    model.bias = np.float32(-1.0)  # of 15 to 30 in 100, the widest gap leaves 20 above, also where 30 is asked for
    model.calibrate(np.array([-grid, grid, 5 * grid, 6 * grid]), np.array([70, 10, 5, 15]), 0.3, 0.15)
    assert model.bias == pytest.approx(-1.0 - (grid + 1 + 5 * grid) / 2 / grid)
    model.bias = np.float32(-1.0)
    model.calibrate(np.array([-2 * grid]), np.array([5]), 0.9)
    assert model.bias == np.float32(-1.0)  # nothing lies above an empty text
    model.calibrate(np.zeros(0, np.int64), np.zeros(0, np.int64), 0.1)
    assert model.bias == np.float32(-1.0)

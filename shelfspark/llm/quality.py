"""Quality classifier: attention-based multiple-instance learning in numpy.

A document is a bag of passages (consecutive ``PASSAGE`` bytes of its UTF-8
text, all of them). Each passage is encoded by how often pairs of neighbouring
character classes occur in it. Gated attention weighs the passages; the weighted
mean passage goes through a logistic layer. Attention and classifier are learnt
together from document labels alone. Ids, sources and languages are not inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import bounded_texts, filter_rows, held_out, learning_labels, register, ship_code, table

PASSAGE = 512
# Character classes; every other byte below 128 is "other".
MARKS = "!?|*$%&#@.,;:-_\"'()[]{}<>/\\=+~^`"
WORDS, UPPER, DIGIT, SPACE, BREAK, HIGH, OTHER = range(7)
N_CLASSES = 7 + len(MARKS)
KEPT_MARKS = 12  # marks with pairs of their own; the rest share one class in pairs
N_PAIR = 7 + KEPT_MARKS + 1
FEATURES = N_CLASSES + N_PAIR * N_PAIR


def _classes() -> tuple[np.ndarray, np.ndarray]:
    single = np.full(256, OTHER, np.int64)
    single[128:] = HIGH
    for a, b, c in (("a", "z", WORDS), ("A", "Z", UPPER), ("0", "9", DIGIT)):
        single[ord(a):ord(b) + 1] = c
    single[[0x20, 0x09]] = SPACE
    single[[0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
    for i, m in enumerate(MARKS):
        single[ord(m)] = 7 + i
    return single, np.minimum(single, N_PAIR - 1)


def encode(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(passages, first)``: a feature row per passage (at least one per text, a
    zero row for an empty one) and per text its first passage, n+1 entries."""
    size = np.diff(offsets)
    n = np.maximum(-(-size // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros((int(first[-1]), FEATURES), np.float32)
    if len(raw) == 0:
        return out, first
    single, pair = _classes()
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], size)
    passage = np.repeat(first[:-1], size) + place // PASSAGE
    total = np.bincount(passage, minlength=len(out)).astype(np.float32)
    ones = np.bincount(passage * N_CLASSES + single[raw], minlength=len(out) * N_CLASSES)
    out[:, :N_CLASSES] = ones.reshape(-1, N_CLASSES)
    same = np.flatnonzero(passage[1:] == passage[:-1])
    code = pair[raw[same]] * N_PAIR + pair[raw[same + 1]]
    twos = np.bincount(passage[same] * N_PAIR**2 + code, minlength=len(out) * N_PAIR**2)
    out[:, N_CLASSES:] = twos.reshape(-1, N_PAIR**2)
    return np.sqrt(out / np.maximum(total, 1)[:, None]), first


class AttentionMIL:
    """Gated attention over passages, logistic output."""

    def __init__(self, features: int, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"V": r.normal(0, 0.1, (hidden, features)), "U": r.normal(0, 0.1, (hidden, features)),
                  "w": r.normal(0, 0.1, hidden), "c": np.zeros(features), "b": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)

    def _forward(self, x, first):
        p = self.p
        t, g = np.tanh(x @ p["V"].T), 1 / (1 + np.exp(-(x @ p["U"].T)))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), np.diff(first)))
        a = e / np.repeat(np.add.reduceat(e, first[:-1]), np.diff(first))
        z = np.add.reduceat(a[:, None] * x, first[:-1], axis=0)
        return t, g, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))

    def score(self, x, first):
        return self._forward((x - self.mean) * self.scale, first)[-1]

    def fit(self, x, first, y, epochs=30, rate=0.003, decay=1e-4, batch=128, seed=11):
        self.mean = x.mean(axis=0)
        self.scale = 1 / (x.std(axis=0) + 0.02)
        x -= self.mean  # the sample is the caller's to use up
        x *= self.scale
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)).astype(np.float32)
        r = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            for bags in np.array_split(r.permutation(len(y)), max(1, len(y) // batch)):
                rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in bags])
                cut = np.concatenate([[0], np.cumsum(first[bags + 1] - first[bags])])
                grad = self._gradient(x[rows], cut, y[bags], weight[bags])
                step += 1
                for k, v in self.p.items():
                    g = grad[k] + decay * v
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    v -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x, first, y, weight):
        p, n = self.p, np.diff(first)
        t, g, a, z, s = self._forward(x, first)
        d = weight * (s - y) / len(y)
        da = np.repeat(d, n) * (x @ p["c"])
        de = a * (da - np.repeat(np.add.reduceat(a * da, first[:-1]), n))
        gate = de[:, None] * p["w"]
        return {"c": z.T @ d, "b": np.array([d.sum()]), "w": (t * g).T @ de,
                "V": (gate * g * (1 - t * t)).T @ x, "U": (gate * t * g * (1 - g)).T @ x}


def _encoded(batches):
    """(text, y) -> one row per document: y and its passages, flattened."""
    for batch in batches:
        y = batch.column("y")
        for i, j, raw, offsets in S.batches(batch.column("text")):
            x, first = encode(raw, offsets)
            rows = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([y.slice(i, j - i), pa.array(rows, pa.binary())],
                                             names=["y", "passages"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(text, y)``: at most ``most`` rows and ``most_bytes`` of text of each class of the
    learning folds, chosen by a hash of the id (see ``bounded_texts``)."""
    marked = learning_labels(labels, label, id_col)
    picked = None
    for y in (0, 1):
        one = marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = one if picked is None else picked.unionByName(one)
    return bounded_texts(docs, picked, most_bytes, id_col, text_col).select("text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 1_500,
                most_bytes: int = 32 << 20, **ids) -> AttentionMIL:
    """Fit on at most ``most`` labelled documents of each class, ``most_bytes`` of text
    together (all their passages; a passage is 1.7 KB in the driver, so at most 3.4 bytes for
    each byte of text, and 1.7 KB for a document without one). Without any label the model
    scores 0.5 everywhere, and ``keep_good`` keeps all."""
    ship_code(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, most, most_bytes, **ids)
    rows = sample.mapInArrow(_encoded, "y int, passages binary").toArrow().sort_by(
        [("y", "ascending"), ("passages", "ascending")])  # one order whatever the partitions
    model = AttentionMIL(FEATURES)
    if not rows.num_rows:
        return model
    y = rows["y"].to_numpy().astype(np.float32)
    bags = rows["passages"]
    first = np.concatenate([[0], np.cumsum([len(b.as_buffer()) // (4 * FEATURES) for b in bags])])
    x = np.empty((int(first[-1]), FEATURES), np.float32)
    for i, b in enumerate(bags):
        x[first[i]:first[i + 1]] = np.frombuffer(b.as_buffer(), np.float32).reshape(-1, FEATURES)
    del rows, bags
    return model.fit(x, first, y)


def _scores(model):
    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for i, j, raw, offsets in S.batches(batch.column("text"), 1 << 19):
                s = model.value.score(*encode(raw, offsets)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(s)], names=["id", "score"])
    return run


def score_quality(docs: DataFrame, model: AttentionMIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per input row, 0 to 1; NULL and empty texts are a bag of one
    empty passage. No shuffle."""
    spark = docs.sparkSession
    ship_code(spark)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_scores(spark.sparkContext.broadcast(model)), f"id {dict(docs.dtypes)[id_col]}, score double")


def keep_good(docs: DataFrame, model: AttentionMIL, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score ``least`` or more, all columns."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    def good(batch):
        scores = [shared.value.score(*encode(raw, offsets))
                  for _, _, raw, offsets in S.batches(batch.column(text_col), 1 << 19)]
        return pa.array(np.concatenate(scores).astype(np.float64) >= least if scores else np.zeros(0, bool))
    return filter_rows(docs, good)


@register("op2_quality_mil")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))

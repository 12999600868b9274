"""Toxicity: non-negative positive-unlabelled learning in numpy.

Confirmed toxic documents are the positives; all documents not confirmed are the
unlabelled set, a mixture with a known share of toxic ones (the class prior: what the
toxic share of the labelled learning rows leaves among documents not confirmed). A
linear model over words minimises

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

so the positives hidden among the unlabelled are taken out of the risk, and the
corrected negative part never goes below zero (where it does in a batch, the
step goes the other way). Ids, sources and languages are not inputs.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import bounded_texts, held_out, learning_labels, register, ship_code, table


GRID = 256  # margins are counted in steps of 1/256, from -30 to 30


def grid_steps(margins: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(margins, -30, 30).astype(np.float64) * GRID).astype(np.int64)


def _distinct_words(texts: pa.Array):
    for i, j, raw, offsets in S.batches(texts):
        w, first = S.words(raw, offsets, S.NOT_ALNUM)
        yield i, j, [np.unique(w[a:b]) for a, b in zip(first[:-1], first[1:])]


class PULearner:
    """Logistic model over the presence of chosen words."""

    def __init__(self, words: np.ndarray, prior: float):
        self.words, self.prior = words, prior
        self.weight, self.bias = np.zeros(len(words), np.float32), np.float32(0)

    def matrix(self, docs: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(docs), len(self.words)), np.float32)
        if len(self.words):
            for r, d in enumerate(docs):
                at = np.minimum(np.searchsorted(self.words, d), len(self.words) - 1)
                x[r, at[self.words[at] == d]] = 1
        return x

    def margin(self, docs: list[np.ndarray]) -> np.ndarray:
        return np.clip(self.matrix(docs) @ self.weight + self.bias, -30, 30)

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(docs)))

    def fit(self, positive, unlabelled, epochs=60, rate=0.02, decay=1e-3, batches=8, seed=5):
        """Non-negative risk, logistic loss, Adam over mini-batches."""
        xp, xu, r = self.matrix(positive), self.matrix(unlabelled), np.random.default_rng(seed)
        theta = np.zeros(len(self.words) + 1, np.float32)
        m1, m2, step = np.zeros_like(theta), np.zeros_like(theta), 0
        for _ in range(epochs):
            for ip, iu in zip(np.array_split(r.permutation(len(xp)), batches),
                              np.array_split(r.permutation(len(xu)), batches)):
                if not len(ip) or not len(iu):
                    continue
                zp, zu = xp[ip] @ theta[:-1] + theta[-1], xu[iu] @ theta[:-1] + theta[-1]
                sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
                negative = np.logaddexp(0, zu).mean() - self.prior * np.logaddexp(0, zp).mean()

                def slope(x, d):  # gradient of the mean loss with derivative d in the margin
                    return np.append(x.T @ d, d.sum()) / len(d)
                corrected = slope(xu[iu], su) - self.prior * slope(xp[ip], sp)
                if negative >= 0:
                    grad = self.prior * slope(xp[ip], sp - 1) + corrected
                else:
                    grad = -corrected
                grad = grad + decay * np.append(theta[:-1], 0)
                step += 1
                m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
                theta -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        self.weight, self.bias = theta[:-1].astype(np.float32), np.float32(theta[-1])
        return self

    def calibrate(self, steps: np.ndarray, counts: np.ndarray, share: float, error: float = 0.0):
        """Shift the margin so that the share of texts at 0.5 or more matches ``share``: of
        the cuts within ``error`` of it the one in the widest gap between margins, else (and
        among equal gaps) the nearest one. A text without any of the words stays below.
        ``counts`` texts have a margin in step ``steps`` (ascending) of the grid."""
        own = int(grid_steps(np.array([self.bias]))[0])
        levels = np.union1d(steps, [own])
        held = np.zeros(len(levels))
        held[np.searchsorted(levels, steps)] = counts
        above = (held.sum() - np.cumsum(held))[:-1] / max(held.sum(), 1)
        cuts = (levels[:-1] + 1 + levels[1:]) / 2 / GRID  # between the end of a step and the next one held
        may = levels[:-1] >= own
        if may.any():
            off = np.where(may, np.abs(above - share), np.inf)
            gap = np.where(off <= error, np.diff(levels), 0)
            self.bias = np.float32(self.bias - cuts[np.lexsort((off, -gap))[0]])
        return self


def without_near_copies(docs: list[np.ndarray], low: int = 16, same: int = 8) -> list[np.ndarray]:
    """Sample documents whose 16 lowest word hashes are not half shared with an
    earlier one: copies would pass for many witnesses of the same words."""
    owners: dict[int, list[int]] = {}
    kept: list[np.ndarray] = []
    for d in docs:
        marks = d[:low].tolist()
        met = Counter(i for h in marks for i in owners.get(h, ()))
        if met and max(met.values()) >= min(same, max(1, len(marks) // 2)):
            continue
        for h in marks:
            owners.setdefault(h, []).append(len(kept))
        kept.append(d)
    return kept


def choose_words(positive, unlabelled, least_g: float = 16.0, least: int = 3, most: int = 4096) -> np.ndarray:
    """Words more frequent in positives than in unlabelled texts, with a
    log-likelihood ratio of at least ``least_g`` (the ``most`` highest)."""
    n, m = max(len(positive), 1), max(len(unlabelled), 1)
    wp, cp = np.unique(np.concatenate(positive), return_counts=True)
    wu, cu = np.unique(np.concatenate(unlabelled), return_counts=True)
    a, b = cp.astype(float), np.zeros(len(wp))
    if len(wu):
        at = np.minimum(np.searchsorted(wu, wp), len(wu) - 1)
        b = np.where(wu[at] == wp, cu[at], 0).astype(float)
    e = (a + b) / (n + m)

    def term(x, expected):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9)), 0)
    g = 2 * (term(a, n * e) + term(b, m * e) + term(n - a, n * (1 - e)) + term(m - b, m * (1 - e)))
    keep = (g >= least_g) & (a >= least) & (a / n > b / m)
    return np.sort(wp[keep][np.argsort(-g[keep], kind="stable")[:most]])


def _sampled(batches):
    for batch in batches:
        for i, j, docs in _distinct_words(batch.column("text")):
            ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int32)
            flat = np.concatenate(docs) if docs else np.zeros(0, S.U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive").slice(i, j - i),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
                names=["positive", "words"])


def _margin_counts(model):
    def run(batches):
        held = Counter()
        for batch in batches:
            for _, _, docs in _distinct_words(batch.column("text")):
                steps, n = np.unique(grid_steps(model.value.margin(docs)), return_counts=True)
                held.update(dict(zip(steps.tolist(), n.tolist())))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())],
                                         names=["step", "n"])
    return run


def margin_counts(docs: DataFrame, model: PULearner, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """How many of all texts have a margin in each step of the grid (15,361 steps at most)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_margin_counts(shared), "step long, n long") \
        .groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").toArrow()
    return rows["step"].to_numpy(), rows["n"].to_numpy()


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_positive: int = 3_000,
                 most_unlabelled: int = 9_000, most_bytes: int = 32 << 20, id_col: str = "doc_id",
                 text_col: str = "text") -> PULearner:
    """Fit on at most ``most_positive`` confirmed documents and ``most_unlabelled`` of those not
    confirmed, ``most_bytes`` of text each, all of the learning folds and chosen by a hash of the
    id (see ``bounded_texts``). Documents labelled 0 are among the not confirmed ones; the class
    prior there is the toxic share that the labelled rows leave to them, at any label coverage.

    The threshold comes from the margins of all learning-fold documents: the share at 0.5 or
    more matches the toxic share of the labelled rows, within two standard errors of that share
    where the margins leave a gap there (see ``calibrate``). Both shares are held
    between 0.001 and 0.5. Without confirmed documents every score is a constant below 0.5.
    """
    ship_code(docs.sparkSession)
    learn = learning_labels(labels, label, id_col)
    known = F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    ids = docs.where(known).select(F.col(id_col).alias("id"))
    n = ids.join(learn, "id", "left").agg(
        F.count(F.lit(1)).alias("all"), F.count("y").alias("labelled"), F.sum("y").alias("toxic")).first()
    share = (n["toxic"] or 0) / max(n["labelled"], 1)
    left = (n["all"] - n["labelled"]) * share / max(n["all"] - (n["toxic"] or 0), 1)
    share, prior = (min(max(p, 1e-3), 0.5) for p in (share, left))
    by_hash = (F.xxhash64("id"), "id")
    confirmed = learn.where("y = 1").select("id")
    positive = confirmed.orderBy(*by_hash).limit(most_positive)
    unlabelled = ids.join(confirmed, "id", "left_anti").distinct().orderBy(*by_hash).limit(most_unlabelled)
    picked = positive.withColumn("y", F.lit(1)).unionByName(
        unlabelled.withColumn("y", F.lit(0)))  # bounded by the two limits
    rows = bounded_texts(docs, picked, most_bytes, id_col, text_col) \
        .select("text", (F.col("y") == 1).alias("positive")) \
        .mapInArrow(_sampled, "positive boolean, words array<long>").toArrow()
    lists = rows["words"].combine_chunks()
    flat = lists.flatten().to_numpy().view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    docs_words = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    is_positive = rows["positive"].to_pylist()
    keyed = sorted(zip(is_positive, docs_words), key=lambda x: (x[0], x[1].tobytes()))  # one order always
    pos, unl = [d for p, d in keyed if p], [d for p, d in keyed if not p]
    if not pos or not unl:
        model = PULearner(np.zeros(0, S.U64), prior)  # nothing to learn from: every score is the prior
        model.bias = np.float32(np.log(prior / (1 - prior)) - 1e-3)
        return model
    apart = without_near_copies(pos), without_near_copies(unl)
    model = PULearner(choose_words(*apart), prior).fit(*apart)
    error = 2 * np.sqrt(share * (1 - share) / max(n["labelled"], 1))
    return model.calibrate(*margin_counts(docs.where(known), model, text_col), share, error)


def _scores(model):
    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for i, j, docs in _distinct_words(batch.column("text")):
                s = model.value.score(docs).astype(np.float64)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(s)], names=["id", "score"])
    return run


def score_toxicity(docs: DataFrame, model: PULearner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per input row, 0 to 1; NULL and empty texts hold no words. No shuffle."""
    spark = docs.sparkSession
    ship_code(spark)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_scores(spark.sparkContext.broadcast(model)), f"id {dict(docs.dtypes)[id_col]}, score double")


@register("op4_toxicity_pu")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup.

Every benchmark item has a 128-bit SimHash of its word shingles; the k-th occurrence
of a shingle is a feature of its own, so that the fingerprints' distance follows the
weighted similarity. Over every document windows as long as an item (in
words) are fingerprinted the same way. Fingerprints are cut into 8 blocks of 16
bits; two that differ in at most 31 bits agree in some block up to 3 bits, so
looking up each block within 3 bits finds every pair within the radius. Pairs
found are verified by exact weighted similarity: the sum of the smaller counts
over the sum of the larger counts of each shingle.

A window that shares no shingle with any item has similarity 0, so only windows
around a shared shingle are fingerprinted; nothing that could be reported is
left out by that. A text shorter than an item (the item with words dropped) is
its one window for that item; an item shorter than a shingle is one shingle of all
its words. Two texts of similarity 0.8 differ in 19 of 128 bits on
average (standard deviation 4), so the radius of 31 misses about 2 in 1000 at
the threshold itself and fewer above it.
"""

from __future__ import annotations

import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import filter_rows, register, ship_code, table

BITS, BLOCKS, NEAR = 128, 8, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
NEIGHBOURS = np.array([0] + [sum(1 << b for b in c) for k in range(1, NEAR + 1)
                             for c in combinations(range(16), k)], np.uint16)


def features(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    """A hash for the k-th occurrence (from 1) of each shingle."""
    return np.where(k > 1, S.mix(h + k.astype(np.uint64) * S.U64(S.MIX_1)), h)


class Repeats:
    """Occurrences of the same shingle in a sequence."""

    def __init__(self, h: np.ndarray):
        self.n = len(h)
        group = np.unique(h, return_inverse=True)[1].astype(np.int64)
        self.base, self.place = group * (self.n + 1), np.arange(self.n)
        self.key = np.sort(self.base + self.place)
        self.at = np.searchsorted(self.key, self.base + self.place)
        same = np.diff(self.key // (self.n + 1)) == 0
        #: fewest places between two occurrences of one shingle
        self.closest = int(np.diff(self.key)[same].min()) if same.any() else self.n + 1

    def up_to(self, span: int) -> np.ndarray:
        """Of the ``span`` places that end at each place, how many hold its shingle."""
        return self.at - np.searchsorted(self.key, self.base + np.maximum(self.place - span + 1, 0)) + 1

    def onward(self, span: int) -> np.ndarray:
        """Of the ``span`` places that begin at each place, how many hold its shingle."""
        return np.searchsorted(self.key, self.base + np.minimum(self.place + span, self.n)) - self.at


def signs(h: np.ndarray) -> np.ndarray:
    """Per shingle hash its 128 bits as +1 / -1 (int8)."""
    both = np.stack([S.mix(h), S.mix(h ^ S.U64(S.BASE))], axis=1)
    return (np.unpackbits(both.view(np.uint8).reshape(len(h), 16), axis=1).astype(np.int8) * 2 - 1)


def pack_bits(sums: np.ndarray) -> np.ndarray:
    """Rows of 128 sums -> rows of 8 blocks of 16 bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


class Items:
    """Fingerprints and block index of a block of benchmark items, by size."""

    def __init__(self, items: list[tuple], width: int):
        self.width = width
        texts = pa.array([t for _, t in items], pa.large_string())
        w, first = S.words(*S.text_bytes(texts), S.NOT_ALNUM)
        h, win = S.shingles(w, first, width)
        n_words = np.diff(first)
        self.by_size: dict[int, dict] = {}
        known = []
        for i, (item_id, _) in enumerate(items):
            if n_words[i] < width:
                continue
            own = h[win[i]:win[i + 1]]
            known.append(own)
            at = self.by_size.setdefault(int(n_words[i]), {"ids": [], "prints": [], "shingles": []})
            at["ids"].append(item_id)
            unit = features(own, Repeats(own).up_to(len(own)))
            at["prints"].append(pack_bits(signs(unit).sum(axis=0, dtype=np.int32)[None, :])[0])
            at["shingles"].append(np.unique(own, return_counts=True))
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, S.U64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.known & S.U64((1 << 20) - 1)).astype(np.int64)] = True
        for at in self.by_size.values():
            at["prints"] = np.array(at["prints"], np.uint16)
            at["index"] = []
            for b in range(BLOCKS):
                near = at["prints"][:, b, None] ^ NEIGHBOURS[None, :]
                item = np.repeat(np.arange(len(near)), len(NEIGHBOURS))
                order = np.argsort(near.ravel(), kind="stable")
                at["index"].append((near.ravel()[order], item[order]))

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Which shingles are an item's."""
        out = np.zeros(len(h), bool)
        if len(self.known):
            maybe = np.flatnonzero(self.filter[(h & S.U64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
            out[maybe] = self.known[at] == h[maybe]
        return out

    def candidates(self, size: int, prints: np.ndarray) -> np.ndarray:
        """(window, item) pairs within the radius."""
        at, found = self.by_size[size], []
        for b in range(BLOCKS):
            value, item = at["index"][b]
            lo = np.searchsorted(value, prints[:, b], side="left")
            n = np.searchsorted(value, prints[:, b], side="right") - lo
            window = np.repeat(np.arange(len(prints)), n)
            place = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(window))
            found.append(np.stack([window, item[place]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        apart = np.bitwise_count(prints[pairs[:, 0]] ^ at["prints"][pairs[:, 1]]).sum(axis=1)
        return pairs[apart <= RADIUS]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (distinct shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / (int(a[1].sum()) + int(b[1].sum()) - low)


def _search_stretch(region, lo, hits, stretch, items, threshold, best, whole) -> None:
    """Enter the windows of ``region`` (which begins at ``lo``) into ``best``;
    ``whole``: it is all of its text, so the one window of items longer than it."""
    def sums_of(unit: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(signs(unit), axis=0, dtype=np.int32)])
    plain, repeats = sums_of(region), Repeats(region)
    here = np.zeros(len(region) + 1, np.int64)
    here[hits[(hits >= lo) & (hits < lo + len(region))] - lo + 1] = 1
    here = np.cumsum(here)
    for size, at in items.by_size.items():
        span = size - items.width + 1  # shingles in a window of that many words
        if span > len(region):
            # fewer shingles than the threshold's share of the item's cannot reach it
            if not whole or len(region) < (threshold - 1e-12) * span:
                continue
            span = len(region)
        start = np.flatnonzero(here[span:] - here[:-span] > 0)
        start = start[start < stretch]
        if not len(start):
            continue
        # a shingle that enters a window takes its next number, one that leaves its last
        entered = left = plain
        if repeats.closest < span:
            entered = sums_of(features(region, repeats.up_to(span)))
            left = sums_of(features(region, repeats.onward(span)))
        prints = pack_bits(entered[start + span] - left[start])
        for w, i in items.candidates(size, prints):
            s = int(start[w])
            sim = similarity(np.unique(region[s:s + span], return_counts=True), at["shingles"][i])
            if sim >= threshold - 1e-12:
                name, new = at["ids"][i], (sim, -(lo + s))
                if name not in best or new > best[name][0]:
                    best[name] = (new, span + items.width - 1)


def search_text(h: np.ndarray, hits: np.ndarray, items: Items, threshold: float,
                stretch: int = 20_000) -> list[tuple]:
    """Best window per item in one text: ``(item_id, similarity, start, size)``.

    ``h``: the text's shingles in order; ``hits``: places of item shingles. Texts
    are worked through ``stretch`` window starts at a time, to bound memory."""
    best: dict = {}
    if not len(hits):
        return []
    longest = max(items.by_size)
    cuts = np.flatnonzero(np.diff(hits) > 2 * longest)
    for part in np.split(hits, cuts + 1):  # stretches no window reaches across
        lo, hi = max(0, int(part[0]) - longest), min(len(h), int(part[-1]) + longest)
        for at in range(lo, hi, stretch):  # windows that start in [at, at + stretch)
            region = h[at:min(at + stretch + longest, hi)]
            _search_stretch(region, at, part, stretch, items, threshold, best, len(region) == len(h))
    return [(name, sim, -start, size) for name, ((sim, start), size) in best.items()]


def item_groups(items: list[tuple], width: int) -> list[Items]:
    """Items of at least ``width`` words, and shorter ones by their number of words."""
    n_words = np.diff(S.words(*S.text_bytes(pa.array([t for _, t in items], pa.large_string())), S.NOT_ALNUM)[1])
    return [Items([x for x, n in zip(items, n_words) if n == m or m == width < n], m)
            for m in range(1, width + 1) if (n_words >= width if m == width else n_words == m).any()]


def search_batch(texts: pa.Array, groups: list[Items], threshold: float):
    """``(row, item_id, similarity, start, size)`` for the texts of an array."""
    for begin, _, raw, offsets in S.batches(texts):
        w, first = S.words(raw, offsets, S.NOT_ALNUM)
        for items in groups:
            h, win = S.shingles(w, first, items.width)
            hits = np.flatnonzero(items.holds(h))
            owner = np.searchsorted(win, hits, side="right") - 1
            for d in np.unique(owner):
                for got in search_text(h[win[d]:win[d + 1]], hits[owner == d] - win[d], items, threshold):
                    yield begin + int(d), *got


_loaded: dict[str, list[Items]] = {}


def _indexed(shared) -> list[Items]:
    """The index of a block of items, built once in each Python worker."""
    name, items, width = shared.value
    if name not in _loaded:
        if len(_loaded) > 1:
            _loaded.clear()
        _loaded[name] = item_groups(items, width)
    return _loaded[name]


def _search(shared, threshold):
    def run(batches):
        groups = _indexed(shared)
        for batch in batches if groups else ():
            found = list(search_batch(batch.column("text"), groups, threshold))
            if found:
                row, item, sim, start, size = (list(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()),
                     pa.array(sim, pa.float64()), pa.array(start, pa.int64()), pa.array(size, pa.int64())],
                    names=["id", "item_id", "similarity", "start_word", "n_words"])
    return run


def _item_blocks(benchmark: DataFrame, width: int, block_items: int, block_bytes: int = 1 << 23):
    """Broadcasts of the benchmark in blocks of about ``block_items`` items and
    ``block_bytes`` of text, whichever is less."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, [tuple(r) for r in mine.distinct().collect()], width))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 5, threshold: float = 0.8, block_items: int = 5_000) -> DataFrame:
    """``(id, item_id, similarity, start_word, n_words)``: per document and
    benchmark item found in it, the most similar window (first of equals). A
    document of fewer words than the item is one window, of all its words.

    Words are runs of letters and digits, ASCII lower-cased. An item of fewer than
    ``width`` words is found where all its words stand together; items without a
    word are not searched. The benchmark is read in blocks of about
    ``block_items``, each against all documents; the documents are never
    shuffled. Repeated rows give repeated results; NULL and empty texts none.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(docs.dtypes)[id_col]}, item_id long, similarity double, start_word long, n_words long"
    out = None
    for shared in _item_blocks(benchmark, width, block_items):
        found = texts.mapInArrow(_search(shared, threshold), schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = 5,
                      threshold: float = 0.8, block_items: int = 5_000) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found, all columns."""
    ship_code(docs.sparkSession)

    def clean(shared):
        def keep(batch):
            mask = np.ones(batch.num_rows, bool)
            mask[[x[0] for x in search_batch(batch.column(text_col), _indexed(shared), threshold)]] = False
            return pa.array(mask)
        return keep
    for shared in _item_blocks(benchmark, width, block_items):
        docs = filter_rows(docs, clean(shared))
    return docs


@register("op9_benchmark_decontamination")
def op9(spark, sf_dir):
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("similarity", 6).alias("similarity"),
                        "start_word", "n_words")

"""Cross-tokenizer alignment by interval coalescing over token byte ranges.

Two tokenizers cut the same bytes (a space and the text) into tokens. All tokens of
both are sorted by start (lexsort) and the running maximum of their ends is taken; a
group ends where a start reaches that maximum, which is where tokens of both end.
Overlapping ranges inside a group are the links.

Neither tokenizer looks across a space that follows a visible character: the first
splits its text there, and no piece of the second holds a space after another
character. So a text is cut there into chunks, and a chunk's tokens, groups and links
are found once for all its occurrences in a Python worker (the new chunks of a batch
together, in one sort); a text's are its chunks' put together. Chunks stay in a
bounded store, very long ones only for their batch.

How often an id pair is linked over the corpus comes from the stored links of the
texts: distinct pairs per task, summed by Spark. The most frequent pairs, at most
``most_held`` of them, are broadcast to look links up where they are stored; rarer
ones are joined by Spark.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, ship_code, stored, table
from .tokens import NOT_PLAIN, byte_alphabet, text_slices, vocabulary_path

# A cut lies before a run of spaces between a visible character and another
# character that is no space. Characters that some tables count as white space and
# others do not are no place for a cut.
CUT = re.compile("(?<=[^\\s\\u180e\\u200b\\ufeff])(?= +[^ ])")
UNEASY = re.compile("[\\s\\u180e\\u200b\\ufeff] ")
BAD = 1 << 120  # beside three counts of 40 bits each
MARKS = ("", ";", "|", ",")  # before a chunk's first token, a group, its B tokens, another token of a side


def split_text(text: str) -> list[str]:
    """Chunks of a space and the text, each without its own first space."""
    if text.endswith(" ") or UNEASY.search(" " + text):
        return [c[1:] for c in CUT.split(" " + text)]
    return text.split(" ")


def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, group)``: tokens by start, and the group of each in that order."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


class Aligner:
    """Texts to their alignment. ``known``: chunk -> its numbers of A tokens, B tokens
    and groups in one number, the text of its groups, its pair codes as bytes."""

    def __init__(self, path_a: str, path_b: str, most_cached: int = 200_000, longest: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        if hasattr(self.a.model, "_resize_cache"):
            self.a.model._resize_cache(0)  # chunks are kept below, once
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            whole = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if whole else token.encode()
        self.quick = self._ranked(path_a)
        self.n_b = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.n_b) for p in [self.b.id_to_piece(i)]]
        self.space_b = self.b.piece_to_id("▁")
        self.kind = "<u4" if len(self.a_bytes) * self.n_b <= 1 << 32 else "<u8"
        # an id's text after each of MARKS
        self.most_ids = max(len(self.a_bytes), self.n_b)
        self.shown = [m + str(i) for m in MARKS for i in range(self.most_ids)]
        self.shown_len = np.array([len(x) for x in self.shown], np.int64)
        self.most, self.longest = most_cached, longest
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def _ranked(self, path_a: str):
        """The first tokenizer over its own vocabulary as ranks, several times as fast,
        where its file says that this is the same: byte-level words by the known
        pattern, and merges numbered in the order in which they are tried."""
        with open(path_a) as f:
            spec = json.load(f)
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in model.get("merges", [])]
        added = {t["id"] for t in spec.get("added_tokens", [])}
        ids = [model["vocab"].get(m) for m in merges]
        if (spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
                or not cut.get("use_regex", True) or model.get("type") != "BPE"
                or ids != list(range(256, 256 + len(ids))) or len(set(model["vocab"].values()) - added) != 256 + len(ids)):
            return None
        import public_tokenizers
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            b: i for i, b in enumerate(self.a_bytes) if i not in added}).encode_ordinary

    def _encode_a(self, chunks: list[str]) -> list[list[int]]:
        """Characters whose class depends on Unicode tables, and very long chunks, go to
        the tokenizers library."""
        whole = [" " + c for c in chunks]
        quick = self.quick
        out = [quick(c) if quick and len(c) <= 256 and not NOT_PLAIN.search(c) else None for c in whole]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.a.encode_batch([whole[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _tokens(self, ids: list[list[int]], spelled: list[bytes], chunk_bytes: np.ndarray, chunk_len: np.ndarray):
        """Ids, their byte lengths and each chunk's number of them, and which chunks
        they spell exactly. ``chunk_bytes``: all chunks put together."""
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = list(chain.from_iterable(ids))
        parts = [spelled[i] for i in flat]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        own = np.repeat(np.arange(len(ids)), n)
        good = np.bincount(own, weights=size, minlength=len(ids)).astype(np.int64) == chunk_len
        if not good.all():
            parts = [p for p, ok in zip(parts, good[own].tolist()) if ok]
            chunk_bytes = chunk_bytes[np.repeat(good, chunk_len)]
        differs = np.flatnonzero(np.frombuffer(b"".join(parts), np.uint8) != chunk_bytes)
        if len(differs):
            kept = np.flatnonzero(good)
            good[kept[np.searchsorted(np.cumsum(chunk_len[kept]), differs, side="right")]] = False
        return np.array(flat, np.int64), size, own, good

    def learn(self, chunks: list[str]) -> None:
        """Align new chunks, all in one sort."""
        a = self._encode_a(chunks)
        # a space alone is an empty text to the second tokenizer
        b = [x or [self.space_b] for x in self.b.encode(chunks, num_threads=1)]
        raw = [(" " + c).encode() for c in chunks]
        chunk_len = np.fromiter(map(len, raw), np.int64, len(raw))
        chunk_bytes = np.frombuffer(b"".join(raw), np.uint8)
        sides = [self._tokens(a, self.a_bytes, chunk_bytes, chunk_len),
                 self._tokens(b, self.b_bytes, chunk_bytes, chunk_len)]
        good = sides[0][3] & sides[1][3]
        ids, end, start, own = [], [], [], []
        for flat, size, chunk, _ in sides:
            keep = good[chunk]
            ids.append(flat[keep])
            own.append(chunk[keep])
            end.append(np.cumsum(size[keep]))
            start.append(end[-1] - size[keep])
        # overlaps: for each A token the run of B tokens that end after its start and begin before its end
        low = np.searchsorted(end[1], start[0], side="right")
        n = np.searchsorted(start[1], end[0], side="left") - low
        left = np.repeat(np.arange(len(n)), n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n - low, n)
        codes = (ids[0][left] * self.n_b + ids[1][right]).astype(self.kind)
        links = np.bincount(own[0], weights=n, minlength=len(chunks)).astype(np.int64) * codes.itemsize

        side = np.repeat([0, 1], [len(ids[0]), len(ids[1])])
        order, group = coalesce(np.concatenate(start), np.concatenate(end), side)
        order = order[np.argsort(group * 2 + side[order], kind="stable")]  # A before B in each group
        token, side, chunk = np.concatenate(ids)[order], side[order], np.concatenate(own)[order]
        new_group = np.diff(group, prepend=-1) > 0
        mark = np.where(np.diff(chunk, prepend=-1) > 0, 0, np.where(new_group, 1, np.where(
            np.diff(side, prepend=0) > 0, 2, 3)))
        shown = mark * self.most_ids + token
        text = "".join(map(self.shown.__getitem__, shown.tolist()))
        text_len = np.bincount(chunk, weights=self.shown_len[shown], minlength=len(chunks)).astype(np.int64)
        counts = [np.bincount(x, minlength=len(chunks)).tolist() for x in (*own, chunk[new_group])]
        data = codes.tobytes()
        places = [np.concatenate([[0], np.cumsum(x)]).tolist() for x in (text_len, links)]
        for i, (c, ok, na, nb, ng) in enumerate(zip(chunks, good.tolist(), *counts)):
            self.known[c] = (na | nb << 40 | ng << 80, text[places[0][i]:places[0][i + 1]],
                             data[places[1][i]:places[1][i + 1]]) if ok else (BAD, "", b"")

    def __call__(self, texts: list[str | None], at_once: int = 20_000):
        """Per text ``(n_a, n_b, n_groups, groups, links)``."""
        cut = [split_text(t) if t else None for t in texts]
        new = list(set().union(*(c for c in cut if c)).difference(self.known))
        for i in range(0, len(new), at_once):
            self.learn(new[i:i + at_once])
        out, mask = [], (1 << 40) - 1
        for chunks in cut:
            counts, groups, links = zip(*map(self.known.__getitem__, chunks)) if chunks else ((BAD,), (), ())
            total = sum(counts)
            out.append((0, 0, 0, "", b"") if total >= BAD else (
                total & mask, total >> 40 & mask, total >> 80 & mask, ";".join(groups), b"".join(links)))
        if len(self.known) > self.most:
            self.known.clear()
        for c in new:
            if len(c) > self.longest:
                self.known.pop(c, None)
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups {groups}, links binary"


def _align_pass(path_a: str, path_b: str, keep_groups: bool):
    def run(batches):
        align = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, end in text_slices(batch, 1 << 20):
                part = batch.slice(begin, end - begin)
                done = align(part.column("text").to_pylist())
                n_a, n_b, n_groups, groups, links = zip(*done)
                text = groups if keep_groups else [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                width = np.dtype(align.kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(done))), part.column("id"),
                     *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, [len(x) // width for x in links])),
                     pa.array(text, pa.string()), pa.array(links, pa.binary())],
                    names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
                row += len(done)
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
          path_b: str | None = None, keep_groups: bool = False) -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, n_links, groups, links)``, one row per input row.

    ``groups``: ``a1,a2|b1;a3|b2,b3``, or with ``keep_groups=False`` its lower-case
    sha256 (either way '' without tokens); ``links``: the pair codes
    (A id * B vocabulary size + B id) in order of A, unsigned little-endian 32-bit
    (64-bit for vocabularies of more pairs); ``row``: a number of its own for each
    row. Texts that are NULL or empty, or whose joined tokens differ from a space and
    the text, have no tokens. NULL and repeated ids are kept. A caller that reads the
    result more than once stores it.
    """
    ship_code(docs.sparkSession)
    path_a = path_a or vocabulary_path("byte_bpe_50k.json")
    path_b = path_b or vocabulary_path("piece_bpe_32k.model")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _align_pass(path_a, path_b, keep_groups),
        f"row long, id {dict(docs.dtypes)[id_col]}, {ALIGNED.format(groups='string')}")


def _codes(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a column of bytes, and where each row's begin and end."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind), (at - at[0]) // np.dtype(kind).itemsize


def _count_pass(kind: str, most: int = 1 << 20):
    def emit(code, n):
        return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n)], names=["code", "n"])

    def run(batches):
        code, n = np.zeros(0, kind), np.zeros(0, np.int64)
        for batch in batches:
            new, m = np.unique(_codes(batch.column("links"), kind)[0], return_counts=True)
            code, place = np.unique(np.concatenate([code, new]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([n, m]), minlength=len(code)).astype(np.int64)
            if len(code) > most:
                yield emit(code, n)
                code, n = code[:0], n[:0]
        yield emit(code, n)
    return run


def count_pairs(aligned: DataFrame, n_b: int, kind: str) -> DataFrame:
    """``(code, n, best)``: links of each id pair over the corpus, and whether no pair
    of the same B id has more. A stored table."""
    pairs = stored(aligned.select("links").mapInArrow(_count_pass(kind), "code long, n long")
                   .groupBy("code").agg(F.sum("n").alias("n")), "align-pairs")
    b = F.pmod("code", F.lit(n_b))
    # one row per id of the second vocabulary: its size bounds the broadcast
    top = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("top"))
    return stored(pairs.join(F.broadcast(top), b == F.col("b")).select(
        "code", "n", (F.col("n") == F.col("top")).alias("best")), "align-counts")


def _held(pairs: DataFrame, most_held: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent pairs, at most ``most_held``, and the others if there are any."""
    total = 0
    for r in pairs.groupBy(F.floor(F.log2("n")).alias("size")).count().orderBy(F.desc("size")).collect():
        if total + r["count"] > most_held:
            least = 2 ** (r["size"] + 1)
            return pairs.where(F.col("n") >= least), pairs.where(F.col("n") < least)
        total += r["count"]
    return pairs, None


def _sum_pass(shared, kind: str):
    def run(batches):
        code, n, best = shared.value
        for batch in batches:
            links, ends = _codes(batch.column("links"), kind)
            at = np.minimum(np.searchsorted(code, links), max(len(code) - 1, 0))
            known = code[at] == links if len(code) else np.zeros(len(links), bool)
            sums = []
            for value in (best, n):
                each = np.where(known, value[at], 0) if len(code) else np.zeros(len(links), np.int64)
                run_sum = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
                sums.append(pa.array(run_sum[ends[1:]] - run_sum[ends[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [*(c for c, name in zip(batch.columns, batch.schema.names) if name != "links"), *sums],
                names=[*(x for x in batch.schema.names if x != "links"), "n_best", "count_sum"])
    return run


def _rare_pass(shared, kind: str):
    """``(row, code, m)``: links of each row whose pair is not held."""
    def run(batches):
        code = shared.value[0]
        for batch in batches:
            links, ends = _codes(batch.column("links"), kind)
            at = np.minimum(np.searchsorted(code, links), max(len(code) - 1, 0))
            rest = np.flatnonzero(code[at] != links) if len(code) else np.arange(len(links))
            row = np.asarray(batch.column("row"))[np.searchsorted(ends, rest, side="right") - 1]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(links[rest].astype(np.int64))],
                                             names=["row", "code"])
    return run


def link_scores(aligned: DataFrame, n_b: int, kind: str, most_held: int = 1_000_000) -> DataFrame:
    """``aligned`` (a stored table) without its links, with ``n_best``, the links whose
    count is the highest of their B id (ties included), and ``count_sum`` over links."""
    pairs = count_pairs(aligned, n_b, kind)
    held, rare = _held(pairs, most_held)
    known = held.orderBy("code").toArrow()
    shared = aligned.sparkSession.sparkContext.broadcast(tuple(
        known.column(c).to_numpy().astype(t) for c, t in (("code", kind), ("n", np.int64), ("best", np.int64))))
    kept = [f for f in aligned.schema.fields if f.name != "links"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "n_best long", "count_sum long"])
    out = aligned.mapInArrow(_sum_pass(shared, kind), schema)
    if rare is None:
        return out
    more = aligned.select("row", "links").mapInArrow(_rare_pass(shared, kind), "row long, code long") \
        .groupBy("row", "code").agg(F.count("*").alias("m")).join(rare, "code") \
        .groupBy("row").agg(F.sum(F.col("m") * F.col("best").cast("long")).alias("more_best"),
                            F.sum(F.col("m") * F.col("n")).alias("more_sum"))
    return out.join(more, "row", "left").select(
        *[f.name for f in kept], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def align_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                 path_b: str | None = None, keep_groups: bool = False, most_held: int = 1_000_000) -> DataFrame:
    """``align`` with ``n_best`` and ``count_sum`` of each row, without the links. An
    empty table gives no rows."""
    path_a = path_a or vocabulary_path("byte_bpe_50k.json")
    path_b = path_b or vocabulary_path("piece_bpe_32k.model")
    aligned = stored(align(docs, id_col, text_col, path_a, path_b, keep_groups), "align")
    own = aligner(path_a, path_b)
    return link_scores(aligned, own.n_b, own.kind, most_held)


@register("op11_token_alignment")
def op11(spark, sf_dir):
    found = align_corpus(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("groups").alias("groups_sha256"))

"""Word and shingle hashing over Arrow text batches, vectorised with numpy.

A batch of texts is looked at as one UTF-8 byte buffer. Words are runs of
bytes that are no separator; each word gets a 64-bit polynomial hash of its
(ASCII lower-cased) bytes, each window of ``width`` consecutive words of one
text a 64-bit hash of its word hashes. Nothing loops over words in Python.

Hashes stand for words and shingles from here on: two different shingles are
taken for one with probability about 2^-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multipliers of the hash.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes(b for b in range(0x80) if not chr(b).isalnum())

INVERSE = pow(BASE, -1, 1 << 64)

_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept and grown by doubling."""
    table = _tables.get(base, np.ones(1, dtype=U64))
    while len(table) < n:
        table = np.concatenate([table, table * U64(pow(base, len(table), 1 << 64))])
    _tables[base] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64-bit word (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(MIX_1)
    x = x ^ (x >> U64(27))
    x = x * U64(MIX_2)
    return x ^ (x >> U64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n+1 byte offsets (NULL: empty)."""
    arr = texts.cast(pa.large_string()).fill_null("")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _byte_values(separators: bytes) -> np.ndarray:
    """Per byte its hash value: 0 for separators, else 1 + the lower-cased byte."""
    values = np.arange(256, dtype=U64) + U64(1)
    values[ord("A"):ord("Z") + 1] += U64(32)
    values[list(separators)] = 0
    return values


def words(raw: np.ndarray, offsets: np.ndarray, separators: bytes = WHITESPACE
          ) -> tuple[np.ndarray, np.ndarray]:
    """``(word_hash, first)``: hashes of all words, and per text its first word's
    index (n+1 entries). A word never spans two texts."""
    if len(raw) == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    values = _byte_values(separators)[raw]
    inside = values != 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(raw)]
    start[bounds] = inside[bounds]
    starts = np.flatnonzero(start)
    first = np.searchsorted(starts, offsets).astype(np.int64)
    if len(starts) == 0:
        return np.zeros(0, U64), first
    # polynomial over the buffer, divided by the power at the word's start
    values *= _powers(BASE, len(raw))[:len(raw)]
    return mix(np.add.reduceat(values, starts) * _powers(INVERSE, len(raw))[starts]), first


def shingles(word_hash: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside each text, in text order,
    with per text its first window's index. A text of fewer words (but at
    least one) is one window of all its words."""
    n_words = np.diff(first)
    n_win = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    win_first = np.concatenate([[0], np.cumsum(n_win)]).astype(np.int64)
    total = int(win_first[-1])
    if total == 0:
        return np.zeros(0, U64), win_first
    begin = np.repeat(first[:-1] - win_first[:-1], n_win) + np.arange(total)
    padded = np.concatenate([word_hash, np.zeros(width, U64)])
    short = np.repeat(np.where(n_words < width, n_words, width), n_win)
    out = np.zeros(total, U64)
    for k in range(width):
        out = mix(out * U64(BASE) + np.where(k < short, padded[begin + k], U64(0)) + U64(k + 1))
    return out, win_first


def batches(texts: pa.Array, most_bytes: int = 1 << 20, most_rows: int = 1024):
    """``(begin, end, raw, offsets)`` slices of a string array: at most
    ``most_bytes`` of text each, or one text where that is longer."""
    for row in range(0, len(texts), most_rows):
        raw, offsets = text_bytes(texts.slice(row, most_rows))
        begin, n = 0, len(offsets) - 1
        while begin < n:
            end = int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1
            end = min(max(end, begin + 1), n)
            yield row + begin, row + end, raw[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin]
            begin = end

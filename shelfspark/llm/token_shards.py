"""Token ids in binary shards with a minimal perfect hash index.

A shard file holds documents in ascending id order, little-endian:

  magic ``SHTOKID1`` | header length u32 | header (JSON: counts, section offsets)
  starts  u64[rows + 1]   place of each document in the payload, in ids
  keys    i64[rows]       document ids; nulls u8[rows] marks rows without id
  index   per level a bit array (u64 words), ranks u32 per word, and per slot a
          fingerprint u32, first row u32 and number of rows u32
  payload u16 or u32 ids  (u16 where the vocabulary allows)

The index is a minimal perfect hash of the shard's distinct ids: at each level
the ids that hash to a place of their own set that bit and are done, the rest go
on to the next level; the rank of the bit is the slot. An access hashes the id,
tests one bit per level (about 1.6 on average) and compares the fingerprint, so
an id that is not there is refused but for a chance of 2^-32; the stored key
then settles it.

Shards are written by the tasks that tokenise, each under a new name; only the
names in the stored manifest count, so repeated or lost tasks do no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import register, scratch, ship_code, stored, table
from .shingles import BASE, U64, mix
from .tokens import encoder, text_slices, vocabulary_path

MAGIC = b"SHTOKID1"
MANIFEST = "part long, seq long, file string, low long, high long, rows long, ids long"


# --- minimal perfect hash ----------------------------------------------------------

def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.view(U64) * U64(BASE) + U64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64))


def build_index(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (u64 words), one per level, for distinct int64 keys."""
    levels, left = [], keys
    while len(left):
        words = max(1, -(-2 * len(left) // 64))
        place = (_hash(left, len(levels)) % U64(words * 64)).astype(np.int64)
        alone = np.bincount(place, minlength=words * 64) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[place]]
    return levels


def slots(keys: np.ndarray, levels: list[np.ndarray], ranks: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level has it."""
    out = np.full(len(keys), -1, np.int64)
    todo, before = np.arange(len(keys)), 0
    for n, words in enumerate(levels):
        place = _hash(keys[todo], n) % U64(len(words) * 64)
        word, bit = (place >> U64(6)).astype(np.int64), place & U64(63)
        hit = (words[word] >> bit) & U64(1) == 1
        below = np.bitwise_count(words[word] & ((U64(1) << bit) - U64(1)))
        out[todo[hit]] = (ranks[before + word] + below)[hit]
        todo, before = todo[~hit], before + len(words)
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1 << 20) >> U64(32)).astype("<u4")


# --- shard files --------------------------------------------------------------------

def shard_bytes(keys: list, payloads: list[bytes], wide: bool) -> bytes:
    """One shard of documents in the order given (equal keys adjacent)."""
    n = len(keys)
    null = np.array([k is None for k in keys], np.uint8)
    key = np.array([0 if k is None else k for k in keys], "<i8")
    starts = np.concatenate([[0], np.cumsum([len(p) // 4 for p in payloads])]).astype("<u8")
    own, first, times = np.unique(key[null == 0], return_index=True, return_counts=True)
    levels = build_index(own)
    counts = np.concatenate([np.bitwise_count(w) for w in levels]) if levels else np.zeros(0, np.int64)
    ranks = (np.cumsum(counts) - counts).astype("<u4")
    slot = slots(own, levels, ranks)
    entry = np.zeros((3, len(own)), "<u4")
    entry[0][slot], entry[1][slot], entry[2][slot] = fingerprints(own), first + int(null.sum()), times
    payload = b"".join(payloads)
    if not wide:
        payload = np.frombuffer(payload, "<u4").astype("<u2").tobytes()
    parts = {"starts": starts.tobytes(), "keys": key.tobytes(), "nulls": null.tobytes(),
             "bits": b"".join(w.tobytes() for w in levels), "ranks": ranks.tobytes(),
             "entries": entry.tobytes(), "payload": payload}
    at, sections = 0, {}
    for name, data in parts.items():
        sections[name] = [at, len(data)]
        at += len(data)
    head = json.dumps({"rows": n, "keys": len(own), "levels": [len(w) for w in levels],
                       "id_bytes": 4 if wide else 2, "sections": sections}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + b"".join(parts.values())


class Shard:
    """An opened shard: sections are read when asked for."""

    def __init__(self, file):
        self.file = file
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(file.read(4), "little")
        self.head = json.loads(file.read(size))
        self.body = 12 + size
        n = self.head["keys"]
        bits, at, self.levels = self._array("bits", "<u8"), 0, []
        for k in self.head["levels"]:
            self.levels.append(bits[at:at + k])
            at += k
        self.ranks = self._array("ranks", "<u4").astype(np.int64)
        self.entries = self._array("entries", "<u4").reshape(3, n)
        self.starts = self._array("starts", "<u8").astype(np.int64)
        self.keys = self._array("keys", "<i8")
        self.nulls = self._array("nulls", "u1").astype(bool)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(self.body + at)
        return self.file.read(size)

    def _array(self, name, kind):
        at, size = self.head["sections"][name]
        return np.frombuffer(self._read(at, size), kind)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row (-1: not here) and number of rows of each key, by the index."""
        keys = np.asarray(keys, np.int64)
        row, times = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        if self.head["keys"]:
            slot = slots(keys, self.levels, self.ranks)
            there = (slot >= 0) & (self.entries[0][slot] == fingerprints(keys))
            there &= self.keys[np.where(there, self.entries[1][slot], 0)] == keys
            row[there] = self.entries[1][slot[there]]
            times[there] = self.entries[2][slot[there]]
        return row, times

    def ids(self, row: int) -> np.ndarray:
        """The ids of one document, read from the payload alone."""
        width = self.head["id_bytes"]
        at = self.head["sections"]["payload"][0]
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        return np.frombuffer(self._read(at + a * width, (b - a) * width), f"<u{width}").astype("<u4")


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


def open_shard(path: str) -> Shard:
    system, at = _filesystem(path)
    return Shard(system.open_input_file(at))


# --- the operator ---------------------------------------------------------------------

def _write(folder, path, end_id, shard_ids):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(path)
        wide = encode.vocabulary > 65536
        part = TaskContext.get().partitionId()
        system, at = _filesystem(folder)
        system.create_dir(at, recursive=True)
        keys, payloads, held, seq = [], [], 0, 0

        def flush():
            name = f"ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.bin"
            with system.open_output_stream(f"{at}/{name}") as out:
                out.write(shard_bytes(keys, payloads, wide))
            known = [k for k in keys if k is not None] or [None]
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "file": f"{folder}/{name}", "low": known[0], "high": known[-1],
                "rows": len(keys), "ids": held}], schema=pa.schema([
                    ("part", pa.int64()), ("seq", pa.int64()), ("file", pa.string()), ("low", pa.int64()),
                    ("high", pa.int64()), ("rows", pa.int64()), ("ids", pa.int64())]))

        for batch in batches:
            for a, b in text_slices(batch):
                names = batch.column("id").slice(a, b - a).to_pylist()
                for key, data in zip(names, encode(batch.column("text").slice(a, b - a).to_pylist())):
                    keys.append(key)
                    payloads.append(data + end)
                    held += len(data) // 4 + 1
                    if held >= shard_ids:
                        yield flush()
                        keys, payloads, held, seq = [], [], 0, seq + 1
        if keys:
            yield flush()
    return run


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, shard_ids: int = 8_000_000, tokenizer: str | None = None) -> DataFrame:
    """Write all documents as shards under ``folder``; returns the manifest, one
    row per shard with ``start``, the ids in all shards before it.

    Rows are range-partitioned on the id, so files ascend by (part, seq). NULL
    ids come first and can be scanned but not looked up; repeated ids lie side
    by side, ordered by text hash. ``shard_ids`` bounds what a task holds.
    """
    ship_code(docs.sparkSession)
    path = tokenizer or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    manifest = stored(rows.mapInArrow(_write(folder, path, end_id, shard_ids), MANIFEST), "manifest")
    # one narrow row per shard of millions of ids: the running sum is one small task
    before = F.sum("ids").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def _read(batches):
    for batch in batches:
        for m in batch.to_pylist():
            shard = open_shard(m["file"])
            row, times = shard.find(np.unique(shard.keys[~shard.nulls]))
            if (row < 0).any() or int(times.sum()) != int((~shard.nulls).sum()):
                raise ValueError(f"index of {m['file']} misses documents")
            at = np.sort(np.concatenate([np.flatnonzero(shard.nulls),
                                         np.repeat(row, times) + _within(times)]))
            for a in range(0, len(at), 10_000):
                rows = at[a:a + 10_000]
                data = [shard.ids(r) for r in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.keys[rows], mask=shard.nulls[rows]),
                    pa.array(shard.starts[rows] + m["start"]),
                    pa.array([len(x) for x in data], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in data], pa.int64())],
                    names=["id", "start", "n_tokens", "ids_crc32"])


def _within(times: np.ndarray) -> np.ndarray:
    """0..t-1 for each t, one after the other."""
    return np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, found through the index:
    ``(id, start, n_tokens, ids_crc32)``."""
    ship_code(manifest.sparkSession)
    files = max(1, manifest.count())
    return (manifest.select("file", "start").repartition(files, "file")
            .mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long"))


@register("op6_token_shards")
def op6(spark, sf_dir):
    folder = scratch(spark, "token-shards")
    manifest = write_shards(table(spark, sf_dir, "documents"), folder)
    return read_shards(manifest).withColumnRenamed("id", "doc_id")

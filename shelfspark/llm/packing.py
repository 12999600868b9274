"""Best-fit packing of token sequences, best-two-fit.

Documents are cut into pieces of at most ``size`` tokens; pieces are numbered and
dealt by a hash of their number into groups of about ``group_rows`` and each group is packed on
its own, so no task holds more than a group and the loss is at most about one
partly filled sequence per group. In a group each sequence is filled greedily
(the longest piece left, then the longest that fits, and so on); then its
smallest piece gives way to two pieces left over that fit the larger gap more
tightly, if there are such.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, ship_code, stored, table
from .tokens import encoder, text_slices, vocabulary_path

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"
NUMBER = "number"  # of a piece, its own however many rows are equal


def _pieces(path: str, end_id: int, size: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(path)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("id")
            for a, b in text_slices(batch):
                row, piece, start, length, crc = [], [], [], [], []
                for r, data in enumerate(encode(batch.column("text").slice(a, b - a).to_pylist()), a):
                    data += end
                    for k, at in enumerate(range(0, len(data), 4 * size)):
                        part = data[at:at + 4 * size]
                        row.append(r)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array(np.arange(number, number + len(row)))],
                    names=["id", "piece", "start", "length", "ids_crc32", NUMBER])
                number += len(row)
    return run


def pack(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each piece; every length is 1..size."""
    order = np.argsort(-lengths, kind="stable")
    by_length = {int(n): [] for n in np.unique(lengths)}
    for i in order[::-1]:
        by_length[int(lengths[i])].append(int(i))
    count = np.zeros(size + 1, np.int64)
    for n, items in by_length.items():
        count[n] = len(items)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    index = np.arange(size + 1)
    best = np.maximum.accumulate(np.where(count > 0, index, 0))  # longest left that is no longer than x
    dirty = False
    number = 0
    while True:
        if dirty:
            best, dirty = np.maximum.accumulate(np.where(count > 0, index, 0)), False
        if not best[size]:
            return sequence, offset
        bin_, gap = [], size
        while gap and (n := int(best[gap])):
            take = min(int(count[n]), gap // n) if n * 2 <= gap else 1
            bin_ += [n] * take
            gap -= n * take
            count[n] -= take
            if not count[n]:
                best = np.maximum.accumulate(np.where(count > 0, index, 0))
        if gap and len(bin_) > 1:
            least = bin_[-1]
            room = gap + least
            a = index[1:room]
            a = a[count[a] > 0]
            if len(a):
                b = best[np.minimum(a, room - a)]
                same = (a == b) & (count[a] < 2)  # one piece is not taken twice
                b = np.where(same, best[np.maximum(b - 1, 0)], b)
                total = np.where(b > 0, a + b, 0)
                k = int(np.argmax(total))
                if total[k] > least:
                    bin_[-1:] = [int(a[k]), int(b[k])]
                    count[a[k]] -= 1
                    count[b[k]] -= 1
                    count[least] += 1
                    dirty = True
        at = 0
        for n in bin_:
            # pieces returned by a swap were never popped: items are taken only here
            i = by_length[n].pop()
            sequence[i], offset[i] = number, at
            at += n
        number += 1


def _packed(size: int):
    def run(batches):
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        rows = rows.drop_columns(NUMBER).sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending"),
                             ("ids_crc32", "ascending")])
        sequence, offset = pack(rows["length"].to_numpy(), size)
        first = TaskContext.get().partitionId() << 32
        rows = rows.append_column("sequence_id", pa.array(sequence + first)) \
                   .append_column("offset", pa.array(offset))
        yield from rows.combine_chunks().to_batches(max_chunksize=50_000)
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
                   end_id: int = 0, group_rows: int = 50_000, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ``(id, piece, start, length, ids_crc32, sequence_id, offset)``.

    A document is its ids and the end id; an empty or NULL text is the end id
    alone. Rows with a NULL or repeated id are packed like any other, and equal rows
    are dealt over all groups. ``group_rows`` bounds a task: more of it packs a little
    tighter. An empty
    table gives no rows. Only ``id_col`` and ``text_col`` are read.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    path = tokenizer or vocabulary_path()
    pieces = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                    .mapInArrow(_pieces(path, end_id, size), f"id {kind}, {PIECE_SCHEMA}, {NUMBER} long"), "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    return (pieces.repartition(groups, NUMBER)
            .mapInArrow(_packed(size), f"id {kind}, {PIECE_SCHEMA}, sequence_id long, offset long"))


@register("op10_best_fit_packing")
def op10(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

"""N-gram Jaccard join: a grouped prefix join over word shingles.

Two texts link when the Jaccard similarity of their shingle sets reaches a
threshold. Every set is put in one global order, rare shingles first; two sets
at or above the threshold share a shingle among their first
``n - ceil(t * n) + 1`` ones. The join

1. counts in how many texts each word occurs (all texts) and orders shingles by
   the class (log2) of their rarest word's count, then by hash. Any fixed order
   gives the same result; this one keeps lists of common shingles short;
2. collapses equal sets into nodes, and nodes of equal size and prefix into
   groups, so only groups meet in the inverted lists;
3. pairs the groups of a list that pass the size and the overlap bound. Lists
   over ``list_size`` groups are not paired but go to step 4 whole;
4. expands groups to their nodes and verifies exactly, inside blocks of at most
   twice ``block`` nodes; a larger list is split into pairs of blocks, dealt to
   different tasks. Each block returns a spanning forest of its links, never
   all its pairs;
5. links become components.

The work for a list of m different texts that truly share rare prefixes is
m^2 / block rows: only those lists pay it. Copies are never paired.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import drop_keys, register, semi_join_ids, ship_code, stored, table
from .components import connected_components, spread_join

CLASS_SHIFT, HASH_BITS_CUT = 58, 6  # class (0..31) above 58 bits of hash
LEAST_DF = 16  # words in fewer texts all count as rare


# --- step 1: the global order ----------------------------------------------------

def _word_counts(batches):
    """Arrow batches of ``text`` -> (word, df), summed over what a task has read so far."""
    held: list[np.ndarray] = []
    size = 0

    def flush():
        w, c = np.unique(np.concatenate(held), return_counts=True)
        for i in range(0, len(w), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 50_000].view(np.int64)),
                                              pa.array(c[i:i + 50_000])], names=["word", "df"])

    for batch in batches:
        for _, _, raw, offsets in S.batches(batch.column("text")):
            w, first = S.words(raw, offsets)
            for a, b in zip(first[:-1], first[1:]):
                held.append(np.unique(w[a:b]))
                size += len(held[-1])
            if size > 1_500_000:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()


def word_classes(texts: DataFrame, most_words: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of common words and their class. At most ``most_words`` (the
    commonest) come to the driver; words left out only count as rare, which
    changes the order of shingles and nothing else."""
    counts = stored(texts.select("text").mapInArrow(_word_counts, "word long, df long")
                    .groupBy("word").agg(F.sum("df").alias("df")).where(F.col("df") >= LEAST_DF)
                    .select("word", F.least(F.floor(F.log2("df")), F.lit(31)).cast("int").alias("class")),
                    "words")
    by_class = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.count("*").alias("n")).collect()}
    total, least = 0, 99
    for c in sorted(by_class, reverse=True):
        if total + by_class[c] > most_words:
            break
        total, least = total + by_class[c], c
    kept = counts.where(F.col("class") >= least).toArrow()
    word = kept["word"].to_numpy().view(np.uint64)
    order = np.argsort(word)
    return word[order], kept["class"].to_numpy().astype(np.uint64)[order]


def _token_sets(raw, offsets, width, known, classes):
    """Per text its sorted distinct tokens: class in the high bits, then hash."""
    w, first = S.words(raw, offsets)
    h, win = S.shingles(w, first, width)
    if len(known):
        at = np.minimum(np.searchsorted(known, w), len(known) - 1)
        c = np.where(known[at] == w, classes[at], np.uint64(0))
    else:
        c = np.zeros(len(w), np.uint64)
    padded = np.concatenate([c, np.full(width, 63, np.uint64)])
    n_words = np.diff(first)
    n_win = np.diff(win)
    begin = np.repeat(first[:-1] - win[:-1], n_win) + np.arange(len(h))
    short = np.repeat(np.minimum(n_words, width), n_win)
    rarest = padded[begin]
    for k in range(1, width):
        rarest = np.where(k < short, np.minimum(rarest, padded[begin + k]), rarest)
    tokens = (rarest << np.uint64(CLASS_SHIFT)) | (h >> np.uint64(HASH_BITS_CUT))
    return [np.unique(tokens[a:b]) for a, b in zip(win[:-1], win[1:])]


def _node(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _prefixes(width, percent, order):
    def run(batches):
        known, classes = order.value
        for batch in batches:
            ids = batch.column("id")
            for i, j, raw, offsets in S.batches(batch.column("text")):
                sets = _token_sets(raw, offsets, width, known, classes)
                n = [len(s) for s in sets]
                cut = [s[:m - -(-percent * m // 100) + 1] if m else s for s, m in zip(sets, n)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array([_node(s) for s in sets], pa.binary()),
                     pa.array([hashlib.blake2b(p.tobytes() + m.to_bytes(8, "little"), digest_size=16).digest()
                               for p, m in zip(cut, n)], pa.binary()), _lists(cut)],
                    names=["id", "n", "node", "grp", "prefix"])
    return run


def _full_sets(width, order):
    def run(batches):
        known, classes = order.value
        for batch in batches:
            for _, _, raw, offsets in S.batches(batch.column("text")):
                sets = _token_sets(raw, offsets, width, known, classes)
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.binary()),
                                                  _lists(sets)], names=["node", "tokens"])
    return run


# --- step 4: exact verification ------------------------------------------------------

def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, over the tokens that at least two sets hold."""
    k = len(sets)
    sizes = np.array([len(s) for s in sets])
    token, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(k), sizes)
    counts = np.bincount(column, minlength=len(token))
    number = np.cumsum(counts > 1) - 1
    shared = counts[column] > 1
    row, column = row[shared], number[column[shared]]
    out = np.zeros((k, k))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + step, step))
    for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        x = np.zeros((k, step), np.float32)
        x[row[a:b], column[a:b] - c * step] = 1
        out += x @ x.T
    np.fill_diagonal(out, sizes)
    return out


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: 100 * intersection >= percent * union."""
    size = np.array([len(s) for s in sets], float)
    inter = _intersections(sets)
    return 100 * inter >= percent * (size[:, None] + size[None, :] - inter)


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """One (node, root) per node that is linked to an earlier root."""
    k, seen, out = len(adjacent), np.zeros(len(adjacent), bool), []
    for root in range(k):
        if seen[root]:
            continue
        seen[root], front = True, [root]
        while front:
            near = adjacent[front].any(axis=0) & ~seen
            seen |= near
            front = np.flatnonzero(near).tolist()
            out += [(v, root) for v in front]
    return out


def _verify(percent):
    def cell_links(nodes, sets):
        keep = {n: s for n, s in zip(nodes, sets)}  # a repeated row counts once
        names = list(keep)
        return [(names[a], names[b]) for a, b in _forest(linked(list(keep.values()), percent))]

    def run(batches):
        key, nodes, sets, out = None, [], [], []
        for batch in batches:
            cells = list(zip(batch.column("cell").to_pylist(), batch.column("i").to_pylist(),
                             batch.column("j").to_pylist()))
            ids = batch.column("node").to_pylist()
            lists = batch.column("tokens")
            flat = lists.flatten().to_numpy().view(np.uint64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            for r, cell in enumerate(cells):
                if cell != key:
                    if len(nodes) > 1:
                        out += cell_links(nodes, sets)
                    key, nodes, sets = cell, [], []
                nodes.append(ids[r])
                sets.append(flat[ends[r]:ends[r + 1]])
            if out:
                yield _links_batch(out)
                out = []
        if len(nodes) > 1:
            out += cell_links(nodes, sets)
        if out:
            yield _links_batch(out)
    return run


def _links_batch(links):
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.binary()),
                                       pa.array([b for _, b in links], pa.binary())], names=["u", "v"])


# --- the operator ------------------------------------------------------------------

def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 5, percent: int = 80, list_size: int = 64,
                       block: int = 512) -> DataFrame:
    """One row per input row: ``(id, n_shingles, component_id)``.

    Texts link at ``100 * |A & B| >= percent * |A | B|`` of their sets of
    distinct ``width``-word shingles (ASCII lower-cased whitespace words; fewer
    words: the whole sequence is one shingle). ``component_id`` is the smallest
    id reachable by links. Empty and NULL texts link with nothing. Rows without
    id are returned with a NULL component and take part in no link; repeated
    ids and repeated rows are returned as often as they come. Other columns are
    not read.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = spark.sparkContext.broadcast(word_classes(texts))
    rows = stored(texts.mapInArrow(
        _prefixes(width, percent, order),
        f"id {dict(texts.dtypes)['id']}, n long, node binary, grp binary, prefix array<long>"), "prefixes")
    sets = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    nodes = stored(sets.groupBy("node").agg(
        F.first("grp").alias("grp"), F.min("id").alias("id"), F.count("*").alias("rows")), "nodes")

    # step 2: groups of equal size and prefix, and their inverted lists
    groups = sets.groupBy("grp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    postings = groups.select("grp", "n", F.posexplode("prefix").alias("pos", "token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > 1)
    postings = stored(postings.join(lists, "token"), "postings")

    # step 3: group pairs of the short lists, each kept with its first common token
    short = postings.where(F.col("m") <= list_size)
    x = short.select("token", *[F.col(c).alias(f"{c}_x") for c in ("grp", "n", "pos")])
    y = short.select("token", *[F.col(c).alias(f"{c}_y") for c in ("grp", "n", "pos")])
    need = F.ceil(F.lit(percent) * (F.col("n_x") + F.col("n_y")) / F.lit(100 + percent))
    pairs = (x.join(y, "token")
             .where((F.col("grp_x") < F.col("grp_y"))
                    & (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent))
             .groupBy("grp_x", "grp_y")
             .agg(F.min("token").alias("token"), F.count("*").alias("common"), F.max("pos_x").alias("pos_x"),
                  F.max("pos_y").alias("pos_y"), F.first("n_x").alias("n_x"), F.first("n_y").alias("n_y"))
             .where(F.col("common") + F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
                    - 1 >= need))
    cells = (pairs.select(F.col("token").alias("cell"),
                          F.explode(F.array("grp_x", "grp_y")).alias("grp"))
             .unionByName(postings.where(F.col("m") > list_size).select(F.col("token").alias("cell"), "grp"))
             .distinct())
    own = nodes.groupBy("grp").agg(F.count("*").alias("k")).where(F.col("k") > 1) \
        .select((-F.abs(F.xxhash64("grp")) - 1).alias("cell"), "grp")  # tokens are not negative

    # step 4: expand to nodes, deal out in blocks, verify
    members = stored(cells.unionByName(own).join(nodes.drop("rows"), "grp").select("cell", "node", "id"),
                     "members")
    count = members.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.join(count, "cell").select("cell", "node", mine.alias("b"), "blocks")
             .select("cell", "node", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
             .select("cell", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "node"))
    wanted = semi_join_ids(texts, members.select("id").distinct(), "id")
    full = wanted.mapInArrow(_full_sets(width, order), "node binary, tokens array<long>")
    links = (dealt.join(full, "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
             .select("cell", "i", "j", "node", "tokens")
             .mapInArrow(_verify(percent), "u binary, v binary"))

    # step 5: components of nodes, then the smallest id of each, for nodes and for rows
    labels = connected_components(links)
    named = stored(nodes.join(labels, "node", "left").select(
        "node", "id", "rows", F.coalesce("component", "node").alias("label")), "named")
    smallest = stored(named.groupBy("label").agg(F.min("id").alias("low"), F.count("*").alias("n")), "smallest")
    found = stored(spread_join(named.select("node", "rows", "label"), smallest, "label")
                   .select("node", "low", F.col("rows").alias("n")), "found")
    out = spread_join(rows.select("id", F.col("n").alias("n_shingles"), "node"), found, "node", how="left")
    return out.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("low", "id"))
                      .alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one of smallest id (then of
    smallest text hash); all columns. A document is an id with a text: of two texts
    under one id only the one that has a near copy goes. Rows that repeat as a whole
    stay or go together. Rows without id stay, as they are in no component."""
    key = "_text_key"
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    named = marked.select(F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), key)).alias("id"),
                          F.col(text_col).alias("text"))
    found = jaccard_components(named, "id", "text", **options)
    lost = found.where(F.col("id") != F.col("component_id")).select(
        F.col("id.id").alias(id_col), F.col(f"id.{key}").alias(key))
    return drop_keys(marked, lost).drop(key)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
         ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id WHERE r.c < l.v)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""


@register("op1_ngram_jaccard_join", OP1_SQL)
def op1(spark, sf_dir):
    out = jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")

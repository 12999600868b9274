"""Secret scan: Aho-Corasick keywords, then anchored expressions at the hits.

One pass of an Aho-Corasick automaton over the whole text finds the places of
all keywords; the expression of a kind is tried only there. Tokens that carry a
checksum are kept only if it holds. Runs of hex digits have no keyword and are
found by their own scan.
"""

from __future__ import annotations

import re
import zlib
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPANS, register, ship_code, span_digest, table

# The kinds, their keywords and expressions.
BASE_KINDS = ["assign", "access", "hex"]
OWN_KINDS = ["github", "npm"]
ANY_CASE = ["password", "passwd", "secret", "token", "apikey", "api_key"]
EXACT = {"AKIA": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
         "ghr_": "github", "npm_": "npm"}
EXPRESSIONS = {
    "assign": re.compile("""(?:password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE | re.ASCII),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "github": re.compile("gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile("npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
}
HEX = re.compile("[0-9a-f]{32,}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_automata: list = []


def base62(n: int, width: int = 6) -> str:
    out = ""
    while n:
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.rjust(width, "0")


def valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 8
    if kind == "access":
        return len(match[0]) >= 16
    return match[2] == base62(zlib.crc32(match[1].encode()))  # the token's own checksum


def automaton():
    """Keywords to (kind, length); any-case keywords in each of their spellings."""
    if not _automata:
        import ahocorasick
        a = ahocorasick.Automaton()
        for word in ANY_CASE:
            for spelled in product(*[sorted({c, c.upper()}) for c in word]):
                a.add_word("".join(spelled), ("assign", len(word)))
        for word, kind in EXACT.items():
            a.add_word(word, (kind, len(word)))
        a.make_automaton()
        _automata.append(a)
    return _automata[0]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` in code points, leftmost and not overlapping
    per kind; a match that fails its check is dropped and not retried."""
    if not text:
        return []
    hits: dict[str, list[int]] = {}
    for last, (kind, size) in automaton().iter(text):
        hits.setdefault(kind, []).append(last - size + 1)
    out = []
    for kind, starts in hits.items():
        done, expression = 0, EXPRESSIONS[kind]
        for at in sorted(starts):
            if at >= done and (m := expression.match(text, at)):
                done = m.end()
                if valid(kind, m):
                    out.append((kind, at, done))
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def _scan(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t)]
                 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], names=["id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, spans)``. NULL and empty texts have no spans;
    NULL and repeated ids pass through. No shuffle."""
    ship_code(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_scan, f"id {dict(docs.dtypes)[id_col]}, spans {SPANS}")


@register("op3_secret_scan")
def op3(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return span_digest(found, BASE_KINDS, OWN_KINDS)

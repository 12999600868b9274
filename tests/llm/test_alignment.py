"""Token alignment against whole-text encoding and plain interval arithmetic."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from shelfspark.llm import token_alignment as A

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Contract columns of ``(id, text)`` rows, texts encoded whole."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {
        chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in printable)}

    def piece(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(tokens):
        at, out = 0, []
        for i, data in tokens:
            out.append((at, at + len(data), i))
            at += len(data)
        return out
    found, pairs = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            enc = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(byte[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
            b = [(i, piece(i)) for i in b_model.encode(text)]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a = b = []
        a, b = ranges(a), ranges(b)
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, links, i, j = [], [], 0, 0
        for cut in cuts:
            own, other = [], []
            while i < len(a) and a[i][1] <= cut:
                own.append(a[i])
                i += 1
            while j < len(b) and b[j][1] <= cut:
                other.append(b[j])
                j += 1
            groups.append(",".join(str(x[2]) for x in own) + "|" + ",".join(str(x[2]) for x in other))
            links += [(x[2], y[2]) for x in own for y in other if x[0] < y[1] and y[0] < x[1]]
        pairs.update(links)
        found.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    top = Counter()
    for (_, y), n in pairs.items():
        top[y] = max(top[y], n)
    return sorted(((d, na, nb, ng, len(ls), sum(pairs[p] == top[p[1]] for p in ls), sum(pairs[p] for p in ls),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for d, na, nb, ng, ls, g in found),
                  key=lambda r: (r[0] is None, r[0] or 0, r))


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = [tuple(r) for r in entry.queries()["op11_token_alignment"](spark, SF).collect()]
    want = brute(rows)
    assert sorted(got) == want and sum(r[1] > 0 for r in want) > 100


SPACES = ["a b", " a", "a ", "a  ", "  a   b  ", "a\n b", "a\n  b c", "a \n b", "\n", " ", "   ", "a\x1c b", "a\u3000 b",
          "a\u180e b", "a▁ b", "a\xa0 b", "<s> </s> <0x41> <|endoftext|> x", "don't  won't 's 's", "fi ﬁ é é",
          "\u200b a \ufeff b", "tab\t x \t y", "x" * 300 + " " + "1" * 2000, "漢字 かな漢字 text", "😀 é́ \x00 İ"]


@pytest.mark.parametrize("most_held", [1_000_000, 3, 0])
def test_odd_rows(spark, make_docs, odd_rows, most_held):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(SPACES)]
    got = A.align_corpus(make_docs(rows), most_held=most_held).select("id", *COLUMNS).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r)) == brute(rows)


def test_small_store_and_empty_table(spark, make_docs):
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    small, large = A.Aligner(*paths, most_cached=3, longest=2), A.Aligner(*paths)
    for _ in range(2):
        assert small(SPACES) == large(SPACES)
    assert len(small.known) <= 3
    assert A.align_corpus(make_docs([])).collect() == []
    whole = A.align(make_docs([(1, "two words")]), keep_groups=True).collect()[0]
    assert whole.groups.count(";") + 1 == whole.n_groups and "|" in whole.groups


def test_ranks_give_the_tokenizers_ids():
    """Every entry's own text and all chunks of the small table, both ways."""
    own = A.Aligner(*[public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")])
    assert own.quick
    chunks = {b.decode("utf-8", "ignore").strip() for b in own.a_bytes}
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text <> ''").fetchall():
        chunks.update(A.split_text(text))
    chunks = sorted(chunks)
    assert own._encode_a(chunks) == [e.ids for e in own.a.encode_batch([" " + c for c in chunks],
                                                                       add_special_tokens=False)]
    own.quick = None
    assert own(["two words"]) == A.Aligner(*[public_tokenizers.path(x) for x in (
        "byte_bpe_50k.json", "piece_bpe_32k.model")])(["two words"])

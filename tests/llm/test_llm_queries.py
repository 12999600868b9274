"""The registered queries against brute force over the smallest driver tables."""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import oracle_check
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op5_license_scan", "op8_exact_dedup"])
def test_oracle(spark, name):
    r = oracle_check.compare(spark, name, SF)
    assert r["cols_match"] and r["hash_match"], r


def ids_of(rows, end):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: e.ids + [end] for (i, _), e in zip(
        rows, t.encode_batch([x or "" for _, x in rows], add_special_tokens=False))}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op6(spark, docs_rows):
    got = sorted(map(tuple, entry.queries()["op6_token_shards"](spark, SF).collect()))
    want, at = [], 0
    for i, ids in ids_of(docs_rows, 2).items():
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want


def test_op10(spark, docs_rows):
    rows = entry.queries()["op10_best_fit_packing"](spark, SF).collect()
    want = {(i, k // 2048, k, len(ids[k:k + 2048]), crc(ids[k:k + 2048]))
            for i, ids in ids_of(docs_rows, 0).items() for k in range(0, len(ids), 2048)}
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in rows) // 2048) * 1.03 + 1


def digest(spans):
    text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(t):
    assign = re.compile("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                        re.I | re.A)
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]


def luhn(x):
    return sum((v - 9 if v > 9 else v) for i, c in enumerate(reversed(x)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def base_pii(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, "email", m.end())
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 10 <= len(digits(m)) <= 15]


@pytest.mark.parametrize("name,base", [("op3_secret_scan", base_secrets), ("op7_pii_sanitisation", base_pii)])
def test_spans(spark, docs_rows, name, base):
    rows = {r.doc_id: r for r in entry.queries()[name](spark, SF).collect()}
    assert len(rows) == len(docs_rows)
    for i, t in docs_rows:
        assert rows[i].base_sha256 == digest(base(t or "")), i


@pytest.mark.parametrize("name,label,least", [("op2_quality_mil", "quality", 0.9), ("op4_toxicity_pu", "toxic", 0.9)])
def test_classifiers(spark, name, label, least):
    """Held-out accuracy on the 0.1 tables; every document has one row."""
    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet'").fetchall())
    rows = entry.queries()[name](spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= least


def test_op9(spark, docs_rows):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()

    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)

    def grams(w):
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    want = {}
    for i, t in docs_rows:
        w = words(t)
        own = set(grams(w))
        for j, u in items:
            b = words(u)
            g = Counter(grams(b))
            if not own & set(g):
                continue
            best = 0
            for k in range(max(1, len(w) - len(b) + 1)):
                x = Counter(grams(w[k:k + len(b)]))
                best = max(best, sum((g & x).values()) / sum((g | x).values()))
            if best >= 0.8:
                want[i, j] = round(best, 6)
    rows = entry.queries()["op9_benchmark_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in rows} == want and want


def test_pipeline(spark, tmp_path):
    """Each stage against what it was given: what it keeps and what it must not."""
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES:
        out = p.stored(stage(spark, docs, SF), name)
        kept[name] = (docs, out)
        if name != "packed_sequences":
            assert out.columns == docs.columns
        docs = out
    before, after = kept["exact_duplicates"]
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    last = {}
    for r in before.collect():
        last[low(r.text)] = max(last.get(low(r.text), -1), r.doc_id)
    assert {r.doc_id for r in after.collect()} == set(last.values())
    before, after = kept["near_duplicates"]
    sets = {}
    for r in before.collect():
        w = [x for x in re.split("[\x20\x09-\x0d]+", low(r.text)) if x]
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((group[i], group[j]))
                    group = {k: a if g == b else g for k, g in group.items()}
    assert {r.doc_id for r in after.collect()} == set(group.values())
    before, after = kept["benchmark_leaks"]
    from shelfspark.llm.decontaminate import contaminated
    lost = {r.id for r in contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - lost
    before, after = kept["packed_sequences"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}

"""Licence scan by a positional rare-token index, in DataFrame functions only.

Document frequencies of the templates' words are counted over all files. A template
has a mandatory key phrase. Of a template whose key words all occur in a file, the two
that are rarest over all files (highest IDF) are looked up: an occurrence at place p
of a word that stands at place k of the phrase votes for the start p - k, and the
votes of both words are intersected. At every start so found the key phrase must be
there in full; the rest of the template is then compared word by word around it.

A file that holds a key phrase holds all its words, so no choice of words loses a
label, and a file's labels do not depend on other files: only which words are looked
up does. All of it is column expressions on the file's own words: no shuffle but the
one of the word counts (at most one row per template word and task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, register, table

# Separators of words, the base phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
# Further templates (label, words of the public text, key phrase of them).
OWN = [
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the
        software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the software the software is provided as is without warranty of any kind express or
        implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement""", "permission is hereby granted free of charge"),
    ("apache-2", """licensed under the apache license version 2 0 the license you may not use this file except in
        compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
        unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied""",
     "licensed under the apache license version 2"),
    ("gpl-3", """this program is free software you can redistribute it and or modify it under the terms of the gnu
        general public license version 3 as published by the free software foundation this program is distributed in
        the hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose""", "gnu general public license version 3"),
    ("gpl-2", """this program is free software you can redistribute it and or modify it under the terms of the gnu
        general public license version 2 as published by the free software foundation this program is distributed in
        the hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose""", "gnu general public license version 2"),
    ("lgpl", """this library is free software you can redistribute it and or modify it under the terms of the gnu
        lesser general public license as published by the free software foundation this library is distributed in
        the hope that it will be useful but without any warranty""", "gnu lesser general public license"),
    ("agpl", """this program is free software you can redistribute it and or modify it under the terms of the gnu
        affero general public license as published by the free software foundation""",
     "gnu affero general public license"),
    ("mpl-2", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the
        mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0""",
     "mozilla public license v 2"),
    ("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met redistributions of source code must retain the above copyright notice
        this list of conditions and the following disclaimer redistributions in binary form must reproduce the above
        copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution""", "redistribution and use in source and binary forms"),
    ("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies the
        software is provided as is and the author disclaims all warranties with regard to this software""",
     "permission to use copy modify and or distribute this software"),
    ("unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy
        modify publish use compile sell or distribute this software either in source code form or as a compiled
        binary for any purpose commercial or non commercial and by any means""", "free and unencumbered software"),
]


def _key_place(words: list[str], key: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


#: (label, words, first and number of key words, whether a base phrase)
TEMPLATES = [(label, p.split(), 0, len(p.split()), True) for label, p in BASE] + [
    (label, t.split(), _key_place(t.split(), k.split()), len(k.split()), False) for label, t, k in OWN]
VOCABULARY = sorted({w for _, words, at, n, _ in TEMPLATES for w in words[at:at + n]})


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def word_counts(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """In how many files each key word occurs (a row per such word)."""
    own = F.array(*[F.lit(w) for w in VOCABULARY])
    rows = docs.select(F.explode(F.array_intersect(words_of(F.col(text_col)), own)).alias("w")) \
        .groupBy("w").agg(F.count("*").alias("n")).collect()
    return {r["w"]: r["n"] for r in rows}


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _index(counts: dict[str, int]) -> Column:
    """The templates as a constant: words, key phrase, and the words that stand once in
    the phrase with their places in it, those in the fewest files first."""
    def one(label, words, at, n, base):
        key = words[at:at + n]
        rare = sorted((counts.get(w, 0), w, i) for i, w in enumerate(key) if key.count(w) == 1)
        return F.struct(F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(at).alias("at"),
                        _array(words).alias("words"), _array(key).alias("key"),
                        F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for _, w, i in rare]).alias("rare"))
    return F.array(*[one(*t) for t in TEMPLATES])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  counts: dict[str, int] | None = None) -> DataFrame:
    """``(id, n_words, base, own, score)`` per input row.

    ``base``: ``(label, start)`` of every place of a base phrase; ``own``: labels
    of the other templates whose key phrase stands in the file; ``score``: the
    greatest share of a template's words found in place around a key phrase. NULL
    and empty texts have no words and score 0; ids are not looked at.
    """
    counts = word_counts(docs, text_col) if counts is None else counts
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    rows = rows.withColumn("present", F.array_intersect("words", _array(VOCABULARY)))
    # templates whose key words are all in the file, each with its rarest words there
    rows = rows.withColumn("templates", F.when(F.size("present") > 0, F.transform(
        F.filter(_index(counts), lambda t: F.size(F.array_except(t["key"], F.col("present"))) == 0),
        lambda t: t.withField("rare", F.slice(F.filter(t["rare"], lambda r: F.array_contains("present", r["w"])), 1, 2))))
        .otherwise(F.filter(_index(counts), lambda t: F.lit(False))))
    w = F.col("words")
    looked_up = F.flatten(F.transform("templates", lambda t: t["rare"]["w"]))
    places = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))),
                      lambda h: F.array_contains(F.col("rare"), h["w"]))
    rows = rows.withColumn("rare", F.array_distinct(looked_up)).withColumn(
        "hits", F.when(F.size("rare") > 0, places).otherwise(F.array().cast("array<struct<w:string,i:int>>")))

    def votes(probe: Column) -> Column:
        return F.transform(F.filter("hits", lambda h: h["w"] == probe["w"]), lambda h: h["i"] - probe["i"])

    def starts(t: Column) -> Column:
        both = F.aggregate(F.slice(t["rare"], 2, 1), votes(F.get(t["rare"], 0)),
                           lambda acc, probe: F.array_intersect(acc, votes(probe)))
        return F.filter(both, lambda s: (s >= 0) & (F.slice(w, s + 1, F.size(t["key"])) == t["key"]))

    def share(t: Column, s: Column) -> Column:
        skipped = F.greatest(t["at"] - s, F.lit(0))  # template words before the file begins
        n = F.size(t["words"]) - skipped
        same = F.zip_with(F.slice(t["words"], skipped + 1, n), F.slice(w, s - t["at"] + skipped + 1, n),
                          lambda x, y: F.when(x == y, 1).otherwise(0))
        return F.aggregate(same, F.lit(0), lambda acc, x: acc + x) / F.size(t["words"])
    found = F.transform("templates", lambda t: F.struct(t["label"].alias("label"), t["base"].alias("base"), F.transform(
        starts(t), lambda s: F.struct(s.cast("long").alias("start"), share(t, s).alias("share"))).alias("at")))
    rows = rows.withColumn("found", F.filter(found, lambda f: F.size(f["at"]) > 0))
    base = F.flatten(F.transform(F.filter("found", lambda f: f["base"]), lambda f: F.transform(
        f["at"], lambda a: F.struct(f["label"].alias("label"), a["start"].alias("start")))))
    own = F.array_distinct(F.transform(F.filter("found", lambda f: ~f["base"]), lambda f: f["label"]))
    score = F.coalesce(F.array_max(F.flatten(F.transform("found", lambda f: f["at"]["share"]))), F.lit(0.0))
    return rows.select("id", F.size("words").cast("long").alias("n_words"), base.alias("base"), own.alias("own"),
                       score.alias("score"))


def _values() -> str:
    return ", ".join(f"({t}, {i}, '{w}')" for t, (_, words, *_) in enumerate(TEMPLATES) for i, w in enumerate(words))


OP5_SQL = rf"""
WITH f AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM f),
t(tid, k, word) AS (VALUES {_values()}),
m(tid, label, key_at, key_n, is_base, n) AS (VALUES {", ".join(
    f"({t}, '{label}', {k}, {n}, {str(b).lower()}, {len(words)})"
    for t, (label, words, k, n, b) in enumerate(TEMPLATES))}),
c AS (SELECT doc_id, tid, pos - k + key_at AS s FROM p JOIN t USING (word) JOIN m USING (tid)
    WHERE k >= key_at AND k < key_at + key_n GROUP BY doc_id, tid, s, key_n HAVING count(*) = key_n),
cov AS (SELECT c.doc_id, c.tid, c.s, count(*) AS same
    FROM c JOIN m USING (tid) JOIN t USING (tid)
    JOIN p ON p.doc_id = c.doc_id AND p.pos = c.s + t.k - m.key_at AND p.word = t.word GROUP BY ALL),
r AS (SELECT doc_id, max(same / n::DOUBLE) AS score,
    count(*) FILTER (is_base) AS n_base,
    min(s) FILTER (is_base) AS first_word,
    max(s) FILTER (is_base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM cov JOIN m USING (tid) GROUP BY doc_id)
SELECT f.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    round(coalesce(score, 0), 6) AS score
FROM f LEFT JOIN r USING (doc_id)
"""


@register("op5_license_scan", OP5_SQL)
def op5(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda b: b["start"])
    base = F.array_distinct(F.transform("base", lambda b: b["label"]))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("own"))), ",").alias("labels"),
        F.round("score", 6).alias("score"))

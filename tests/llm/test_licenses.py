"""Licence labels do not depend on other files; parts of templates."""

from __future__ import annotations

from shelfspark.llm import licenses as L

TEXTS = [(1, "released under the GNU General Public License version 3"),
         (2, "Permission is hereby granted, free of charge, ..."),
         (3, "GNU General Public License version 3"), (4, " ".join(L.TEMPLATES[3][1])),
         (5, "gnu general license public version 3"), (6, "CC-BY-NC cc by nc"), (7, None), (8, ""),
         (9, "under the MIT license, under the mit license; Apache License, Version 2.0 " * 300)]


def labels(rows):
    return {r.id: (sorted({b.label for b in r.base} | set(r.own)), len(r.base), round(r.score, 6)) for r in rows}


def test_labels_alone_and_among_others(spark, make_docs):
    alone = labels(L.scan_licenses(make_docs(TEXTS)).collect())
    assert alone[1][0] == alone[3][0] == ["gpl-3"] and alone[2][0] == alone[4][0] == ["mit"]
    assert alone[4][2] == 1.0 and 0 < alone[3][2] < alone[1][2] + 1e-9 and alone[5] == ([], 0, 0.0)
    assert alone[6][:2] == (["cc-by-nc"], 2) and alone[7] == alone[8] == ([], 0, 0.0)
    assert alone[9][0] == ["apache-2", "mit"] and alone[9][1] == 900
    others = [(100 + i, f"gnu public version {i} permission hereby granted charge mit nc license") for i in range(14)]
    many = labels(L.scan_licenses(make_docs(TEXTS + others)).collect())
    assert {i: many[i] for i in alone} == alone
    skewed = labels(L.scan_licenses(make_docs(TEXTS), counts={"gnu": 10**9, "3": 0, "free": 10**6}).collect())
    assert skewed == alone

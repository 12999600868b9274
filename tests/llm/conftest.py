from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture()
def make_docs(spark):
    """Documents with extra columns whose names the operators use themselves."""
    def make(rows):
        schema = ("doc_id long, text string, lang string, id long, n long, node string, spans string, "
                  "words string, score double, length long, piece int")
        return spark.createDataFrame([(i, t, "en", 7, 7, "x", "x", "x", 0.5, 7, 7) for i, t in rows], schema)
    return make


ODD = [(1, None), (2, ""), (3, "one"), (4, "one two"), (5, "a b c d e f g h"), (6, "A b c D e f g h"),
       (6, "A b c D e f g h"), (7, "\U0001F600 é́ \x00 İ " + "x" * 5000), (8, "word " * 20000), (None, "null id"),
       (None, None), (9, " \t\n"), (10, "1" * 30000), (11, "a@" * 3000), (12, "token" + " " * 20000 + "="),
       (13, "1." * 10000)]


@pytest.fixture()
def odd_rows():
    return ODD

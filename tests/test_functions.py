"""Scalar column functions on literal rows (FIXTURES F6, F9)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import text as X
from shelfspark.plans.reports import age_category


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(fn(F.col("v")).alias("out")).first()["out"]


def test_sanitize_text(spark):
    assert one(spark, "<p>Test   text</p>", X.sanitize_text) == "Test text"
    assert one(spark, None, X.sanitize_text) is None
    assert one(spark, "", X.sanitize_text) == ""
    assert one(spark, " <b>a</b>\t\n b ", X.sanitize_text) == "a b"


@pytest.mark.parametrize("text,expected", [
    ("$9.99", 9.99), ("Free", 0.0), ("", 0.0), (".", 0.0), ("5.", 5.0), (".5", 0.5),
    ("1.2.3", 0.0), ("1.234,56", 1.23456), ("$1,299.00", 1299.0), (None, 0.0),
])
def test_price_to_float(spark, text, expected):
    assert one(spark, text, X.price_to_float) == pytest.approx(expected)


@pytest.mark.parametrize("text,expected", [
    ("18+", 18), (" 18 ", 18), ("17.0", 0), ("abc", 0), (None, 0), ("18", 18), ("-2+", -2),
])
def test_safe_int(spark, text, expected):
    assert one(spark, text, X.safe_int) == expected


def test_language_lists(spark):
    html = ("English<strong>*</strong>, French<br><strong>*</strong>"
            "languages with full audio support")
    assert one(spark, html, X.supported_languages) == ["English", "French"]
    assert one(spark, html, X.full_audio_languages) == ["English", "French"]
    plain = "English*, French, German*"
    assert one(spark, plain, X.supported_languages) == ["English", "French", "German"]
    assert one(spark, plain, X.full_audio_languages) == ["English", "German"]
    assert one(spark, None, X.supported_languages) == []
    assert one(spark, None, X.full_audio_languages) == []


def test_owners(spark):
    assert one(spark, "20,000 .. 50,000", X.owners_text) == "20000 - 50000"
    assert one(spark, None, X.owners_text) == "0 - 0"
    assert one(spark, "20000 - 50000", X.owners_upper_bound) == 50000
    assert one(spark, "", X.owners_upper_bound) is None


@pytest.mark.parametrize("text,expected", [
    ("Oct 1, 2023", 2023), ("2023-01-01", None), ("Oct 1, 2023\n", None), ("", None),
])
def test_release_year(spark, text, expected):
    assert one(spark, text, X.release_year) == expected


def test_cents_to_price(spark):
    assert one(spark, "1999", X.cents_to_price) == 19.99
    assert one(spark, "599", X.cents_to_price) == 5.99
    assert one(spark, None, X.cents_to_price) == 0.0


@pytest.mark.parametrize("age,expected", [
    (-2, "Everyone"), (-1, "1. Everyone"), (8, "1. Everyone"), (9, "2. PG"), (12, "2. PG"),
    (13, "3. Teen"), (16, "3. Teen"), (17, "4. Mature"),
])
def test_age_buckets(spark, age, expected):
    assert one(spark, age, age_category, "bigint") == expected


def test_strip_unicode_whitespace(spark):
    assert one(spark, " \tAction  ", X.strip_ws) == "Action"


def test_tags_map(spark):
    assert one(spark, '{"t1":5}', X.tags_map) == {"t1": 5}
    assert one(spark, "[]", X.tags_map) == {}
    assert one(spark, None, X.tags_map) == {}


def test_split_keeps_empty(spark):
    assert one(spark, "", lambda c: X.split_strip(c, ",")) == [""]
    assert one(spark, "a, b ,", lambda c: X.split_strip(c, ",")) == ["a", "b", ""]


def test_whole_number(spark):
    assert one(spark, "85", X.whole_number) == 85
    assert one(spark, "85.7", X.whole_number) == 85
    assert one(spark, None, X.whole_number) == 0
    assert one(spark, "x", X.whole_number) == 0


def test_nbsp_and_tab_trimmed_in_genre_counts(spark):
    from shelfspark.plans.reports import genre_counts
    base = spark.createDataFrame([(" Action\t,\tRPG ",), ("Action",)], "genres string")
    got = {r["genre"]: r["count"] for r in genre_counts(base).collect()}
    assert got == {"Action": 2, "RPG": 1}


def test_age_distribution_null_age_counts_as_zero(spark):
    from shelfspark.plans.reports import age_distribution
    base = spark.createDataFrame([(None,), (0,), (-2,), (17,)], "required_age bigint")
    got = {r["age_category"]: r["number_of_games"] for r in age_distribution(base).collect()}
    assert got == {"1. Everyone": 2, "Everyone": 1, "4. Mature": 1}

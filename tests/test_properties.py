"""Property checks: report sums, last-wins, work list, statuses."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfspark import schema as S
from shelfspark.operators import ingest
from shelfspark.plans.reports import genre_counts

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

genre = st.sampled_from(["Action", " RPG", "Indie ", "", " Sim", "Action"])
genres_text = st.lists(genre, min_size=0, max_size=4).map(", ".join)


@SETTINGS
@given(st.lists(genres_text, min_size=1, max_size=30))
def test_genre_counts_sum_to_exploded_tokens(spark, texts):
    base = spark.createDataFrame([(t,) for t in texts], "genres string")
    got = {r["genre"]: r["count"] for r in genre_counts(base).collect()}
    expected: dict[str, int] = {}
    for t in texts:
        for tok in t.split(","):
            key = tok.strip()
            expected[key] = expected.get(key, 0) + 1
    assert got == expected
    assert sum(got.values()) == sum(len(t.split(",")) for t in texts)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 12), st.text(max_size=3)),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])))
def test_last_wins_is_highest_batch_and_idempotent(spark, rows):
    df = spark.createDataFrame([(str(k), b, v) for k, b, v in rows], "app_id string, b long, v string")
    once = {r["app_id"]: (r["b"], r["v"]) for r in ingest.last_wins(df, "app_id", "b").collect()}
    expected: dict[str, tuple[int, str]] = {}
    for k, b, v in sorted(rows, key=lambda r: r[1]):  # replay in batch order, dict.update style
        expected[str(k)] = (b, v)
    assert once == expected
    twice = ingest.last_wins(ingest.last_wins(df, "app_id", "b").unionByName(df), "app_id", "b")
    assert {r["app_id"]: (r["b"], r["v"]) for r in twice.collect()} == once


status_row = st.tuples(st.integers(0, 15), st.sampled_from([S.PROCESSED, S.DISCARDED, S.NOT_RELEASED]))


@SETTINGS
@given(st.lists(status_row, max_size=20), st.booleans())
def test_work_list_excludes_known_apps(spark, rows, released):
    apps = spark.createDataFrame([(str(i),) for i in range(16)], "app_id string")
    status = spark.createDataFrame([(str(a), s) for a, s in rows], "app_id string, status string")
    work = {r[0] for r in ingest.work_list(apps, status, released).collect()}
    skip = {S.PROCESSED, S.DISCARDED} | ({S.NOT_RELEASED} if released else set())
    known = {str(a) for a, s in rows if s in skip}
    assert work == {str(i) for i in range(16)} - known


outcome = st.sampled_from(["added", "not_released", "discarded", "failed"])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10), outcome), max_size=15, unique_by=lambda r: r[0]))
def test_update_status_matches_set_semantics(spark, outs):
    old = [("1", S.NOT_RELEASED), ("2", S.PROCESSED), ("3", S.DISCARDED)]
    status = spark.createDataFrame(old, "app_id string, status string")
    outcomes = spark.createDataFrame([(str(a), o) for a, o in outs], "app_id string, outcome string")
    got = {tuple(r) for r in ingest.update_status(status, outcomes).collect()}
    sets = {S.PROCESSED: {"2"}, S.DISCARDED: {"3"}, S.NOT_RELEASED: {"1"}}
    for a, o in outs:
        a = str(a)
        if o == "added":
            sets[S.PROCESSED].add(a)
            sets[S.NOT_RELEASED].discard(a)
        elif o == "not_released":
            sets[S.NOT_RELEASED].add(a)
        elif o == "discarded":
            sets[S.DISCARDED].add(a)
    assert got == {(a, s) for s, ids in sets.items() for a in ids}


_FIELDS = {
    "name": st.text(alphabet="ab ", max_size=4),
    "required_age": st.integers(-3, 30),
    "price": st.sampled_from([0.0, 1.5, 19.99]),
    "windows": st.booleans(),
    "genres": st.lists(st.sampled_from(["Action", "RPG", ""]), max_size=3),
    "estimated_owners": st.sampled_from(["", "0 - 0", "100 - 200"]),
}
record = st.fixed_dictionaries({}, optional={k: st.one_of(st.none(), v) for k, v in _FIELDS.items()})


@SETTINGS
@given(st.lists(record, min_size=1, max_size=10))
def test_flatten_matches_dict_get_defaults(spark, records):
    import json

    from shelfspark.operators.flatten import flatten_records
    rows = [(str(i), json.dumps(r)) for i, r in enumerate(records)]
    got = {r["app_id"]: r for r in flatten_records(
        spark.createDataFrame(rows, "app_id string, record string")).collect()}
    defaults = {n: d for n, _, d in S.BASE_COLUMNS}
    for i, rec in enumerate(records):
        out = got[str(i)]
        for name in _FIELDS:
            if name == "genres":
                expected = ", ".join(rec.get("genres") or [])   # NULL list = empty list
            else:
                expected = rec.get(name, defaults[name])        # absent -> default, null stays null
            assert out[name] == expected, (name, rec)


# Independent models of the rules (written from the spec, character by character).

def _py_price(s):
    """Keep digits and dots; a number needs a digit and at most one dot; else 0.0."""
    kept = "".join(ch for ch in s if ch.isascii() and (ch.isdigit() or ch == "."))
    ok = kept.count(".") <= 1 and any(ch.isdigit() for ch in kept)
    return float(kept) if ok else 0.0


def _py_safe_int(v, default=0):
    """Without '+' and surrounding blanks: optional '-', digit groups joined by '_'."""
    t = str(v).replace("+", "").strip()
    body = t[1:] if t.startswith("-") else t
    groups = body.split("_")
    if body and all(g and g.isascii() and g.isdigit() for g in groups):
        value = int("".join(groups))
        return -value if t.startswith("-") else value
    return default


def _drop_tags(t):
    """Remove each '<' + at least one non-'<' character + up to the nearest
    following '>' (the first character after '<' may itself be a '>')."""
    out, i = [], 0
    while i < len(t):
        if t[i] == "<" and i + 1 < len(t) and t[i + 1] != "<":
            j = i + 2
            while j < len(t) and t[j] not in "<>":
                j += 1
            if j < len(t) and t[j] == ">":
                i = j + 1
                continue
        out.append(t[i])
        i += 1
    return "".join(out)


def _py_sanitize(t):
    return " ".join(_drop_tags(t).split()) if t else t


def _one_col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789.$,Fre ", max_size=8), min_size=1, max_size=25))
def test_price_to_float_matches_python(spark, texts):
    from shelfspark.functions.text import price_to_float
    assert _one_col(spark, texts, price_to_float) == [_py_price(t) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789+-_ .ab", max_size=7), min_size=1, max_size=25))
def test_safe_int_matches_python(spark, texts):
    from shelfspark.functions.text import safe_int
    assert _one_col(spark, texts, safe_int) == [_py_safe_int(t) for t in texts]


@settings(max_examples=40, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<>/p \t\n\xa0", max_size=12), min_size=1, max_size=40))
def test_sanitize_matches_python(spark, texts):
    from shelfspark.functions.text import sanitize_text
    assert _one_col(spark, texts, sanitize_text) == [_py_sanitize(t) for t in texts]


def _py_languages(text):
    """Tokens of the tag-free text (legend removed) split on ', '; '*' marks full audio."""
    if text is None:
        return [], []
    tokens = _drop_tags(text).replace("languages with full audio support", "").split(", ")
    return ([tok.replace("*", "") for tok in tokens],
            [tok.replace("*", "") for tok in tokens if "*" in tok])


lang_piece = st.sampled_from(["English", "French", "*", ", ", "<br>", "<strong>*</strong>",
                              "languages with full audio support", " ", "De"])


@SETTINGS
@given(st.lists(st.lists(lang_piece, max_size=6).map("".join), min_size=1, max_size=20))
def test_language_lists_match_python(spark, texts):
    from shelfspark.functions.text import full_audio_languages, supported_languages
    got_s = _one_col(spark, texts, supported_languages)
    got_f = _one_col(spark, texts, full_audio_languages)
    expected = [_py_languages(t) for t in texts]
    assert got_s == [e[0] for e in expected]
    assert got_f == [e[1] for e in expected]

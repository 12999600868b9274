"""Personal data: pattern spans, then information-theoretic sanitisation.

Entities (e-mail addresses, IP addresses, card and phone numbers) are found by
expressions and checks. Words (runs of letters, marks and digits of any length,
outside entities) may give an entity away as well: how strongly a word t reveals an entity e is estimated from co-occurrence over the
whole corpus as PMI(t, e) / IC(e), with PMI = log(N * n(t,e) / (n(t) * n(e))) and
IC = log(N / n(e)), n being numbers of whole documents that hold the word, the
entity or both. A word that always comes with the entity scores 1. Words that
come with the same entity in at least ``least_texts`` different texts and score ``remove_at`` or more are removed,
those from ``generalise_at`` on are generalised to a placeholder, wherever they
occur in any text.

DataFrame functions only. Spans come from splitting the text at the matches and
adding up lengths, so they count code points. Expressions are possessive and
anchored to the run they begin in, sums run chunk by chunk and texts are cut up
block by block, so the time is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted, register, semi_join_ids, span_digest, stored, table

# Kinds and their expressions; each begins where its first run of
# characters begins or where the last match ended.
BASE_KINDS = ["email", "ip", "card", "phone"]
OWN_KINDS = ["term_removed", "term_generalised"]
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_VALID = rf"^{PART}(?:\.{PART}){{3}}$"
# what a text must hold for the kind to be looked for at all
HINTS = {"ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}"}
TERM_CHAR = r"[\p{L}\p{M}\p{N}]"
TERM = TERM_CHAR + "++"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
                "term_removed": "", "term_generalised": "[TERM]"}

MATCH = "array<struct<start:long,end:long,value:string>>"
CHUNK = 32  # elements that a running sum appends one by one; longer arrays are summed chunk by chunk
BLOCK = 4096  # code points that are cut up at once


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running_sums(numbers: Column, levels: int = 2) -> Column:
    """For each number of an array the sum of those before it, in time linear in the
    array: chunks are summed first, and their running sums continued inside each."""
    def inside(chunk: Column, before: Column) -> Column:
        begin = F.struct(before.alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(chunk, begin, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    zero = F.lit(0).cast("long")
    if levels == 0:
        return inside(numbers, zero)

    def chunks(all_numbers: Column) -> Column:  # an empty array has one empty chunk
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_numbers), F.lit(1)), F.lit(CHUNK))
        return F.transform(firsts, lambda i: F.slice(all_numbers, i, CHUNK))

    def sums(cs: Column) -> Column:
        return F.transform(cs, lambda c: F.aggregate(c, zero, lambda total, x: total + x))
    return _let(numbers, lambda ns: _let(chunks(ns), lambda cs: F.flatten(
        F.zip_with(cs, running_sums(sums(cs), levels - 1), inside))))


def matches(text: Column, pattern: str | Column) -> Column:
    """All matches with their places (code points, end exclusive)."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    parts = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    steps = F.zip_with(parts, values, lambda p, v: F.struct(F.length(p).cast("long").alias("gap"), v.alias("value")))

    def placed(s: Column) -> Column:
        long = F.transform(s, lambda x: x["gap"] + F.coalesce(F.length(x["value"]), F.lit(0)))
        found = F.zip_with(s, running_sums(long), lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value")))
        return F.filter(found, lambda m: m["value"].isNotNull())
    return _let(steps, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
        return total + twice
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _card_ok(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))


def entity_spans(text: Column) -> Column:
    """``array<struct<kind, start, end, value>>`` of the base kinds."""
    empty = F.array().cast(MATCH)
    t = F.coalesce(text, F.lit(""))
    found = {
        "email": F.when(t.contains("@"), matches(t, EMAIL)).otherwise(empty),
        "ip": F.filter(F.when(t.rlike(HINTS["ip"]), matches(t, IP)).otherwise(empty),
                       lambda m: m["value"].rlike(IP_VALID)),
        "card": F.filter(F.when(t.rlike(HINTS["card"]), matches(t, CARD)).otherwise(empty),
                         lambda m: _card_ok(m["value"])),
        "phone": F.filter(F.when(t.contains("+"), matches(t, PHONE)).otherwise(empty),
                          lambda m: F.length(_digits(m["value"])).between(10, 15)),
    }

    def named(kind: str) -> Column:
        return F.transform(found[kind], lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
    return F.concat(*[named(k) for k in BASE_KINDS])


def _replaced(text: Column, spans: Column, mark: Callable[[Column, Column, Column], Column]) -> Column:
    """The text without its spans, block by block; ``mark(span, at, until)`` stands for
    what a span newly covers of a block, from ``at`` (or its start, if later) to ``until``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def block(all_spans: Column, b: Column, i: Column) -> Column:
        first = i.cast("long") * BLOCK
        own = F.filter(all_spans, lambda s: (s["end"] > first) & (s["start"] < first + BLOCK))
        begin = F.struct(first.alias("at"), F.lit("").alias("out"))

        def add(acc, s):
            until = F.least(s["end"], first + BLOCK)
            piece = F.substring(b, (acc["at"] - first + 1).cast("int"),
                                F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
            return F.struct(F.greatest(until, acc["at"]).alias("at"),
                            F.concat(acc["out"], piece, mark(s, acc["at"], until)).alias("out"))
        return F.aggregate(own, begin, add, lambda acc: F.concat(
            acc["out"], F.substring(b, (acc["at"] - first + 1).cast("int"), F.lit(BLOCK))))
    cut = _let(ordered, lambda ss: F.array_join(F.transform(blocks, lambda b, i: block(ss, b, i)), ""))
    return F.when(F.size(spans) == 0, text).otherwise(cut)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces for all characters of the spans: places stay."""
    return _replaced(text, spans, lambda s, at, until: F.repeat(
        F.lit(" "), (until - F.greatest(s["start"], at)).cast("int")))


def _term(value: Column) -> Column:
    return F.xxhash64(F.lower(value))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), _term))


def _marked(texts: DataFrame, terms: DataFrame, most_broadcast: int) -> DataFrame:
    """``(row, own)``: all places of ``terms`` (term, kind) in ``texts`` (row, text).

    The distinct words of each text meet the terms first; places are looked for only
    in texts that hold a term, by an expression of that text's own terms.
    """
    words = texts.select("row", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))))
                         .alias("word"))
    held = words.withColumn("term", _term(F.col("word"))).join(counted(terms, most_broadcast), "term") \
        .groupBy("row").agg(*[F.collect_list(F.when(F.col("kind") == k, F.col("word"))).alias(k) for k in OWN_KINDS])

    def places(kind: str) -> Column:  # words hold no character with a meaning in expressions
        pattern = F.concat(F.lit(f"(?<!{TERM_CHAR})(?={TERM_CHAR})(?:"), F.array_join(kind, "|"),
                           F.lit(f")(?!{TERM_CHAR})"))
        return F.when(F.size(kind) > 0, F.transform(matches(F.col("text"), pattern), lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))).otherwise(F.array())
    return texts.join(held, "row").select("row", F.concat(*[places(k) for k in OWN_KINDS]).alias("own"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_texts: int = 2,
                       generalise_at: float = 0.7, remove_at: float = 0.95,
                       most_broadcast: int = 1_000_000) -> DataFrame:
    """One row per input row: ``(id, text_key, spans)``.

    ``text_key`` is a hash of the text, to tell rows apart that repeat an id.
    Spans are ``(kind, start, end)`` of the base kinds and of all occurrences of
    revealing terms in all texts (which may not overlap a base span); a term that
    reveals several entities is of the kind of its highest score. Texts are stored
    with their entities blanked out, and entities as hashes alone. NULL and empty
    texts have no spans; rows with a NULL id take part in the counts like any other;
    repeated rows each get their spans.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.select("id", F.xxhash64("text").alias("text_key"), "text", entity_spans(F.col("text")).alias("e"))
    # entities are looked for and blanked once; the number tells repeated rows apart
    texts = stored(found.select(
        F.monotonically_increasing_id().alias("row"), "id", "text_key",
        F.transform("e", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                            s["end"].alias("end"))).alias("spans"),
        F.array_distinct(F.transform("e", lambda s: F.xxhash64(s["kind"], F.lower(s["value"])))).alias("entities"),
        _blanked(F.col("text"), F.col("e")).alias("text")), "pii-texts")
    held = stored(texts.where(F.size("entities") > 0).select("text_key", "entities", _terms(F.col("text"))
                                                             .alias("terms")), "pii-held")

    # Co-occurrence in whole texts. Only entities and terms of enough different
    # texts can be reported, and as n(t,e) <= n(e) a score of generalise_at needs
    # n(t) <= N^(1 - generalise_at) * n(e)^generalise_at: all else is left out
    # before pairs are formed.
    n_docs = texts.count()
    of = stored(held.select("text_key", F.explode("entities").alias("entity"))
                .groupBy("text_key", "entity").agg(F.count("*").alias("m")), "pii-of")
    most = F.pow(F.lit(float(n_docs)), F.lit(1 - generalise_at)) * F.pow("n_e", F.lit(generalise_at)) * (1 + 1e-9)
    entities = stored(of.groupBy("entity").agg(F.count("*").alias("texts"), F.sum("m").alias("n_e"))
                      .where((F.col("texts") >= least_texts) & (F.col("n_e") < n_docs))
                      .select("entity", "n_e", most.alias("most")), "pii-entities")
    most_common = entities.agg(F.max("most")).first()[0]
    spans = texts.select("row", "id", "text_key", "spans")
    if most_common is not None:
        of = stored(of.join(counted(entities, most_broadcast), "entity"), "pii-of")
        candidates = semi_join_ids(held, stored(of.select("text_key").distinct(), "pii-keys"), "text_key") \
            .select("text_key", F.explode("terms").alias("term"))
        support = stored(candidates.distinct().groupBy("term").count().where(F.col("count") >= least_texts)
                         .select("term"), "pii-support")
        words = texts.select(F.explode(_terms(F.col("text"))).alias("term"))
        if support.count() <= most_broadcast:  # then only words of interest leave the scan
            n_t = words.join(F.broadcast(support), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
        else:
            n_t = words.groupBy("term").agg(F.count("*").alias("n_t")).join(support, "term", "left_semi")
        n_t = stored(n_t.where(F.col("n_t") <= most_common), "pii-words")
        pairs = candidates.join(counted(n_t, most_broadcast), "term").distinct().join(of, "text_key") \
            .where(F.col("n_t") <= F.col("most")).groupBy("entity", "term") \
            .agg(F.count("*").alias("texts"), F.sum("m").alias("n_te"), F.max("n_t").alias("n_t"),
                 F.max("n_e").alias("n_e")).where(F.col("texts") >= least_texts)
        n = F.lit(float(n_docs))
        ic = F.log(n / F.col("n_e"))
        pmi = F.log(n * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
        revealing = pairs.withColumn("disclosure", pmi / ic) \
            .where(F.col("disclosure") >= generalise_at) \
            .groupBy("term").agg(F.when(F.max("disclosure") >= remove_at, F.lit(OWN_KINDS[0]))
                                 .otherwise(F.lit(OWN_KINDS[1])).alias("kind"))
        own = _marked(texts.select("row", "text"), stored(revealing, "pii-terms"), most_broadcast)
        spans = spans.join(own, "row", "left").withColumn("spans", F.concat("spans", F.coalesce("own", F.array())))
    return spans.select("id", "text_key", "spans")


def sanitise(text: Column, spans: Column) -> Column:
    """The text with each span replaced: entities and generalised terms by a
    placeholder, removed terms by nothing. Spans that overlap are replaced as one, by
    the placeholder of the first."""
    marks = F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])
    return _replaced(text, spans, lambda s, at, until: F.when(
        s["start"] >= at, F.element_at(marks, s["kind"])).otherwise(""))


@register("op7_pii_sanitisation")
def op7(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return span_digest(found.select(F.col("id").alias("doc_id"), "spans"), BASE_KINDS, OWN_KINDS)

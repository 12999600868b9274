"""Column functions for catalog text.

All of these are built-in Spark expressions (JVM-side, whole-stage codegen);
none of them is a Python UDF. Each takes and returns a ``Column``.

Regex notes: ``(?U)`` makes Java's ``\\s`` and ``\\d`` Unicode-aware, like
Python's and Rust's; ``\\z`` is end-of-text (Java's ``$`` also matches before
a final newline).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Patterns and literals the catalog text is cleaned with.
EDGE_WHITESPACE = r"(?U)^\s+|(?<!\s)\s+\z"  # a run is tried from its start only
HTML_TAG = r"<[^<]+?>"
WHITESPACE_RUN = r"(?U)\s+"
NOT_PRICE_CHAR = r"[^0-9.]"
YEAR_AT_END = r", (\d{4})\z"
DIGITS_AT_END = r"(?<!\d)(\d+)\z"
FULL_AUDIO_LEGEND = "languages with full audio support"
LANGUAGE_SEPARATOR = ", "
LIST_SEPARATOR = ", "
DEFAULT_OWNERS = "0 - 0"
DIGIT_GROUPS = r"^-?[0-9]+(_[0-9]+)+$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing Unicode whitespace (SCL3, SCL16)."""
    return F.regexp_replace(_col(c), EDGE_WHITESPACE, "")


def split_literal(c: ColumnOrName, sep: str) -> Column:
    """Split on a literal separator; '' gives [''] (SCL1, SCL2)."""
    return F.split(_col(c), re.escape(sep))


def split_strip(c: ColumnOrName, sep: str) -> Column:
    """Split on ``sep`` and strip every piece."""
    return F.transform(split_literal(c, sep), strip_ws)


def extract_bigint(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """Regex group as BIGINT; no match (or out of range) gives NULL."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit("")).try_cast("bigint")


def release_year(c: ColumnOrName) -> Column:
    """Four-digit year after ', ' at the very end; else NULL (SCL4)."""
    return extract_bigint(c, YEAR_AT_END)


def owners_upper_bound(c: ColumnOrName) -> Column:
    """Drop commas, take the trailing digits as BIGINT (SCL5)."""
    return extract_bigint(F.replace(_col(c), F.lit(","), F.lit("")), DIGITS_AT_END)


def sanitize_text(c: ColumnOrName) -> Column:
    """Strip HTML tags, collapse whitespace runs to one space, strip (SCL10).

    NULL and '' pass through unchanged.
    """
    no_tags = F.regexp_replace(_col(c), HTML_TAG, "")
    return strip_ws(F.regexp_replace(no_tags, WHITESPACE_RUN, " "))


def price_to_float(c: ColumnOrName) -> Column:
    """Keep digits and dots, parse as DOUBLE; unparsable or NULL gives 0.0 (SCL11)."""
    digits = F.regexp_replace(_col(c), NOT_PRICE_CHAR, "")
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def safe_int(c: ColumnOrName, default: int = 0) -> Column:
    """Drop '+', parse as BIGINT; anything else gives ``default`` (SCL12).

    Like Python's ``int()``: surrounding whitespace is allowed, and so are
    single underscores between digits (``1_000``).
    """
    cleaned = F.trim(F.replace(_col(c).cast("string"), F.lit("+"), F.lit("")))
    grouped = F.when(cleaned.rlike(DIGIT_GROUPS), F.replace(cleaned, F.lit("_"), F.lit(""))) \
        .otherwise(cleaned)
    return F.coalesce(grouped.try_cast("bigint"), F.lit(default).cast("bigint"))


def whole_number(c: ColumnOrName, default: int = 0) -> Column:
    """A JSON number (int or float, as text) truncated to BIGINT; else ``default`` (SCL22)."""
    # whole digits directly: a DOUBLE would lose those above 2^53
    return F.coalesce(_col(c).try_cast("bigint"), _col(c).try_cast("double").try_cast("bigint"),
                      F.lit(default).cast("bigint"))


def fill_null(c: ColumnOrName, value) -> Column:
    """``fill_null`` (SCL6)."""
    return F.coalesce(_col(c), F.lit(value))


def join_list(c: ColumnOrName, sep: str = LIST_SEPARATOR) -> Column:
    """Join a string list; a NULL list is the empty list (SCL9)."""
    return F.array_join(F.coalesce(_col(c), F.array().cast("array<string>")), sep)


def cents_to_price(c: ColumnOrName) -> Column:
    """Cents to currency rounded to 2 places, missing gives 0.0 (SCL19)."""
    cents = F.coalesce(_col(c).try_cast("double"), F.lit(0.0))
    return F.round(cents * F.lit(0.01), 2)


def owners_text(c: ColumnOrName) -> Column:
    """'20,000 .. 50,000' -> '20000 - 50000'; missing gives '0 - 0' (SCL20)."""
    text = F.coalesce(_col(c), F.lit(DEFAULT_OWNERS))
    return F.replace(F.replace(text, F.lit(","), F.lit("")), F.lit(".."), F.lit("-"))


def _language_tokens(c: ColumnOrName) -> Column:
    no_tags = F.regexp_replace(_col(c), HTML_TAG, "")
    no_legend = F.replace(no_tags, F.lit(FULL_AUDIO_LEGEND), F.lit(""))
    return split_literal(no_legend, LANGUAGE_SEPARATOR)


def supported_languages(c: ColumnOrName) -> Column:
    """Language list from the HTML language text; NULL gives [] (SCL13)."""
    tokens = F.transform(_language_tokens(c), lambda x: F.replace(x, F.lit("*"), F.lit("")))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def full_audio_languages(c: ColumnOrName) -> Column:
    """Languages whose raw token carries '*' (SCL14)."""
    marked = F.filter(_language_tokens(c), lambda x: x.contains("*"))
    tokens = F.transform(marked, lambda x: F.replace(x, F.lit("*"), F.lit("")))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def strip_each(c: ColumnOrName) -> Column:
    """Strip every element of a string list; NULL list gives [] (SCL15)."""
    return F.transform(F.coalesce(_col(c), F.array().cast("array<string>")), strip_ws)


def size_or_null(c: ColumnOrName) -> Column:
    """Element count; NULL for a NULL array whatever the ANSI setting
    (``size(NULL)`` is -1 when ANSI mode is off)."""
    return F.when(_col(c).isNotNull(), F.size(_col(c)))


def list_size(c: ColumnOrName) -> Column:
    """Element count, NULL list counts 0 (SCL17)."""
    return F.when(_col(c).isNull(), F.lit(0)).otherwise(F.size(_col(c))).cast("bigint")


def descriptions(c: ColumnOrName) -> Column:
    """Array of {description} objects -> array of descriptions, default '' (PRJ9)."""
    items = F.coalesce(_col(c), F.array().cast("array<struct<description:string>>"))
    return F.transform(items, lambda x: F.coalesce(x["description"], F.lit("")))


def released_date(release: ColumnOrName) -> Column:
    """Release date text, '' while coming soon or missing (SCL23)."""
    r = _col(release)
    return F.when(F.coalesce(r["coming_soon"], F.lit(False)), F.lit("")) \
        .otherwise(F.coalesce(r["date"], F.lit("")))


def percent(count: ColumnOrName, total: ColumnOrName) -> Column:
    """round(100 * count / total, 2); NULL when total is 0 (SCL26)."""
    return F.round(F.lit(100.0) * _col(count) / F.nullif(_col(total), F.lit(0)), 2)


def tags_map(c: ColumnOrName) -> Column:
    """Tags text: a JSON object -> map; '[]', NULL or junk -> empty map."""
    parsed = F.from_json(_col(c), "map<string,bigint>")
    return F.coalesce(parsed, F.create_map().cast("map<string,bigint>"))

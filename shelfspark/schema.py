"""Fixed schemas of the catalog: raw payloads, normalised record, base table."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _array(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t, True)


# --- raw primary-store payload (the ``data`` object of one app) -------------
# required_age is STRING: it arrives as a number or as text such as "18+",
# and a STRING field keeps both spellings. The counters (score, totals) are
# STRING too so that 85 and 85.0 both convert like Python's int().
SUB_RAW = _struct(("option_text", S), ("option_description", S),
                  ("price_in_cents_with_discount", S))
PACKAGE_GROUP_RAW = _struct(("title", S), ("description", S), ("subs", _array(SUB_RAW)))
DESCRIPTION_ITEM = _struct(("description", S))

APP_DATA_RAW = _struct(
    ("type", S),
    ("name", S),
    ("is_free", B),
    ("required_age", S),
    ("price_overview", _struct(("final_formatted", S))),
    ("dlc", _array(S)),
    ("detailed_description", S),
    ("about_the_game", S),
    ("short_description", S),
    ("release_date", _struct(("coming_soon", B), ("date", S))),
    ("platforms", _struct(("windows", B), ("mac", B), ("linux", B))),
    ("metacritic", _struct(("score", S))),
    ("achievements", _struct(("total", S))),
    ("recommendations", _struct(("total", S))),
    ("content_descriptors", _struct(("notes", S))),
    ("supported_languages", S),
    ("developers", _array(S)),
    ("publishers", _array(S)),
    ("categories", _array(DESCRIPTION_ITEM)),
    ("genres", _array(DESCRIPTION_ITEM)),
    ("package_groups", _array(PACKAGE_GROUP_RAW)),
)

# One response body: {"<appid>": {"success": bool, "data": {...}}}
APP_ENVELOPE = _struct(("success", B), ("data", APP_DATA_RAW))
PRIMARY_BODY = T.MapType(S, APP_ENVELOPE, True)

# --- raw secondary statistics payload ---------------------------------------
# ``tags`` is an object or an empty list; it is parsed separately (see
# functions.text.tags_map), so the field is kept as text here. Numbers are text
# as well: the feed has them as integers, floats or quoted.
STATS_RAW = _struct(
    ("developer", S),
    ("userscore", S),
    ("score_rank", S),
    ("positive", S),
    ("negative", S),
    ("owners", S),
    ("average_forever", S),
    ("average_2weeks", S),
    ("median_forever", S),
    ("median_2weeks", S),
    ("ccu", S),
    ("tags", S),
)

# --- normalised record -------------------------------------------------------
SUB = _struct(("text", S), ("description", S), ("price", D))
PACKAGE = _struct(("title", S), ("description", S), ("subs", _array(SUB)))

RECORD = _struct(
    ("name", S), ("release_date", S), ("required_age", L), ("price", D),
    ("dlc_count", L), ("detailed_description", S), ("about_the_game", S),
    ("short_description", S), ("windows", B), ("mac", B), ("linux", B),
    ("metacritic_score", L), ("achievements", L), ("recommendations", L),
    ("notes", S), ("supported_languages", _array(S)),
    ("full_audio_languages", _array(S)), ("packages", _array(PACKAGE)),
    ("developers", _array(S)), ("publishers", _array(S)),
    ("categories", _array(S)), ("genres", _array(S)),
)

STATS_FIELDS = (
    ("user_score", L), ("score_rank", S), ("positive", L), ("negative", L),
    ("estimated_owners", S), ("average_playtime_forever", L),
    ("average_playtime_2weeks", L), ("median_playtime_forever", L),
    ("median_playtime_2weeks", L), ("peak_ccu", L),
    ("tags", T.MapType(S, L, True)),
)

ENRICHED_RECORD = T.StructType(RECORD.fields + [T.StructField(n, t, True) for n, t in STATS_FIELDS])

# --- base table (29 columns), with the value used when a key is missing ------
# Column order, types and missing-key defaults of the base table.
BASE_COLUMNS: list[tuple[str, T.DataType, object]] = [
    ("app_id", S, None),
    ("name", S, ""),
    ("release_date", S, ""),
    ("required_age", L, 0),
    ("price", D, 0.0),
    ("dlc_count", L, 0),
    ("support_email", B, False),
    ("windows", B, False),
    ("mac", B, False),
    ("linux", B, False),
    ("metacritic_score", L, 0),
    ("achievements", L, 0),
    ("recommendations", L, 0),
    ("supported_languages", S, []),
    ("full_audio_languages", S, []),
    ("developers", S, []),
    ("publishers", S, []),
    ("categories", S, []),
    ("genres", S, []),
    ("user_score", L, 0),
    ("score_rank", S, ""),
    ("positive", L, 0),
    ("negative", L, 0),
    ("estimated_owners", S, ""),
    ("average_playtime_forever", L, 0),
    ("average_playtime_2weeks", L, 0),
    ("median_playtime_forever", L, 0),
    ("median_playtime_2weeks", L, 0),
    ("peak_ccu", L, 0),
]

# Columns that hold lists in the record and ", "-joined text in the base table.
LIST_COLUMNS = ("supported_languages", "full_audio_languages", "developers",
                "publishers", "categories", "genres")

BASE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t, _ in BASE_COLUMNS])

# Status table of the incremental ingest: one row per (app_id, status).
STATUS_SCHEMA = _struct(("app_id", S), ("status", S))

# Status names.
PROCESSED, DISCARDED, NOT_RELEASED = "processed", "discarded", "notreleased"
ADDED, FAILED = "added", "failed"

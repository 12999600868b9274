"""Landed payload tables derived from the driver tables.

The driver ships no catalog payloads, so the ingest operators are exercised on
bodies that Spark builds from the adapter's base table: one primary body and
at most one statistics body per app, serialised with ``to_json``. The rules
below vary field presence, spelling and eligibility by the app key so every
branch of the ingest is taken; the oracle SQL derives the expected results
from the same base columns without any JSON.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testdata

# Markup used in the built bodies.
FULL_AUDIO_MARK = "<strong>*</strong>"
LEGEND = "<br><strong>*</strong>languages with full audio support"


def _k() -> Column:
    return F.col("app_id").cast("bigint")


def _mod(n: int, r: int) -> Column:
    return (_k() % F.lit(n)) == F.lit(r)


def _nullif_empty_list(text: Column, sep: str = ", ") -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, sep))


def primary_data(base: DataFrame) -> Column:
    """The ``data`` struct of one primary body, from a base-table row."""
    age = F.col("required_age").cast("string")
    age_text = (F.when(_mod(4, 0), F.concat(age, F.lit("+")))
                .when(_mod(4, 1), F.concat(F.lit(" "), age))
                .when(_mod(4, 2), F.concat(age, F.lit(".0")))
                .otherwise(age))
    price_overview = (F.when(_mod(11, 5), F.struct(F.lit("").alias("final_formatted")))
                      .when(_mod(13, 6), F.lit(None))
                      .otherwise(F.struct(F.concat(F.lit("$"), F.format_number("price", 2))
                                          .alias("final_formatted"))))
    first_marked = F.regexp_replace("supported_languages", "^([^,]*)", "$1" + FULL_AUDIO_MARK)
    languages = F.when(_mod(10, 7), F.lit(None)).otherwise(
        F.concat(first_marked, F.when(_mod(2, 0), F.lit(LEGEND)).otherwise(F.lit(""))))
    developers = F.transform(_nullif_empty_list(F.col("developers")),
                             lambda x: F.concat(F.lit(" "), x, F.lit("  ")))
    genres = F.transform(_nullif_empty_list(F.col("genres")), lambda g: F.struct(g.alias("description")))
    categories = F.array(F.struct(F.col("categories").alias("description")),
                         F.struct(F.lit(None).cast("string").alias("description")))
    subs = F.array(
        F.struct(F.lit(" Buy <i>now</i> ").alias("option_text"),
                 F.lit("std").alias("option_description"),
                 F.round(F.col("price") * 100).cast("bigint").alias("price_in_cents_with_discount")),
        F.struct(F.lit("Bundle").alias("option_text"),
                 F.lit(None).cast("string").alias("option_description"),
                 F.lit(None).cast("bigint").alias("price_in_cents_with_discount")))
    package_groups = F.when(_mod(3, 0), F.array(F.struct(
        F.concat(F.lit("<b>"), F.col("name"), F.lit("</b>")).alias("title"),
        F.concat(F.lit("Pack  of "), F.col("publishers")).alias("description"),
        subs.alias("subs"))))
    release = F.when(_mod(41, 0), F.lit(None)).otherwise(F.struct(
        (F.col("release_date") == "").alias("coming_soon"),
        F.when(F.col("release_date") == "", F.lit("Coming soon"))
         .otherwise(F.col("release_date")).alias("date")))
    return F.struct(
        F.when(_mod(7, 3), F.lit("dlc")).otherwise(F.lit("game")).alias("type"),
        F.concat(F.lit("  "), F.col("name"), F.lit(" ")).alias("name"),
        _mod(9, 4).alias("is_free"),
        age_text.alias("required_age"),
        price_overview.alias("price_overview"),
        F.when(_mod(8, 0), F.lit(None)).otherwise(
            F.array_repeat(F.lit("dlc"), (_k() % 4).cast("int"))).alias("dlc"),
        F.concat(F.lit("<p>"), F.col("genres"), F.lit("</p>\n\n  <br/>"), F.col("developers"))
         .alias("detailed_description"),
        release.alias("release_date"),
        F.struct(F.col("windows").alias("windows"),
                 F.when(_mod(6, 1), F.lit(None)).otherwise(F.col("mac")).alias("mac"),
                 F.col("linux").alias("linux")).alias("platforms"),
        F.when(_mod(5, 2), F.lit(None)).otherwise(
            F.struct(F.col("metacritic_score").alias("score"))).alias("metacritic"),
        F.struct(F.col("achievements").alias("total")).alias("achievements"),
        F.struct(F.col("recommendations").alias("total")).alias("recommendations"),
        F.struct(F.concat(F.lit("<i>"), F.col("categories"), F.lit("</i>")).alias("notes"))
         .alias("content_descriptors"),
        languages.alias("supported_languages"),
        developers.alias("developers"),
        F.array(F.col("publishers")).alias("publishers"),
        categories.alias("categories"),
        genres.alias("genres"),
        package_groups.alias("package_groups"),
    )


def primary_bodies(base: DataFrame) -> DataFrame:
    """``(app_id, body)``: one response body per app.

    An empty body for keys ≡ 0 (mod 43) and a non-JSON body for keys ≡ 0
    (mod 47): both are failures to retry.
    """
    envelope = F.struct((_k() % 19 != 0).alias("success"), primary_data(base).alias("data"))
    body = (F.when(_mod(43, 0), F.lit(""))
            .when(_mod(47, 0), F.lit("Service Unavailable"))
            .otherwise(F.to_json(F.create_map(F.col("app_id"), envelope))))
    return base.select("app_id", body.alias("body"))


def stats_bodies(base: DataFrame) -> DataFrame:
    """``(app_id, body)`` of the statistics feed, one per app.

    Invalid on purpose (so the app stays unmatched): blank developer for apps
    without positive reviews and for keys ≡2 (mod 7), rate-limit text (≡3 mod
    17), blank body (≡4 mod 23). ``tags`` is an object for even keys, ``[]``
    else.
    """
    lo_hi = F.split(F.col("estimated_owners"), " - ")
    owners = F.when(F.col("estimated_owners") == "", F.lit(None)).otherwise(F.concat(
        F.format_number(lo_hi[0].cast("bigint"), 0), F.lit(" .. "),
        F.format_number(lo_hi[1].cast("bigint"), 0)))
    fields = F.struct(
        F.when(_mod(7, 2) | (F.col("positive") <= 0), F.lit("")).otherwise(F.col("publishers"))
         .alias("developer"),
        F.col("metacritic_score").alias("userscore"),
        F.col("positive").alias("positive"),
        F.col("negative").alias("negative"),
        owners.alias("owners"),
        F.col("average_playtime_forever").alias("average_forever"),
        F.col("average_playtime_2weeks").alias("average_2weeks"),
        F.col("median_playtime_forever").alias("median_forever"),
        F.col("median_playtime_2weeks").alias("median_2weeks"),
        F.col("peak_ccu").alias("ccu"))
    tags = F.when(_mod(2, 0), F.to_json(F.create_map(
        F.lit("genre"), F.col("positive"), F.lit("brand"), F.col("negative")))).otherwise(F.lit("[]"))
    obj = F.to_json(fields)
    body = F.concat(F.regexp_replace(obj, "\\}\\z", ""), F.lit(',"tags":'), tags, F.lit("}"))
    body = (F.when(_mod(17, 3), F.lit("Too many connections"))
            .when(_mod(23, 4), F.lit("   "))
            .otherwise(body))
    return base.select("app_id", body.alias("body"))


_LANDED: dict[tuple[str, str], str] = {}
_LANDING_LOCK = threading.Lock()


def land(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the apps, primary and stats tables as Parquet under ``root``."""
    base = testdata.catalog(spark, sf_dir)
    # a landing zone holds many files (one per fetch batch); spread the bodies
    # over as many files as the session has cores so reads parse in parallel
    from ..session import parallelism
    files = parallelism(spark)
    base.select("app_id").write.mode("overwrite").parquet(f"{root}/apps")
    primary_bodies(base).repartition(files).write.mode("overwrite").parquet(f"{root}/primary")
    stats_bodies(base).repartition(files).write.mode("overwrite").parquet(f"{root}/stats")
    return root


def landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(apps, primary, stats)`` landed tables built from the driver tables.

    The bodies are written once per session to the shared folder and read
    back, as a real landing zone would be: the ingest plans then start from
    plain columns.
    """
    import hashlib
    import uuid

    from ..session import session_id, shared_path
    key = (session_id(spark), sf_dir)
    with _LANDING_LOCK:
        if key not in _LANDED:
            tag = f"{hashlib.sha1(sf_dir.encode()).hexdigest()[:10]}-{uuid.uuid4().hex}"
            _LANDED[key] = land(spark, sf_dir, shared_path(spark, "landing", tag))
    root = _LANDED[key]
    return tuple(spark.read.parquet(f"{root}/{t}") for t in ("apps", "primary", "stats"))

"""The thirteen catalog reports, each a lazy DataFrame plan over the base table.

Ordering rules (kept from the catalog's reports): descending sorts put NULL
first, ascending sorts put NULL first. Ties in top-10 lists are broken by the
key ascending, then ``app_id`` ascending, so every run gives the same rows.

Plan shape: list columns are split, exploded and aggregated with partial
(map-side) aggregation, so a hot genre or developer holding a third of all
rows is pre-combined in every task before the shuffle. Top-10 lists plan as
``TakeOrderedAndProject`` (per-partition top-k, no full sort).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import owners_upper_bound, release_year, split_literal, strip_ws
from ..operators.describe import describe
from ..operators.topk import top_k_distinct

TOP = 10
MIN_GROUP = 10


def _tokens(df: DataFrame, col: str, sep: str, alias: str, *keep: str) -> DataFrame:
    """split -> explode (NULL list keeps one NULL row) -> strip.

    Strip after the explode, not inside it: exploding the plain ``split``
    keeps the generator in whole-stage codegen (a lambda would not).
    """
    return (df.select(F.explode_outer(split_literal(col, sep)).alias("_token"), *keep)
            .select(strip_ws("_token").alias(alias), *keep))


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def _asc(c: str) -> Column:
    return F.col(c).asc_nulls_first()


def genre_counts(base: DataFrame) -> DataFrame:
    """Rows per genre ('' is a genre), most frequent first."""
    return (_tokens(base, "genres", ",", "genre")
            .groupBy("genre").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(_desc("count"), _asc("genre")))


def avg_price_by_genre(base: DataFrame) -> DataFrame:
    """R2: mean price per genre."""
    return (_tokens(base, "genres", ",", "genre", "price")
            .groupBy("genre").agg(F.avg("price").alias("avg_price"))
            .orderBy(_desc("avg_price"), _asc("genre")))


def top_10_dlc(base: DataFrame) -> DataFrame:
    """One row per name (its highest dlc_count), top 10."""
    return top_k_distinct(base, "name", "dlc_count", TOP)


def top_10_peak_ccu(base: DataFrame) -> DataFrame:
    """Top 10 rows by peak_ccu; names are not deduplicated."""
    return (base.select("name", "peak_ccu", "app_id")
            .orderBy(_desc("peak_ccu"), _asc("name"), _asc("app_id"))
            .limit(TOP).select("name", "peak_ccu"))


def platform_distribution(base: DataFrame) -> DataFrame:
    """One row, number of apps per platform flag."""
    return base.agg(F.count_if(F.col("windows")).alias("Windows"),
                    F.count_if(F.col("mac")).alias("Mac"),
                    F.count_if(F.col("linux")).alias("Linux"))


def top_10_languages(base: DataFrame) -> DataFrame:
    """Ten most frequent supported languages."""
    return (_tokens(base, "supported_languages", ",", "language")
            .groupBy("language").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(_desc("count"), _asc("language")).limit(TOP))


def top_10_developers(base: DataFrame) -> DataFrame:
    """Developers split on ';' (not ','), '' dropped, top 10 by games."""
    return (_tokens(base, "developers", ";", "developer", "price")
            .where(F.col("developer") != "")
            .groupBy("developer")
            .agg(F.count(F.lit(1)).alias("game_count"), F.avg("price").alias("average_price"))
            .orderBy(_desc("game_count"), _asc("developer")).limit(TOP))


def games_per_year(base: DataFrame) -> DataFrame:
    """Apps per release year; dates without ', YYYY' at the end are NULL."""
    return (base.select(release_year("release_date").alias("release_year"))
            .groupBy("release_year").agg(F.count(F.lit(1)).alias("game_count"))
            .orderBy(_asc("release_year")))


def games_highest_ownership(base: DataFrame) -> DataFrame:
    """Top 10 by the owners upper bound, NULL (no number) first."""
    return (base.select("name", "app_id",
                        owners_upper_bound("estimated_owners").alias("estimated_owners_num"))
            .orderBy(_desc("estimated_owners_num"), _asc("name"), _asc("app_id"))
            .limit(TOP).select("name", "estimated_owners_num"))


def avg_positive_negative_by_genre(base: DataFrame) -> DataFrame:
    """Reviewed apps only; mean reviews per genre, genres with >= 10 apps."""
    return (base.where((F.col("positive") > 0) & (F.col("negative") > 0))
            .transform(lambda d: _tokens(d, "genres", ",", "genre", "positive", "negative"))
            .groupBy("genre")
            .agg(F.avg("positive").alias("average_positive_reviews"),
                 F.avg("negative").alias("average_negative_reviews"),
                 F.count(F.lit(1)).alias("game_count"))
            .where(F.col("game_count") >= MIN_GROUP)
            .orderBy(_desc("average_positive_reviews"), _asc("genre")))


def price_distribution(base: DataFrame) -> DataFrame:
    """describe(price) — nine statistics."""
    return describe(base, "price")


def top_developers_user_score(base: DataFrame) -> DataFrame:
    """Developers split on ',', mean recommendations, >= 10 apps, top 10."""
    return (_tokens(base, "developers", ",", "developer", "recommendations")
            .groupBy("developer")
            .agg(F.avg("recommendations").alias("average_recommendations"),
                 F.count(F.lit(1)).alias("game_count"))
            .where(F.col("game_count") >= MIN_GROUP)
            .orderBy(_desc("average_recommendations"), _asc("developer")).limit(TOP))


# Age buckets, inclusive, first match wins.
AGE_BUCKETS = (
    (-1, 8, "1. Everyone"),
    (8, 12, "2. PG"),
    (12, 16, "3. Teen"),
)
AGE_MATURE_FROM, AGE_MATURE = 17, "4. Mature"
AGE_OTHER = "Everyone"


def age_category(age: Column) -> Column:
    out = None
    for lo, hi, label in AGE_BUCKETS:
        cond = age.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when(age >= AGE_MATURE_FROM, F.lit(AGE_MATURE)).otherwise(F.lit(AGE_OTHER))


def age_distribution(base: DataFrame) -> DataFrame:
    """Apps per age category (NULL age counts as 0)."""
    age = F.coalesce(F.col("required_age"), F.lit(0)).cast("bigint")
    return (base.select(age_category(age).alias("age_category"))
            .groupBy("age_category").agg(F.count(F.lit(1)).alias("number_of_games"))
            .orderBy(_asc("age_category")))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "genre_counts": genre_counts,
    "avg_price_by_genre": avg_price_by_genre,
    "top_10_dlc": top_10_dlc,
    "top_10_peak_ccu": top_10_peak_ccu,
    "platform_distribution": platform_distribution,
    "top_10_languages": top_10_languages,
    "top_10_developers": top_10_developers,
    "games_per_year": games_per_year,
    "games_highest_ownership": games_highest_ownership,
    "avg_positive_negative_by_genre": avg_positive_negative_by_genre,
    "price_distribution": price_distribution,
    "top_developers_user_score": top_developers_user_score,
    "age_distribution": age_distribution,
}


def generate_reports(base: DataFrame) -> dict[str, DataFrame]:
    """All reports as lazy plans, keyed by table name."""
    return {name: fn(base) for name, fn in REPORTS.items()}

"""All thirteen reports from two scans of the base table.

Scan 1, ``report_groups``: every row becomes its (dimension, key) pairs with the measures
that the reports of that dimension need, and one aggregation, partial in each task, makes
one row per pair: genres (R1, R2, R10), languages (R6), the two developer splits (R7, R12),
years (R8), age categories (R13), names (R3), prices (R11) and the platforms (R5). It is
written once, in a folder per dimension, so a report reads its own dimension only.

Scan 2, ``ranked_rows``: the rows of the two lists that keep single rows (R4, R9). Each task
keeps ten rows per list before the shuffle (a window group limit), so at most twenty rows
of a task are shuffled.

The rows equal those of ``reports``; averages are sums over counts in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import owners_upper_bound, release_year, split_literal, strip_ws
from ..operators.describe import describe_histogram
from . import reports as R

GENRE, LANGUAGE, DEVELOPER, CREDIT = "genre", "language", "developer", "credited_developer"
YEAR, AGE, NAME, PRICE, PLATFORM = "year", "age", "name", "price", "platform"
GROUP_SCHEMA = ("dimension string, key string, value double, n bigint, avg1 double, max1 bigint, "
                "nulls1 bigint, reviewed bigint, avg_positive double, avg_negative double")
PEAK, OWNERS = "peak_ccu", "estimated_owners_num"


def _entry(dimension: str, key: Column | None = None, value: Column | None = None, measure: Column | None = None,
           whole: Column | None = None, positive: Column | None = None, negative: Column | None = None) -> Column:
    def typed(c: Column | None, kind: str) -> Column:
        return (F.lit(None) if c is None else c).cast(kind)
    return F.struct(F.lit(dimension).alias("dimension"), typed(key, "string").alias("key"),
                    typed(value, "double").alias("value"), typed(measure, "double").alias("measure"),
                    typed(whole, "bigint").alias("whole"), typed(positive, "double").alias("positive"),
                    typed(negative, "double").alias("negative"))


def _tokens(column: str, separator: str, entry) -> Column:
    """An entry per token; a NULL list is one entry with a NULL key."""
    tokens = F.coalesce(split_literal(column, separator), F.array(F.lit(None).cast("string")))
    return F.transform(tokens, lambda t: entry(strip_ws(t)))


def _entries() -> Column:
    """A row's entries in all dimensions."""
    reviewed = (F.col("positive") > 0) & (F.col("negative") > 0)
    age = F.coalesce(F.col("required_age"), F.lit(0)).cast("bigint")
    single = F.array(
        _entry(YEAR, release_year("release_date")),
        _entry(AGE, R.age_category(age)),
        _entry(NAME, F.col("name"), whole=F.col("dlc_count")),
        _entry(PRICE, value=F.col("price")))
    flags = F.array(*[F.when(F.col(c), _entry(PLATFORM, F.lit(c))) for c in ("windows", "mac", "linux")])
    return F.concat(
        _tokens("genres", ",", lambda t: _entry(
            GENRE, t, measure=F.col("price"), positive=F.when(reviewed, F.col("positive")),
            negative=F.when(reviewed, F.col("negative")))),
        _tokens("supported_languages", ",", lambda t: _entry(LANGUAGE, t)),
        _tokens("developers", ";", lambda t: _entry(DEVELOPER, t, measure=F.col("price"))),
        _tokens("developers", ",", lambda t: _entry(CREDIT, t, measure=F.col("recommendations"))),
        single, F.filter(flags, lambda e: e.isNotNull()))


def report_groups(base: DataFrame) -> DataFrame:
    """One row per (dimension, key): counts and means of its rows."""
    return (base.select(F.inline(_entries()))
            .groupBy("dimension", "key", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("measure").alias("avg1"),
                 F.max("whole").alias("max1"), F.count_if(F.col("whole").isNull()).alias("nulls1"),
                 F.count("positive").alias("reviewed"), F.avg("positive").alias("avg_positive"),
                 F.avg("negative").alias("avg_negative")))


def ranked_rows(base: DataFrame) -> DataFrame:
    """``(list, rank, name, figure)``: the first ten rows of R4 and of R9."""
    figure = [F.struct(F.lit(PEAK).alias("list"), F.col("peak_ccu").cast("bigint").alias("figure")),
              F.struct(F.lit(OWNERS).alias("list"), owners_upper_bound("estimated_owners").cast("bigint").alias("figure"))]
    rows = base.select("name", "app_id", F.inline(F.array(*figure)))
    order = Window.partitionBy("list").orderBy(R._desc("figure"), R._asc("name"), R._asc("app_id"))
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= R.TOP)
            .select("list", "rank", "name", "figure"))


def store_groups(base: DataFrame, path: str) -> DataFrame:
    """Write ``report_groups``, a folder per dimension, and read it back."""
    report_groups(base).write.mode("overwrite").partitionBy("dimension").parquet(path)
    return base.sparkSession.read.schema(GROUP_SCHEMA).parquet(path)


def reports_from_groups(groups: DataFrame, ranked: DataFrame) -> dict[str, DataFrame]:
    """The thirteen reports, by table name, from the stored groups and the ranked rows.

    ``price_distribution`` looks at the price groups while its plan is built.
    """
    def of(dimension: str) -> DataFrame:
        return groups.where(F.col("dimension") == dimension)

    def top(name: str, out: str) -> DataFrame:
        return (ranked.where(F.col("list") == name).orderBy("rank").limit(R.TOP)
                .select("name", F.col("figure").alias(out)))

    genre, credit = of(GENRE).withColumnRenamed("key", "genre"), of(CREDIT).withColumnRenamed("key", "developer")
    developer = of(DEVELOPER).withColumnRenamed("key", "developer")
    flag = {c: F.coalesce(F.sum(F.when(F.col("key") == c.lower(), F.col("n"))), F.lit(0)).alias(c)
            for c in ("Windows", "Mac", "Linux")}
    return {
        "genre_counts": genre.select("genre", F.col("n").alias("count")).orderBy(R._desc("count"), R._asc("genre")),
        "avg_price_by_genre": genre.select("genre", F.col("avg1").alias("avg_price"))
        .orderBy(R._desc("avg_price"), R._asc("genre")),
        "top_10_dlc": of(NAME).select(F.col("key").alias("name"),
                                      F.when(F.col("nulls1") == 0, F.col("max1")).alias("dlc_count"))
        .orderBy(R._desc("dlc_count"), R._asc("name")).limit(R.TOP),
        "top_10_peak_ccu": top(PEAK, "peak_ccu"),
        "platform_distribution": of(PLATFORM).agg(*flag.values()),
        "top_10_languages": of(LANGUAGE).select(F.col("key").alias("language"), F.col("n").alias("count"))
        .orderBy(R._desc("count"), R._asc("language")).limit(R.TOP),
        "top_10_developers": developer.where(F.col("developer") != "")
        .select("developer", F.col("n").alias("game_count"), F.col("avg1").alias("average_price"))
        .orderBy(R._desc("game_count"), R._asc("developer")).limit(R.TOP),
        "games_per_year": of(YEAR).select(F.col("key").cast("bigint").alias("release_year"),
                                          F.col("n").alias("game_count")).orderBy(R._asc("release_year")),
        "games_highest_ownership": top(OWNERS, "estimated_owners_num"),
        "avg_positive_negative_by_genre": genre.where(F.col("reviewed") >= R.MIN_GROUP)
        .select("genre", F.col("avg_positive").alias("average_positive_reviews"),
                F.col("avg_negative").alias("average_negative_reviews"), F.col("reviewed").alias("game_count"))
        .orderBy(R._desc("average_positive_reviews"), R._asc("genre")),
        "price_distribution": describe_histogram(of(PRICE).select(F.col("value").alias("v"), F.col("n").alias("c")),
                                                 "price"),
        "top_developers_user_score": credit.where(F.col("n") >= R.MIN_GROUP)
        .select("developer", F.col("avg1").alias("average_recommendations"), F.col("n").alias("game_count"))
        .orderBy(R._desc("average_recommendations"), R._asc("developer")).limit(R.TOP),
        "age_distribution": of(AGE).select(F.col("key").alias("age_category"), F.col("n").alias("number_of_games"))
        .orderBy(R._asc("age_category")),
    }


def fused_reports(spark: SparkSession, base: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The thirteen reports over ``base``; the groups and ranked rows are written under ``folder``."""
    groups = store_groups(base, f"{folder}/groups")
    ranked_rows(base).write.mode("overwrite").parquet(f"{folder}/ranked")
    return reports_from_groups(groups, spark.read.parquet(f"{folder}/ranked"))

"""Registered queries of the splittable scans, the run registry, the landing watermark,
the quarantine, chunk manifests, the cached app list and the published tables' contents,
with their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import ingest
from ..sinks import files as sinks
from ..sources import files as sources
from ..sources import keyed, payloads, testdata
from . import jobs
from .app_list_cache import resolve_app_list
from .ingest_queries import SANITIZE_SQL, _prior_status, _scratch, _with_cls, _with_src
from .queries import ORACLE, register, round_doubles, with_base

CHUNK = 500
NOTE = '},"{ [\\'  # separators, quotes and an escape inside a string

CATALOG_SQL = with_base("""SELECT app_id, name, genres, CAST(required_age AS BIGINT) AS required_age,
    name || '},"{ [\\' AS note FROM base""")


def _write_objects(base: DataFrame, path: str, member, open_: str, between: str, close: str) -> str:
    """Files of one object each, of at most about ``CHUNK`` records; returns their glob."""
    records = base.select("app_id", F.struct(
        "name", "genres", "required_age", F.concat("name", F.lit(NOTE)).alias("note")).alias("record"))
    n = max(1, -(-base.count() // CHUNK))
    rows = records.select(F.pmod(F.xxhash64("app_id"), F.lit(n)).alias("file"), member(F.col("app_id"), F.col("record"))
                          .alias("m"))
    text = F.concat(F.lit(open_), F.array_join(F.collect_list("m"), between), F.lit(close))
    rows.groupBy("file").agg(text.alias("value")).write.partitionBy("file").text(path)
    return f"{path}/file=*"


def _fields(found: DataFrame) -> DataFrame:
    def value(name: str) -> Column:
        return F.get_json_object("record", f"$.{name}")
    return found.select("app_id", value("name").alias("name"), value("genres").alias("genres"),
                        value("required_age").cast("bigint").alias("required_age"), value("note").alias("note"))


@register("indented_catalog_scan", CATALOG_SQL)
def indented_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indented ``{app_id: record}`` files, cut at record ends."""
    def member(app_id: Column, record: Column) -> Column:
        pretty = F.regexp_replace(F.to_json(record, {"pretty": "true"}), "\n", "\n    ")
        return F.concat(F.lit('    "'), app_id, F.lit('": '), pretty)
    path = _write_objects(testdata.catalog(spark, sf_dir), _scratch(spark, "indented", sf_dir), member, "{\n", ",\n", "\n}")
    return _fields(keyed.indented_catalog(spark, path))


@register("one_line_catalog_scan", CATALOG_SQL)
def one_line_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-line ``{app_id: record}`` files, cut at braces and put together again."""
    def member(app_id: Column, record: Column) -> Column:
        return F.concat(F.lit('"'), app_id, F.lit('": '), F.to_json(record))
    path = _write_objects(testdata.catalog(spark, sf_dir), _scratch(spark, "one_line", sf_dir), member, "{", ", ", "}")
    return _fields(keyed.one_line_catalog(spark, path))


@register("ingest_two_sources", ORACLE["ingest_stream_status"])
def ingest_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams of two landing folders into one root."""
    from ..streaming.landing import ingest_stream
    root = _scratch(spark, "ingest_two_sources", sf_dir)
    _, primary, stats = payloads.landed(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    for part in (0, 1):
        primary.where(k % 2 == part).write.parquet(f"{root}/landing{part}/part=0")
        ingest_stream(spark, f"{root}/landing{part}/part=*", f"{root}/out", stats=stats,
                      checkpoint=f"{root}/checkpoint{part}", merge_each_batch=False).awaitTermination()
    return jobs.current_status(spark, f"{root}/out")


@register("ingest_landing_zone", ORACLE["ingest_stream_status"])
def ingest_landing_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed partitions; the second run reads only what the first has not."""
    from .landing_zone import ingest_landed
    root = _scratch(spark, "ingest_landing_zone", sf_dir)
    apps, primary, stats = payloads.landed(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    for part in (0, 1):
        primary.where(k % 2 == part).select("app_id", "body", F.lit(part).cast("bigint").alias("landed_at")) \
            .write.parquet(f"{root}/zone/landed={part}")
        ingest_landed(spark, f"{root}/out", apps, f"{root}/zone", stats)
    return jobs.current_status(spark, f"{root}/out")


@register("quarantined_lines", """
SELECT CASE WHEN p_partkey % 13 = 0 THEN 'broken' ELSE 'good' END AS kind, count(*) AS n,
       CAST(sum(CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_partkey END) AS BIGINT) AS keys FROM part GROUP BY 1""")
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines of which some are cut: rows that parse, and a counted quarantine."""
    root = _scratch(spark, "quarantine", sf_dir)
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name")
    line = F.to_json(F.struct("p_partkey", "p_name"))
    part.select(F.when(F.col("p_partkey") % 13 == 0, F.expr("left(to_json(struct(p_partkey, p_name)), 12)"))
                .otherwise(line).alias("value")).write.text(f"{root}/lines")
    good, broken = sources.quarantined_lines(spark, f"{root}/lines", part.schema, f"{root}/quarantine")
    both = good.select(F.lit("good").alias("kind"), "p_partkey").unionByName(
        broken.select(F.lit("broken").alias("kind"), F.lit(0).cast("bigint").alias("p_partkey")))
    return both.groupBy("kind").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys"))


# --- contents of every published table (DF5) -------------------------------------------------------

# Columns of the reports' tables: d double, l whole number, s text.
REPORT_COLUMNS = {
    "genre_counts": {"genre": "s", "count": "l"},
    "avg_price_by_genre": {"genre": "s", "avg_price": "d"},
    "top_10_dlc": {"name": "s", "dlc_count": "l"},
    "top_10_peak_ccu": {"name": "s", "peak_ccu": "l"},
    "platform_distribution": {"Windows": "l", "Mac": "l", "Linux": "l"},
    "top_10_languages": {"language": "s", "count": "l"},
    "top_10_developers": {"developer": "s", "game_count": "l", "average_price": "d"},
    "games_per_year": {"release_year": "l", "game_count": "l"},
    "games_highest_ownership": {"name": "s", "estimated_owners_num": "l"},
    "avg_positive_negative_by_genre": {"genre": "s", "average_positive_reviews": "d",
                                       "average_negative_reviews": "d", "game_count": "l"},
    "price_distribution": {"statistic": "s", "price": "d"},
    "top_developers_user_score": {"developer": "s", "average_recommendations": "d", "game_count": "l"},
    "age_distribution": {"age_category": "s", "number_of_games": "l"},
}
_KINDS = {"double": "d", "bigint": "l", "boolean": "b", "string": "s"}
PUBLISHED_COLUMNS = {"catalog": {n: _KINDS[t.simpleString()] for n, t, _ in S.BASE_COLUMNS}, **REPORT_COLUMNS}


def _contents_sql() -> str:
    """Rows of each table and the sum of their hashes; doubles count to six places."""
    def text(column: str, kind: str) -> str:
        value = f'CAST(round("{column}" * 1000000) AS BIGINT)' if kind == "d" else f'"{column}"'
        return f"coalesce(CAST({value} AS VARCHAR), '~')"

    def table(name: str, columns: dict[str, str], rows: str) -> str:
        line = " || '|' || ".join(text(c, k) for c, k in columns.items())
        return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
  CAST(coalesce(sum(CAST('0x' || substr(md5({line}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest FROM ({rows}) t"""
    sources_ = {"catalog": with_base("SELECT * FROM base"), **{n: ORACLE[n] for n in REPORT_COLUMNS}}
    return "\nUNION ALL\n".join(table(n, c, sources_[n]) for n, c in PUBLISHED_COLUMNS.items())


@register("published_contents", _contents_sql())
def published_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and contents of every table that the publish job wrote, read back from Parquet."""
    from functools import reduce
    paths = jobs.publish(testdata.catalog(spark, sf_dir), _scratch(spark, "published_contents", sf_dir))

    def text(column: str, kind: str) -> Column:
        value = F.round(F.col(column) * 1000000).cast("bigint") if kind == "d" else F.col(column)
        return F.coalesce(value.cast("string"), F.lit("~"))

    def contents(name: str, columns: dict[str, str]) -> DataFrame:
        line = F.concat_ws("|", *[text(c, k) for c, k in columns.items()])
        part = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")
        return spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(
            F.sum(part), F.lit(0)).alias("digest")).select(F.lit(name).alias("table_name"), "row_count", "digest")
    return reduce(DataFrame.unionByName, [contents(n, c) for n, c in PUBLISHED_COLUMNS.items()])


# --- chunk manifests (SNK2, SRC4) and the cached app list (SRC3) ---------------------------------------

@register("verified_merge", ORACLE["ingest_merged"])
def verified_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of many chunks each, compared with their manifests and merged."""
    from .ingest_queries import _enriched_columns
    root = _scratch(spark, "verified_merge", sf_dir)
    apps, primary, stats = payloads.landed(spark, sf_dir)
    for _ in range(2):
        jobs.ingest_run(spark, root, apps, primary, stats, chunk_size=CHUNK)
    return round_doubles(jobs.merge(spark, root, verify=True).select("app_id", *_enriched_columns()))


@register("app_list_cached", "SELECT CAST(p_partkey AS VARCHAR) AS app_id FROM part WHERE p_partkey % 3 <> 0")
def app_list_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call lands a payload and caches it; the second finds the cached list
    though another payload has landed meanwhile."""
    root = _scratch(spark, "app_list_cached", sf_dir)
    part = testdata.read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"))

    def payload(name: str, ids: DataFrame):
        def landed() -> DataFrame:
            sinks.write_app_list(ids, f"{root}/{name}", chunk_rows=CHUNK)
            return sources.app_list(spark, f"{root}/{name}")
        return landed
    resolve_app_list(spark, f"{root}/cache", payload("first", part.where(F.col("app_id") % 3 != 0)), CHUNK)
    return resolve_app_list(spark, f"{root}/cache", payload("second", part), CHUNK)


# --- run counters over known sets (AGG7) and every package (PRJ8) ---------------------------------------

@register("run_summary_known", _with_cls(r""",
known AS (SELECT *, coalesce(metacritic_score >= 60, false) AS done,
                 coalesce(publishers LIKE 'Brand#1%', false) AS out, release_date = '' OR k % 82 = 0 AS waiting FROM cls),
work AS (SELECT * FROM known WHERE NOT done AND NOT out),
n AS (SELECT (SELECT count(*) FROM work WHERE outcome = 'added') AS added,
             (SELECT count(*) FROM known) - (SELECT count(*) FROM known WHERE done)
             - (SELECT count(*) FROM known WHERE out) - (SELECT count(*) FROM known WHERE waiting) AS total)
SELECT count(*) FILTER (WHERE outcome = 'added') AS added,
       count(*) FILTER (WHERE outcome = 'not_released' AND NOT waiting) AS not_released,
       count(*) FILTER (WHERE outcome = 'discarded') AS discarded,
       count(*) FILTER (WHERE outcome = 'failed') AS failed,
       (SELECT total FROM n) AS total,
       round((SELECT round(100.0 * added / nullif(total, 0), 2) FROM n), 6) AS percent_added
FROM work""".lstrip()))
def run_summary_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run over apps of which many are known, some as not released."""
    apps, primary, stats = payloads.landed(spark, sf_dir)
    base = testdata.catalog(spark, sf_dir)
    waiting = base.where(F.col("app_id").cast("bigint") % 82 == 0).select("app_id", F.lit(S.NOT_RELEASED).alias("status"))
    status = _prior_status(base).unionByName(waiting).distinct()
    work = ingest.work_list(apps, status, released=False)
    return round_doubles(ingest.run_summary(apps, status, ingest.classify(work, primary, stats)))


@register("every_package", _with_src(r"""
, g AS (SELECT unnest([0, 1]) AS package, * FROM src WHERE k % 43 <> 0 AND k % 47 <> 0 AND k % 3 = 0),
s AS (SELECT unnest([0, 1]) AS sub, * FROM g)
SELECT app_id, package, sub, CASE package WHEN 0 THEN """ + SANITIZE_SQL.format(x="name") + r""" ELSE 'Again: ' || """
                                     + SANITIZE_SQL.format(x="name") + r""" END AS title,
  """ + SANITIZE_SQL.format(x="'Pack of ' || publishers") + r""" AS description,
  CASE WHEN package = sub THEN 'Buy now' ELSE 'Bundle' END AS text,
  CASE WHEN package = sub THEN 'std' ELSE '' END AS sub_description,
  round(CASE WHEN package = sub THEN round(round(price * 100) * 0.01, 2) ELSE 0.0 END, 6) AS price
FROM s""".lstrip()))
def every_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All packages and all their subs: each landed group, and once more with another
    title and its subs the other way round."""
    _, primary, _ = payloads.landed(spark, sf_dir)
    groups = F.col("data.package_groups")
    again = F.transform(groups, lambda g: g.withField("title", F.concat(F.lit("<i>Again:</i> "), g["title"]))
                        .withField("subs", F.reverse(g["subs"])))
    rows = ingest.parse_primary(primary).where(F.col("data").isNotNull())
    packs = rows.select("app_id", F.posexplode(ingest.packages(F.concat(groups, again))).alias("package", "p"))
    subs = packs.select("app_id", F.col("package").cast("int"), "p.title", "p.description",
                        F.posexplode("p.subs").alias("sub", "s"))
    return round_doubles(subs.select("app_id", "package", "sub", "title", "description", F.col("s.text").alias("text"),
                                     F.col("s.description").alias("sub_description"), F.col("s.price").alias("price")))


@register("work_list_bucketed", ORACLE["work_list"])
def work_list_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work list against status sets stored in buckets."""
    root = _scratch(spark, "work_list_bucketed", sf_dir)
    base = testdata.catalog(spark, sf_dir)
    jobs.seed_status(spark, root, _prior_status(base))
    return jobs.status_table_as_of(spark, root).work_list(base.select("app_id"), released=True)

"""Registered queries for the ingest side, with their DuckDB oracle SQL.

The Spark side serialises payloads built from the driver tables to JSON and
runs the ingest operators over the text; the oracle derives the expected
values straight from the same base columns (no JSON), so each pair checks the
parse -> check -> normalise -> enrich path against an independent derivation.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..operators import flatten, ingest
from ..session import shared_path
from ..sinks import files as sinks
from ..sources import files as sources
from ..sources import payloads, testdata
from . import jobs
from .queries import base_cte, register, round_doubles, with_base

K = "CAST(app_id AS BIGINT)"
SANITIZE_SQL = r"trim(regexp_replace(regexp_replace({x}, '<[^<]+?>', '', 'g'), '\s+', ' ', 'g'))"


def _src_ctes() -> str:
    return f"{base_cte()},\nsrc AS (SELECT *, {K} AS k FROM base)"


def _with_src(select_sql: str) -> str:
    """Oracle text: CTEs ``base`` and ``src`` (base + integer key ``k``)."""
    return f"{_src_ctes()}\n{select_sql}"


def _with_cls(select_sql: str) -> str:
    """Oracle text: CTEs ``base``, ``src`` and ``cls`` (expected outcome per app)."""
    return f"{_src_ctes()},{_CLS}\n{select_sql}"


def _scratch(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A new folder for each call: queries never share what they write."""
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    return shared_path(spark, "queries", name, f"{tag}-{uuid.uuid4().hex}")


def _join(c) -> F.Column:
    return F.array_join(c, "|")


# --- payload normalisation (PRJ7-9, SCL10-23) ---------------------------------------

@register("normalise_payload", _with_src(r"""
SELECT app_id, name,
  CASE WHEN k % 41 = 0 THEN '' ELSE release_date END AS release_date,
  CASE WHEN required_age IS NULL OR k % 4 = 2 THEN 0 ELSE required_age END AS required_age,
  round(CASE WHEN k % 9 = 4 OR k % 11 = 5 OR k % 13 = 6 THEN 0.0 ELSE price END, 6) AS price,
  CASE WHEN k % 8 = 0 THEN 0 ELSE k % 4 END AS dlc_count,
  """ + SANITIZE_SQL.format(x="'<p>' || genres || '</p>' || chr(10) || chr(10) || '  <br/>' || developers") + r""" AS detailed_description,
  '' AS about_the_game, '' AS short_description,
  windows, CASE WHEN k % 6 = 1 THEN false ELSE mac END AS mac, linux,
  CASE WHEN k % 5 = 2 THEN 0 ELSE metacritic_score END AS metacritic_score,
  achievements, recommendations,
  """ + SANITIZE_SQL.format(x="categories") + r""" AS notes,
  CASE WHEN k % 10 = 7 THEN '' ELSE replace(supported_languages, ', ', '|') END AS supported_languages,
  CASE WHEN k % 10 = 7 THEN ''
       WHEN k % 2 = 0 THEN replace(supported_languages, ', ', '|')
       ELSE split_part(supported_languages, ', ', 1) END AS full_audio_languages,
  replace(developers, ', ', '|') AS developers,
  publishers,
  categories || '|' AS categories,
  replace(genres, ', ', '|') AS genres,
  CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS package_count,
  CASE WHEN k % 3 = 0 THEN name END AS package_title,
  CASE WHEN k % 3 = 0 THEN 'Pack of ' || publishers END AS package_description,
  CASE WHEN k % 3 = 0 THEN 'Buy now|Bundle' END AS sub_texts,
  CASE WHEN k % 3 = 0 THEN 'std|' END AS sub_descriptions,
  round(CASE WHEN k % 3 = 0 THEN round(round(price * 100) * 0.01, 2) ELSE 0.0 END, 6) AS sub_price_total
FROM src WHERE k % 43 <> 0 AND k % 47 <> 0"""))
def normalise_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, primary, _ = payloads.landed(spark, sf_dir)
    parsed = ingest.parse_primary(primary).where(F.col("data").isNotNull())
    r = parsed.select("app_id", ingest.normalise(F.col("data")).alias("r"))
    first = F.get(F.col("r.packages"), 0)
    prices = F.flatten(F.transform("r.packages", lambda p: F.transform(p["subs"], lambda s: s["price"])))
    out = r.select(
        "app_id", "r.name", "r.release_date", "r.required_age", "r.price", "r.dlc_count",
        "r.detailed_description", "r.about_the_game", "r.short_description",
        "r.windows", "r.mac", "r.linux", "r.metacritic_score", "r.achievements",
        "r.recommendations", "r.notes",
        *[_join(F.col(f"r.{c}")).alias(c) for c in S.LIST_COLUMNS],
        X.size_or_null("r.packages").alias("package_count"),
        first["title"].alias("package_title"),
        first["description"].alias("package_description"),
        _join(F.transform(first["subs"], lambda s: s["text"])).alias("sub_texts"),
        _join(F.transform(first["subs"], lambda s: s["description"])).alias("sub_descriptions"),
        F.aggregate(prices, F.lit(0.0), lambda a, x: a + x).alias("sub_price_total"))
    return round_doubles(out)


# --- classification with enrichment (FLT1-3, JN1, DF1) ----------------------------------

_CLS = r"""
cls AS (SELECT *,
  CASE WHEN k % 43 = 0 OR k % 47 = 0 THEN 'failed'
       WHEN k % 19 = 0 OR k % 7 = 3 OR (k % 9 <> 4 AND k % 11 = 5) OR developers = '' THEN 'discarded'
       WHEN k % 41 = 0 OR release_date = '' THEN 'not_released'
       ELSE 'added' END AS outcome,
  (positive > 0 AND k % 7 <> 2 AND k % 17 <> 3 AND k % 23 <> 4) AS sv
  FROM src)"""

# Expected enriched fields of an added app (``sv``: its stats body is valid).
_ENRICHED_FIELDS = (
    ("name", "name"),
    ("price", "round(CASE WHEN k % 9 = 4 OR k % 11 = 5 OR k % 13 = 6 THEN 0.0 ELSE price END, 6)"),
    ("user_score", "CASE WHEN sv THEN metacritic_score ELSE 0 END"),
    ("score_rank", "''"),
    ("positive", "CASE WHEN sv THEN positive ELSE 0 END"),
    ("negative", "CASE WHEN sv THEN negative ELSE 0 END"),
    ("estimated_owners", "CASE WHEN sv AND estimated_owners <> '' THEN estimated_owners ELSE '0 - 0' END"),
    ("average_playtime_forever", "CASE WHEN sv THEN average_playtime_forever ELSE 0 END"),
    ("peak_ccu", "CASE WHEN sv THEN peak_ccu ELSE 0 END"),
    ("tag_count", "CASE WHEN sv AND k % 2 = 0 THEN 2 ELSE 0 END"),
)


def _enriched_sql(only_added: bool) -> str:
    if only_added:
        return ",".join(f"\n  CASE WHEN outcome = 'added' THEN {e} END AS {n}" for n, e in _ENRICHED_FIELDS)
    return ",".join(f"\n  {e} AS {n}" for n, e in _ENRICHED_FIELDS)


def _enriched_columns(rec: str = "record") -> list:
    r = lambda c: F.col(f"{rec}.{c}")
    return [r("name").alias("name"), r("price").alias("price"), r("user_score").alias("user_score"),
            r("score_rank").alias("score_rank"), r("positive").alias("positive"),
            r("negative").alias("negative"), r("estimated_owners").alias("estimated_owners"),
            r("average_playtime_forever").alias("average_playtime_forever"),
            r("peak_ccu").alias("peak_ccu"), X.size_or_null(r("tags")).alias("tag_count")]


@register("classify_apps", _with_cls("SELECT app_id, outcome," + _enriched_sql(True) + "\nFROM cls"))
def classify_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps, primary, stats = payloads.landed(spark, sf_dir)
    out = ingest.classify(apps, primary, stats)
    return round_doubles(out.select("app_id", "outcome", *_enriched_columns()))


_JOINED = [n for n, _ in _ENRICHED_FIELDS if n not in ("name", "price")]


@register("enrich_left_join", _with_cls("SELECT app_id, 'app ' || app_id AS name" + "".join(
    f",\n  {e} AS {n}" for n, e in _ENRICHED_FIELDS if n in _JOINED) + "\nFROM cls"))
def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1 alone: every app's name record left-joined with the stats feed."""
    apps, _, stats = payloads.landed(spark, sf_dir)
    recs = apps.select("app_id", F.struct(F.concat(F.lit("app "), "app_id").alias("name")).alias("record"))
    e = ingest.enrich(recs, ingest.parse_stats(stats))
    tags = X.size_or_null("record.tags").alias("tag_count")
    return e.select("app_id", "record.name", *[f"record.{n}" for n in _JOINED if n != "tag_count"], tags)


@register("run_summary", _with_cls(r"""
SELECT count(*) FILTER (WHERE outcome = 'added') AS added,
       count(*) FILTER (WHERE outcome = 'not_released') AS not_released,
       count(*) FILTER (WHERE outcome = 'discarded') AS discarded,
       count(*) FILTER (WHERE outcome = 'failed') AS failed,
       count(*) AS total,
       round(round(100.0 * count(*) FILTER (WHERE outcome = 'added') / count(*), 2), 6) AS percent_added
FROM cls"""))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps, primary, stats = payloads.landed(spark, sf_dir)
    none = spark.createDataFrame([], S.STATUS_SCHEMA)
    outcomes = ingest.classify(apps, primary, stats)
    return round_doubles(ingest.run_summary(apps, none, outcomes))


# --- work list and status sets (JN2, FLT7, SET1-3) ----------------------------------------

def _prior_status(base: DataFrame) -> DataFrame:
    return (base.where(F.col("metacritic_score") >= 60).select("app_id", F.lit(S.PROCESSED).alias("status"))
            .unionByName(base.where(F.col("publishers").startswith("Brand#1"))
                         .select("app_id", F.lit(S.DISCARDED).alias("status")))
            .unionByName(base.where(F.col("release_date") == "")
                         .select("app_id", F.lit(S.NOT_RELEASED).alias("status"))))


@register("work_list", with_base("""
SELECT app_id FROM base
WHERE NOT (metacritic_score >= 60 OR publishers LIKE 'Brand#1%' OR release_date = '')"""))
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = testdata.catalog(spark, sf_dir)
    return ingest.work_list(base.select("app_id"), _prior_status(base), released=True)


@register("work_list_with_unreleased", with_base("""
SELECT app_id FROM base
WHERE NOT (metacritic_score >= 60 OR publishers LIKE 'Brand#1%')"""))
def work_list_with_unreleased(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = testdata.catalog(spark, sf_dir)
    return ingest.work_list(base.select("app_id"), _prior_status(base), released=False)


_CUSTOMER_OUTCOME = """CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND c_acctbal > 0 THEN 'added'
            WHEN c_mktsegment = 'MACHINERY' THEN 'discarded'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'not_released'
            ELSE 'failed' END"""


@register("id_set_update", f"""
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS app_id, c_acctbal, c_mktsegment FROM customer),
old AS (SELECT app_id, 'processed' AS status FROM c WHERE c_acctbal > 5000
        UNION SELECT app_id, 'notreleased' FROM c WHERE c_mktsegment = 'BUILDING'
        UNION SELECT app_id, 'discarded' FROM c WHERE c_mktsegment = 'FURNITURE' AND c_acctbal < 0),
o AS (SELECT app_id, {_CUSTOMER_OUTCOME} AS outcome FROM c WHERE c_acctbal <= 5000),
new AS (SELECT app_id, CASE outcome WHEN 'added' THEN 'processed' WHEN 'not_released' THEN 'notreleased'
                       ELSE 'discarded' END AS status FROM o WHERE outcome <> 'failed')
SELECT app_id, status FROM (SELECT * FROM old UNION SELECT * FROM new)
WHERE NOT (status = 'notreleased' AND app_id IN (SELECT app_id FROM o WHERE outcome = 'added'))""")
def id_set_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = testdata.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("app_id"), "c_acctbal", "c_mktsegment")
    old = (c.where(F.col("c_acctbal") > 5000).select("app_id", F.lit(S.PROCESSED).alias("status"))
           .unionByName(c.where(F.col("c_mktsegment") == "BUILDING")
                        .select("app_id", F.lit(S.NOT_RELEASED).alias("status")))
           .unionByName(c.where((F.col("c_mktsegment") == "FURNITURE") & (F.col("c_acctbal") < 0))
                        .select("app_id", F.lit(S.DISCARDED).alias("status"))))
    outcomes = c.where(F.col("c_acctbal") <= 5000).select("app_id", F.expr(_CUSTOMER_OUTCOME).alias("outcome"))
    return ingest.update_status(old, outcomes)


# --- last-wins upsert (JN3) ---------------------------------------------------------------

@register("merge_last_wins", """
WITH b AS (
  SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) - 1990 AS BIGINT) AS batch_no FROM orders
  UNION ALL SELECT o_orderkey, o_totalprice * 2, 'X', CAST(100 AS BIGINT) FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, o_totalprice + 1, 'Y', CAST(99 AS BIGINT) FROM orders WHERE o_orderstatus = 'P')
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, o_orderpriority, batch_no FROM b
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY batch_no DESC) = 1""")
def merge_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = testdata.read_table(spark, sf_dir, "orders")
    batches = (o.select("o_orderkey", "o_totalprice", "o_orderpriority",
                        (F.year("o_orderdate") - 1990).cast("bigint").alias("batch_no"))
               .unionByName(o.where(F.col("o_orderstatus") == "F").select(
                   "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
                   F.lit("X").alias("o_orderpriority"), F.lit(100).cast("bigint").alias("batch_no")))
               .unionByName(o.where(F.col("o_orderstatus") == "P").select(
                   "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                   F.lit("Y").alias("o_orderpriority"), F.lit(99).cast("bigint").alias("batch_no"))))
    return round_doubles(ingest.last_wins(batches, "o_orderkey", "batch_no"))


# --- JSON records -> base table (SRC1, PRJ1, PRJ2, DF3) ---------------------------------------

def _record_struct() -> F.Column:
    cols = []
    for name, _, _ in S.BASE_COLUMNS[1:]:
        c = F.col(name)
        cols.append((F.split(c, ", ") if name in S.LIST_COLUMNS else c).alias(name))
    return F.struct(*cols)


_BASE_NAMES = [n for n, _, _ in S.BASE_COLUMNS]


def _base_select(overrides: dict[str, str]) -> str:
    cols = []
    for n in _BASE_NAMES:
        expr = overrides.get(n, n)
        if n == "price":
            expr = f"round({expr}, 6)"
        cols.append(f"{expr} AS {n}" if expr != n else n)
    return ", ".join(cols)


@register("json_flatten", _with_src(
    "SELECT " + _base_select({"peak_ccu": "CASE WHEN k % 5 = 1 THEN 0 ELSE peak_ccu END",
                              "genres": "CASE WHEN k % 7 = 1 THEN '' ELSE genres END"}) + " FROM src"))
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = testdata.catalog(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    text = F.to_json(_record_struct(), {"ignoreNullFields": "false"})
    text = F.when(k % 5 == 1, F.regexp_replace(text, r',"peak_ccu":-?[0-9]+', "")).otherwise(text)
    text = F.when(k % 7 == 1, F.regexp_replace(text, r',"genres":\[[^\]]*\]', "")).otherwise(text)
    return round_doubles(flatten.flatten_records(base.select("app_id", text.alias("record"))))


# --- chunk files, keyed objects, last chunk wins (SNK2, SRC4, SNK3) ---------------------------

CHUNK_ROWS = 500


@register("chunk_merge", _with_src(
    "SELECT " + _base_select({"peak_ccu": "CASE WHEN k % 10 = 3 THEN -1 ELSE peak_ccu END"}) + " FROM src"))
def chunk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records land as keyed-object chunk files of at most ``CHUNK_ROWS``.

    Block i of the keys lands in chunk 2i+1; its re-delivered apps land again
    in chunk 2i+2 and must win — by number, not text (chunk 10 beats chunk 9).
    """
    base = testdata.catalog(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    block = F.floor(k / CHUNK_ROWS)
    first = base.select("app_id", (block * 2 + 1).alias("chunk"), _record_struct().alias("r"))
    again = base.where(k % 10 == 3).select(
        "app_id", (block * 2 + 2).alias("chunk"),
        _record_struct().withField("peak_ccu", F.lit(-1).cast("bigint")).alias("r"))
    landed = first.unionByName(again)
    # one keyed object per chunk; a chunk holds at most CHUNK_ROWS records
    objects = landed.groupBy("chunk").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("app_id", "r"))),
                  {"ignoreNullFields": "false"}).alias("value"))
    path = _scratch(spark, "chunk_merge", sf_dir)
    objects.write.mode("overwrite").partitionBy("chunk").text(path)
    merged = sources.merge_chunks(spark, path)
    return round_doubles(flatten.flatten_records(merged))


# --- scalar text functions (SCL10-12, 19, 20, 4, 5) --------------------------------------------

@register("sanitize_text", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^<]+?>', '', 'g'),
                                    '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g')) AS text
FROM pages""")
def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = testdata.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", X.sanitize_text("html").alias("text"))


# Text inputs built from ``part``; each entry is one SQL expression that both
# engines evaluate (``{t}`` is the string type name of the engine).
_TEXT_EXPRS = [
    "CASE p_size % 5 WHEN 0 THEN 'Free' WHEN 1 THEN '$' || CAST(p_retailprice AS {t}) "
    "WHEN 2 THEN CAST(p_retailprice AS {t}) || ' USD' WHEN 3 THEN '1.2.' || CAST(p_size AS {t}) "
    "ELSE 'EUR ' || CAST(p_partkey AS {t}) || ',99' END AS price_text",
    "CASE p_size % 4 WHEN 0 THEN CAST(p_size - 3 AS {t}) || '+' WHEN 1 THEN ' ' || CAST(p_size AS {t}) || ' ' "
    "WHEN 2 THEN CAST(p_size AS {t}) || '.0' ELSE 'abc' END AS age_text",
    "CASE WHEN p_size % 3 = 0 THEN NULL "
    "ELSE CAST(p_partkey AS {t}) || ',000 .. ' || CAST(p_partkey * 2 AS {t}) || ',000' END AS owners_raw",
    "CAST(round(p_retailprice * 100) AS BIGINT) AS cents",
    "CASE WHEN p_size % 2 = 0 THEN 'Mar ' || CAST(p_size AS {t}) || ', ' || CAST(1990 + p_size AS {t}) "
    "ELSE CAST(1990 + p_size AS {t}) || '-01-01' END AS date_text",
]
_TEXTS = ",\n  ".join(e.format(t="VARCHAR") for e in _TEXT_EXPRS)


@register("scalar_parsers", f"""
WITH t AS (SELECT p_partkey, {_TEXTS} FROM part),
u AS (SELECT *, replace(replace(coalesce(owners_raw, '0 - 0'), ',', ''), '..', '-') AS owners,
             trim(replace(age_text, '+', '')) AS age_clean FROM t)
SELECT p_partkey,
  round(coalesce(TRY_CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DOUBLE), 0.0), 6) AS price,
  CASE WHEN regexp_full_match(age_clean, '[+-]?[0-9]+') THEN CAST(age_clean AS BIGINT) ELSE 0 END AS age,
  owners,
  TRY_CAST(nullif(regexp_extract(replace(owners, ',', ''), '(\\d+)$', 1), '') AS BIGINT) AS owners_num,
  round(round(cents * 0.01, 2), 6) AS cents_price,
  TRY_CAST(nullif(regexp_extract(date_text, ', (\\d{{4}})$', 1), '') AS BIGINT) AS release_year
FROM u""")
def scalar_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = testdata.read_table(spark, sf_dir, "part")
    t = part.select("p_partkey", *[F.expr(e.format(t="STRING")) for e in _TEXT_EXPRS])
    owners = X.owners_text("owners_raw")
    return round_doubles(t.select(
        "p_partkey",
        X.price_to_float("price_text").alias("price"),
        X.safe_int("age_text").alias("age"),
        owners.alias("owners"),
        X.owners_upper_bound(owners).alias("owners_num"),
        X.cents_to_price("cents").alias("cents_price"),
        X.release_year("date_text").alias("release_year")))


# --- file round trips (SNK1, SNK5, SRC2, SRC5) ---------------------------------------------------

@register("parquet_round_trip", with_base("SELECT " + _base_select({}) + " FROM base"))
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "parquet_round_trip", sf_dir)
    sinks.write_parquet(testdata.catalog(spark, sf_dir), path)
    return round_doubles(sources.parquet_tables(spark, path.rsplit("/", 1)[0], [path.rsplit("/", 1)[1]])
                         [path.rsplit("/", 1)[1]])


@register("json_round_trip", with_base("SELECT " + _base_select({}) + " FROM base"))
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "json_round_trip", sf_dir)
    sinks.write_json(testdata.catalog(spark, sf_dir), path)
    return round_doubles(sources.read_or_empty(spark, path, S.BASE_SCHEMA, fmt="json"))


# --- the incremental ingest job, two runs (DF2, SNK2-4, SRC2, SRC6) --------------------------------

def _two_runs(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Two ingest runs into a folder owned by query ``name``; returns the folder."""
    root = _scratch(spark, name, sf_dir)
    apps, primary, stats = payloads.landed(spark, sf_dir)
    jobs.ingest_run(spark, root, apps, primary, stats, run=1)
    jobs.ingest_run(spark, root, apps, primary, stats, run=2)
    jobs.merge(spark, root)
    return root


@register("ingest_status", _with_cls(r"""
SELECT app_id, CASE outcome WHEN 'added' THEN 'processed' WHEN 'not_released' THEN 'notreleased'
                            ELSE 'discarded' END AS status
FROM cls WHERE outcome <> 'failed'"""))
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_runs(spark, sf_dir, "ingest_status")
    return jobs.current_status(spark, root)


@register("ingest_merged", _with_cls("SELECT app_id," + _enriched_sql(False)
                                      + "\nFROM cls WHERE outcome = 'added'"))
def ingest_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_runs(spark, sf_dir, "ingest_merged")
    merged = spark.read.parquet(f"{root}/merged")
    return round_doubles(merged.select("app_id", *_enriched_columns()))


# --- app list and ID sets in the catalog's JSON form (SRC3, SRC6, SNK4) -------------------------

@register("app_list_scan", "SELECT CAST(p_partkey AS VARCHAR) AS app_id FROM part")
def app_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part key lands in chunked app-list payloads and is read back."""
    path = _scratch(spark, "app_list_scan", sf_dir)
    part = testdata.read_table(spark, sf_dir, "part")
    sinks.write_app_list(part.select(F.col("p_partkey").alias("app_id")), path, chunk_rows=CHUNK_ROWS)
    return sources.app_list(spark, path)


@register("id_set_round_trip", """
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS app_id, 'discarded' AS status FROM customer""")
def id_set_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer key saved as JSON id arrays (each twice) and loaded as a set."""
    path = _scratch(spark, "id_set_round_trip", sf_dir)
    c = testdata.read_table(spark, sf_dir, "customer")
    ids = c.select(F.col("c_custkey").alias("app_id"))
    sinks.write_id_sets(ids.unionByName(ids), path, chunk_rows=CHUNK_ROWS)
    return sources.id_set(spark, path, status=S.DISCARDED)


# --- the ingest as a stream over a landing folder ---------------------------------------------------

@register("ingest_stream_status", _with_cls(r"""
SELECT app_id, CASE outcome WHEN 'added' THEN 'processed' WHEN 'not_released' THEN 'notreleased'
                            ELSE 'discarded' END AS status
FROM cls WHERE outcome <> 'failed'"""))
def ingest_stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies land in two parts; two available-now stream runs ingest them."""
    from ..streaming.landing import ingest_stream
    root = _scratch(spark, 'ingest_stream', sf_dir)
    _, primary, stats = payloads.landed(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    for part in (0, 1):
        primary.where(k % 2 == part).write.mode("overwrite").parquet(f"{root}/landing/part={part}")
        ingest_stream(spark, f"{root}/landing/part=*", f"{root}/out", stats=stats,
                      checkpoint=f"{root}/checkpoint", merge_each_batch=False).awaitTermination()
    return jobs.current_status(spark, f"{root}/out")


# --- collector then transformer: ingest -> merge -> flatten -> report (DF2, SNK3, DF3, R1) ----------

@register("ingested_genre_counts", _with_cls(r"""
SELECT genre, count(*) AS count
FROM (SELECT regexp_replace(g, '^\s+|\s+$', '', 'g') AS genre
      FROM (SELECT unnest(string_split(genres, ',')) AS g FROM cls WHERE outcome = 'added'))
GROUP BY genre"""))
def ingested_genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genre report over the catalog that the ingest job itself produced."""
    from .reports import genre_counts
    root = _two_runs(spark, sf_dir, "ingested_genre_counts")
    return genre_counts(jobs.catalog_from_merged(spark, root))


@register("classify_redelivered", _with_cls("SELECT app_id, outcome," + _enriched_sql(True) + "\nFROM cls"))
def classify_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every app landed three times: a refusal first, then its body, then a body
    that is not JSON. The body in the middle counts, neither greatest nor smallest."""
    apps, primary, stats = payloads.landed(spark, sf_dir)
    ok = primary.where(F.json_object_keys("body").isNotNull())
    refused = F.concat(F.lit('{"'), "app_id", F.lit('": {"success": false}}'))
    bodies = (primary.withColumn("landed_at", F.lit(2))
              .unionByName(ok.select("app_id", refused.alias("body"), F.lit(1).alias("landed_at")))
              .unionByName(primary.select("app_id", F.lit("~ unavailable").alias("body"), F.lit(3).alias("landed_at"))))
    older = F.lit('{"developer": "zz", "userscore": "999", "ccu": 999.0}')
    known = ingest.parse_stats(stats).select("app_id")
    feed = stats.withColumn("landed_at", F.lit(2)).unionByName(
        known.select("app_id", older.alias("body"), F.lit(1).alias("landed_at")))
    out = ingest.classify(apps, bodies, feed)
    return round_doubles(out.select("app_id", "outcome", *_enriched_columns()))


@register("ingest_mixed_enrichment", _with_cls("""
SELECT app_id, name, CASE WHEN sv AND k % 2 = 1 THEN peak_ccu ELSE 0 END AS peak_ccu,
  CASE WHEN k % 2 = 0 THEN '' WHEN sv AND estimated_owners <> '' THEN estimated_owners ELSE '0 - 0' END AS estimated_owners
FROM cls WHERE outcome = 'added'"""))
def ingest_mixed_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1 ingests the even apps without statistics, run 2 the odd ones with them."""
    root = _scratch(spark, "ingest_mixed_enrichment", sf_dir)
    apps, primary, stats = payloads.landed(spark, sf_dir)
    odd = F.pmod(F.col("app_id").cast("bigint"), F.lit(2)) == 1
    jobs.ingest_run(spark, root, apps.where(~odd), primary)
    jobs.ingest_run(spark, root, apps.where(odd), primary, stats)
    jobs.merge(spark, root)
    return jobs.catalog_from_merged(spark, root).select("app_id", "name", "peak_ccu", "estimated_owners")


@register("ingest_three_runs", _with_cls(r"""
SELECT app_id, CASE outcome WHEN 'added' THEN 'processed' WHEN 'not_released' THEN 'notreleased'
                            ELSE 'discarded' END AS status
FROM cls WHERE outcome <> 'failed'"""))
def ingest_three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1 finds every app without a date (not released), run 2 looks at those
    again and finds their bodies, run 3 only fails; the log is compacted between."""
    root = _scratch(spark, "ingest_three_runs", sf_dir)
    apps, primary, stats = payloads.landed(spark, sf_dir)
    undated = F.concat(F.lit('{"'), "app_id", F.lit(
        '": {"success": true, "data": {"type": "game", "is_free": true, "developers": ["d"]}}}'))
    ok = primary.where(F.json_object_keys("body").isNotNull())
    jobs.ingest_run(spark, root, apps, ok.select("app_id", undated.alias("body")))
    jobs.compact(spark, root)
    # a decided app leaves the not-released set only when it is added
    jobs.ingest_run(spark, root, apps, primary, stats, released=False)
    jobs.ingest_run(spark, root, apps, primary.limit(0), stats, released=False)
    status = jobs.current_status(spark, root)
    decided = status.where(F.col("status") == S.DISCARDED).select("app_id")
    return status.where(F.col("status") != S.NOT_RELEASED).unionByName(
        status.where(F.col("status") == S.NOT_RELEASED).join(decided, "app_id", "left_anti"))


# --- one key per scalar parser (SCL11, SCL12, SCL20, SCL19) and the language lists (SCL13, SCL14)

_T_CTE = f"WITH t AS (SELECT p_partkey, {_TEXTS} FROM part)"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = testdata.read_table(spark, sf_dir, "part")
    return part.select("p_partkey", *[F.expr(e.format(t="STRING")) for e in _TEXT_EXPRS])


@register("price_to_float", _T_CTE + r"""
SELECT p_partkey, price_text,
  round(coalesce(TRY_CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DOUBLE), 0.0), 6) AS price
FROM t""")
def price_to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_texts(spark, sf_dir).select(
        "p_partkey", "price_text", X.price_to_float("price_text").alias("price")))


@register("safe_int", _T_CTE + r""",
u AS (SELECT *, trim(replace(age_text, '+', '')) AS age_clean FROM t)
SELECT p_partkey, age_text,
  CASE WHEN regexp_full_match(age_clean, '[+-]?[0-9]+') THEN CAST(age_clean AS BIGINT) ELSE 0 END AS age
FROM u""")
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("p_partkey", "age_text", X.safe_int("age_text").alias("age"))


@register("owners_text", _T_CTE + r"""
SELECT p_partkey, owners_raw,
  replace(replace(coalesce(owners_raw, '0 - 0'), ',', ''), '..', '-') AS owners
FROM t""")
def owners_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("p_partkey", "owners_raw", X.owners_text("owners_raw").alias("owners"))


@register("cents_to_price", _T_CTE + r"""
SELECT p_partkey, cents, round(round(cents * 0.01, 2), 6) AS price FROM t""")
def cents_to_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_texts(spark, sf_dir).select(
        "p_partkey", "cents", X.cents_to_price("cents").alias("price")))


@register("language_lists", _with_src(r"""
SELECT app_id, html,
  replace(supported_languages, ', ', '|') AS supported,
  CASE WHEN legend AND strpos(supported_languages, ', ') > 0 THEN replace(supported_languages, ', ', '|')
       ELSE split_part(supported_languages, ', ', 1) END AS full_audio
FROM (SELECT app_id, supported_languages, k % 2 = 0 AS legend,
             regexp_replace(supported_languages, '^([^,]*)', '\1<strong>*</strong>')
             || CASE WHEN k % 2 = 0 THEN '<br><strong>*</strong>languages with full audio support' ELSE '' END AS html
      FROM src)"""))
def language_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML language text built from the catalog's languages -> the two lists."""
    base = testdata.catalog(spark, sf_dir)
    k = F.col("app_id").cast("bigint")
    html = F.concat(F.regexp_replace("supported_languages", "^([^,]*)", "$1" + payloads.FULL_AUDIO_MARK),
                    F.when(k % 2 == 0, F.lit(payloads.LEGEND)).otherwise(F.lit("")))
    return base.select("app_id", html.alias("html")).select(
        "app_id", "html",
        _join(X.supported_languages("html")).alias("supported"),
        _join(X.full_audio_languages("html")).alias("full_audio"))


# --- the same classification with the statistics feed switched off (DF1 without JN1) ----------------

@register("classify_apps_without_stats", _with_cls(r"""
SELECT app_id, outcome,
  CASE WHEN outcome = 'added' THEN name END AS name,
  CASE WHEN outcome = 'added' THEN round(CASE WHEN k % 9 = 4 OR k % 11 = 5 OR k % 13 = 6 THEN 0.0 ELSE price END, 6) END AS price,
  CASE WHEN outcome = 'added' THEN 0 END AS user_score,
  CASE WHEN outcome = 'added' THEN '' END AS estimated_owners,
  CASE WHEN outcome = 'added' THEN 0 END AS peak_ccu
FROM cls"""))
def classify_apps_without_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No enrichment: the records carry no statistics fields, so the flattened
    base table shows their missing-key defaults."""
    apps, primary, _ = payloads.landed(spark, sf_dir)
    out = ingest.classify(apps, primary, None)
    flat = flatten.flatten_struct(out, keep=("outcome",))
    added = F.col("outcome") == S.ADDED
    return round_doubles(flat.select(
        "app_id", "outcome",
        *[F.when(added, F.col(c)).alias(c) for c in
          ("name", "price", "user_score", "estimated_owners", "peak_ccu")]))


# --- the publish job: base table and 13 reports written, then read back (DF5, SNK5, SRC5) ----------

def _published_counts_sql() -> str:
    from . import reports as R
    from .queries import ORACLE
    parts = [f"SELECT 'catalog' AS table_name, count(*) AS row_count FROM ({with_base('SELECT * FROM base')}) t"]
    parts += [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({ORACLE[name]}) t"
              for name in R.REPORTS]
    return "\nUNION ALL\n".join(parts)


@register("publish_tables", _published_counts_sql())
def publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table the publish job wrote, read back from Parquet."""
    from functools import reduce
    out = _scratch(spark, "publish_tables", sf_dir)
    paths = jobs.publish(testdata.catalog(spark, sf_dir), out)
    counts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count") for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)

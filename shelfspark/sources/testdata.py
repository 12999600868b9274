"""Adapter from the driver's TPC-H-style tables to the catalog base table.

The driver ships no catalog payloads, so the 29-column base table is derived
from ``part, lineitem, orders, nation, region`` with one SQL text. Spark runs
it with the tables bound as DataFrames; the DuckDB oracle runs the very same
text against its registered views (``base_sql()``).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

_BASE_SQL = """
WITH li AS (
  SELECT l_partkey, count(*) AS n,
         sum(cast(l_quantity AS bigint)) AS qty,
         sum(cast(l_quantity AS bigint) * l_linenumber) AS wqty,
         sum(CASE WHEN l_returnflag = 'A' THEN cast(l_quantity AS bigint) ELSE 0 END) AS a_qty,
         sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS n_cnt,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r_cnt
  FROM {lineitem} GROUP BY l_partkey)
SELECT cast(p_partkey AS string) AS app_id,
  p_name || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || cast(p_partkey AS string) END AS name,
  CASE WHEN p_partkey % 17 = 0 THEN ''
       WHEN o_orderdate IS NULL THEN ''
       WHEN p_partkey % 13 = 0 THEN cast(year(o_orderdate) AS string) || '-01-01'
       ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(3*(month(o_orderdate)-1)+1 AS int), 3)
            || ' ' || cast(day(o_orderdate) AS string) || ', ' || cast(year(o_orderdate) AS string) END AS release_date,
  cast(CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size - 3 END AS bigint) AS required_age,
  p_retailprice AS price, cast(coalesce(n, 0) AS bigint) AS dlc_count,
  false AS support_email,
  p_size % 10 <> 0 AS windows, p_size % 3 = 0 AS mac, p_size % 4 = 0 AS linux,
  cast(p_size * 2 AS bigint) AS metacritic_score,
  cast(coalesce(qty, 0) AS bigint) AS achievements, cast(coalesce(a_qty, 0) AS bigint) AS recommendations,
  n1.n_name || CASE WHEN p_size % 2 = 0 THEN ', ' || n2.n_name ELSE '' END AS supported_languages,
  n1.n_name AS full_audio_languages,
  CASE WHEN p_partkey % 29 = 0 THEN '' ELSE p_brand || CASE p_size % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN '; ' || n1.n_name ELSE '' END END AS developers,
  p_brand AS publishers, coalesce(o_orderpriority, '') AS categories,
  CASE WHEN p_partkey % 31 = 0 THEN '' ELSE p_type || CASE WHEN p_size % 3 = 0 THEN ', ' || r_name ELSE '' END END AS genres,
  cast(0 AS bigint) AS user_score, '' AS score_rank,
  cast(coalesce(n_cnt, 0) AS bigint) AS positive,
  cast(CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE coalesce(r_cnt, 0) END AS bigint) AS negative,
  CASE WHEN p_partkey % 37 = 0 THEN '' ELSE cast(cast(coalesce(qty,0) AS bigint) * 100 AS string) || ' - ' || cast(cast(coalesce(qty,0) AS bigint) * 200 AS string) END AS estimated_owners,
  cast(p_size * 60 AS bigint) AS average_playtime_forever, cast(p_size AS bigint) AS average_playtime_2weeks,
  cast(p_size * 50 AS bigint) AS median_playtime_forever, cast(p_size AS bigint) AS median_playtime_2weeks,
  cast(coalesce(wqty, 0) AS bigint) AS peak_ccu
FROM {part}
LEFT JOIN li ON l_partkey = p_partkey
LEFT JOIN {orders} ON o_orderkey = p_partkey
JOIN {nation} n1 ON n1.n_nationkey = p_partkey % 25
JOIN {nation} n2 ON n2.n_nationkey = p_size % 25
JOIN {region} ON r_regionkey = n1.n_regionkey
"""

_BASE_TABLES = ("part", "lineitem", "orders", "nation", "region")


def base_sql() -> str:
    """The adapter SQL with bare table names (for DuckDB), as one SELECT."""
    return _BASE_SQL.format(**{t: t for t in _BASE_TABLES}).strip()


_READERS: dict[tuple, DataFrame] = {}
_READERS_LOCK = threading.Lock()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy reader for one driver table, created once per session.

    The driver tables are read-only, so the reader (its file listing and
    Parquet schema) is reused; every action still scans the files.
    """
    from ..session import session_id
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), session_id(spark), path)
    with _READERS_LOCK:
        df = _READERS.get(key)
        if df is None:
            df = _READERS[key] = spark.read.parquet(path)
    return df


def tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Lazy readers for the driver tables (nothing is scanned until an action)."""
    return {n: read_table(spark, sf_dir, n) for n in names}


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 29-column base table derived from the driver tables."""
    t = tables(spark, sf_dir, _BASE_TABLES)
    return spark.sql(_BASE_SQL, **t)

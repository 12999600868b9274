"""File readers: keyed-object JSON, chunk folders, app lists, ID sets, tables.

Landed data is read in parallel by file. The keyed-object form
``{"<app_id>": {...}, ...}`` (one object per file) is read with
``wholetext`` — one task per file — which suits chunk files; large files are
read by many tasks with ``keyed.indented_catalog`` and ``keyed.one_line_catalog``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

# Chunk naming — a ``chunk_<n>.json`` file or a ``chunk=<n>/`` folder.
CHUNK_NUMBER = r"chunk(?:_(\d+)\.json|=(\d+)/)"


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` (may be a glob) exists on its file system (None if it cannot be asked)."""
    try:
        sc = spark.sparkContext
        jvm, jsc = sc._jvm, sc._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(jsc.hadoopConfiguration()).globStatus(p)
        return found is not None and len(found) > 0
    except Exception:  # no JVM gateway (e.g. Spark Connect): let the read decide
        return None


def numbered_folders(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers ``n`` of the ``<column>=<n>`` folders under ``path``, ascending (a
    folder listing; no file is read)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}=*")
    found = p.getFileSystem(conf).globStatus(p)
    return sorted(int(f.getPath().getName().split("=", 1)[1]) for f in found or [])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; a missing one is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """SRC2: read ``path``; a missing path is an empty table of ``schema``.

    Only a missing path is swallowed; any other error is raised, a line that does
    not parse included (``quarantined_lines`` keeps such lines apart instead).
    """
    if path_exists(spark, path) is False:
        return spark.createDataFrame([], schema)
    try:
        reader = spark.read.schema(schema).option("mode", "FAILFAST")
        return reader.format(fmt).load(path)
    except AnalysisException as ex:
        if ex.getCondition() == "PATH_NOT_FOUND" or "Path does not exist" in str(ex):
            return spark.createDataFrame([], schema)
        raise


def keyed_objects(spark: SparkSession, path: str, dedupe: bool = True) -> DataFrame:
    """SRC1/SRC4: files holding one ``{app_id: record}`` object each.

    Returns ``(app_id, record, file, chunk_no)``: ``record`` is the JSON text
    of the value; ``chunk_no`` is the number in ``chunk_<n>.json`` or
    ``chunk=<n>/`` (NULL otherwise). Within one file the last duplicate key
    wins (as with a Python dict). With ``dedupe=False`` every occurrence is
    kept with its position ``pos`` in the file, so a merge that orders by
    ``(chunk_no, pos)`` does both in one shuffle (see ``merge_chunks``). A file
    that does not parse (such as a truncated one) raises with its name.
    """
    raw = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"))
    records = F.from_json("value", "map<string,string>")
    broken = records.isNull() & (F.trim("value") != "")
    exploded = raw.select(
        F.posexplode(F.map_entries(F.when(broken, F.raise_error(
            F.concat(F.lit("not a JSON object of records: "), F.col("file")))
            .cast("map<string,string>")).otherwise(records))).alias("pos", "e"),
        "file")
    chunk = F.nullif(F.concat(F.regexp_extract("file", CHUNK_NUMBER, 1),
                              F.regexp_extract("file", CHUNK_NUMBER, 2)), F.lit("")).try_cast("bigint")
    if not dedupe:
        return exploded.select(F.col("e.key").alias("app_id"), F.col("e.value").alias("record"),
                               "file", chunk.alias("chunk_no"), "pos")
    # a parsed map keeps repeated keys: keep the last occurrence in each file
    last = (exploded.groupBy("file", F.col("e.key").alias("app_id"))
            .agg(F.max_by(F.col("e.value"), F.col("pos")).alias("record")))
    return last.select("app_id", "record", "file", chunk.alias("chunk_no"))


def merge_chunks(spark: SparkSession, path: str) -> DataFrame:
    """SRC4 + SNK3: read every chunk, keep per app the record of the highest
    chunk number (numeric), and within a chunk the last occurrence — one
    aggregation on ``app_id``. Returns ``(app_id, record, chunk_no)``."""
    from ..operators.ingest import last_wins
    occ = keyed_objects(spark, path, dedupe=False)
    ordered = occ.select("app_id", "record", "chunk_no",
                         F.struct("chunk_no", "pos").alias("_order"))
    return last_wins(ordered, "app_id", "_order").drop("_order")


def quarantined_lines(spark: SparkSession, path: str, schema: T.StructType,
                      quarantine: str) -> tuple[DataFrame, DataFrame]:
    """SRC2 for files that may hold broken lines: the rows that parse, and the lines
    that do not as ``(file, line)``, written to the Parquet folder ``quarantine``."""
    text = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    mark = "_corrupt_record"
    parsed = F.from_json("line", T.StructType([*schema.fields, T.StructField(mark, T.StringType())]),
                         {"columnNameOfCorruptRecord": mark})
    rows = text.withColumn("row", parsed)
    broken = F.col("row").isNull() | F.col(f"row.{mark}").isNotNull()
    rows.where(broken).select("file", "line").write.mode("overwrite").parquet(quarantine)
    return (rows.where(~broken).select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields]),
            spark.read.schema("file string, line string").parquet(quarantine))


def json_lines_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines with an ``app_id`` field per line -> ``(app_id, record)``."""
    raw = spark.read.text(path)
    return raw.select(F.get_json_object("value", "$.app_id").alias("app_id"),
                      F.col("value").alias("record"))


# One element of an indented JSON array of ids: "10", or 10,
INDENTED_ID = r'^\s*(?:"([^"]*)"|(-?[0-9]+))\s*,?\s*$'
INDENTED_APPID = r'"appid"\s*:\s*"?(-?[0-9]+)'


def _line_ids(parsed: Column) -> Column:
    """Ids of a line: those of the document on it, or of a line of an indented array.
    A line that is neither (such as a cut array) gives NULL."""
    alone = F.concat(F.regexp_extract("value", INDENTED_ID, 1), F.regexp_extract("value", INDENTED_ID, 2))
    return F.coalesce(parsed, F.when(F.col("value").rlike(INDENTED_ID), F.array(alone)))


def app_list(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """SRC3: ``{"applist": {"apps": [{"appid": 1}, ...]}}`` -> ``(app_id STRING)``.

    Also reads a cached list (a JSON array of id strings or numbers). Lines read
    in parallel: each holds one document, or a line of an indented one.
    ``multiline=True`` parses each file as one document.
    """
    text = spark.read.text(path, wholetext=multiline)
    payload = F.from_json("value", "applist struct<apps: array<struct<appid: string>>>")
    cached = F.from_json("value", "array<string>")
    ids = F.coalesce(F.transform(payload["applist"]["apps"], lambda a: a["appid"]), cached)
    if not multiline:
        named = F.regexp_extract_all("value", F.lit(INDENTED_APPID), F.lit(1))
        ids = F.when(F.coalesce(F.size(ids), F.lit(-1)) >= 0, ids) \
            .when(F.size(named) > 0, named).otherwise(_line_ids(ids))
    return text.select(F.explode(ids).alias("app_id")).select(F.col("app_id").cast("string"))


def id_set(spark: SparkSession, path: str, status: str | None = None,
           multiline: bool = False) -> DataFrame:
    """SRC6: JSON arrays of ids -> distinct ``(app_id[, status])``.

    Lines read in parallel: each holds one array, or a line of an indented one.
    ``multiline=True`` parses each file as one array. A missing path is the
    empty set. A line that is neither raises with its file.
    """
    schema = S.STATUS_SCHEMA if status else T.StructType([T.StructField("app_id", T.StringType())])
    if path_exists(spark, path) is False:
        return spark.createDataFrame([], schema)
    try:
        text = spark.read.text(path, wholetext=multiline)
    except AnalysisException as ex:
        if ex.getCondition() == "PATH_NOT_FOUND" or "Path does not exist" in str(ex):
            return spark.createDataFrame([], schema)
        raise
    parsed = F.from_json("value", "array<string>")
    found = parsed if multiline else _line_ids(parsed)
    frame = F.trim("value").isin("", "[", "]")  # the brackets of an indented array on lines of their own
    broken = F.raise_error(F.concat(F.lit("not an array of ids: "), F.col("_metadata.file_path"))).cast("array<string>")
    lines = text.select(F.when(frame, F.array().cast("array<string>")).when(found.isNull(), broken)
                        .otherwise(found).alias("ids"))
    ids = lines.select(F.explode("ids").alias("app_id")).distinct()
    return ids.withColumn("status", F.lit(status)) if status else ids


def parquet_tables(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    """SRC5: one Parquet table per name under ``root``."""
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}

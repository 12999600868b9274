"""Splittable scans of large files that hold one ``{app_id: record}`` object each.

A file is read by many tasks; records are found without parsing it as one document.

* Indented files: a line that closes a member of the outer object ends a record.
  JSON strings hold no raw line breaks, so that line cannot stand inside one; it is
  the reader's line separator.
* One-line files: the reader cuts at every ``},``. Each piece is summed up as (quotes,
  change of depth when it begins outside a string, change when it begins inside). The
  state before each piece is a running sum of these: over the blocks of the file
  first, then inside each block. A record ends at a cut outside strings that returns
  to the depth of the outer object. No cut falls into an escape sequence, as a brace
  is never escaped.

Both give ``(app_id, record, file, pos)``, the result of reading each file whole;
``pos`` orders the members of a file. A file that ends too soon raises with its name.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

CUT = "},"


def _open(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _bytes_at(spark: SparkSession, path: str, start: int, size: int) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        stream.seek(start)
        return bytes(b & 0xFF for b in stream.readNBytes(size)).decode("utf-8", "replace")
    finally:
        stream.close()


def catalog_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and size of each file (a path or a glob; folders give their files)."""
    fs, p = _open(spark, path)
    out = []
    for status in fs.globStatus(p) or []:
        for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
            name = f.getPath().getName()
            if not f.isDirectory() and not name.startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def record_separator(head: str) -> str | None:
    """The line that ends a record of an indented file, from its first bytes; None
    where the first member stands on the line of the opening brace."""
    m = re.match(r"\s*\{[ \t]*(\r?\n)([ \t]*)\"", head)
    return f"{m[1]}{m[2]}}}," if m else None


def _members(text: Column, file: Column, *order: Column) -> list[Column]:
    """``app_id, record, file, pos`` of a piece of members, made an object of its own."""
    parsed = F.from_json(text, "map<string,string>")
    whole = F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("not a JSON object of records: "), file))
                   .cast("map<string,string>")).otherwise(parsed)
    return [F.posexplode(F.map_entries(whole)).alias("at", "e"), file.alias("file"), *order]


def _selected(rows: DataFrame, *order: str) -> DataFrame:
    return rows.select(F.col("e.key").alias("app_id"), F.col("e.value").alias("record"), "file",
                       F.struct(*order, "at").alias("pos"))


def _inner(text: Column) -> Column:
    """A piece without the brace that opens the file."""
    return F.regexp_replace(text, r"^\s*\{(?=\s*(?:\"|\}|$))", "")


def indented_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(app_id, record, file, pos)`` of indented files, split at record ends."""
    found = None
    for separator, files in _by_separator(spark, path).items():
        if separator is None:
            raise ValueError(f"not an indented object of records: {files[0]}")
        raw = spark.read.text(files, lineSep=separator).select(
            F.col("value"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
        # a piece without the file's own closing brace lacks that of its last record too
        closed = F.col("value").rlike(r"(?:^|\n)\}\s*$|^\s*\{\s*\}\s*$")
        text = F.concat(F.lit("{"), _inner(F.col("value")), F.when(closed, F.lit("")).otherwise(F.lit("}}")))
        rows = _selected(raw.where(F.trim("value") != "").select(
            *_members(text, F.col("file"), F.col("block"), F.col("n"))), "block", "n")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else _empty(spark, "struct<block:bigint,n:bigint,at:int>")


def _empty(spark: SparkSession, pos: str) -> DataFrame:
    return spark.createDataFrame([], f"app_id string, record string, file string, pos {pos}")


def _by_separator(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """Files by their record separator. The last bytes of each are looked at as well:
    a file cut right after a record would else pass for a whole one."""
    out: dict[str | None, list[str]] = {}
    for name, size in catalog_files(spark, path):
        separator = record_separator(_bytes_at(spark, name, 0, 4096))
        end = r"\}\s*\Z" if separator is None else r"(?:\n|\A\s*\{\s*)\}\s*\Z"  # the outer brace, on its own line
        if not re.search(end, _bytes_at(spark, name, max(0, size - 64), 64)):
            raise ValueError(f"not a JSON object of records: {name}")
        out.setdefault(separator, []).append(name)
    return out


def _running(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the pieces of the file before each piece.
    Blocks are summed first; one row a block takes part in that window."""
    rows = rows.withColumn("_v", value)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum("_v").alias("_b")).select(
        "file", "block", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(blocks, ["file", "block"]).withColumn(
        name, F.col("_before") + F.coalesce(F.sum("_v").over(inside), F.lit(0))).drop("_v", "_before")


def _depth_change(text: Column) -> Column:
    """Braces and brackets opened less those closed; strings are gone from ``text``."""
    return (F.length(F.regexp_replace(text, r"[^{\[]", "")) - F.length(F.regexp_replace(text, r"[^}\]]", ""))).cast("long")


def one_line_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(app_id, record, file, pos)`` of files without line breaks between members
    (others are read as well). The pieces are written once to the shared folder."""
    files = [name for name, _ in catalog_files(spark, path)]
    if not files:
        return _empty(spark, "struct<record_no:bigint,at:int>")
    v = F.regexp_replace("value", r"\\.", "")  # no escaped quotes from here on
    outside = F.regexp_replace(v, r'"[^"]*(?:"|$)', "")
    inside = F.regexp_replace(F.regexp_replace(v, r'^[^"]*(?:"|$)', ""), r'"[^"]*(?:"|$)', "")
    pieces = spark.read.text(files, lineSep=CUT).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        F.length(F.regexp_replace(v, '[^"]', "")).cast("long").alias("quotes"),
        _depth_change(outside).alias("from_outside"), _depth_change(inside).alias("from_inside"))
    folder = shared_path(spark, "catalog-pieces", uuid.uuid4().hex)
    pieces.write.parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)

    rows = _running(pieces, F.col("quotes"), "quotes_before")
    begins_inside = F.col("quotes_before") % 2 == 1
    rows = rows.withColumn("ends_outside", (F.col("quotes_before") + F.col("quotes")) % 2 == 0).withColumn(
        "change", F.when(begins_inside, F.col("from_inside")).otherwise(F.col("from_outside")))
    # the cut's own brace closes a level (also counted after the last piece, which has no cut)
    closes = F.when(F.col("ends_outside"), F.lit(1)).otherwise(F.lit(0))
    rows = _running(rows, F.col("change") - closes, "depth_before")
    after = F.col("depth_before") + F.col("change") - closes
    rows = rows.withColumn("ends_record", (F.col("ends_outside") & (after == 1)).cast("long"))
    rows = _running(rows, F.col("ends_record"), "record_no")
    # depth after the last piece is 0 in a whole file; its cut, counted above, does not exist
    whole = rows.groupBy("file", "record_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "value"))),
                                 lambda p: p["value"]), CUT).alias("text"),
        F.max("ends_record").alias("ended"), F.sum(F.col("change") - closes).alias("change"),
        F.min(F.struct("block", "n", "depth_before"))["depth_before"].alias("depth"))
    ended = F.col("ended") == 1
    at_end = F.col("depth") + F.col("change") == -1  # the file's own brace, and the cut that is not there
    text = F.concat(F.lit("{"), _inner(F.col("text")),
                    F.when(ended, F.lit("}}")).when(at_end, F.lit("")).otherwise(F.lit("<cut>")))
    rest = whole.where(ended | (F.trim("text") != ""))
    return _selected(rest.select(*_members(text, F.col("file"), F.col("record_no"))), "record_no")

"""The app list: the cached one, else the landed payload, which is then cached (SRC3).

  lists/<id>/       a whole list in the catalog's JSON form (``write_id_sets``)
  versions/<n>      the folder of version n

A list is written to a folder of its own first and then named by a version, taken by
put-if-absent: of two writers at once one wins and both return the winner's list. Readers
of an older version are not disturbed; a version whose list is not whole counts as none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sinks.files import DEFAULT_CHUNK_SIZE, write_id_sets
from ..sources.files import id_set, path_exists, remove_folder
from .registry import names, put_if_absent, read_text


def _versions(spark: SparkSession, cache: str) -> list[int]:
    return sorted(int(n) for n in names(spark, f"{cache}/versions") if n.isdigit())


def _whole(spark: SparkSession, cache: str, number: int) -> str | None:
    """The folder of a version's list; None where it is not whole."""
    name = read_text(spark, f"{cache}/versions/{number}")
    folder = f"{cache}/lists/{name}"
    return folder if name and path_exists(spark, f"{folder}/_SUCCESS") is not False else None


def cached_list(spark: SparkSession, cache: str) -> DataFrame | None:
    """``(app_id)`` of the latest version; None without one, or where its list is not whole."""
    cache = cache.rstrip("/")
    known = _versions(spark, cache)
    folder = _whole(spark, cache, known[-1]) if known else None
    return id_set(spark, folder) if folder else None


def publish_list(spark: SparkSession, cache: str, ids: DataFrame, chunk_rows: int = DEFAULT_CHUNK_SIZE,
                 keep_versions: int = 3) -> DataFrame:
    """Write ``ids (app_id)`` as the next version; returns the list then current, which is
    another writer's where that one was first."""
    cache = cache.rstrip("/")
    number = max(_versions(spark, cache), default=0) + 1
    name = uuid.uuid4().hex
    write_id_sets(ids, f"{cache}/lists/{name}", chunk_rows)
    if not put_if_absent(spark, f"{cache}/versions/{number}", name):
        remove_folder(spark, f"{cache}/lists/{name}")
    for old in _versions(spark, cache)[:-max(1, keep_versions)]:
        gone = read_text(spark, f"{cache}/versions/{old}")
        remove_folder(spark, f"{cache}/versions/{old}")
        if gone:
            remove_folder(spark, f"{cache}/lists/{gone}")
    current = cached_list(spark, cache)
    if current is None:
        raise RuntimeError(f"{cache}: the version just published is not whole")
    return current


def resolve_app_list(spark: SparkSession, cache: str, landed: Callable[[], DataFrame],
                     chunk_rows: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """The cached list where there is one; else ``landed()``, published first. ``landed`` is
    not called when the cache is used."""
    cached = cached_list(spark, cache)
    return cached if cached is not None else publish_list(spark, cache, landed(), chunk_rows)

"""Flatten JSON records to the 29-column base table (PRJ1, PRJ2, DF3).

Each record is parsed as ``map<string,string>``: unlike a struct, a map tells
a missing key (default applies) from a key holding JSON ``null`` (stays
NULL). List fields are parsed from their JSON text and joined with ', '; a
NULL list counts as empty. A record that is not a JSON object raises with its
app: it would otherwise become a row of defaults that every report counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.text import join_list


def _field(m: Column, name: str, dtype: T.DataType, default) -> Column:
    raw = m[name]
    if name in S.LIST_COLUMNS:
        value = join_list(F.from_json(raw, "array<string>"))
        return F.when(F.map_contains_key(m, name), value).otherwise(F.lit(""))
    if isinstance(dtype, T.StringType):
        value = raw
    else:
        value = raw.try_cast(dtype)
    return F.when(F.map_contains_key(m, name), value).otherwise(F.lit(default).cast(dtype))


def flatten_records(df: DataFrame, record: str = "record", app_id: str = "app_id") -> DataFrame:
    """``(app_id, record JSON text)`` -> base table with the fixed schema."""
    parsed = F.from_json(F.col(record), "map<string,string>")
    m = F.when(parsed.isNull(), F.raise_error(F.concat(
        F.lit("not a JSON object: record of app "), F.coalesce(F.col(app_id).cast("string"), F.lit("NULL"))))
        .cast("map<string,string>")).otherwise(parsed)
    cols = [F.col(app_id).cast("string").alias("app_id")]
    for name, dtype, default in S.BASE_COLUMNS[1:]:
        cols.append(_field(F.col("_m"), name, dtype, default).alias(name))
    return df.select(app_id, m.alias("_m")).select(*cols)


def flatten_struct(df: DataFrame, record: str = "record", app_id: str = "app_id",
                   keep=()) -> DataFrame:
    """``(app_id, record struct)`` -> base table; absent struct fields get defaults.

    Columns named in ``keep`` are carried along after the base columns.
    """
    have = set(df.schema[record].dataType.fieldNames())
    cols = [F.col(app_id).cast("string").alias("app_id")]
    for name, dtype, default in S.BASE_COLUMNS[1:]:
        field = F.col(f"{record}.{name}")
        if name not in have:
            value = F.lit("" if name in S.LIST_COLUMNS else default).cast(dtype)
        elif name in S.LIST_COLUMNS:
            value = join_list(field)
        else:
            value = field.cast(dtype)
        cols.append(value.alias(name))
    return df.select(*cols, *keep)

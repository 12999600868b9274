"""JDBC sink (SNK6-SNK8): create the table when absent, write in parallel.

Spark's JDBC writer opens one connection per partition on the executors and
inserts in batches; ``numPartitions`` bounds the connections. Column types
come from Spark's dialect for the URL; nested and other types without a SQL
type are written as JSON text (the TEXT fallback).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types with a JDBC mapping in Spark's dialects.
_SQL_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType,
              T.FloatType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.DecimalType, T.BinaryType)


def connection_options(**overrides) -> dict[str, str]:
    """Connection options from the standard libpq variables, with defaults."""
    host = os.environ.get("PGHOST", "localhost")
    port = os.environ.get("PGPORT", "5432")
    db = os.environ.get("PGDATABASE", "catalog")
    opts = {
        "url": f"jdbc:postgresql://{host}:{port}/{db}",
        "user": os.environ.get("PGUSER", "postgres"),
        "password": os.environ.get("PGPASSWORD", ""),
        "driver": "org.postgresql.Driver",
    }
    opts.update({k: str(v) for k, v in overrides.items()})
    return opts


def sql_ready(df: DataFrame) -> DataFrame:
    """Columns without a SQL type as text: arrays, maps and structs as JSON, others cast."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _SQL_TYPES):
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "overwrite",
               batchsize: int = 10000, num_partitions: int = 8) -> None:
    """SNK6: write ``df`` to ``table``; created from the schema when absent.

    ``overwrite`` truncates an existing table (keeps its DDL) instead of
    appending duplicates on a re-run; pass ``mode="append"`` to append.
    """
    (sql_ready(df).write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", str(batchsize))
        .option("numPartitions", str(num_partitions))
        .option("truncate", "true")
        .mode(mode)
        .save())


def load_all(tables: dict[str, DataFrame], options: dict[str, str], mode: str = "overwrite") -> None:
    """SNK8: each table to the SQL table of its name (base first)."""
    for name, df in tables.items():
        write_jdbc(df, name, options, mode)

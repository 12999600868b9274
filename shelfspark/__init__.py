"""shelfspark — catalog analytics on Spark.

Layout:
  functions/  column functions (text cleaning, parsing, lists)
  sources/    readers: keyed-object JSON, chunk folders, status tables,
              Parquet tables, the driver-table adapter
  sinks/      writers: JSON, chunked append, Parquet, JDBC
  operators/  DataFrame transforms: ingest, flatten, upsert, describe, top-k
  plans/      the reports and the end-to-end jobs (ingest, publish, load)
  streaming/  the ingest job over a landing folder with Structured Streaming
"""

__version__ = "0.1.0"

"""adlens: keyword-level ad performance analytics on Spark DataFrames.

Layout
------
functions/  column expressions (safe casts, dates, ratios, JSON fields)
sources/    readers: CSV text, landed API responses, partitioned tables,
            report documents, and the projections of the driver tables
sinks/      partitioned Parquet writes, catalog tables, report rows
operators/  ingest typing, joins, aggregations, windows, top-k, lookups
plans/      report builders composed from the operators
streaming/  Structured Streaming ingest and dead-letter metrics
"""

__all__ = ["session"]

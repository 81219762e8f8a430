"""ledgerlens: Spark-native medallion analytics for card-payment events.

Layers: ``sources`` (bronze text, parquet tables, fixtures derived from the
driver tables), ``functions`` (Column -> Column helpers), ``operators``
(DataFrame -> DataFrame building blocks: data quality, dedup, marts, geo
range join), ``plans`` (end-to-end jobs and reporting views), ``sinks``
(rerun-safe writers and table DDL) and ``streaming`` (Structured Streaming
versions of the same transforms).
"""

__all__ = ["session"]

"""sparkmart: retail / payment data work expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers (CSV as typed strings, Parquet, Kafka, JDBC, driver-table roles)
  sinks      writers (Parquet facts, versioned tables, streaming report sinks)
  functions  column expressions (validation rules, phone format, bands, parsing)
  operators  reusable relational building blocks (range join, group minimum,
             last row per key, running count, upsert, quality checks)
  plans      the workloads themselves, DataFrame in / DataFrame out
  streaming  Structured Streaming runners over the same plan functions
"""
from sparkmart.session import build_session, scratch_dir, sizing_conf

__version__ = "0.1.0"
__all__ = ["build_session", "scratch_dir", "sizing_conf", "__version__"]

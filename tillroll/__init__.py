"""tillroll — customer / product / market analytics on order lines, written as
lazy Spark DataFrame plans.

Layout:
  sources/    readers, writers, merge (upsert) and the test-table adapter
  functions/  column expressions (dates, money, fixed label rules)
  operators/  reusable relational building blocks (ranking, binning, quantiles, stats)
  plans/      the named analyses, dashboard datasets, library queries, profiling
  streaming/  incremental folder ingest with Structured Streaming
"""

__version__ = "0.1.0"

"""vialflow: Spark-native analytics for nested event records.

Layers:
  sources/    readers and writers (parquet tables, nested JSON events, report sinks)
  functions/  column-expression helpers (dates, hours, severity levels, exact rounding)
  operators/  relational building blocks (aggregates, child rows, pivots, windows,
              top-k, ranking, audits, machine learning)
  plans/      composed jobs: the query catalogue, the star-schema build, the report job
  streaming/  incremental refresh of the materialised aggregates
"""

__version__ = "0.1.0"

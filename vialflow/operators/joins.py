"""Join helpers. No hints: a stored dimension is broadcast when its file statistics are under
Spark's threshold, a derived one when its runtime size is (AQE); beyond it the join shuffles.
Building a query starts no job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a side that is usually small; its size decides the strategy at run time."""
    return big.join(small, on, how)


def anti_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Number of child rows whose key has no parent (orphans). NULL child keys are not
    orphans, as with SQL foreign keys.

    Child rows are first counted per key (map-side partial aggregation), so the anti join
    shuffles distinct keys with their counts instead of every child row, and a key held by
    a third of the rows is a single row by the time it reaches the join."""
    c = child.select(F.col(child_key).alias("_k")).where(F.col("_k").isNotNull()) \
        .groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    p = parent.select(F.col(parent_key).alias("_k")).distinct()
    return c.join(p, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("huerfanos"))

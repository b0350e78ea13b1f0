"""Grouped counts, conditional sums, shares and rates over role columns.

All aggregations are plain ``groupBy().agg()`` so Spark runs a partial (map-side)
aggregate before the shuffle; a hot key therefore contributes one row per map task,
not all its rows, to the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_ratio

# Output names of the three severity measures, keyed by level (1 = most severe).
LEVEL_MEASURES = {1: "con_muertos", 2: "con_heridos", 3: "solo_danos"}


def count_rows(name: str = "total") -> Column:
    return F.count(F.lit(1)).alias(name)


def count_by(df: DataFrame, keys, name: str = "total") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(count_rows(name))


def count_when(cond: Column) -> Column:
    """Conditional count as BIGINT (``count_if``)."""
    return F.count_if(cond)


def level_measures(level_col: str = "gravedad_nivel", measures: dict | None = None) -> list[Column]:
    measures = measures or LEVEL_MEASURES
    return [count_when(F.col(level_col) == lvl).alias(name) for lvl, name in measures.items()]


def conditional_counts(df: DataFrame, keys, level_col: str = "gravedad_nivel",
                       total: str = "total", measures: dict | None = None) -> DataFrame:
    """total plus one count per severity level (G5, G8, G11, G36 shapes)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(count_rows(total), *level_measures(level_col, measures))


def sum_measures(df: DataFrame, keys, cols: list[str]) -> DataFrame:
    """Second-level roll-up of already counted columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in cols])


def with_share(df: DataFrame, count_col: str, out: str = "pct", scale: int = 100,
               digits: int = 1, within: list[str] | None = None) -> DataFrame:
    """Share of each row in the total of its partition.

    Use on an *aggregated* result: the window without keys moves every row to one task,
    which is fine for a bounded number of groups (hours, levels, years) only.
    """
    w = Window.partitionBy(*(within or []))
    return df.withColumn(out, round_ratio(F.col(count_col), F.sum(count_col).over(w), scale, digits))


def with_ratio_to_max(df: DataFrame, col: str, out: str = "ratio") -> DataFrame:
    """value / max(value) over the bounded aggregated result (W5); NULL when the maximum is 0."""
    return df.withColumn(out, F.try_divide(F.col(col).cast("double"), F.max(col).over(Window.partitionBy())))


def place_rollup(events: DataFrame, event_place: DataFrame, extra_keys: list[str] | None = None,
                 level_col: str = "gravedad_nivel") -> DataFrame:
    """Conditional counts per place (and optional extra keys such as year).

    Aggregate-before-join: events are first reduced per customer (partial aggregation
    collapses hot customers map-side), the reduced rows are joined to the customer ->
    place table on the same key, and summed again per place. The big event table never
    enters the join.
    """
    extra_keys = extra_keys or []
    per_client = conditional_counts(events, ["cliente", *extra_keys], level_col)
    cols = ["total", *LEVEL_MEASURES.values()]
    joined = per_client.join(event_place, "cliente")
    return sum_measures(joined, ["localidad", *extra_keys], cols)


def first_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """W6 first-wins per natural key: one ``min_by`` aggregate, combined on the map side, so a
    key repeated in a third of the rows is one row of each task before the shuffle."""
    payload = [c for c in df.columns if c not in (key, *order_cols)]
    first = df.groupBy(key).agg(F.min_by(F.struct(*payload), F.struct(*order_cols)).alias("_r"))
    return first.select(key, "_r.*")

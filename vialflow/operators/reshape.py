"""Long <-> wide reshaping, windows over aggregated results, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, keys, pivot_col: str, values: dict[str, str],
                 total: str | None = "total") -> DataFrame:
    """Long -> wide counts with a fixed value list and zero default.

    ``values`` maps the pivoted value to its output column. Rows whose value is outside the
    list count only in ``total`` (the reference's actor pivot does the same). Written as
    conditional counts so it is one partial+final aggregate, no second pass.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [F.count_if(F.col(pivot_col) == v).alias(name) for v, name in values.items()]
    if total:
        aggs.insert(0, F.count(F.lit(1)).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def pivot_sum(df: DataFrame, keys, pivot_col: str, value_col: str, values: dict[str, str]) -> DataFrame:
    """Long -> wide on an already counted long table (value list fixed, missing cell = 0)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [F.coalesce(F.sum(F.when(F.col(pivot_col) == v, F.col(value_col))), F.lit(0)).cast("long").alias(n)
            for v, n in values.items()]
    return df.groupBy(*keys).agg(*aggs)


def unpivot_counts(df: DataFrame, ids: list[str], columns: dict[str, str],
                   name: str, value: str) -> DataFrame:
    """Wide -> long: ``columns`` maps the wide column to the label written in ``name``.
    Together with ``pivot_counts`` this zero-fills every level for each key that exists,
    without a cross join of keys and levels."""
    renamed = df.select(*ids, *[F.col(c).alias(lbl) for c, lbl in columns.items()])
    return renamed.unpivot(ids, list(columns.values()), name, value)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT k with a full, deterministic order (callers add a key tie-break).
    Spark plans this as TakeOrderedAndProject: each task keeps its k best, one task merges."""
    return df.orderBy(*order).limit(k)


def first_per_group(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """Rank-1 row per group (W7). Spark inserts a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most one row per group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def sort_by_choice(df: DataFrame, column: str, descending: bool = True,
                   collation: str | None = None, tie: str | None = None) -> DataFrame:
    """User-selected sort column and direction (L6). Text columns may sort with a
    locale-aware collation, e.g. ``es_AI``."""
    c = F.col(column)
    if collation:
        c = F.collate(c, collation)
    order = [c.desc_nulls_last() if descending else c.asc_nulls_last()]
    if tie:
        order.append(F.col(tie).asc())
    return df.orderBy(*order)


def gather_in_order(rows: DataFrame, key: str, order: list[str], values: list[str], out: str = "hijos",
                    block: int = 4096) -> DataFrame:
    """Per ``key`` one array of structs of ``values``, an element a row, in the order of
    ``order`` (its last column is a position). Rows are gathered and sorted by block of
    positions first, so the children of one huge event are sorted by many tasks and only laid
    end to end at the last."""
    place = F.struct(*order[:-1], F.floor(F.col(order[-1]) / block).alias("_b"))
    parts = rows.groupBy(key, place.alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct(*order, *values))).alias("_rows"))
    per = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_block", "_rows"))).alias("_parts"))
    whole = F.flatten(F.transform("_parts", lambda p: p["_rows"]))
    return per.select(key, F.transform(whole, lambda r: F.struct(*[r[v].alias(v) for v in values])).alias(out))

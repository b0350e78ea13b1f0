"""Data audits re-aimed from the reference's database constraints and smoke checks.

Each audit returns a small report DataFrame (one row per checked rule) so a whole audit
suite is one Spark job graph with no driver loops over data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import anti_count


def _label(df: DataFrame, **labels) -> DataFrame:
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], *df.columns)


def foreign_keys(pairs: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """A1: orphan count per (child table.key -> parent table.key) pair via left_anti."""
    parts = [_label(anti_count(c, p, ck, pk), hijo=f"{cn}.{ck}", padre=f"{pn}.{pk}")
             for cn, c, ck, pn, p, pk in pairs]
    return reduce(DataFrame.unionByName, parts)


def unique_keys(checks: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """A2: number of key values that occur more than once, and the surplus rows."""
    parts = []
    for name, df, keys in checks:
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        r = g.agg(F.count(F.lit(1)).alias("claves_repetidas"),
                  F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("filas_sobrantes"))
        parts.append(_label(r, tabla=name, clave=",".join(keys)))
    return reduce(DataFrame.unionByName, parts)


def not_null(checks: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """A3: NULL count per column; one pass per table (all columns in one aggregate)."""
    parts = []
    for name, df, cols in checks:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        long = wide.unpivot([], cols, "columna", "nulos")
        parts.append(_label(long, tabla=name))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """Labelled row counts, UNION ALL."""
    parts = [df.agg(F.lit(n).alias("tabla"), F.count(F.lit(1)).alias("filas")) for n, df in tables]
    return reduce(DataFrame.unionByName, parts)


def output_contract(name: str, df: DataFrame, required: list[str]) -> DataFrame:
    """One row (consulta, faltan, vacia, ok): the required columns that the analysed plan
    does not have, and whether there is no row (one row is read). Building it runs nothing."""
    missing = ",".join(sorted(set(required) - set(df.columns)))
    empty = df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) == 0).alias("vacia"))
    return empty.select(F.lit(name).alias("consulta"), F.lit(missing).alias("faltan"), "vacia",
                        (~F.col("vacia") & F.lit(not missing)).alias("ok"))

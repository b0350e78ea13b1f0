"""Loading further batches into a warehouse already stored (W4, W6, S5): members keep the keys
they have, new members get the next ones, events already stored are left as they are.

A batch is written to a folder of its own and becomes visible by one small file under
``_commits``, created last and never overwritten: readers list the commits and read the
batches they name, so nobody sees half a batch, and of two loaders that take the same batch
number one fails. Stored rows are never rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import date_key
from ..operators.aggregates import first_per_key
from ..operators.joins import join_small
from ..sources.tables import EventSource

TABLES = ("dim_members", "fact_siniestros")


# ------------------------------------------------------------------ keys and rows
def assign_keys(stored: DataFrame | None, values: DataFrame, group: str = "dimension", value: str = "descripcion",
                key: str = "member_id") -> DataFrame:
    """Members of ``values`` (group, value, further columns) that ``stored`` lacks, with the next
    keys of their group in order of value. NULL values are no members; repeated ones are one.

    The new members are an anti join on (group, value); the window numbers distinct new values
    only, as wide as a vocabulary, and each group's start is its highest stored key."""
    new = values.where(F.col(value).isNotNull()).dropDuplicates([group, value])
    if stored is not None:
        new = new.join(stored.select(group, value), [group, value], "left_anti")
    numbered = new.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(value)))
    if stored is None:
        return numbered.withColumn(key, F.col("_n").cast("int")).drop("_n")
    last = stored.groupBy(group).agg(F.max(key).alias("_last"))
    numbered = join_small(numbered, last, group, "left")
    return numbered.withColumn(key, (F.coalesce("_last", F.lit(0)) + F.col("_n")).cast("int")).drop("_n", "_last")


def new_rows(stored: DataFrame | None, rows: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Rows to insert without conflict: the first of each key in ``rows``, unless the key is
    stored. Only keys of the stored table are read."""
    first = first_per_key(rows.withColumn("_order", F.struct(*order_cols)), key, ["_order"])
    return first if stored is None else first.join(stored.select(key), key, "left_anti")


def member_values(events: DataFrame) -> DataFrame:
    """(dimension, descripcion, nivel) of the events' own dimensions."""
    parts = [events.select(F.lit("gravedad").alias("dimension"), F.col("gravedad").alias("descripcion"), F.col("gravedad_nivel").alias("nivel")),
             events.select(F.lit("clase"), F.col("clase"), F.lit(None).cast("int"))]
    return reduce(DataFrame.union, parts).distinct()


def keyed(events: DataFrame, members: DataFrame, batch: int) -> DataFrame:
    """Fact rows of a batch with the keys of their members."""
    def of(dimension: str, name: str) -> DataFrame:
        return members.where(F.col("dimension") == dimension).select(F.col("member_id").alias(f"{name}_id"), F.col("descripcion").alias(name))
    f = join_small(events, of("clase", "clase"), "clase", "left")
    f = join_small(f, of("gravedad", "gravedad"), "gravedad", "left")
    return f.select("codigo_accidente", date_key("fecha").alias("fecha_id"), "gravedad_id", "clase_id", "hora", F.lit(batch).alias("lote"))


def batch_of(events: DataFrame, members: DataFrame | None, fact: DataFrame | None, batch: int) -> tuple[DataFrame, DataFrame]:
    """(members to add, fact rows to add) for a batch of events."""
    order = [c for c in ("fecha", "cliente", "hora", "gravedad", "clase") if c in events.columns]
    rows = new_rows(fact, events, "codigo_accidente", order)
    added = assign_keys(members, member_values(rows)).select("dimension", "member_id", "descripcion", "nivel")
    return added, keyed(rows, added if members is None else members.unionByName(added), batch)


# ------------------------------------------------------------------ stored batches
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the batches that are whole, ascending."""
    fs, folder = _fs(spark, f"{out.rstrip('/')}/_commits")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)) if fs.exists(folder) else []


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame | None:
    """A table of all batches committed when this is called; None before the first."""
    paths = [f"{out.rstrip('/')}/batch-{n}/{name}" for n in committed(spark, out)]
    return spark.read.parquet(*paths) if paths else None


def load_batch(s: EventSource, out: str, events: DataFrame | None = None) -> int:
    """Append the source's events (or ``events``) to the warehouse under ``out``; returns the
    batch's number. Loading the same events again adds nothing. A load that fails leaves a
    folder that no commit names."""
    spark = s.spark
    done = committed(spark, out)
    batch = (done[-1] if done else 0) + 1
    events = s.events() if events is None else events
    members, fact = (read_table(spark, out, t) for t in TABLES)
    added, rows = batch_of(events, members, fact, batch)
    base = f"{out.rstrip('/')}/batch-{batch}"
    added.write.mode("overwrite").parquet(f"{base}/{TABLES[0]}")
    # keys are read back, so facts and members agree whatever happens to a task
    stored = spark.read.schema(added.schema).parquet(f"{base}/{TABLES[0]}")
    every = stored if members is None else members.unionByName(stored)
    order = [c for c in ("fecha", "cliente", "hora", "gravedad", "clase") if c in events.columns]
    keyed(new_rows(fact, events, "codigo_accidente", order), every, batch).write.mode("overwrite").parquet(f"{base}/{TABLES[1]}")
    fs, mark = _fs(spark, f"{out.rstrip('/')}/_commits/{batch}")
    fs.create(mark, False).close()
    return batch

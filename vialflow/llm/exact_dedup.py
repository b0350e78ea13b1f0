"""Exact deduplication by content sort (DataFrame operations only).

Sampled splitters cut the order (first normalised bytes, digest, doc_id) into ranges; each is
sorted externally by Spark's window operator, neighbours are compared in full, and runs of
equal texts that cross a range boundary are joined through the ranges' edge rows. The
doc_id is part of the range key, so copies of one text that hold a third of all rows spread
over many ranges; no group of copies is ever gathered. The whole text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, normal_space, ordered_id, partitions, sampled_splitters, stored

PREFIX = 48     # characters of the text in the range key; the digest orders the rest


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: bool = False, ranges: int | None = None) -> DataFrame:
    """Group rows of ``docs`` whose texts are equal after replacing each white-space run by
    one space.

    Returns per input row: doc_id, keep_id (smallest doc_id of the group), group_size,
    kept (true for one row of the group), text_sha256 (of the normalised text). With
    ``carry`` the rows keep their own columns and get ``_keep_id, _group_size, _kept,
    _text_sha256`` instead.

    Cases: a null text counts as empty; a null doc_id sorts last and is kept only when the
    whole group has none (keep_id is then null); rows repeated with one doc_id are one group
    of which one row is kept; an empty table gives no rows; other columns, whatever their
    names, are not read unless carried.
    """
    spark = docs.sparkSession
    n_ranges = ranges or 2 * partitions(spark)
    norm = normal_space(F.col(text_col))
    one = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm"), one.alias("row"))
    rows = rows.select("*", F.sha2("norm", 256).alias("sha"))
    rows = rows.withColumn("k", F.concat(F.substring("norm", 1, PREFIX), F.lit("\x00"), "sha", ordered_id(F.col("id"))))
    total = docs.count()
    cuts = sampled_splitters(rows.select("k"), n_ranges, total)
    if carry:   # the raw row travels; the normalised text is made again behind the exchange
        rows = rows.drop("norm")
    rows = rows.withColumn("bucket", bucket_of(F.col("k"), cuts)).drop("k")
    if carry:
        rows = rows.repartition(partitions(spark), "bucket").withColumn("norm", normal_space(F.col(f"row.{text_col}")))

    nulls_last = F.col("id").asc_nulls_last()
    # the order of the range key, so that a range's last run is the one that may go on
    w = Window.partitionBy("bucket").orderBy(F.concat(F.substring("norm", 1, PREFIX), F.lit("\x00"), "sha"), "norm", nulls_last)
    r = rows.select("bucket", "id", "sha", "row", "norm",
                    F.lag("norm").over(w).alias("before"), F.lead(F.lit(1)).over(w).alias("more"),
                    F.row_number().over(w).alias("place"))
    first = F.col("before").isNull() | (F.col("before") != F.col("norm"))
    r = r.select("bucket", "id", "sha", "row", "place", first.cast("long").alias("first"),
                 F.when((F.col("place") == 1) | F.col("more").isNull(), F.col("norm")).alias("edge"))
    r = r.withColumn("run", F.sum("first").over(Window.partitionBy("bucket").orderBy("place")))
    in_run = Window.partitionBy("bucket", "run")
    r = r.select("bucket", "run", "id", "sha", "row", "edge", "first",
                 F.min("id").over(in_run).alias("run_keep"), F.count(F.lit(1)).over(in_run).alias("run_size"))
    r = stored(r, "sorted")
    return _joined_ranges(r, id_col, carry)


def _joined_ranges(r: DataFrame, id_col: str, carry: bool) -> DataFrame:
    """Join the runs that cross range boundaries. Works on one row per range."""
    per = r.filter(F.col("edge").isNotNull()).groupBy("bucket").agg(
        F.min_by("edge", F.col("run")).alias("first_text"), F.max_by("edge", F.col("run")).alias("last_text"),
        F.max("run").alias("runs"),
        F.min_by("run_keep", "run").alias("first_keep"), F.min_by("run_size", "run").alias("first_size"),
        F.max_by("run_keep", "run").alias("last_keep"), F.max_by("run_size", "run").alias("last_size"))
    by = Window.orderBy("bucket")   # one row per range: bounded by the number of ranges
    per = per.withColumn("goes_on", F.coalesce(F.lag("last_text").over(by) == F.col("first_text"), F.lit(False)))
    per = per.withColumn("head", F.max(F.when(~(F.col("goes_on") & (F.col("runs") == 1)), F.col("bucket"))).over(
        by.rowsBetween(Window.unboundedPreceding, 0)))
    per = per.withColumn("head_before", F.lag("head").over(by)).drop("first_text", "last_text")
    tails = per.select("bucket", F.col("runs").alias("run"), F.col("head").alias("chain"),
                       F.col("last_keep").alias("keep"), F.col("last_size").alias("n"))
    fronts = per.filter(F.col("goes_on") & (F.col("runs") > 1)).select(
        "bucket", F.lit(1).cast("long").alias("run"), F.col("head_before").alias("chain"),
        F.col("first_keep").alias("keep"), F.col("first_size").alias("n"))
    whole = Window.partitionBy("chain")
    parts = tails.unionByName(fronts).select(
        "bucket", "run", F.min("keep").over(whole).alias("chain_keep"), F.sum("n").over(whole).alias("chain_size"),
        (F.row_number().over(whole.orderBy("bucket")) > 1).alias("later"))
    # at most two rows per range: broadcasting them is bounded by the number of ranges
    r = r.join(F.broadcast(parts), ["bucket", "run"], "left")
    keep = F.when(F.col("chain_size").isNotNull(), F.col("chain_keep")).otherwise(F.col("run_keep"))
    size = F.coalesce("chain_size", "run_size")
    kept = (F.col("first") == 1) & ~F.coalesce("later", F.lit(False))
    if carry:
        return r.select("row", keep.alias("_keep_id"), size.alias("_group_size"), kept.alias("_kept"),
                        F.col("sha").alias("_text_sha256"))
    return r.select(F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"),
                    F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    return content_sort(docs, id_col, text_col, carry=True).filter("_kept").select("row.*")

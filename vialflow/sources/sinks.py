"""Writers: tables (S5/S7/S8), one-document JSON reports (S6), precomputed aggregate
ingest (S9). Writers go through the DataFrame writer, which commits per task and retries
lost tasks; a replaced table is a new version first, which readers see once it is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Batched insert / create-table-as-select. Partitioning by a low-cardinality
    column (e.g. year) lets later date filters prune whole directories."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "append",
               batchsize: int = 500, partitions: int | None = None) -> None:
    """S5 against a database: rows go in batches of ``batchsize`` from each partition.
    Connection options come from the caller; nothing is hard-coded here."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode(mode).option("batchsize", batchsize).jdbc(url, table, properties=properties)


def replace_table(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Replace a catalog table with a new version. With a v2 catalog configured (Delta,
    Iceberg) the swap is one atomic CREATE OR REPLACE. With the built-in session catalog every
    version is a table of its own and ``name`` a view of the last whole one: replacing the view
    is one change of the catalog, so a reader gets the old rows or the new ones and a failed
    build leaves ``name`` as it was. Earlier versions stay for readers that still use them;
    ``drop_versions`` removes them. A plain table called ``name`` is refused."""
    if spark.conf.get("spark.sql.catalog.spark_catalog", None):
        w = df.writeTo(name)
        if partition_by:
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return
    import uuid
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table: rename it once, then replace_table keeps versions behind a view of that name")
    version = f"{name}__{uuid.uuid4().hex}"
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(version)
    columns = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {version}")


def drop_versions(spark: SparkSession, name: str) -> int:
    """Drop the versions of ``name`` that the view does not read any more; their number."""
    db, _, short = name.rpartition(".")
    used = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    old = [t.name for t in spark.catalog.listTables(db or None) if t.name.startswith(f"{short.lower()}__") and t.name not in used]
    for t in old:
        spark.sql(f"DROP TABLE {db + '.' if db else ''}{t}")
    return len(old)


def report_document(parts: dict[str, DataFrame], scalars: dict | None = None) -> DataFrame:
    """One JSON document from several small aggregate results. Each part becomes a
    JSON array of row objects (``collect_list(struct)`` over an aggregated, bounded result);
    the parts are unioned as (name, json) rows and stitched into one object, JVM-side. The
    arrays keep the parts' order (ids grow along the partitions of a sorted result) and NULL
    fields."""
    import json
    from functools import reduce

    def array(df: DataFrame):
        rows = F.array_sort(F.collect_list(F.struct("_place", F.struct(*df.columns).alias("row"))))
        return F.to_json(F.transform(rows, lambda r: r["row"]), {"ignoreNullFields": "false"})

    rows = [df.withColumn("_place", F.monotonically_increasing_id()).agg(F.lit(name).alias("k"), array(df).alias("v"))
            for name, df in parts.items()]
    kv = reduce(DataFrame.unionByName, rows)
    for k, v in (scalars or {}).items():
        kv = kv.unionByName(kv.sparkSession.range(1).select(F.lit(k).alias("k"), F.lit(json.dumps(v)).alias("v")))
    entry = F.concat(F.lit('"'), F.col("k"), F.lit('":'), F.col("v"))
    return kv.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ","), F.lit("}"))
                  .alias("json"))


def write_report(doc: DataFrame, path: str) -> str:
    """Write the one-line JSON document as a single text file part."""
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


def ingest_precomputed(spark: SparkSession, path: str, renames: dict[str, str], out: str,
                       mode: str = "overwrite") -> DataFrame:
    """Read a published aggregate (JSON array of objects), rename its columns to the
    warehouse names and store it."""
    df = spark.read.option("multiLine", "true").json(path).withColumnsRenamed(renames)
    write_table(df, out, mode)
    return df


def named_counts(df: DataFrame, key: str, value: str = "total") -> DataFrame:
    """Rows -> one map name -> count (for a report field)."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value)))).alias(key))

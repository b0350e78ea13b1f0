"""Sinks and SQL registration: partitioned writes, table replacement, one-document
reports, aggregate ingest, temporary views, nested JSON converted to Parquet."""

import glob
import json
import os
import tempfile

from conftest import SF0001


def test_write_replace_and_ingest(spark, queries):
    from vialflow.sources.sinks import ingest_precomputed, replace_table, write_table
    d = tempfile.mkdtemp(prefix="vialflow-sinks-")
    trend = queries["monthly_trend"](spark, SF0001)
    p = write_table(trend, os.path.join(d, "trend"), mode="overwrite", partition_by=["anio"])
    assert spark.read.parquet(p).count() == trend.count()
    assert glob.glob(os.path.join(p, "anio=*"))
    # a published aggregate as a JSON array of objects, renamed into warehouse names on ingest
    src = os.path.join(d, "tendencia.json")
    with open(src, "w") as f:
        json.dump([r.asDict() for r in trend.collect()], f)
    got = ingest_precomputed(spark, src, {"total": "total_siniestros"}, os.path.join(d, "agg"))
    assert "total_siniestros" in got.columns and got.count() == trend.count()
    replace_table(spark, trend, "vialflow_t")
    replace_table(spark, trend.limit(2), "vialflow_t")
    assert spark.table("vialflow_t").count() == 2
    spark.sql("DROP VIEW vialflow_t")


def test_replace_is_one_step(spark, monkeypatch):
    from pyspark.sql import functions as F
    from vialflow.sources.sinks import drop_versions, replace_table
    rows = spark.range(6).select((F.col("id") % 2).cast("string").alias("part"), F.col("id").alias("v"))
    replace_table(spark, rows, "vialflow_r", ["part"])
    reader = spark.table("vialflow_r")
    # a build that fails in the middle, and one that is stopped before the switch
    bad = rows.withColumn("v", F.when(F.col("v") < 5, F.col("v")).otherwise(F.raise_error("broken")))
    try:
        replace_table(spark, bad, "vialflow_r", ["part"])
    except Exception as e:
        assert "broken" in str(e)
    statements = []
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: statements.append((q, self.table("vialflow_r").count())))
    replace_table(spark, rows.filter("v > 3").withColumn("w", F.lit(1)), "vialflow_r", ["part"])
    monkeypatch.undo()
    assert len(statements) == 1 and statements[0][1] == 6         # whole new version, old rows until the one switch
    assert spark.table("vialflow_r").count() == 6
    spark.sql(statements[0][0])
    got = spark.table("vialflow_r")
    assert got.columns == ["part", "v", "w"] and got.schema["part"].dataType.simpleString() == "string" and got.count() == 2
    assert reader.count() == 6
    assert drop_versions(spark, "vialflow_r") >= 1 and spark.table("vialflow_r").count() == 2
    spark.range(1).write.mode("overwrite").saveAsTable("vialflow_plain")
    try:
        replace_table(spark, rows, "vialflow_plain")
        raise AssertionError("a table was replaced")
    except ValueError:
        pass
    spark.sql("DROP TABLE vialflow_plain")
    spark.sql("DROP VIEW vialflow_r")


def test_report_document_and_named_counts(spark, queries):
    from vialflow.sources.sinks import named_counts, report_document
    sev = queries["severity_counts"](spark, SF0001)
    doc = json.loads(report_document({"gravedad": sev}, {"n": 3}).first().json)
    assert doc["n"] == 3 and sum(r["total"] for r in doc["gravedad"]) == sum(r.total for r in sev.collect())
    m = named_counts(sev, "descripcion").first()[0]
    assert m == {r.descripcion: r.total for r in sev.collect()}


def test_register_views(spark):
    from vialflow.sources.tables import register_views
    names = register_views(spark, SF0001)
    assert "siniestros" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM siniestros").first().n
    assert n == spark.read.parquet(f"{SF0001}/orders.parquet").count()


def test_nested_json_converted_to_parquet(spark, queries):
    from test_nested import RECORDS
    from vialflow.sources.nested import NestedSource, convert_to_parquet
    d = tempfile.mkdtemp(prefix="vialflow-conv-")
    src = os.path.join(d, "siniestros.json")
    with open(src, "w", encoding="utf-8") as f:
        json.dump(RECORDS, f, ensure_ascii=False)
    out = convert_to_parquet(spark, src, os.path.join(d, "parquet"))
    a = NestedSource(spark, src, name=src)
    b = NestedSource(spark, spark.read.parquet(out), name=out)
    ev_a = sorted(a.events().collect())
    ev_b = sorted(b.events().collect())
    assert ev_a == ev_b                      # same first-record-wins survivors
    assert sorted(a.hypotheses().collect()) == sorted(b.hypotheses().collect())


def test_release_caches(spark, queries):
    from vialflow.plans.registry import release_caches
    queries["class_top8"](spark, SF0001).collect()
    assert release_caches(spark) >= 1
    assert queries["class_top8"](spark, SF0001).count() > 0   # rebuilt on demand

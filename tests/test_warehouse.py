"""Star build written and read back, warehouse SQL on nested input, small cross-validation."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0001


def test_build_star_and_query_written_tables(spark, queries):
    from vialflow.plans import star
    from vialflow.sources.tables import EventSource
    out = tempfile.mkdtemp(prefix="vialflow-star-")
    paths = star.build_star(EventSource(spark, SF0001), out, version="v1")
    assert set(paths) == {"fact_siniestros", "dim_fecha", "dim_localidad", "dim_actor", "dim_members"}
    assert os.path.isdir(os.path.join(paths["fact_siniestros"], "anio=1995"))   # partitioned by year
    assert star.current_star(spark, out).endswith("/v1")
    # the page's questions give what the written tables hold
    views = star.register_star(spark, out)
    counts = {r.tabla: r.filas for r in queries["sql_conteos"](spark, SF0001).collect()}
    assert counts == {v: spark.table(v).count() for v in views} and counts["fact_siniestros"] > 0
    by_place = spark.sql("SELECT l.nombre, count(*) AS n FROM fact_siniestros f JOIN dim_localidad l USING (localidad_id) GROUP BY l.nombre")
    assert {r.nombre: r.n for r in by_place.collect()} == {
        r.nombre: r.total for r in queries["sql_tabla_localidades"](spark, SF0001).collect()}
    by_hour = {r.hora: r.n for r in spark.sql("SELECT hora, count(*) AS n FROM fact_siniestros GROUP BY hora").collect()}
    assert by_hour == {r.hora: r.total for r in queries["sql_por_hora"](spark, SF0001).collect()}


def test_warehouse_sql_on_nested_records(spark, queries):
    from test_nested import RECORDS
    d = tempfile.mkdtemp(prefix="vialflow-nested-sql-")
    p = os.path.join(d, "siniestros.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump(RECORDS, f, ensure_ascii=False)
    rows = {r.nombre: r for r in queries["sql_tabla_localidades"](spark, p).collect()}
    assert rows["Kennedy"].zona == "Occidente"
    assert rows["Desconocida"].total == 2          # locality 0 and NULL share the unknown member
    causes = {r.descripcion: r.total for r in queries["sql_hipotesis"](spark, p).collect()}
    assert causes["H2"] == 2


def test_report_job_writes_documents(spark):
    from vialflow.plans.report import run_report
    out = tempfile.mkdtemp(prefix="vialflow-report-")
    paths = run_report(spark, SF0001, out)
    doc = json.loads(open(glob.glob(paths["stats"] + "/part-*")[0]).read())
    assert doc["total_registros"] == sum(r["total"] for r in doc["por_gravedad"])   # invariant 1
    assert doc["total_registros"] == sum(r["total"] for r in doc["tendencia_anual"])  # invariant 2
    ml = json.loads(open(glob.glob(paths["ml"] + "/part-*")[0]).read())
    assert sum(c["size"] for c in ml["kmeans_clusters"]) == doc["total_registros"]


def test_small_cross_validation(spark, queries):
    r = queries["forest_cv"](spark, SF0001, folds=3, num_trees=5).first()
    assert 0.0 <= r.accuracy <= 1.0 and r.folds == 3
    assert abs(r.weighted_recall - r.accuracy) < 1e-12


def test_every_nested_format_gives_all_rows(spark, queries):
    from vialflow.sources.nested import convert_to_parquet
    records = [{"CODIGO_ACCIDENTE": i, "FECHA_STR": "2020-01-0%d" % (i % 9 + 1), "HORA": "9:30:00", "GRAVEDAD": ["Con Muertos", "Con Heridos", "Solo Daños"][i % 3],
                "CLASE": "Choque", "CODIGO_LOCALIDAD": i % 5 + 1, "HIPOTESIS_LISTA": ["H%d" % (i % 4)]} for i in range(600)]
    d = tempfile.mkdtemp(prefix="vialflow-formats-")
    with open(f"{d}/a.json", "w") as f:
        json.dump(records, f)
    os.makedirs(f"{d}/lines")
    for p in (f"{d}/a.jsonl", f"{d}/lines/a.jsonl"):
        with open(p, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in records)
    convert_to_parquet(spark, f"{d}/a.json", f"{d}/parquet")
    want = {"Con Muertos": 200, "Con Heridos": 200, "Solo Daños": 200}
    for root in ("a.json", "a.jsonl", "lines", "parquet"):
        assert {r.descripcion: r.total for r in queries["severity_counts"](spark, f"{d}/{root}").collect()} == want, root
        assert queries["cause_top10"](spark, f"{d}/{root}").count() == 4


def test_replace_table_swaps(spark):
    from vialflow.sources.sinks import replace_table
    replace_table(spark, spark.range(3), "swap_me")
    replace_table(spark, spark.range(5).withColumn("p", F.lit(1)), "swap_me", ["p"])
    assert spark.table("swap_me").count() == 5
    try:
        replace_table(spark, spark.range(2).select(F.raise_error(F.lit("no")).alias("id")), "swap_me")
    except Exception:
        pass
    assert spark.table("swap_me").count() == 5


def test_forest_takes_any_vocabulary(spark):
    from vialflow.operators import ml
    df = spark.range(3000).select(F.concat(F.lit("c"), F.col("id") % 500).alias("c"), (F.col("id") % 7).cast("double").alias("x"),
                                  F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("y"))
    model = ml.fit_forest(ml.forest_pipeline(["c"], ["x"], "y", num_trees=2, max_depth=2, max_bins=64), df)
    assert model.transform(df).count() == 3000


def test_auc_is_exact(spark):
    from pyspark.ml.linalg import Vectors
    from vialflow.operators.ml import per_class_rates, roc_points
    import random
    random.seed(3)
    rows = [(float(y), float(random.random() < 0.5), Vectors.dense([1 - s, s])) for y, s in
            ((random.randrange(2), random.choice([random.random(), 0.25, 1 / 3])) for _ in range(400))]
    df = spark.createDataFrame(rows, ["label", "prediction", "probability"])
    pos, neg = [r[2][1] for r in rows if r[0] == 1], [r[2][1] for r in rows if r[0] == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = {r.clase: r.auc for r in per_class_rates(df, ["n", "p"]).collect()}
    assert abs(got["p"] - want) < 1e-12 and abs(got["n"] - want) < 1e-12
    pts = [r for r in roc_points(df, ["n", "p"]).collect() if r.clase == "p"]
    assert (pts[0].tpr, pts[0].fpr) == (0.0, 0.0) and (pts[-1].tpr, pts[-1].fpr) == (1.0, 1.0)
    assert len(pts) == len({r[2][1] for r in rows}) + 1


def test_cached_view_is_as_old_as_its_files(spark, queries):
    """A file appended to a table shows in the next query; unchanged files keep the cache."""
    import shutil
    from vialflow.plans import warehouse
    root = tempfile.mkdtemp(prefix="vialflow-files-")
    for t in ("region", "nation", "customer", "part", "lineitem"):
        shutil.copy(f"{SF0001}/{t}.parquet", root)
    os.mkdir(f"{root}/orders.parquet")
    shutil.copy(f"{SF0001}/orders.parquet", f"{root}/orders.parquet/a.parquet")
    n = warehouse.analysis_view(spark, root).count()
    kept = warehouse.analysis_view(spark, root)
    assert kept is warehouse.analysis_view(spark, root)
    more = spark.read.parquet(f"{SF0001}/orders.parquet").limit(7).withColumn("o_orderkey", F.col("o_orderkey") + 10**9)
    more.coalesce(1).write.mode("append").parquet(f"{root}/orders.parquet")
    assert warehouse.analysis_view(spark, root).count() == n + 7
    share = queries["severity_share"](spark, root).collect()
    assert sum(r.total for r in share) == n + 7

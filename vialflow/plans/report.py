"""The reference's batch job as one Spark application: analysis view (cached), seven
aggregates, random forest with metrics / importances / confusion, k-means with silhouette
and cluster profile, written as two JSON documents (S6) to ``out``.

    python -m vialflow.plans.report <data dir or nested .json> <output dir>
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import functions as F

from ..sources.sinks import report_document, write_report
from .registry import all_queries


def run_report(spark, root: str, out: str) -> dict:
    q = all_queries()
    from .mining import fit_forest
    from .warehouse import analysis_view
    t0 = time.time()
    view = analysis_view(spark, root)
    total = view.count()
    stats = report_document({
        "por_gravedad": q["severity_share"](spark, root),
        "top_localidades": q["place_top10"](spark, root),
        # The job's hour chart masks the -1 sentinel
        "por_hora": view.where(F.col("hora") >= 0).groupBy("hora").agg(F.count(F.lit(1)).alias("total")).orderBy("hora"),
        "por_clase": q["class_top8"](spark, root),
        "hipotesis_top": q["first_cause_top8"](spark, root),
        "vehiculo_top": q["first_vehicle_top8"](spark, root),
        "tendencia_anual": q["yearly_pivot"](spark, root),
    }, {"total_registros": total})
    # The per-year pivot keyed by the year as text
    por_anio = q["yearly_pivot"](spark, root).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.col("anio").cast("string"), F.struct("total", "con_muertos", "con_heridos", "solo_danos"))))).alias("m"))
    anio_doc = por_anio.select(F.to_json("m").alias("por_anio"))
    labels = fit_forest(spark, root)[2]
    ml = report_document({
        "metricas": q["forest_metrics"](spark, root),
        "feature_importance": q["forest_importance"](spark, root),
        "confusion_matrix": q["forest_confusion"](spark, root),
        "kmeans_clusters": q["kmeans_profile"](spark, root),
        "kmeans": q["kmeans_silhouette"](spark, root),
    }, {"tiempo_total_s": round(time.time() - t0, 1), "etiquetas": labels})
    base = out.rstrip("/")
    return {"stats": write_report(stats, f"{base}/spark_stats"), "ml": write_report(ml, f"{base}/spark_ml"),
            "por_anio": write_report(anio_doc.withColumnRenamed("por_anio", "json"), f"{base}/por_anio")}


if __name__ == "__main__":
    from ..session import get_session
    print(run_report(get_session(), sys.argv[1], sys.argv[2]))

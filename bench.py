"""Benchmark: the reference's batch job (analysis view, seven aggregates, random forest,
k-means) plus the eleven warehouse queries, at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vialflow.plans.registry import all_queries  # noqa: E402
from vialflow.session import get_session  # noqa: E402

# the batch job's seven aggregates, then its two models
JOB_AGGREGATES = ["severity_share", "place_top10", "hourly_counts", "class_top8",
                  "first_cause_top8", "first_vehicle_top8", "yearly_pivot"]
JOB_MODELS = ["forest_metrics", "forest_confusion", "forest_importance", "kmeans_profile", "kmeans_silhouette"]
# the warehouse page's eleven queries, as registered
WAREHOUSE = ["sql_conteos", "sql_gravedad", "sql_tendencia", "sql_por_hora", "sql_hipotesis", "sql_evolucion_gravedad",
             "sql_actores_estado", "sql_hora_fatal", "sql_causas_fatales", "sql_clase_gravedad", "sql_tabla_localidades"]
# the mining workflow's relational steps
MINING = ["class_weights", "folds", "stratified_sample", "one_hot_minmax"]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", root)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app="vialflow-bench", shuffle_partitions=cpus)
    q = all_queries()
    times: dict[str, float] = {}

    def run(name: str, key: str | None = None) -> None:
        t = time.perf_counter()
        q[name](spark, root).collect()
        times[key or name] = round(time.perf_counter() - t, 3)

    t0 = time.perf_counter()
    # analysis view: build + cache + count (the job's load/flatten/cache step)
    from vialflow.plans.mining import _flat
    t = time.perf_counter()
    n_rows = _flat(spark, root).count()
    times["flat_view_cache"] = round(time.perf_counter() - t, 3)
    for n in JOB_AGGREGATES:
        run(n, f"job.{n}")
    for n in JOB_MODELS:
        run(n, f"job.{n}")
    job_total = time.perf_counter() - t0
    t1 = time.perf_counter()
    for n in WAREHOUSE:
        run(n)
    sql_total = time.perf_counter() - t1
    t2 = time.perf_counter()
    for n in MINING:
        run(n, f"mining.{n}")
    mining_total = time.perf_counter() - t2
    total = job_total + sql_total   # the headline of earlier rounds; the mining steps stand beside it
    print(json.dumps({
        "metric": "batch_job_plus_warehouse_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "job_sec": round(job_total, 3),
        "warehouse_sec": round(sql_total, 3),
        "mining_sec": round(mining_total, 3),
        "rows": n_rows,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""ML invariants (published-output invariants 3-6 of SURVEY section 5), fixed-seed
determinism, and the driver contract."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001


def test_forest_invariants(spark, queries):
    m = queries["forest_metrics"](spark, SF001).first()
    conf = queries["forest_confusion"](spark, SF001).collect()
    n = sum(r["count"] for r in conf)
    assert n == m.test_size                                            # inv. 4
    trace = sum(r["count"] for r in conf if r.actual == r.predicted)
    assert m.accuracy == pytest.approx(trace / n)
    assert m.weighted_recall == pytest.approx(m.accuracy)
    flat_rows = spark.read.parquet(f"{SF001}/orders.parquet").where(F.col("o_orderstatus").isin("F", "P", "O")).count()
    assert m.train_size + m.test_size == flat_rows                    # inv. 3
    imp = queries["forest_importance"](spark, SF001).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)       # inv. 6
    roc = queries["forest_roc"](spark, SF001).collect()
    assert all(0.0 <= r.auc <= 1.0 for r in roc) and sum(r.soporte for r in roc) == n


def test_roc_curve_is_monotone_and_ends_at_one(spark, queries):
    pts = queries["forest_roc_curve"](spark, SF001).collect()
    by_class = {}
    for r in pts:
        by_class.setdefault(r.clase, []).append(r)
    for rows in by_class.values():
        rows.sort(key=lambda r: -r.umbral)
        tprs, fprs = [r.tpr for r in rows], [r.fpr for r in rows]
        assert tprs == sorted(tprs) and fprs == sorted(fprs)
        assert tprs[-1] == pytest.approx(1.0) and fprs[-1] == pytest.approx(1.0)


def test_forest_metrics_match_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from vialflow.plans.mining import fit_forest
    from vialflow.operators.ml import confusion, metrics_from_confusion
    _, preds, labels, _, _ = fit_forest(spark, SF001)
    mine = metrics_from_confusion(confusion(preds, len(labels))).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        key = {"weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall"}.get(name, name)
        assert mine[key] == pytest.approx(ev.setMetricName(name).evaluate(preds), abs=1e-12)


def test_hash_split_is_repeatable(spark):
    from vialflow.operators.ml import hash_split
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    a, _ = hash_split(df, "o_orderkey")
    b, _ = hash_split(df.repartition(7), "o_orderkey")
    assert sorted(r[0] for r in a.select("o_orderkey").collect()) == sorted(r[0] for r in b.select("o_orderkey").collect())


def test_kmeans_profile_invariants(spark, queries):
    prof = queries["kmeans_profile"](spark, SF001).collect()
    total = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert sum(r.size for r in prof) == total                           # inv. 5
    assert all(r.con_muertos + r.con_heridos + r.solo_danos == r.size for r in prof)
    s = queries["kmeans_silhouette"](spark, SF001).first().silhouette
    assert -1.0 <= s <= 1.0


def test_sample_and_folds(spark, queries):
    smp = queries["stratified_sample"](spark, SF001)
    assert smp.count() == 3000
    per = {r.gravedad: r["count"] for r in smp.groupBy("gravedad").count().collect()}
    assert max(per.values()) - min(per.values()) <= 200                 # proportional quotas
    folds = queries["folds"](spark, SF001).groupBy("gravedad", "fold").count().collect()
    by_class = {}
    for r in folds:
        by_class.setdefault(r.gravedad, []).append(r["count"])
    assert all(len(v) == 10 and max(v) - min(v) <= 1 for v in by_class.values())


def test_row_silhouette_mean_tracks_evaluator(spark):
    from vialflow.plans.mining import _row_silhouettes
    rows = _row_silhouettes(spark, SF001)
    assert rows.where(F.col("silueta").isNull()).count() == 0
    assert rows.agg(F.max("silueta")).first()[0] <= 1.0


def test_anova_matches_closed_form(spark):
    from vialflow.operators.ml import f_survival, one_way_anova
    data = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 4.0), ("b", 6.0), ("c", 5.0), ("c", 6.0), ("c", 7.0)]
    r = one_way_anova(spark.createDataFrame(data, "g string, x double"), "g", "x").first()
    # group means 2, 4, 6; grand mean 4; SSB = 3*(4+0+4) = 24; SSW = 2 + 8 + 2 = 12
    assert (r.gl_entre, r.gl_dentro) == (2, 6)
    assert r.sc_entre == pytest.approx(24.0) and r.sc_dentro == pytest.approx(12.0)
    assert r.f == pytest.approx(6.0)
    assert f_survival(1.0, 2, 2) == pytest.approx(0.5)                 # F(2,2): 1/(1+f)
    # with 2 numerator degrees of freedom: P(F > f) = (1 + 2 f / d2) ** (-d2 / 2) = 1/27
    assert r.p_valor == pytest.approx(1 / 27, rel=1e-9)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["nombre", "zona", "total", "con_muertos", "con_heridos", "solo_danos", "tasa_mortalidad"]
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q)
    for name in ("table_counts", "severity_share", "folds"):
        assert q[name](spark, SF0001).count() >= 0


def test_slots_without_the_vector_are_those_of_the_vector(spark):
    """Also with 10^5 values: the slots are an offset and an index, whatever the vocabulary."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    from vialflow.operators import ml
    df = spark.range(60).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("a"), F.col("id") % 5)).alias("a"),
                                F.concat(F.lit("b"), F.col("id") % 3).alias("b"), F.col("id").cast("double").alias("x"))
    enc = ml.onehot_minmax_pipeline(["a", "b"], ["x"]).fit(df).transform(df)
    rows = enc.select(ml.onehot_slots(enc, ["a", "b"]).alias("s"), vector_to_array("features").alias("v")).collect()
    assert all(r.s == [i for i, v in enumerate(r.v[:-1]) if v == 1.0] for r in rows) and {len(r.s) for r in rows} == {1, 2}
    wide = spark.range(100_000).select("id", F.concat(F.lit("a"), F.col("id")).alias("a"), F.lit("b").alias("b"), F.lit(1.0).alias("x"))
    enc = ml.onehot_minmax_pipeline(["a", "b"], ["x"]).fit(wide).transform(wide)
    got = enc.select(ml.onehot_slots(enc, ["a", "b"]).alias("s")).agg(F.count_distinct(F.col("s")[0]), F.min(F.col("s")[1])).first()
    assert tuple(got) == (100_000, 100_000)


def test_exact_quantiles(spark):
    import math
    import random
    from vialflow.operators.ml import exact_quantiles
    random.seed(3)
    rows = [("a", random.gauss(0, 1)) for _ in range(999)] + [("b", 5.0)] * 10 + [("c", float(i % 3)) for i in range(100)]
    rows += [(None, 1.0), (None, 2.0), ("d", None), ("a", -1e9)]
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "hi": 1.0}
    got = {r.k: tuple(r)[1:] for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", probs, bins=16).collect()}
    want = {}
    for k in ("a", "b", "c", None):
        v = sorted(x for g, x in rows if g == k and x is not None)
        want[k] = tuple(v[max(1, math.ceil(len(v) * p)) - 1] for p in probs.values())
    assert got == want


def test_row_silhouette_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors
    from vialflow.operators.ml import row_silhouette
    rows = [(0, [1.0, 0, 0, 2]), (0, [0, 0, 0, 1.0]), (0, [2.0, 0, 0, 0]), (1, [0, 9.0, 8, 0]), (1, [0, 7.0, 9, 1]), (2, [0, 0, 50.0, 0])]
    data = [(i, c, Vectors.sparse(4, {j: x for j, x in enumerate(v) if x}) if i % 2 else Vectors.dense(v)) for i, (c, v) in enumerate(rows)]
    got = {r.i: r.silueta for r in row_silhouette(spark.createDataFrame(data, ["i", "c", "x"]), "x", "c").collect()}

    def far(v, c, skip):
        d = [sum((a - b) ** 2 for a, b in zip(v, w)) for j, (o, w) in enumerate(rows) if o == c and j != skip]
        return sum(d) / len(d)

    for i, (c, v) in enumerate(rows):
        b = min(far(v, o, None) for o in {0, 1, 2} - {c})
        a = far(v, c, i) if c != 2 else 0
        assert abs(got[i] - (0 if c == 2 else (b - a) / max(a, b))) < 1e-9

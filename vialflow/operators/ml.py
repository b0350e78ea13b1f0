"""Distributed machine-learning operators on ``pyspark.ml``.

Models are fitted by Spark ML on executors. Everything derived from predictions (metrics,
confusion, per-class rates, silhouettes, ANOVA) is computed as DataFrame aggregates; only
model parameters of bounded size (k centroids, a few importances) reach the driver.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (Imputer, MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .forest import HistogramForest
from .ranking import hash_order


# ------------------------------------------------------------------ splitting (M5)
def in_train(key: str, train_pct: int = 80, seed: int = 42):
    """Whether a row trains: 32 bits of an md5 of its key, the same in any engine."""
    return F.conv(F.substring(hash_order([key], seed), 1, 8), 16, 10).cast("long") % 100 < train_pct


def hash_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42):
    """Repeatable train/test split on a hash of the key: unlike ``randomSplit`` it does
    not depend on partitioning or row order, so a recomputed partition lands identically."""
    t = in_train(key, train_pct, seed)
    return df.where(t), df.where(~t)


# ------------------------------------------------------------------ forest (M1-M8)
def forest_pipeline(cat_cols: list[str], num_cols: list[str], label_col: str, num_trees: int = 50,
                    max_depth: int = 6, max_bins: int = 256, seed: int = 42,
                    weight_col: str | None = None, label_order: str = "frequencyDesc",
                    label_domain=None) -> Pipeline:
    """Index categories (unknown kept), index the label (unknown is an error: the label
    set is filtered upstream, so no phantom class), assemble, random forest."""
    # one multi-column indexer: a single pass over the data for all vocabularies
    idx = StringIndexer(inputCols=cat_cols, outputCols=[c + "_idx" for c in cat_cols], handleInvalid="keep")
    label = StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="error", stringOrderType=label_order)
    if label_domain is not None:
        # the label vocabulary comes from all rows, so a class missing from the training
        # rows is still known when the test rows are scored
        label = label.fit(label_domain)
    asm = VectorAssembler(inputCols=[c + "_idx" for c in cat_cols] + num_cols, outputCol="features",
                          handleInvalid="keep")
    rf = HistogramForest(featuresCol="features", labelCol="label", numTrees=num_trees,
                         maxDepth=max_depth, maxBins=max_bins, seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return Pipeline(stages=[idx, label, asm, rf])


def with_room(forest: HistogramForest, indexer) -> HistogramForest:
    """The forest with at least a bin for every category that the fitted indexer knows (and
    one for unknown ones): the number of bins never limits the vocabulary."""
    most = max((len(v) for v in indexer.labelsArray), default=0) + 1
    return forest.setMaxBins(max(forest.getMaxBins(), most))


def fit_forest(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit the indexers, make room for their vocabularies, then fit the forest."""
    *prepare, forest = pipeline.getStages()
    prep = Pipeline(stages=prepare).fit(train)
    return PipelineModel(stages=[*prep.stages, with_room(forest, prep.stages[0]).fit(prep.transform(train))])


def confusion(preds: DataFrame, n_labels: int) -> DataFrame:
    """Dense confusion counts (actual, predicted, count), zero cells included. The cell
    grid comes from pivoting on the fixed label range, not from a cross join; one empty
    row per label makes sure a class absent from the test rows still gets its row."""
    c = preds.select(F.col("label").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"))
    blanks = preds.sparkSession.range(n_labels).select(F.col("id").cast("int").alias("actual"),
                                                       F.lit(None).cast("int").alias("predicted"))
    labels = list(range(n_labels))
    wide = c.unionByName(blanks).groupBy("actual").agg(
        *[F.count_if(F.col("predicted") == j).alias(f"p{j}") for j in labels])
    long = wide.unpivot(["actual"], [f"p{j}" for j in labels], "predicted", "count")
    return long.select("actual", F.substring("predicted", 2, 9).cast("int").alias("predicted"), "count")


def metrics_from_confusion(conf: DataFrame) -> DataFrame:
    """accuracy, weighted precision / recall / F1 and multiclass MCC from the counts,
    one row (same definitions as Spark's MulticlassClassificationEvaluator)."""
    per_actual = conf.groupBy(F.col("actual").alias("k")).agg(F.sum("count").alias("t_k"))
    per_pred = conf.groupBy(F.col("predicted").alias("k")).agg(F.sum("count").alias("p_k"))
    tp = conf.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("k"), F.col("count").alias("c_k"))
    k = per_actual.join(per_pred, "k", "full").join(tp, "k", "full").na.fill(0)
    n = F.sum("t_k").over(Window.partitionBy())
    k = k.withColumn("n", n)
    prec = F.when(F.col("p_k") > 0, F.col("c_k") / F.col("p_k")).otherwise(0.0)
    rec = F.when(F.col("t_k") > 0, F.col("c_k") / F.col("t_k")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    w = F.col("t_k") / F.col("n")
    g = k.agg(
        (F.sum("c_k") / F.first("n")).alias("accuracy"),
        F.sum(w * f1).alias("f1"),
        F.sum(w * prec).alias("weighted_precision"),
        F.sum(w * rec).alias("weighted_recall"),
        F.sum("c_k").cast("double").alias("_c"), F.first("n").cast("double").alias("_s"),
        F.sum(F.col("p_k").cast("double") * F.col("t_k")).alias("_pt"),
        F.sum(F.col("p_k").cast("double") ** 2).alias("_pp"),
        F.sum(F.col("t_k").cast("double") ** 2).alias("_tt"))
    den = F.sqrt((F.col("_s") ** 2 - F.col("_pp")) * (F.col("_s") ** 2 - F.col("_tt")))
    mcc = F.when(den > 0, (F.col("_c") * F.col("_s") - F.col("_pt")) / den).otherwise(0.0)
    return g.select("accuracy", "f1", "weighted_precision", "weighted_recall", mcc.alias("mcc"))


def per_class_rates(preds: DataFrame, labels: list[str]) -> DataFrame:
    """M15 + M16: one-vs-rest AUC from the class probability, recall and precision per class."""
    prob = preds.select("label", "prediction")
    c = _ranked(preds, labels)
    # the trapezoids between neighbouring thresholds; a class without rows of both kinds has none
    step = (F.col("fp") * (2 * F.col("ctp") - F.col("tp"))).cast("decimal(38,0)")
    auc = c.groupBy("k", "clase").agg(F.sum(step).cast("double").alias("_s"), F.max("p").alias("_p"), F.max("n").alias("_n"))
    area = F.col("_s") / (2.0 * F.col("_p") * F.col("_n"))
    auc = auc.select("k", "clase", F.when((F.col("_p") > 0) & (F.col("_n") > 0), area).otherwise(0.0).alias("auc"))
    counts = prob.groupBy().agg(*[
        agg for i in range(len(labels)) for agg in (
            F.count_if((F.col("label") == i) & (F.col("prediction") == i)).alias(f"tp{i}"),
            F.count_if(F.col("label") == i).alias(f"t{i}"),
            F.count_if(F.col("prediction") == i).alias(f"p{i}"))])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col(f"tp{i}").alias("tp"), F.col(f"t{i}").alias("t"), F.col(f"p{i}").alias("p"))
        for i in range(len(labels))])).alias("r")).select("r.*")
    out = auc.join(stacked, "k")
    return out.select("k", "clase", "auc",
                      F.when(F.col("t") > 0, F.col("tp") / F.col("t")).alias("recall"),
                      F.when(F.col("p") > 0, F.col("tp") / F.col("p")).alias("precision"),
                      F.col("t").alias("soporte"))


def _ranked(preds: DataFrame, labels: list[str]) -> DataFrame:
    """(k, clase, umbral, tp, fp, ctp, cfp, p, n): rows of class k (tp) and others (fp) with a
    score of exactly ``umbral``, the same from there up, and all. Exact: one row for each
    distinct score. Running sums go over score ranges first and within a range then, so the
    scores of a class need not meet in one task."""
    prob = preds.select("label", vector_to_array("probability").alias("p"))
    each = prob.select("label", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.lit(name).alias("clase"), F.col("p")[i].alias("umbral"))
        for i, name in enumerate(labels)])).alias("c")).select("label", "c.*")
    own = F.col("label") == F.col("k")
    c = each.groupBy("k", "clase", "umbral").agg(F.count_if(own).alias("tp"), F.count_if(~own).alias("fp"))
    c = c.withColumn("_range", F.floor(F.col("umbral") * 1000))
    whole = c.groupBy("k", "_range").agg(F.sum("tp").alias("_tp"), F.sum("fp").alias("_fp"))
    above = Window.partitionBy("k").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("k")
    whole = whole.select("k", "_range", F.coalesce(F.sum("_tp").over(above), F.lit(0)).alias("_atp"),
                         F.coalesce(F.sum("_fp").over(above), F.lit(0)).alias("_afp"),
                         F.sum("_tp").over(every).alias("p"), F.sum("_fp").over(every).alias("n"))
    upto = Window.partitionBy("k", "_range").orderBy(F.desc("umbral")).rowsBetween(Window.unboundedPreceding, 0)
    return c.join(whole, ["k", "_range"]).select(
        "k", "clase", "umbral", "tp", "fp", (F.col("_atp") + F.sum("tp").over(upto)).alias("ctp"),
        (F.col("_afp") + F.sum("fp").over(upto)).alias("cfp"), "p", "n")


def roc_points(preds: DataFrame, labels: list[str]) -> DataFrame:
    """M15 curve: the exact one-vs-rest ROC per class, from (0, 0) at an infinite threshold."""
    r = _ranked(preds, labels)
    pts = r.select("clase", "umbral", F.when(F.col("p") > 0, F.col("ctp") / F.col("p")).alias("tpr"),
                   F.when(F.col("n") > 0, F.col("cfp") / F.col("n")).alias("fpr"))
    start = preds.sparkSession.createDataFrame([(c, float("inf"), 0.0, 0.0) for c in labels], pts.schema)
    return pts.unionByName(start).orderBy("clase", F.desc("umbral"))


def class_weights(df: DataFrame, label_col: str, out: str = "peso") -> DataFrame:
    """M13 balanced weights n / (k * n_class) per class (small table, one row per class)."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_clase"))
    all_ = Window.partitionBy()
    return c.select(label_col, "n_clase",
                    (F.sum("n_clase").over(all_) / (F.count(F.lit(1)).over(all_) * F.col("n_clase"))).alias(out))


def hash_rank(df: DataFrame, key: str, label_col: str, seed: int, out: str = "_rn") -> DataFrame:
    """``df`` with the rank of each row within its class in the order of its key's md5. Rows are
    ranked within ranges of the hash (4096 a class) and the counts of the ranges before are
    added: exact, without a sort of the whole table and without a task for a whole class."""
    d = df.withColumn("_h", hash_order([key], seed)).withColumn("_b", F.substring("_h", 1, 3))
    per = d.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(label_col).alias("_l"), F.col("_b").alias("_pb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(label_col, "_b").orderBy("_h", key)))
    d = d.join(per, (F.col("_b") == F.col("_pb")) & F.col(label_col).eqNullSafe(F.col("_l")))
    return d.withColumn(out, F.col("_base") + F.col("_r")).drop("_h", "_b", "_l", "_pb", "_base", "_r")


def stratified_folds(df: DataFrame, key: str, label_col: str, k: int = 10, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Rows of each class dealt round-robin over k folds in hashed order, so every
    fold holds n_class/k (+-1) rows of each class. Exact and skew-free."""
    r = hash_rank(df, key, label_col, seed)
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def stratified_sample(df: DataFrame, key: str, label_col: str, size: int, seed: int = 42) -> DataFrame:
    """Exact fixed-size stratified sample. Quotas by largest remainder on the class
    counts (a small table); rows chosen by their rank in hashed order within the class. Only
    keys and classes are ranked; the payload is read for the chosen keys."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    all_ = Window.partitionBy()
    total = F.sum("_n").over(all_)
    q = counts.select(label_col, "_n", (F.col("_n") * size).alias("_num"), total.alias("_tot"))
    q = q.select(label_col, F.expr("_num div _tot").alias("_base"), F.expr("_num % _tot").alias("_rem"))
    left = F.lit(size) - F.sum("_base").over(all_)
    rank_rem = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label_col)))
    q = q.select(label_col, (F.col("_base") + F.when(rank_rem <= left, 1).otherwise(0)).alias("_quota"))
    r = hash_rank(df.select(key, label_col), key, label_col, seed).join(q, label_col)
    return df.join(r.where(F.col("_rn") <= F.col("_quota")).select(key), key, "left_semi")


# ------------------------------------------------------------------ encoders
def onehot_minmax_pipeline(cat_cols: list[str], num_cols: list[str]) -> Pipeline:
    """Categories -> sorted index -> one-hot with one slot per known value; a missing
    value (NULL) sets no slot. Numbers: missing values (NULL / NaN) take the column mean,
    then everything is scaled to [0, 1]."""
    # 'keep' files NULLs under an extra last index; dropLast removes exactly that slot
    idx = StringIndexer(inputCols=cat_cols, outputCols=[c + "_i" for c in cat_cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    oh = OneHotEncoder(inputCols=[c + "_i" for c in cat_cols], outputCols=[c + "_oh" for c in cat_cols],
                       dropLast=True, handleInvalid="error")
    imp = Imputer(inputCols=num_cols, outputCols=[c + "_imp" for c in num_cols], strategy="mean")
    num = VectorAssembler(inputCols=[c + "_imp" for c in num_cols], outputCol="_num", handleInvalid="keep")
    mm = MinMaxScaler(inputCol="_num", outputCol="_num_mm")
    asm = VectorAssembler(inputCols=[c + "_oh" for c in cat_cols] + ["_num_mm"], outputCol="features")
    return Pipeline(stages=[idx, oh, imp, num, mm, asm])


def onehot_slots(encoded: DataFrame, cat_cols: list[str]):
    """The active slots of a row, ascending: each category's offset plus its index, without the
    vector, so a row's work does not grow with the vocabulary. A missing value has no slot.
    Sizes come from the encoded columns' own metadata."""
    slots, offset = [], 0
    for c in cat_cols:
        size = encoded.schema[f"{c}_oh"].metadata["ml_attr"]["num_attrs"]
        slots.append(F.when(F.col(f"{c}_i") < size, F.lit(offset) + F.col(f"{c}_i").cast("long")))
        offset += size
    return F.array_compact(F.array(*slots))


# ------------------------------------------------------------------ k-means
def kmeans_pipeline(cat_cols: list[str], num_cols: list[str], k: int = 5, seed: int = 42,
                    max_iter: int = 20) -> Pipeline:
    idx = StringIndexer(inputCols=cat_cols, outputCols=[c + "_km_idx" for c in cat_cols], handleInvalid="keep")
    asm = VectorAssembler(inputCols=num_cols + [c + "_km_idx" for c in cat_cols], outputCol="features_raw",
                          handleInvalid="keep")
    sc = StandardScaler(inputCol="features_raw", outputCol="features_km", withMean=True, withStd=True)
    km = KMeans(featuresCol="features_km", predictionCol="cluster", k=k, maxIter=max_iter, seed=seed)
    return Pipeline(stages=[idx, asm, sc, km])


def silhouette(df: DataFrame, features: str, cluster: str) -> float:
    return float(ClusteringEvaluator(featuresCol=features, predictionCol=cluster,
                                     metricName="silhouette").evaluate(df))


def row_silhouette(df: DataFrame, features: str, cluster: str, out: str = "silueta") -> DataFrame:
    """Per-row silhouette with squared Euclidean distance (the measure of Spark's
    ClusteringEvaluator), from per-cluster sums: the mean squared distance from x to the
    points of C is |x|^2 - 2 x.m_C + q_C, with m_C the mean and q_C the mean squared norm.
    Own cluster excludes the point itself. A row's work is its own non-zero slots, k times."""
    n = Summarizer.metrics("mean", "normL2").summary(F.col(features))
    stats = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), n.alias("s")).select(
        F.col(cluster).cast("int").alias("c"), "n", vector_to_array("s.mean").alias("m"),
        (F.aggregate(vector_to_array("s.normL2"), F.lit(0.0), lambda acc, v: acc + v * v) / F.col("n")).alias("q"))
    # every cluster's row carries all clusters: k rows of k means, as many numbers as the model's
    # centres k times over, so the broadcast is bounded by k and the encoders' vocabularies
    every = stats.agg(F.sort_array(F.collect_list(F.struct("c", "n", "m", "q"))).alias("_cl"))
    every = every.select(F.explode(F.col("_cl.c")).alias("_c"), "_cl")
    x = df.join(F.broadcast(every), F.col(cluster).cast("int") == F.col("_c")).withColumn("_v", F.unwrap_udt(F.col(features)))
    norm = F.aggregate("_v.values", F.lit(0.0), lambda acc, v: acc + v * v)

    def dot(m):     # only the slots that the row holds
        sparse = F.zip_with("_v.indices", "_v.values", lambda i, v: v * F.get(m, i))
        dense = F.zip_with("_v.values", m, lambda v, w: v * w)
        return F.aggregate(F.when(F.col("_v.type") == 0, sparse).otherwise(dense), F.lit(0.0), lambda acc, v: acc + v)

    x = x.withColumn("_nx", norm)
    x = x.withColumn("_d", F.transform("_cl", lambda s: F.struct(
        s["c"].alias("c"), s["n"].alias("n"), (F.col("_nx") - 2 * dot(s["m"]) + s["q"]).alias("d"))))
    own = F.filter("_d", lambda s: s["c"] == F.col("_c"))[0]
    others = F.filter("_d", lambda s: (s["c"] != F.col("_c")) & (s["n"] > 0))
    a = F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1)).otherwise(0.0)
    b = F.array_min(F.transform(others, lambda s: s["d"]))
    s = F.when(own["n"] <= 1, 0.0).otherwise((b - a) / F.greatest(a, b))
    return x.withColumn(out, s).drop("_v", "_nx", "_c", "_cl", "_d")


def exact_quantiles(df: DataFrame, group: str, value: str, probs: dict[str, float], bins: int = 4096) -> DataFrame:
    """Per ``group`` the value at rank ceil(p * n) for each of ``probs`` (name -> p), exact.

    Equal values are one row with a count first. A second pass counts them by range of values;
    only the ranges that hold a rank are then put in order, so no task sorts a group. Nulls are
    left out; a group without values has no row."""
    rows = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    ends = rows.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total")).select(
        F.col("_g").alias("_of"), "_lo", "_hi", "_total")
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)))
    rows = rows.join(ends, F.col("_g").eqNullSafe(F.col("_of"))).withColumn("_bin", F.coalesce(place, F.lit(0)).cast("int"))
    before = Window.partitionBy("_g").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("_g", "_bin", "_total").agg(F.sum("_n").alias("_in")) \
        .withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    ranks = F.array(*[F.struct(F.lit(k).alias("name"), F.greatest(F.ceil(F.col("_total") * F.lit(p)), F.lit(1)).alias("rank")) for k, p in probs.items()])
    held = F.filter(ranks, lambda r: (r["rank"] > F.col("_before")) & (r["rank"] <= F.col("_before") + F.col("_in")))
    per = per.withColumn("_ranks", held).where(F.size("_ranks") > 0).select(F.col("_g").alias("_pg"), F.col("_bin").alias("_pb"), "_before", "_ranks")
    near = rows.join(per, F.col("_g").eqNullSafe(F.col("_pg")) & (F.col("_bin") == F.col("_pb")))
    upto = Window.partitionBy("_g", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_upto", F.col("_before") + F.sum("_n").over(upto)).withColumn("_r", F.explode("_ranks"))
    near = near.where((F.col("_r.rank") > F.col("_upto") - F.col("_n")) & (F.col("_r.rank") <= F.col("_upto")))
    return near.groupBy(F.col("_g").alias(group)).agg(*[F.min(F.when(F.col("_r.name") == k, F.col("_v"))).alias(k) for k in probs])


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (modified Lentz)."""
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 3e-16:
            break
    return h


def f_survival(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution, via the regularised incomplete beta."""
    if not (f > 0) or d1 <= 0 or d2 <= 0:
        return float("nan") if f != f else 1.0
    x = d2 / (d2 + d1 * f)
    a, b = d2 / 2.0, d1 / 2.0
    lbeta = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def one_way_anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """F statistic from grouped n / sum / sum of squares (one aggregate job); the
    p-value is evaluated on the three resulting numbers."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.sum(value).alias("s"),
                              F.sum(F.col(value) * F.col(value)).alias("ss"))
    t = g.agg(F.sum("n").alias("N"), F.sum("s").alias("S"), F.count(F.lit(1)).alias("G"),
              F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"), F.sum("ss").alias("SS"))
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    res = t.select((F.col("G") - 1).alias("gl_entre"), (F.col("N") - F.col("G")).alias("gl_dentro"),
                   ssb.alias("sc_entre"), ssw.alias("sc_dentro"))
    res = res.withColumn("f", (F.col("sc_entre") / F.col("gl_entre")) / (F.col("sc_dentro") / F.col("gl_dentro")))
    pval = F.udf(lambda f, a, b: None if f is None else f_survival(float(f), float(a), float(b)), "double")
    # one row: a scalar helper on the final statistic, not on data rows
    return res.withColumn("p_valor", pval("f", "gl_entre", "gl_dentro"))

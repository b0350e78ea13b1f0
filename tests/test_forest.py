"""The histogram forest against Spark's own and against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def _rows(spark, n=4000):
    df = spark.range(n).select(
        "id", F.concat(F.lit("a"), F.xxhash64("id", F.lit(1)) % 5).alias("a"), F.concat(F.lit("b"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40))).alias("b"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(24)).cast("double").alias("x"), (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(10007)) / 10007).alias("z"))
    y = F.when(F.col("x") < 8, "u").when((F.col("z") > 0.5) | F.col("a").isin("a1", "a-2"), "v").otherwise("w")
    return df.withColumn("y", y).withColumn("peso", F.when(F.col("y") == "u", 3.0).otherwise(1.0))


def _accuracy(preds):
    return preds.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


@pytest.mark.parametrize("weight", [None, "peso"])
def test_forest_agrees_with_sparks(spark, weight):
    from pyspark.ml import Pipeline
    from vialflow.operators import ml
    from vialflow.operators.forest import HistogramForest
    df = _rows(spark)
    *prepare, forest = ml.forest_pipeline(["a", "b"], ["x", "z"], "y", num_trees=30, max_depth=5, weight_col=weight).getStages()
    assert isinstance(forest, HistogramForest)
    data = Pipeline(stages=prepare).fit(df).transform(df).persist()
    other = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=30, maxDepth=5, maxBins=256, seed=42)
    if weight:
        other.setWeightCol(weight)
    ours, theirs = forest.fit(data), other.fit(data)
    mine, spark_s = ours.transform(data), theirs.transform(data)
    assert abs(_accuracy(mine) - _accuracy(spark_s)) < 0.06
    assert np.abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.12
    p = vector_to_array("probability")
    both = mine.select("id", p.alias("p")).join(spark_s.select("id", p.alias("q")), "id")
    assert both.agg(F.avg(F.abs(F.col("p")[0] - F.col("q")[0]))).first()[0] < 0.08
    again = forest.fit(data).transform(data)        # cached rows: the same forest
    assert again.select("id", p).exceptAll(mine.select("id", p)).count() == 0
    data.unpersist()


def test_best_split_is_that_of_brute_force():
    from vialflow.operators.forest import best_split
    rng = np.random.default_rng(1)

    def gini(s):
        return 1 - ((s / s.sum()) ** 2).sum()

    for case in range(30):
        h = rng.integers(0, 9, size=(6, 3)).astype(float)
        if case == 0:
            h[2] = 0
        total = h.sum(axis=0)
        for arity, sides in ((6, [list(c) for k in range(1, 6) for c in itertools.combinations(range(6), k)]),
                             (0, [list(range(k)) for k in range(1, 6)])):
            want = max(gini(total) - l.sum() / total.sum() * gini(l) - (total - l).sum() / total.sum() * gini(total - l)
                       for l in (h[s].sum(axis=0) for s in sides) if 0 < l.sum() < total.sum())
            gain, goes, left = best_split(h, arity, 8)
            assert gain == pytest.approx(want, abs=1e-12) and left.tolist() == h[goes].sum(axis=0).tolist()


def test_thresholds_are_midpoints_or_quantiles(spark):
    from vialflow.operators.forest import thresholds
    rows = spark.range(1000).select(F.array((F.col("id") % 4).cast("double"), F.lit(0.0), F.col("id").cast("double")).alias("x"))
    few, category, many = thresholds(rows, [0, 3, 0], 16)
    assert few.tolist() == [0.5, 1.5, 2.5] and category is None
    assert len(many) == 15 and np.abs(many - np.arange(1, 16) * 62.5).max() < 3


def _random_trees(rng, sizes, depth, n):
    from vialflow.operators.forest import Tree
    trees = [Tree(depth, max(sizes), 3) for _ in range(n)]
    for t in trees:
        for node in range(1, 1 << depth):
            f = int(rng.integers(-1, len(sizes)))
            if f >= 0 and (node == 1 or t.feature[node // 2] >= 0):
                t.feature[node], t.left[node, :sizes[f]] = f, rng.random(sizes[f]) < 0.5
    return trees


def test_copies_follow_the_steps():
    from vialflow.operators import forest as f
    h = np.random.default_rng(5).integers(0, 1 << 63, 200_000).astype(np.uint64)
    salt = np.uint64(((42 * 1_000_003 + 8) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
    z = h ^ salt
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    want = np.searchsorted(f.STEPS, (z >> np.uint64(32)).astype(np.uint32), side="right")
    assert (f._copies(f._mixed(h), 42, 7) == want).all() and (f.COPIES == f.ODD).any()


@pytest.mark.parametrize("depth", [1, 4, 5, 6])
def test_routes_lead_where_the_splits_do(depth):
    """A row stands at its leaf or below it, in groups of features and alone."""
    from vialflow.operators import forest as f
    rng = np.random.default_rng(depth)
    sizes = [3, 90, 40, 5000, 2]
    assert f._groups(sizes) == [[0, 1], [2], [3], [4]] and f._groups([8, 8, 8, 8]) == [[0, 1, 2, 3]]
    binned = np.stack([rng.integers(0, s, 5000) for s in sizes], axis=1).astype(np.int32)
    for groups in (f._groups(sizes), [[j] for j in range(5)]):
        for tree in _random_trees(rng, sizes, depth, 6):
            got = f._Routes(tree, depth, groups, sizes).place(f._joint(list(binned.T), groups, sizes)).astype(np.int64)
            want = tree.place(binned, depth)
            below = np.array([depth + 1 - int(w).bit_length() for w in want])
            assert (got >> below == want).all()
            some = np.arange(0, 5000, 7)
            assert (f._Routes(tree, depth, groups, sizes).place(f._joint(list(binned.T), groups, sizes), some) == got[some]).all()


@pytest.mark.parametrize("level", [0, 3, 7])
def test_counts_are_those_of_single_rows(level):
    """Counts of a level as a loop over rows makes them; rows without weight do not count."""
    from vialflow.operators import forest as f
    import pyarrow as pa
    rng = np.random.default_rng(level)
    sizes, n, seed = [4, 30, 7], 3000, 42
    binned = np.stack([rng.integers(0, s, n) for s in sizes], axis=1).astype(np.int32)
    label, weight = rng.integers(0, 3, n).astype(np.int32), rng.choice([0.5, 2.0, 0.0, np.nan, -1.0], n)
    h = rng.integers(-(1 << 63), 1 << 63, n)
    trees = dict(enumerate(_random_trees(rng, sizes, max(level, 1), 2)))
    open_nodes = {t: [n for n in range(1 << level, 2 << level) if level == 0 or tree.feature[n // 2] >= 0][::3] for t, tree in trees.items()}
    batch = pa.RecordBatch.from_arrays([*[pa.array(binned[:, j]) for j in range(3)], pa.array(label), pa.array(weight), pa.array(h)],
                                       ["b0", "b1", "b2", "label", "weight", "h"])
    halves = [batch.slice(0, 1000), batch.slice(1000)]
    got = [(r["tree"], np.frombuffer(r["counts"])) for b in f._count(open_nodes, trees, level, sizes, 3, 2, seed)(iter(halves)) for r in b.to_pylist()]
    assert [t for t, _ in got] == [0, 1]
    for t, counts in got:
        at, copies, want = trees[t].place(binned, level), f._copies(f._mixed(h.view(np.uint64)), seed, t), []
        for node in open_nodes[t]:
            for j in f._subset(seed, t, node, 3, 2):
                table = np.zeros((sizes[j], 3))
                for i in np.flatnonzero((at == node) & (weight > 0)):
                    table[binned[i, j], label[i]] += weight[i] * copies[i]
                want.append(table.reshape(-1))
        assert np.allclose(counts, np.concatenate(want), rtol=1e-12) and counts.sum() > 0
    assert list(f._count(open_nodes, trees, level, sizes, 3, 2, seed)(iter([]))) == []

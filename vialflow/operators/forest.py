"""Random forest from histograms: one distributed pass a level for all trees.

Spark's own fit visits every row once a tree and level through boxed per-row updates (about 5
microseconds each). Here the rows are cut into bins once and cached as small columns; tasks count
(node, feature, bin, class) with numpy (a row's way down a tree is a few lookups for groups of
features), one shuffle brings the counts of a tree together, and each tree's group picks the best
split of its nodes. Parameters, candidate splits, bagging (Poisson of mean 1 by row and tree),
feature subsets, Gini gains, leaf votes and importances follow ``RandomForestClassifier``. Only
splits (a bit a bin, a few numbers a node) reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 1 << 14             # rows counted at once in a task: their columns stay in a core's cache
GROUP = 1 << 12             # values of a group of features that are looked up together
ROOM = 256 << 20            # bytes of counts that a task holds: more trees take more passes
# P(Poisson(1) <= k) as 32-bit integers: a row's copies in a tree are the steps below its hash
STEPS = np.array([min(2 ** 32 - 1, round(2 ** 32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))))
                  for k in range(13)], dtype=np.uint32)
# copies by the upper 16 bits, ODD where the lower ones decide
ODD = 255
COPIES = np.searchsorted(STEPS, np.arange(1 << 16, dtype=np.uint32) << np.uint32(16), side="right").astype(np.uint8)
COPIES[STEPS >> np.uint32(16)] = ODD


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow column of arrays of doubles."""
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _binned(x: np.ndarray, cuts: list) -> np.ndarray:
    """Bin of each value: a category's own number, or the count of thresholds below the value."""
    if np.isnan(x).any():
        raise ValueError("a feature holds NaN")
    out = np.empty(x.shape, dtype=np.int32)
    for j, c in enumerate(cuts):
        out[:, j] = x[:, j] if c is None else np.searchsorted(c, x[:, j], side="left")
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    """What the draws of all trees share of a row's hash."""
    return h ^ (h >> np.uint64(30))


def _copies(mixed: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """Poisson(1) copies of each row in a tree: a hash of the row's number, the seed and the tree."""
    salt = np.uint64(((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
    z = mixed ^ _mixed(salt)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    y = z >> np.uint64(27)
    z ^= y
    z *= np.uint64(0x94D049BB133111EB)
    np.right_shift(z, np.uint64(48), out=y)
    copies = COPIES.take(y.view(np.int64))
    odd = np.flatnonzero(copies == ODD)
    copies[odd] = np.searchsorted(STEPS, (z[odd] >> np.uint64(32)).astype(np.uint32), side="right")
    return copies


class Tree:
    """Nodes in heap order (root 1): the feature of a split (-1: leaf), the bins that go left,
    the class weights, and gain times weight for the importances."""

    def __init__(self, depth: int, bins: int, classes: int):
        nodes = 1 << (depth + 1)
        self.feature = np.full(nodes, -1, dtype=np.int32)
        self.left = np.zeros((nodes, bins), dtype=bool)
        self.stats = np.zeros((nodes, classes))
        self.gain = np.zeros(nodes)

    def place(self, binned: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` splits."""
        rows, width = binned.shape
        flat, at, node = binned.reshape(-1), np.arange(rows) * width, np.ones(rows, dtype=np.int64)
        left, bins = self.left.reshape(-1), self.left.shape[1]
        for _ in range(levels):
            f = self.feature[node]
            right = ~left[node * bins + flat[at + np.maximum(f, 0)]]
            node = np.where(f >= 0, 2 * node + right, node)
        return node


MOST_BITS = 6       # splits deep that a 64-bit word of decisions covers


def _groups(sizes: list[int]) -> list[list[int]]:
    """Features, in groups of at most GROUP values together (a longer feature alone)."""
    out, room = [], 0
    for f, size in enumerate(sizes):
        if room < size:
            out.append([])
            room = GROUP
        out[-1].append(f)
        room //= size
    return out


def _joint(columns: list[np.ndarray], groups: list[list[int]], sizes: list[int]) -> list[np.ndarray]:
    """One number for each row and group of features."""
    out = []
    for first, *others in groups:
        x = columns[first].astype(np.int64)
        for f in others:
            x *= sizes[f]
            x += columns[f]
        out.append(x)
    return out


class _Routes:
    """Where rows stand after ``levels`` splits of a tree. Each value of a feature has a bit for every
    node that splits on it (set: right), so a row's decisions are the union of a few lookups and
    its way down is arithmetic. A row that stops early goes on to the left: below a leaf."""

    def __init__(self, tree: Tree, levels: int, groups: list[list[int]], sizes: list[int]):
        self.levels, self.kind = levels, np.uint32 if levels < MOST_BITS else np.uint64
        self.tables: list[np.ndarray | None] = []
        split = np.arange(1, 1 << levels)
        split = split[tree.feature[split] >= 0]
        for g in groups:
            table = np.zeros(1, self.kind)
            for f in g:
                own = np.zeros(sizes[f], self.kind)
                for node in split[tree.feature[split] == f]:
                    own |= (~tree.left[node, :sizes[f]]).astype(self.kind) << self.kind(node)
                table = (table[:, None] | own).reshape(-1)
            self.tables.append(table if table.any() else None)

    def place(self, joint: list[np.ndarray], rows: np.ndarray | None = None) -> np.ndarray:
        mask = None
        for table, x in zip(self.tables, joint):
            if table is not None:
                got = table.take(x if rows is None else x.take(rows))
                mask = got if mask is None else np.bitwise_or(mask, got, out=mask)
        n = len(joint[0]) if rows is None else len(rows)
        if mask is None:
            return np.full(n, 1 << self.levels, self.kind)
        node = np.ones(n, self.kind)
        for _ in range(self.levels):
            bit = mask >> node
            bit &= self.kind(1)
            node <<= self.kind(1)
            node |= bit
        return node


def _subset(seed: int, tree: int, node: int, width: int, take: int) -> np.ndarray:
    return np.sort(np.random.default_rng([seed & 0x7FFFFFFF, tree, node]).permutation(width)[:take])


class _Counter:
    """Counts of one tree's open nodes: (node, feature of its subset, bin, class) in a flat array."""

    def __init__(self, nodes: list[int], subsets: list[np.ndarray], sizes: list[int], classes: int, top: int):
        self.nodes, self.subsets, self.classes = nodes, subsets, classes
        self.slot = np.full(top, -1, dtype=np.int64)
        self.slot[nodes] = np.arange(len(nodes))
        self.pick = np.array(subsets)                                               # slot x subset
        width = np.array(sizes)[self.pick]
        self.base = np.concatenate([[0], np.cumsum(width.reshape(-1))])
        self.start = self.base[:-1].reshape(self.pick.shape)
        self.counts = np.zeros(int(self.base[-1]) * classes)

    def add(self, by: np.ndarray, rows: np.ndarray, weight: np.ndarray, node: np.ndarray) -> None:
        """``by`` has each row's bins times the classes plus its class, feature by feature; ``rows`` are
        the places in it where the counted rows begin."""
        slot = self.slot.take(node)
        if slot.size and slot.min() < 0:
            keep = np.flatnonzero(slot >= 0)
            slot, rows, weight = slot.take(keep), rows.take(keep), weight.take(keep)
        for pick, start in zip(self.pick.T, self.start.T * self.classes):
            if len(pick) > 1:
                at = by.take(rows + pick.take(slot)) + start.take(slot)
            else:
                at = by.take(rows + pick[0]) + start[0]
            self.counts += np.bincount(at, weights=weight, minlength=len(self.counts))


def _parts(batches, columns: int):
    """Columns of a task's rows as numpy arrays, up to about ``BATCH`` rows at once."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BATCH:
            yield [np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(columns)]
            held, rows = [], 0
    if rows:
        yield [np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(columns)]


def _count(open_nodes: dict, trees: list, level: int, sizes: list[int], classes: int, take: int, seed: int):
    """The map side of a level: a task's counts, one row a tree."""
    def run(batches):
        width, groups, deep = len(sizes), _groups(sizes), level > MOST_BITS
        counters = {t: _Counter(nodes, [_subset(seed, t, n, width, take) for n in nodes], sizes, classes, 1 << (level + 1))
                    for t, nodes in open_nodes.items()}
        routes = {} if deep else {t: _Routes(trees[t], level, groups, sizes) for t in open_nodes}
        some = False
        for cols in _parts(batches, width + 3):
            label, weight, h = cols[width].astype(np.int64), cols[width + 1], cols[width + 2].view(np.uint64)
            if not (weight > 0).all():
                good = np.flatnonzero(weight > 0)
                cols, label, weight, h = [x.take(good) for x in cols[:width]], label.take(good), weight.take(good), h.take(good)
            some = True
            binned = np.ascontiguousarray(np.stack(cols[:width], axis=1))
            by = (binned * np.int64(classes) + label[:, None]).reshape(-1)
            begin, joint, mixed = np.arange(len(label)) * width, _joint(cols, groups, sizes), _mixed(h)
            for t, counter in counters.items():
                copies = _copies(mixed, seed, t)
                rows = np.flatnonzero(copies)
                node = trees[t].place(binned[rows], level) if deep else routes[t].place(joint, rows)
                counter.add(by, begin.take(rows), weight.take(rows) * copies.take(rows), node)
        for t, c in counters.items() if some else ():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([c.counts.tobytes()], pa.binary())], ["tree", "counts"])
    return run


def _gini(s: np.ndarray) -> np.ndarray:
    n = s.sum(axis=-1)
    return 1.0 - np.square(s).sum(axis=-1) / np.square(np.where(n > 0, n, 1.0))


def best_split(h: np.ndarray, arity: int, unordered: int):
    """(gain, left bins, left class weights) of the best split of one feature's counts ``h`` (bins x
    classes), None without one: thresholds, all subsets of a short category, or categories
    in the order of their impurity (two classes: of their share of class 1)."""
    bins, classes = h.shape
    total = h.sum(axis=0)
    if arity and classes > 2 and arity <= unordered:
        masks = (np.arange(1, 1 << (bins - 1))[:, None] >> np.arange(bins) & 1).astype(bool)
    else:
        order = np.arange(bins)
        if arity:
            n = h.sum(axis=1)
            centre = _gini(h) if classes > 2 else h[:, 1] / np.where(n > 0, n, 1.0)
            order = np.argsort(np.where(n > 0, centre, np.inf), kind="stable")
        masks = None
    left = masks @ h if masks is not None else np.cumsum(h[order], axis=0)[:-1]
    right = total - left
    if not len(left):
        return None
    nl, nr, n = left.sum(axis=1), right.sum(axis=1), total.sum()
    ok = (nl > 1e-9 * n) & (nr > 1e-9 * n)
    if not ok.any():
        return None
    gain = np.where(ok, _gini(total) - nl / n * _gini(left) - nr / n * _gini(right), -np.inf)
    i = int(np.argmax(gain))
    if masks is None:
        goes = np.zeros(bins, dtype=bool)
        goes[order[:i + 1]] = True
    else:
        goes = masks[i]
    return float(gain[i]), goes, left[i]


def _choose(open_nodes: dict, sizes: list[int], arity: list[int], unordered: int, classes: int, take: int, seed: int):
    """The reduce side of a level: the best split of each open node of a tree."""
    def run(key, table):
        t = key[0].as_py()
        c = _Counter(open_nodes[t], [_subset(seed, t, n, len(sizes), take) for n in open_nodes[t]], sizes, classes, max(open_nodes[t]) + 1)
        for part in table.column("counts"):
            c.counts += np.frombuffer(part.as_buffer())
        counts, rows = c.counts.reshape(-1, classes), []
        for s, node in enumerate(c.nodes):
            best, total = None, None
            for j, f in enumerate(c.subsets[s]):
                h = counts[c.start[s, j]:c.start[s, j] + sizes[f]]
                total = h.sum(axis=0)
                found = best_split(h, arity[f], unordered)
                if found and (best is None or found[0] > best[0]):
                    best = (*found, int(f))
            split = best is not None and best[0] > 0
            rows.append((t, node, best[3] if split else -1, best[0] if split else 0.0, np.packbits(best[1]).tobytes() if split else b"",
                         total.tolist(), best[2].tolist() if split else []))
        names, types = ["tree", "node", "feature", "gain", "goes", "total", "left"], [
            pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.table([pa.array([r[i] for r in rows], ty) for i, ty in enumerate(types)], names=names)
    return run


def _distinct(width: int, wanted: list[int], most: int):
    """At most ``most`` + 1 different values of each wanted feature in a task."""
    def run(batches):
        seen = {j: np.empty(0) for j in wanted}
        for b in batches:
            x = _matrix(b.column(0), width)
            for j in wanted:
                if len(seen[j]) <= most:
                    seen[j] = np.unique(np.concatenate([seen[j], x[:, j]]))
        for j, v in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([j] * len(v[:most + 1]), pa.int32()), pa.array(v[:most + 1])], ["j", "v"])
    return run


def thresholds(rows: DataFrame, arity: list[int], most: int) -> list:
    """Per feature None (a category) or its ascending thresholds: midpoints of the different values, or
    quantiles where there are more values than bins."""
    numeric = [j for j, a in enumerate(arity) if not a]
    found = rows.select("x").mapInArrow(_distinct(len(arity), numeric, most), "j int, v double") \
        .distinct().groupBy("j").agg(F.sort_array(F.collect_set("v")).alias("v")) \
        .select("j", F.slice("v", 1, most + 1).alias("v")).collect()
    values = {r.j: np.array(r.v) for r in found}
    cuts = [None if a else (values[j][:-1] + values[j][1:]) / 2 if j in values else np.empty(0) for j, a in enumerate(arity)]
    many = [j for j in numeric if j in values and len(values[j]) > most]
    if many:
        shares = [i / most for i in range(1, most)]
        q = rows.agg(*[F.percentile_approx(F.col("x")[j], shares, 10000).alias(f"q{j}") for j in many]).first()
        for j in many:
            cuts[j] = np.unique(np.array(q[f"q{j}"]))
    return cuts


def categories(df: DataFrame, features: str) -> list[int]:
    """Number of values of each slot of an assembled vector, 0 for a numeric one (from its metadata)."""
    about = df.schema[features].metadata["ml_attr"]
    arity = [0] * about["num_attrs"]
    for a in about["attrs"].get("nominal", []):
        arity[a["idx"]] = len(a["vals"]) if "vals" in a else a["num_vals"]
    return arity


class HistogramForest(RandomForestClassifier):
    """``RandomForestClassifier`` with its parameters (Gini, Poisson bagging), fitted by histograms."""

    def _fit(self, dataset: DataFrame) -> "HistogramForestModel":
        arity = categories(dataset, self.getFeaturesCol())
        width, most, depth, n_trees, seed = len(arity), self.getMaxBins(), self.getMaxDepth(), self.getNumTrees(), self.getSeed()
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        # tasks stream their rows, so their number is that of the cores, not of the rows
        tasks = 2 * dataset.sparkSession.sparkContext.defaultParallelism
        rows = dataset.coalesce(tasks).select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"),
                              weight.alias("weight"), F.xxhash64(F.monotonically_increasing_id()).alias("h"))
        cuts = thresholds(rows, arity, most)
        sizes = [a or len(c) + 1 for a, c in zip(arity, cuts)]

        def to_bins(batches):
            for b in batches:
                x = _binned(_matrix(b.column(0), width), cuts)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[:, j]) for j in range(width)], *[b.column(i) for i in (1, 2, 3)]],
                                                 [*[f"b{j}" for j in range(width)], "label", "weight", "h"])
        schema = ", ".join([*[f"b{j} int" for j in range(width)], "label int", "weight double", "h long"])
        table = rows.mapInArrow(to_bins, schema).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, top = table.agg(F.count(F.lit(1)), F.max("label")).first()
            known = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {}).get("vals")
            classes = max(2, len(known) if known else 0, (top or 0) + 1)
            unordered = int(math.log2(min(most, max(n, 1)) // 2 + 1) + 1)
            take = max(1, math.ceil(math.sqrt(width)))
            trees = [Tree(depth, max(sizes), classes) for _ in range(n_trees)]
            open_nodes = {t: [1] for t in range(n_trees)}
            for level in range(depth):
                nodes = max((len(v) for v in open_nodes.values()), default=0)
                if not nodes:
                    break
                each = max(1, ROOM // (8 * classes * nodes * sum(sorted(sizes)[-take:])))
                listed, grown = sorted(open_nodes), []
                for i in range(0, len(listed), each):
                    some = {t: open_nodes[t] for t in listed[i:i + each]}
                    shown = {t: trees[t] for t in some}
                    counts = table.mapInArrow(_count(some, shown, level, sizes, classes, take, seed), "tree int, counts binary")
                    grown += counts.groupBy("tree").applyInArrow(
                        _choose(some, sizes, arity, unordered, classes, take, seed),
                        "tree int, node int, feature int, gain double, goes binary, total array<double>, left array<double>").collect()
                open_nodes = {}
                for r in sorted(grown, key=lambda r: (r.tree, r.node)):
                    tree, total = trees[r.tree], np.array(r.total)
                    tree.stats[r.node] = total
                    if r.feature < 0:
                        continue
                    goes = np.unpackbits(np.frombuffer(r.goes, dtype=np.uint8), count=sizes[r.feature]).astype(bool)
                    tree.feature[r.node], tree.gain[r.node] = r.feature, r.gain * total.sum()
                    tree.left[r.node, :len(goes)] = goes
                    for child, s in ((2 * r.node, np.array(r.left)), (2 * r.node + 1, total - np.array(r.left))):
                        tree.stats[child] = s
                        if level + 1 < depth and np.count_nonzero(s > 1e-9 * total.sum()) > 1:     # a pure child is a leaf
                            open_nodes.setdefault(r.tree, []).append(child)
        finally:
            table.unpersist()
        return HistogramForestModel(trees, cuts, depth, classes, self.getFeaturesCol())


class HistogramForestModel(Model):
    """Fitted trees; ``transform`` adds probability (the mean of the leaves' class shares) and prediction."""

    def __init__(self, trees: list[Tree], cuts: list, depth: int, classes: int, features: str):
        super().__init__()
        self.trees, self.cuts, self.depth, self.classes, self.features = trees, cuts, depth, classes, features

    @property
    def featureImportances(self):
        total = np.zeros(len(self.cuts))
        for t in self.trees:
            inner = t.feature >= 0
            own = np.bincount(t.feature[inner], weights=t.gain[inner], minlength=len(self.cuts))
            total += own / own.sum() if own.sum() > 0 else 0
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, cuts, depth, classes = self.trees, self.cuts, self.depth, self.classes

        def score(batches):
            shares = [t.stats / np.maximum(t.stats.sum(axis=1, keepdims=True), 1e-300) for t in trees]
            sizes, each = [t.left.shape[1] for t in trees[:1]] * len(cuts), [[j] for j in range(len(cuts))]
            places = [t.place for t in trees]
            if depth <= MOST_BITS:
                places = [_Routes(t, depth, each, sizes).place for t in trees]
                for t, s in zip(trees, shares):
                    for node in np.flatnonzero(t.feature[:1 << depth] < 0)[1:]:     # below a leaf: its shares
                        s[2 * node] = s[2 * node + 1] = s[node]
            for x in batches:
                binned = np.ascontiguousarray(_binned(_matrix(x, len(cuts)), cuts))
                given = (_joint(list(binned.T), each, sizes),) if depth <= MOST_BITS else (binned, depth)
                p = sum((s.take(place(*given), axis=0) for place, s in zip(places, shares)), np.zeros((len(binned), classes))) / len(trees)
                ends = pa.array(np.arange(len(binned) + 1, dtype=np.int32) * classes)
                yield pa.ListArray.from_arrays(ends, pa.array(p.reshape(-1)))

        scored = _scorer(score)
        df = dataset.withColumn("_p", scored(vector_to_array(self.features)))
        first = F.array_position("_p", F.array_max("_p")) - 1       # ties: the smallest label
        return df.withColumn("probability", array_to_vector("_p")).withColumn("prediction", first.cast("double")).drop("_p")


def _scorer(score):
    import collections.abc

    def run(batches: collections.abc.Iterator[pa.Array]) -> collections.abc.Iterator[pa.Array]:
        return score(batches)
    run.__annotations__ = {"batches": collections.abc.Iterator[pa.Array], "return": collections.abc.Iterator[pa.Array]}
    return F.arrow_udf(run, "array<double>")

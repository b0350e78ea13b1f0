"""The Jaccard join against brute force, with hot keys forced through hubs on every level."""

import collections
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vialflow.llm import jaccard_join as J
from vialflow.llm.common import CLEANUP, stored
from vialflow.llm.components import roots

SCHEMA = "doc_id long, text string"


def shingles(t, k):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    return frozenset(tuple(w[a:a + k]) for a in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, p, q):
    sets, at = {i: shingles(t, k) for i, t in rows}, collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    up = {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for i, s in sets.items():
        for j, n in collections.Counter(j for x in s for j in at[x] if j < i).items():
            if q * n >= p * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n, seed=3):
    random.seed(seed)
    voc = [f"w{i}" for i in range(400)]
    base = [random.choice(voc) for _ in range(260)]
    rows = []
    for i in range(n):
        t = list(base)
        for _ in range(random.choice([0, 1, 2, 3, 4, 6, 8])):
            t[random.randrange(len(t))] = random.choice(voc + base[:5])
        if i % 3 == 0:
            t = t[:120]
        if i % 7 == 0:
            t = t + base[:random.randrange(1, 20)]
        rows.append((i, " ".join(t)))
    return rows + [(1000 + i, " ".join(random.choice(voc) for _ in range(random.randrange(9)))) for i in range(30)]


@pytest.mark.parametrize("small,deep,pairs,triples", [(32, 256, 6, 11), (4, 12, 2, 4)])
@pytest.mark.parametrize("k,p,q", [(3, 9, 10), (5, 4, 5)])
def test_like_brute_force(spark, monkeypatch, small, deep, pairs, triples, k, p, q):
    for name, v in (("SMALL", small), ("DEEP", deep), ("PAIRS_FROM", pairs), ("TRIPLES_FROM", triples)):
        monkeypatch.setattr(J, name, v)
    rows = near_copies(140)
    got = J.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3), k, f"{p}/{q}").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, k, p, q)


def one_group(n, seed=11):
    """Near copies of one text as check tables have them: words left out, changed and added."""
    r = random.Random(seed)
    voc = [f"v{i}" for i in range(3000)]
    base = [r.choice(voc) for _ in range(120)]
    rows = []
    for i in range(n):
        t = list(base)
        for _ in range(r.choice([1, 2, 2, 3, 3, 4, 6])):
            at = r.randrange(len(t))
            t[at:at + 1] = r.choice([[], [r.choice(voc)], [t[at], r.choice(voc)]])
        rows.append((i, " ".join(t)))
    return rows


def labels_of_one_group(rows, k, p, q):
    """Components from the whole matrix of common shingles."""
    sets = [shingles(t, k) for _, t in rows]
    often = [x for x, c in collections.Counter(x for s in sets for x in s).items() if c > 1]
    at = {x: j for j, x in enumerate(often)}
    m = np.zeros((len(rows), len(often)), np.float32)
    for i, s in enumerate(sets):
        m[i, [at[x] for x in s if x in at]] = 1
    n = np.array([len(s) for s in sets])
    both = (m @ m.T).round().astype(np.int64)
    linked = q * both >= p * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(linked, True)
    label = np.arange(len(rows))
    while True:
        new = np.where(linked, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            return {rows[i][0]: (int(n[i]), rows[label[i]][0]) for i in range(len(rows))}
        label = new


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Right classes, and compared pairs bounded by the number of texts."""
    met, compared = [], J._compared

    def counting(pairs, *args, **kw):
        met.append(pairs.count())
        return compared(pairs, *args, **kw)
    monkeypatch.setattr(J, "_compared", counting)
    pairs = {}
    for n in (1000, 2000):
        met.clear()
        rows = one_group(n)
        got = J.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4), 5, "0.8").collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == labels_of_one_group(rows, 5, 4, 5)
        pairs[n] = sum(met)
    assert all(v <= 20 * n for n, v in pairs.items())


def test_documents_like_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = J.jaccard_components(docs, 3, "0.9").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 3, 9, 10)
    kept = J.drop_near_copies(docs, 3, "0.9")
    assert kept.columns == docs.columns
    want = brute(rows, 3, 9, 10)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_odd_rows(spark):
    rows = [(None, "a b c d"), (5, "A b  c\nd"), (5, "a b c d"), (6, None), (7, ""), (8, " \t"), (None, ""), (9, "one"), (10, "ONE"), (11, "one two"), (12, "x " * 30000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("key", F.lit("k")).withColumn("row", F.lit(3))
    got = J.jaccard_components(df, 3, "0.9").collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(
        [(None, 2, 5), (5, 2, 5), (5, 2, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (None, 0, None), (9, 1, 9), (10, 1, 9), (11, 1, 11), (12, 1, 12)], key=repr)
    kept = J.drop_near_copies(df, 3, "0.9").collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([5, 6, 7, 8, None, 9, 11, 12], key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert J.jaccard_components(empty).count() == 0 and J.drop_near_copies(empty).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = dict(tuple(r) for r in roots(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}


def test_every_repeated_token_has_its_class(spark):
    """More tokens met twice than any cap: each is told from tokens met once."""
    often = " ".join(f"t{i}" for i in range(300_000))
    rows = [(0, often), (1, f"{often} end"), (2, " ".join(f"once{i}" for i in range(1000)))]
    docs = spark.createDataFrame(rows, SCHEMA).select(F.col("doc_id").alias("id"), "text")
    table = np.frombuffer(J._classes(docs, 1), np.uint8)
    twice, once = (J.words.shingles(pa.array([rows[i][1]]), 1)[0] for i in (0, 2))
    assert (table[(twice >> np.uint64(64 - J.SLOTS)).astype(np.int64)] >= 1).all()
    assert (table[(once >> np.uint64(64 - J.SLOTS)).astype(np.int64)] == 0).mean() > 0.9


def test_wanted_slots_fill_the_bitmap(spark):
    nodes = [(-1,), (-2 ** 63,), (5,), (5,), (5 + J.BITMAP,), (64,), (63,), (2 ** 63 - 1,)]
    bits = np.unpackbits(np.frombuffer(J._bitmap(spark.createDataFrame(nodes, "node long")), np.uint8), bitorder="little")
    assert len(bits) == J.BITMAP and set(np.flatnonzero(bits)) == {n % J.BITMAP for n, in nodes}


def test_the_join_leaves_no_shuffles_and_few_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 4)
    made, dropped = [], []
    for name, seen in (("stored", made), ("drop_stored", dropped)):
        monkeypatch.setattr(J, name, lambda df, *a, f=getattr(J, name), seen=seen: (seen.append(a), f(df, *a))[1])

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {x.name() for x in (blocks.apply(i) for i in range(blocks.size())) if x.isShuffle()}
    before, conf = shuffles(), spark.conf.get(CLEANUP)
    kept = stored(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count(), "test")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(CLEANUP) == conf and kept.count() == 10
    rows = near_copies(60)
    nodes, _ = J.links(spark.createDataFrame(rows, SCHEMA).select(F.col("doc_id").alias("id"), "text"), 3, 9, 10)
    links = sum(a == ("links",) for a in made)
    assert links > 1 and len(made) - len(dropped) == links + 1     # the links and the nodes stay


def test_single_keys_are_not_shuffled(spark):
    """Every key met twice stays, nearly all others go before the rows are dealt out by key."""
    n = 60_000
    rows = spark.range(n, numPartitions=5).select(F.xxhash64("id").alias("key"), F.col("id").alias("node"), F.lit(9).cast("long").alias("n"))
    twice = spark.range(300).select(F.xxhash64(n - 100 + F.col("id")).alias("key"), (F.col("id") + n).alias("node"), F.lit(9).cast("long").alias("n"))
    index = rows.unionByName(twice)
    got = [r.key for r in J._repeated(index).collect()]
    want = index.groupBy("key").count().filter("count > 1").collect()
    assert len(want) == 100 and collections.Counter(got) & collections.Counter({r.key: 2 for r in want}) == {r.key: 2 for r in want}
    assert len(got) < 300
    assert J._repeated(index.limit(0)).count() == 0

"""Ranked lexical search of a set of items over all documents.

Method: pipelined term partitioning. Terms belong to owners by how many documents hold them,
the rarest to the first owner, each owner with about the same number of postings. Items travel
in bundles of at most BUNDLE; for each block of documents a bundle carries a sparse accumulator
(item, document, score) through the owners, one stage each: a cogroup of the accumulators with
the owner's postings adds integer contributions. After each stage the LIMIT-th best partial
score of an item bounds its result from below, and what the owners to come can add bounds a
document from above; an entry that cannot reach the result any more is not carried on, which
changes no result. The last stage selects.

Scale. Documents are indexed in blocks of at most BLOCK by the tasks that read them: a block's
postings of a term are one row, so nothing is shuffled to build the index and a term held by
every document is one bounded row for each block. Only terms that an item may hold are
indexed (a bit table of fixed size tells). A cogroup's group is one bundle and one block,
bounded by BUNDLE x BLOCK accumulators. Nothing of the corpus reaches the driver but N and L
and the number of postings in each of at most 64 frequency classes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored

LIMIT = 50          # documents of an item
BLOCK = 8192        # documents of a block
BUNDLE = 256        # items of a bundle
OWNERS = 4          # stages
BITS = 1 << 21      # bytes of the table of wanted terms
SEGMENT = 4 << 20   # bytes of a text that are split at once
MERGED = 64         # blocks whose best scores are merged at once

# A-Z become a-z, other term bytes stay, all else separates; a term has whole characters
# because every byte of a character beyond 0x7F counts as one of a term
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def counted(text: str | None) -> Counter:
    """Occurrences of each term (as UTF-8) in the whole text."""
    raw = (text or "").encode("utf-8", "replace").translate(_TERM)
    if len(raw) <= SEGMENT:
        return Counter(raw.split())
    got, at = Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + SEGMENT)
        end = len(raw) if end < 0 else end
        got.update(raw[at:end].split())
        at = end
    return got


def _slot(term: bytes) -> int:
    return zlib.crc32(term) & (BITS - 1)


# ------------------------------------------------------------------ items
def _items(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bundles of the items that a task reads, with their distinct terms."""
    from pyspark import TaskContext
    base, n = TaskContext.get().partitionId() << 32, 0
    for b in it:
        terms = [sorted(x.decode() for x in counted(t)) for t in b.column("text").to_pylist()]
        at = range(n, n + b.num_rows)
        n += b.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([base + i // BUNDLE for i in at], pa.int64()), pa.array([i % BUNDLE for i in at], pa.int32()),
             b.column("item_id"), pa.array(terms, pa.list_(pa.string()))], ["bundle", "slot", "item_id", "terms"])


def _slots(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        got = {_slot(t.encode()) for ts in b.column("terms").to_pylist() for t in ts}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(got), pa.int32())], ["s"])


# ------------------------------------------------------------------ index
def _index(wanted):
    """Rows of a block: one without a term for its documents (ids, terms of each), one for each
    term (places, occurrences, terms of those documents)."""
    def flush(block, ids, totals, found):
        lengths = np.array(totals, np.int64)
        terms, at, tf, n, size = [None], [b""], [b""], [lengths.tobytes()], [len(ids)]
        for t, (places, times) in found.items():
            places = np.array(places, np.int32)
            terms.append(t.decode())
            at.append(places.tobytes())
            tf.append(np.array(times, np.int64).tobytes())
            n.append(lengths[places].tobytes())
            size.append(len(places))
        k = len(terms)
        own = pa.array([ids] + [None] * (k - 1), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * k, pa.int64()), pa.array(terms, pa.string()), pa.array(size, pa.int64()), pa.array(at, pa.binary()),
             pa.array(tf, pa.binary()), pa.array(n, pa.binary()), own], ["block", "term", "size", "at", "tf", "n", "ids"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        table, block = wanted.value, TaskContext.get().partitionId() << 32
        ids, totals, found = [], [], {}
        for b in it:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                counts = counted(text.as_py())
                for t, times in counts.items():
                    if table[zlib.crc32(t) & (BITS - 1)]:
                        x = found.setdefault(t, ([], []))
                        x[0].append(len(ids))
                        x[1].append(times)
                ids.append(doc)
                totals.append(counts.total())
                if len(ids) == BLOCK:
                    yield flush(block, ids, totals, found)
                    ids, totals, found, block = [], [], {}, block + 1
        if ids:
            yield flush(block, ids, totals, found)
    return run


INDEX = "block long, term string, size long, at binary, tf binary, n binary, ids array<bigint>"


def _totals(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        n = [np.frombuffer(x, np.int64) for x in b.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())],
                                         ["docs", "terms"])


# ------------------------------------------------------------------ stages
def part(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a term's occurrences add for each unit of its weight."""
    m = 50 + (50 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _best(acc: np.ndarray, limit: int) -> list[bytes]:
    """The highest partial scores of each item, descending."""
    out = []
    for row in acc:
        x = row[row > 0]
        if len(x) > limit:
            x = np.partition(x, len(x) - limit)[-limit:]
        out.append(np.sort(x)[::-1].tobytes())
    return out


def _stage(docs: int, terms: int, limit: int):
    """Adds an owner's contributions to a bundle's accumulator over one block."""
    def run(key, left, right):
        bundle, block = (k.as_py() for k in key)
        state, floor, rest = (left.column(c)[0].as_py() for c in ("state", "floor", "rest"))
        floor, rest = np.frombuffer(floor, np.int64), np.frombuffer(rest, np.int64)
        keys, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if state:
            keys, scores = np.frombuffer(state, np.int64).reshape(2, -1)
        acc = np.zeros((len(floor), BLOCK), np.int64)
        acc[keys // BLOCK, keys % BLOCK] = scores
        for slots, w, at, tf, n in zip(*[right.column(c).to_pylist() for c in ("slots", "w", "at", "tf", "n")]):
            at = np.frombuffer(at, np.int32)
            add = w * part(np.frombuffer(tf, np.int64), np.frombuffer(n, np.int64), docs, terms)
            for s in slots:
                acc[s, at] += add
        best = _best(acc, limit)
        acc[acc + rest[:, None] < floor[:, None]] = 0
        item, doc = np.nonzero(acc)
        state = np.concatenate([item * BLOCK + doc, acc[item, doc]]).astype(np.int64).tobytes()
        return pa.table({"bundle": pa.array([bundle], pa.int64()), "block": pa.array([block], pa.int64()), "state": pa.array([state], pa.binary()),
                         "best": pa.array([best], pa.list_(pa.binary()))})
    return run


def _merge(limit: int):
    def run(key, rows):
        best = [np.concatenate([np.frombuffer(x, np.int64) for x in xs]) for xs in zip(*rows.column("best").to_pylist())]
        best = [np.sort(x)[::-1][:limit].tobytes() for x in best]
        return pa.table({"bundle": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "best": pa.array([best], pa.list_(pa.binary()))})
    return run


def _floors(limit: int):
    """The limit-th best partial score of each item, 1 where fewer documents have any."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for best in b.column("best").to_pylist():
                got = [np.frombuffer(x, np.int64) for x in best]
                out.append(np.array([x[limit - 1] if len(x) >= limit else 1 for x in got], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("bundle"), pa.array(out, pa.binary())], ["bundle", "floor"])
    return run


def _floor_of(stage: DataFrame, blocks: int, limit: int) -> DataFrame:
    """(bundle, floor): best scores merged MERGED blocks at a time, so no task gets them all."""
    got = stage.select("bundle", "block", "best")
    while blocks > 1:
        blocks = -(-blocks // MERGED)
        got = got.select("bundle", F.pmod(F.xxhash64("block"), F.lit(blocks)).alias("block"), "best").groupBy("bundle", "block").applyInArrow(
            _merge(limit), "bundle long, block long, best array<binary>")
    return got.mapInArrow(_floors(limit), "bundle long, floor binary")


def _chosen(limit: int):
    """Of a block, the first documents of each item: by score, then doc_id (none last)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for bundle, state, ids in zip(b.column("bundle").to_pylist(), b.column("state").to_pylist(), b.column("ids")):
                keys, scores = np.frombuffer(state, np.int64).reshape(2, -1)
                ids = ids.values
                none = ids.is_null().to_numpy(zero_copy_only=False)[keys % BLOCK]
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False)[keys % BLOCK]
                order = np.lexsort((doc, none, -scores, keys // BLOCK))
                item = (keys // BLOCK)[order]
                first = np.searchsorted(item, item)
                order = order[np.arange(len(item)) - first < limit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(order), bundle, np.int64)), pa.array((keys[order] // BLOCK).astype(np.int32)),
                     pa.array(doc[order], mask=none[order]), pa.array(scores[order])], ["bundle", "slot", "doc_id", "score"])
    return run


def _bounds(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bundle and owner, what the owners after it can add to each item."""
    for b in it:
        for bundle, slots, most in zip(*[b.column(c).to_pylist() for c in ("bundle", "slots", "most")]):
            table = np.zeros((OWNERS, slots), np.int64)
            for x in most:
                table[x["owner"], x["slot"]] = x["u"]
            after = table[::-1].cumsum(axis=0)[::-1] - table
            yield pa.RecordBatch.from_arrays(
                [pa.array([bundle] * OWNERS, pa.int64()), pa.array(range(OWNERS), pa.int32()), pa.array([x.tobytes() for x in after], pa.binary())],
                ["bundle", "owner", "rest"])


def _open(slots: int) -> bytes:
    return np.ones(slots, np.int64).tobytes()


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT) -> DataFrame:
    """item_id, rank, doc_id, score: the ``limit`` best documents of every item.

    Cases: null and empty texts have no terms: such an item has no rows, such a document is
    in none; every row is a document or an item of its own, so repeated rows rank one by one
    (equal scores by ascending doc_id, rows without doc_id last) and items that share an
    item_id, or have none, have ranks of their own; texts of any length are read whole; with
    no documents or no items there are no rows; other columns are not read.
    """
    spark = docs.sparkSession
    result = "item_id long, rank int, doc_id long, score long"
    asked = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _items, "bundle long, slot int, item_id long, terms array<string>"), "items")
    table = np.zeros(BITS, np.uint8)
    table[asked.mapInArrow(_slots, "s int").distinct().toArrow().column("s").to_numpy()] = 1     # at most BITS numbers
    wanted = spark.sparkContext.broadcast(table.tobytes())
    index = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _index(wanted), INDEX), "postings")
    blocks = index.filter("term is null")
    total = blocks.select("n").mapInArrow(_totals, "docs long, terms long").agg(F.sum("docs"), F.sum("terms"), F.count(F.lit(1))).first()
    n, length, count = (x or 0 for x in total)
    if not length:
        return spark.createDataFrame([], result)

    # owners: terms by frequency class, each with about as many postings as the others
    held = index.filter("term is not null").groupBy("term").agg(F.sum("size").alias("df"))
    w = F.floor(1000 * F.log((F.lit(2.0 * n) + 2) / (2 * F.col("df") + 1))).cast("long")
    one = asked.select("bundle", "slot", F.explode("terms").alias("term")).groupBy("bundle", "term").agg(
        F.sort_array(F.collect_list("slot")).alias("slots"))        # at most BUNDLE
    wants = stored(one.join(held.select("term", "df", w.alias("w"), F.floor(F.log2("df")).cast("int").alias("class")), "term").filter("w > 0"), "wants")
    volume = dict(wants.groupBy("class").agg(F.sum("df")).collect())   # at most 64 rows
    seen, owner = 0, F.lit(0)
    for c in sorted(volume):
        owner = F.when(F.col("class") >= c, min(OWNERS - 1, seen * OWNERS // sum(volume.values()))).otherwise(owner)
        seen += volume[c]
    wants = wants.withColumn("owner", owner.cast("int"))
    # a term adds less than 10**6 for each unit of its weight
    most = wants.select("bundle", "owner", F.explode("slots").alias("slot"), "w").groupBy("bundle", "owner", "slot").agg(
        F.sum(F.col("w") * 1_000_000).alias("u"))
    most = most.groupBy("bundle").agg(F.collect_list(F.struct("owner", "slot", "u")).alias("most"))
    slots = asked.groupBy("bundle").agg((F.max("slot") + 1).alias("slots"))
    rest = stored(slots.join(most, "bundle").mapInArrow(_bounds, "bundle long, owner int, rest binary"), "rest")

    postings = index.filter("term is not null").drop("ids").join(wants.select("bundle", "term", "slots", "w", "owner"), "term")
    state = stored(postings.select("bundle", "block").distinct().withColumn("state", F.lit(b"")), "pairs")
    floor = rest.filter("owner = 0").select("bundle", F.col("rest").alias("floor")).mapInArrow(_ones, "bundle long, floor binary")
    old = []
    for k in range(OWNERS):
        left = state.join(floor, "bundle").join(rest.filter(F.col("owner") == k).select("bundle", "rest"), "bundle")
        right = postings.filter(F.col("owner") == k).select("bundle", "block", "slots", "w", "at", "tf", "n")
        stage = stored(left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block")).applyInArrow(
            _stage(n, length, limit), "bundle long, block long, state binary, best array<binary>"), "stage")
        state = stage.select("bundle", "block", "state")
        if k < OWNERS - 1:
            floor = stored(_floor_of(stage, count, limit), "floor")
        old.append(stage)
    for t in old[:-1]:
        drop_stored(t)
    found = state.join(blocks.select("block", "ids"), "block").mapInArrow(_chosen(limit), "bundle long, slot int, doc_id long, score long")
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.join(asked.select("bundle", "slot", "item_id"), ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")


def _ones(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the first stage any score above 0 may reach the result."""
    for b in it:
        yield pa.RecordBatch.from_arrays([b.column("bundle"), pa.array([_open(len(x) // 8) for x in b.column("floor").to_pylist()], pa.binary())],
                                         ["bundle", "floor"])

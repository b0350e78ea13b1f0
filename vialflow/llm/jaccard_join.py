"""Exact set-similarity self-join on word shingles, with connected components.

Method: token-combination prefixes. All sets order their tokens alike (frequency class, then
hash). A set's prefix is extended until, whatever a similar set may lack, they still share
SHARED index keys: rare tokens are indexed singly, tokens of frequent classes as combinations
of two or three within a sub-class. Sets that share so many keys are compared.

Scale. Frequency classes come from one counted pass over all documents (compressed blocks of
32-bit hashes, one reducer per hash range). Every frequency from two up has its class, however
many tokens reach it: otherwise, as the corpus grows, ever more frequent tokens count as rare,
unlike sets share keys, and candidates grow faster than the input. A key with many sets (one boilerplate passage, a
large group of near copies) never emits its pairs: its sets are compared with one hub, and
the join goes on over their *differences* from the hub. For sets x, y and a hub c, x differs
from y exactly where their differences dx, dy from c differ. Call e the number (q + p) |dx| -
(q - p) (|x| - |c|) for similarity p/q: x is not linked to c when e exceeds 2 (q - p) |c|, and
x and y are similar when dx and dy share (e(x) + e(y) - 2 (q - p) |c|) / (2 (q + p)) tokens. Of
two sets that are not connected through the hub anyway, the farther one is not linked to it.
It looks for all tokens of its difference, under its e (a bucket as wide as one token); the
nearer one is indexed for each bucket by the rarest tokens that the shared ones leave over.
Tokens met once fill the front of every prefix and cannot be shared, so a set that differs by
words of its own stands in no bucket at all, and candidates grow with the group. Differences that are hot in turn get a hub of their own; each
such group lacks the hubs before it, so this ends. Documents with equal sets are one node
throughout. Links, nodes and sets stay distributed; the driver gets the frequency classes (a
byte a slot, 2**SLOTS slots) and a bitmap of candidate slots (BITMAP bits).

Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import drop_stored, partitions, setting, stored
from .components import roots

U = np.uint64
SLOTS = 24              # log2 of the slots of the frequency-class table (one byte each)
PAIRS_FROM, TRIPLES_FROM = 6, 11    # log2 of the frequency from which tokens are combined
SUB = {2: 64, 3: 32}    # sub-classes of the combined classes
SHARED = 3              # keys that two similar sets share at least (all, if they have fewer)
COMBINED_FROM = 200     # smaller sets index single tokens only
SMALL = 32              # a key with more sets goes through a hub
DEEP = 128              # the same for keys of differences, which part their sets already
BITMAP = 1 << 24        # a whole number of words of 64 bits
ROWS = 500              # texts hashed at once
BATCH = 2500            # rows that go to a Python worker at once: texts and sets are long
FLUSH = 2 << 20         # hashes counted at once in a task


def _batches(it, others, text_col):
    for b in it:
        for i in range(0, b.num_rows, ROWS):
            part = b.slice(i, ROWS)
            yield [part.column(c) for c in others], part.column(text_col)


def _narrow(k: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, marks), texts in _batches(it, ("id", "mark"), "text"):
            sets = words.shingles(texts, k)
            n = np.array([len(s) for s in sets], np.int64)
            digest = np.array([words.set_digest(s) if len(s) else 0 for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([ids, marks, pa.array(n), pa.array(digest, mask=n == 0)], ["id", "mark", "n", "node"])
    return run


def _blocks(got: list[np.ndarray], cuts: list[int]) -> pa.RecordBatch:
    """Blocks of ascending 32-bit hashes, each with its count, by hash range: a hash met in a third
    of the rows is one entry of a block."""
    x = np.concatenate(got)
    x.sort()
    cut = np.searchsorted(x, cuts)
    key, blob, counts = [], [], []
    for r in range(len(cuts) - 1):      # range by range: what is held besides is small
        if cut[r] < cut[r + 1]:
            part, n = np.unique(x[cut[r]:cut[r + 1]], return_counts=True)
            step = np.diff(part, prepend=part[:1]).astype("<u4").view(np.uint8).reshape(-1, 4)
            key.append(r)
            blob.append(part[:1].astype("<u4").tobytes() + step.T.tobytes())
            counts.append(n.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(blob, pa.binary()), pa.array(counts, pa.binary())],
                                      ["r", "block", "counts"])


def _token_blocks(k: int, cuts: list[int]):
    """Blocks of the hashes of shingles, one set of blocks for each FLUSH shingles."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n, seen = [], 0, set()
        for _, texts in _batches(it, (), "text"):
            for s in words.shingles(texts, k):
                if len(s) and (d := words.set_digest(s)) not in seen:   # copies in one task count once
                    seen.add(d)
                    got.append((s >> U(32)).astype(np.uint32))
                    n += len(s)
                    if n >= FLUSH:
                        yield _blocks(got, cuts)
                        got, n, seen = [], 0, set()
        if n:
            yield _blocks(got, cuts)
    return run


def _key_blocks(cuts: list[int]):
    """Blocks of the upper halves of index keys, one set of blocks for each FLUSH keys."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n = [], 0
        for b in it:
            got.append((b.column("key").to_numpy(zero_copy_only=False).view(U) >> U(32)).astype(np.uint32))
            n += b.num_rows
            if n >= FLUSH:
                yield _blocks(got, cuts)
                got, n = [], 0
        if n:
            yield _blocks(got, cuts)
    return run


def _columns(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a range, ascending, and their counts, summed as blocks come: what is
    held is the range's distinct hashes and one block."""
    token, count = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    waiting, size = [], 0
    blocks = list(zip(rows.column("block"), rows.column("counts")))
    for i, (blob, n) in enumerate(blocks):
        blob = blob.as_py()
        x = np.cumsum(_columns(blob[4:]), dtype=np.uint64).astype(np.uint32) + np.frombuffer(blob[:4], "<u4")[0]
        waiting.append((x, _columns(n.as_py()).astype(np.int64)))
        size += len(x)
        if size >= max(FLUSH, len(token)) or i == len(blocks) - 1:
            both = np.concatenate([token, *(w[0] for w in waiting)])
            counts = np.concatenate([count, *(w[1] for w in waiting)])
            token, at = np.unique(both, return_inverse=True)
            count = np.zeros(len(token), np.int64)
            np.add.at(count, at, counts)
            waiting, size = [], 0
    return token, count


def _classes_of(token: np.ndarray, count: np.ndarray, table: np.ndarray, slot: np.ndarray) -> None:
    """A slot's byte: the log2 of the frequency of its most frequent token, 0 where all are met once."""
    np.maximum.at(table, slot, np.floor(np.log2(count)).astype(np.uint8))


def _bits_of(token: np.ndarray, count: np.ndarray, table: np.ndarray, slot: np.ndarray) -> None:
    """A slot's byte: a bit for each eighth of it that holds a hash met twice."""
    more = count > 1
    np.bitwise_or.at(table, slot[more], np.uint8(1) << (token[more] >> np.uint32(32 - SLOTS - 3) & np.uint32(7)).astype(np.uint8))


def _by_slot(blocks, fill, name: str, spark) -> bytes:
    """A byte for each of 2**SLOTS slots of hashes (16 MB whatever the corpus), filled from the counted
    hashes of its range: ``blocks`` makes them, given where ranges begin and the last ends."""
    ranges = max(64, 2 * partitions(spark))
    cuts = [(r * (1 << SLOTS) // ranges) << (32 - SLOTS) for r in range(ranges + 1)]
    at = [c >> (32 - SLOTS) for c in cuts]

    def run(key, rows):
        r = key[0].as_py()
        token, count = _summed(rows)
        part = np.zeros(at[r + 1] - at[r], np.uint8)
        fill(token, count, part, (token >> np.uint32(32 - SLOTS)).astype(np.int64) - at[r])
        return pa.table({"r": pa.array([r], pa.int32()), "part": pa.array([pa.compress(part, codec="zstd", asbytes=True)], pa.binary())})
    parts = stored(blocks(cuts).groupBy("r").applyInArrow(run, "r int, part binary"), name)
    table = np.zeros(1 << SLOTS, np.uint8)
    for r, part in parts.collect():
        table[at[r]:at[r + 1]] = np.frombuffer(pa.decompress(part, at[r + 1] - at[r], codec="zstd"), np.uint8)
    drop_stored(parts)
    return table.tobytes()


def _classes(docs: DataFrame, k: int) -> bytes:
    """The frequency class (log2, 0 for tokens met once) of each slot of token hashes."""
    return _by_slot(lambda cuts: docs.mapInArrow(_token_blocks(k, cuts), "r int, block binary, counts binary"), _classes_of, "classes", docs.sparkSession)


def _repeated(index: DataFrame) -> DataFrame:
    """``index`` without most keys of one row (nearly all are): a bit for each 2**(SLOTS + 3) slots of
    keys tells where one is met twice, so that single keys are neither shuffled nor sorted."""
    spark = index.sparkSession
    bitmap = spark.sparkContext.broadcast(_by_slot(
        lambda cuts: index.select("key").mapInArrow(_key_blocks(cuts), "r int, block binary, counts binary"), _bits_of, "bits", spark))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for b in it:
            h = b.column("key").to_numpy(zero_copy_only=False).view(U) >> U(64 - SLOTS - 3)
            yield b.filter(pa.array(bits[(h >> U(3)).astype(np.int64)] >> (h & U(7)).astype(np.uint8) & 1 == 1))
    few = stored(index.mapInArrow(run, index.schema), "repeated")
    bitmap.destroy()
    return few


def _keys(s: np.ndarray, cls: np.ndarray, p: int, q: int) -> list[int]:
    """Index keys of a sorted set for similarity p/q, given its tokens' classes."""
    n = len(s)
    same = -(-p * n // q)                   # a similar set has at least so many of the tokens
    need = n - same + min(SHARED, same)
    order = np.argsort(cls, kind="stable")
    out = []
    if n <= COMBINED_FROM * q // p + 1:
        out.append(words.mix(s[order[:need]] ^ U(0x51)))
    if n >= COMBINED_FROM:
        c = cls[order]
        if c[need - 1] < PAIRS_FROM:
            out.append(words.mix(s[order[:need]] ^ U(0xA7)))
        else:
            seen: dict[tuple[int, int], list[int]] = {}
            singles, gained = [], 0
            for t, ct in zip(s[order].tolist(), c.tolist()):
                if gained >= need:
                    break
                if ct < PAIRS_FROM:
                    singles.append(t)
                    gained += 1
                    continue
                size = 2 if ct < TRIPLES_FROM else 3
                own = seen.setdefault((size, (t >> 20) % SUB[size]), [])
                own.append(t)
                gained += len(own) >= size
            out.append(words.mix(np.array(singles, U) ^ U(0xA7)))
            combos = [sum(x) % (1 << 64) for (size, _), own in seen.items() for x in itertools.combinations(own, size)]
            out.append(words.mix(np.array(combos, U) ^ U(0xC3)))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, np.int64)


def _index(k: int, p: int, q: int, classes):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(classes.value, np.uint8)
        seen: set[int] = set()
        for _, texts in _batches(it, (), "text"):
            keys, nodes, ns = [], [], []
            for s in words.shingles(texts, k):
                if not len(s) or (d := words.set_digest(s)) in seen:
                    continue
                if len(seen) < 2_000_000:
                    seen.add(d)
                x = _keys(s, table[(s >> U(64 - SLOTS)).astype(np.int64)], p, q)
                keys.append(x)
                nodes.append(np.full(len(x), d, np.int64))
                ns.append(np.full(len(x), len(s), np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, ns)], ["key", "node", "n"])
    return run


def _bitmap(wanted: DataFrame) -> bytes:
    """A bit for each slot of the nodes ``wanted``; it comes to the driver as words of 64 bits."""
    slot = F.pmod("node", F.lit(BITMAP))
    got = wanted.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(pmod(node, 64) as int))").alias("bit")) \
        .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITMAP // 64, "<i8")
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out.tobytes()


def _wanted_sets(k: int, bitmap):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        seen: set[int] = set()
        for _, texts in _batches(it, (), "text"):
            node, blob = [], []
            for s in words.shingles(texts, k):
                if len(s) and bits[(at := (d := words.set_digest(s)) % BITMAP) >> 3] >> (at & 7) & 1 and d not in seen:
                    if len(seen) < 2_000_000:
                        seen.add(d)
                    node.append(d)
                    blob.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(blob, pa.binary())], ["node", "tokens"])
    return run


def _compare(p: int, q: int, differences: bool):
    """Exact comparison of two sets; with their difference, deletions marked, on demand."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            linked, n, m, diff = [], [], [], []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.intersect1d(x, y, assume_unique=True)
                i = len(both)
                linked.append(q * i >= p * (len(x) + len(y) - i))
                n.append(len(y))
                m.append(len(x))
                if differences:
                    plus = np.setdiff1d(y, both, assume_unique=True)
                    minus = words.mix(np.setdiff1d(x, both, assume_unique=True) ^ U(0xD1))
                    diff.append(np.concatenate([plus, minus]).view(np.int64))
            cols = [b.column("a"), b.column("b"), pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), pa.array(m, pa.int64())]
            if differences:
                at = np.cumsum([0, *(len(d) for d in diff)])
                cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(diff) if diff else np.zeros(0, np.int64))))
            yield pa.RecordBatch.from_arrays(cols, ["a", "b", "linked", "n", "m", "diff"][:len(cols)])
    return run


def _compared(pairs: DataFrame, sets: DataFrame, p: int, q: int, differences: bool = False) -> DataFrame:
    got = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("sa")), "a")
    got = got.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("sb")), "b").select("a", "b", "sa", "sb")
    return got.mapInArrow(_compare(p, q, differences), "a long, b long, linked boolean, n long, m long" + ", diff array<long>" * differences)


def _pairs(members: DataFrame, p: int, q: int, shared: int) -> DataFrame:
    """Pairs that meet in at least ``shared`` of the given keys (all keys that sets of so few
    tokens must share, if fewer): the nearer one to the hub has the key in its prefix, the
    farther one is not linked to the hub, and both have as many tokens as they must share."""
    m = members.groupBy("key").agg(F.collect_list(F.struct("node", "n", "e", "kept", "edge", "prefix", "free")).alias("m")).filter(F.size("m") > 1)

    def meets(x, y):
        enough = x.e + y.e - x.edge <= 2 * (q + p) * F.least(x.kept, y.kept)
        return y.free & ((x.e < y.e) | ((x.e == y.e) & (x.node < y.node))) & enough & (q * F.least(x.n, y.n) >= p * F.greatest(x.n, y.n))

    pair = F.flatten(F.transform(F.filter("m", lambda x: x.prefix), lambda x: F.transform(F.filter("m", lambda y: meets(x, y)), lambda y: F.struct(
        F.least(x.node, y.node).alias("a"), F.greatest(x.node, y.node).alias("b"), F.least(x.n, y.n).alias("n")))))
    got = m.select(F.explode(pair).alias("x")).groupBy("x.a", "x.b", "x.n").agg(F.count(F.lit(1)).alias("times"))
    return got.filter(F.col("times") >= F.least(F.lit(shared), F.ceil(F.col("n") * p / q))).select("a", "b")


def links(docs: DataFrame, k: int, p: int, q: int) -> tuple[DataFrame, DataFrame]:
    """(documents with their node, links (a, b) that connect the nodes). Every two sets with
    Jaccard similarity p/q or more are connected by links; each link is itself such a pair."""
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
        return _links(docs, k, p, q)


def _links(docs: DataFrame, k: int, p: int, q: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    marked = docs.select("id", F.xxhash64("text").alias("mark"), "text")
    nodes = stored(marked.mapInArrow(_narrow(k), "id long, mark long, n long, node long"), "nodes")
    classes = spark.sparkContext.broadcast(_classes(docs, k))
    index = stored(docs.mapInArrow(_index(k, p, q, classes), "key long, node long, n long"), "index")
    classes.destroy()       # a table of 16 MB in every executor and worker
    few = _repeated(index)
    drop_stored(index)
    size = few.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    members = stored(few.join(size.filter("m > 1"), "key").select("key", "node", "n").distinct(), "members")
    drop_stored(few)
    # before there is a hub: one group, every set free and indexed by all its keys
    members = members.withColumns({**{c: F.lit(0).cast("long") for c in ("e", "kept", "edge", "line")}, "prefix": F.lit(True), "free": F.lit(True)})
    small, hot = _by_size(members, SMALL)
    pairs = stored(_pairs(small, p, q, SHARED), "pairs")
    hot = stored(hot, "hot")
    drop_stored(members)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(hot.select("node"))
    bitmap = spark.sparkContext.broadcast(_bitmap(wanted))
    sets = stored(docs.mapInArrow(_wanted_sets(k, bitmap), "node long, tokens binary").groupBy("node").agg(
        F.first("tokens").alias("tokens")), "sets")
    bitmap.destroy()

    found = [stored(_compared(pairs, sets, p, q).filter("linked").select("a", "b"), "links")]
    drop_stored(pairs)
    while not hot.isEmpty():
        members = _hub_members(hot, sets, p, q, found)
        drop_stored(hot)
        small, hot = _by_size(members, DEEP)
        found.append(stored(_compared(_pairs(small, p, q, 1), sets, p, q).filter("linked").select("a", "b"), "links"))
        hot = stored(hot, "hot")
        drop_stored(members)
    for gone in (hot, sets):
        drop_stored(gone)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return nodes, out


def _by_size(members: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Members of keys with at most ``most`` sets, and of the others; keys of one set go, and
    keys that no set looks for or no prefix holds."""
    size = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("free").alias("free"), F.max("prefix").alias("prefix"))
    joined = members.join(size.filter("m > 1 and free and prefix").select("key", "m"), "key")
    return joined.filter(F.col("m") <= most).drop("m"), joined.filter(F.col("m") > most).drop("m")


def _hub_members(hot: DataFrame, sets: DataFrame, p: int, q: int, found: list) -> DataFrame:
    """Compare the sets of each hot key with one hub; the members of the next level (stored) are
    (group, difference token) keys. A group is a line of hubs and lacks them all, so groups
    shrink from level to level. Adds the links to the hubs to
    ``found``."""
    deg = hot.groupBy("line", "node").agg(F.countDistinct("key").alias("deg"))
    hub = hot.join(deg, ["line", "node"]).groupBy("line", "key").agg(
        F.max_by("node", F.struct("deg", -F.col("e"), "node")).alias("a"))    # the set in most hot keys
    groups = stored(hot.join(hub, ["line", "key"]).filter("a <> node").select(
        F.xxhash64("line", "a").alias("line"), "a", F.col("node").alias("b")).distinct(), "groups")
    compared = stored(_compared(groups.select("a", "b").distinct(), sets, p, q, differences=True), "hub")
    found.append(stored(compared.filter("linked").select("a", "b"), "links"))
    got = groups.join(compared, ["a", "b"]).withColumn("d", F.size("diff"))
    # tokens met once cannot be shared; being the rarest, they fill the front of every prefix
    tokens = got.select("line", "b", F.explode("diff").alias("t"))
    often = tokens.groupBy("line", "t").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    kept = tokens.join(often, ["line", "t"]).groupBy("line", "b").agg(F.array_sort(F.collect_list(F.struct("f", "t"))).alias("ts"))
    wide = q + p
    one = got.select("line", "b", "n", "linked", (wide * F.col("d") - (q - p) * (F.col("n") - F.col("m"))).alias("e"),
                     (2 * (q - p) * F.col("m")).alias("edge")).join(kept, ["line", "b"]).withColumn("kept", F.size("ts").cast("long"))
    own = F.floor(F.col("e") / wide)
    first = F.greatest(F.floor(F.col("edge") / wide), own)
    last = F.floor((2 * wide * F.col("kept") + F.col("edge") - F.col("e")) / wide)
    shared = F.greatest(F.floor(F.col("e") / (2 * wide)) + 1, F.ceil((F.col("bucket") * wide + F.col("e") - F.col("edge")) / (2 * wide)))
    near = one.filter(last >= first).withColumn("bucket", F.explode(F.sequence(first, last)))
    near = near.withColumn("x", F.explode(F.slice("ts", F.lit(1), F.greatest(F.lit(0), F.col("kept") - shared + 1).cast("int"))))
    far = one.filter("not linked").withColumn("bucket", own).withColumn("x", F.explode("ts"))
    both = near.withColumn("prefix", F.lit(True)).withColumn("free", F.lit(False)).unionByName(
        far.withColumn("prefix", F.lit(False)).withColumn("free", F.lit(True)))
    members = stored(both.select(F.xxhash64("line", "bucket", "x.t").alias("key"), F.col("b").alias("node"), "n", "e", "kept", "edge", "prefix",
                                 "free", "line"), "members")
    for gone in (groups, compared):
        drop_stored(gone)
    return members


def drop_near_copies(docs: DataFrame, k: int = 5, similarity: Fraction | str = "0.8", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of similar texts: the row of its smallest doc_id
    (of several such, of the smallest digest), columns unchanged. Rows without words all stay;
    rows that repeat one doc_id and text are one document."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(f"`{text_col}`").cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    narrow = docs.filter(worded).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    found = jaccard_components(narrow, k, similarity, keep_text_hash=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "mark")).alias("first")
    keep = found.groupBy("label").agg(first).select(
        F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias("i"), F.col("first.mark").alias("m"))
    row = docs.filter(worded).select(F.struct(*names).alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("")).alias("i"),
                                     F.xxhash64(text).alias("m"))
    stay = row.join(keep, ["i", "m"], "left_semi").dropDuplicates(["i", "m"]).select("row.*")
    return stay.unionByName(docs.filter(~worded).select(*names))


def jaccard_components(docs: DataFrame, k: int = 5, similarity: Fraction | str = "0.8",
                       id_col: str = "doc_id", text_col: str = "text", keep_text_hash: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links of at least ``similarity``, itself included), node (digest of its set).

    Cases: null and empty texts and texts without words have no shingles, link with nothing
    and are their own component; texts shorter than k words are one shingle; repeated rows
    and equal texts link; a row without doc_id takes part, and its component_id is the
    smallest doc_id of its component (null if there is none); an empty table gives no rows;
    other columns are not read.
    """
    s = Fraction(similarity)
    p, q = s.numerator, s.denominator
    if p >= q:
        raise ValueError("similarity must be below 1")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    nodes, found = links(docs, k, p, q)
    root = roots(found)
    by_node = nodes.filter("node is not null").groupBy("node").agg(F.min("id").alias("id")).join(root, "node", "left")
    by_node = by_node.withColumn("root", F.coalesce("root", "node"))
    least = by_node.groupBy("root").agg(F.min("id").alias("component"))
    component = by_node.join(least, "root").select("node", "component", F.col("root").alias("label"))
    out = nodes.join(component, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"), "node", "mark", "label")
    return out if keep_text_hash else out.drop("mark", "label")

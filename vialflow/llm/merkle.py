"""Merkle manifest of a corpus: one binary hash tree for each language, one over their roots.

Method: the trees are stored as aligned subtrees of at most 2**HEIGHT leaves, one row each,
their nodes in van Emde Boas order: a tree of L levels is its upper L // 2 levels, then its
lower trees from left to right, each laid out the same way. ``address`` gives a node's place
from its depth and number alone; it serves the construction (children from places, parents
into places) and the retrieval of siblings. The roots of the subtrees are the leaves of the
next tier, until one subtree is left; the languages' roots make a tree of the same kind.

Scale. Leaves are hashed by Spark and numbered by ranges (no single task). A subtree holds at
most 2**HEIGHT digests, so no group grows with the input, whichever language holds the rows.
A tier has 2**HEIGHT times fewer rows than the one below it. Paths come down tier by tier, one
row for a subtree: a join of the lower tier's rows with the upper tier's paths.

H is sha256 in lowercase hex; digests enter it as hex text. A node with one child is the H of
that child's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_number_by
from .common import stored

HEIGHT = 10     # a stored subtree has at most 2**HEIGHT leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# ------------------------------------------------------------------ layout
def address(depth: int, j: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``j`` (from the left) at ``depth`` (root: 0) of a tree of ``levels``
    levels in van Emde Boas order."""
    base, j = np.zeros(len(j), np.int64), np.asarray(j, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        tree = j >> (depth - upper)
        base += (1 << upper) - 1 + tree * ((1 << lower) - 1)
        j = j & ((1 << (depth - upper)) - 1)
        depth, levels = depth - upper, lower
    return base


@lru_cache(maxsize=2 * HEIGHT + 2)
def _places(levels: int) -> list[np.ndarray]:
    """Places of all nodes of a subtree, by depth."""
    return [address(d, np.arange(1 << d), levels) for d in range(levels)]


def height(n: int, whole: bool) -> int:
    """Levels above the leaves of a subtree: a lone one ends at its only node, one of several
    goes all the way up."""
    return HEIGHT if not whole else max(0, (n - 1).bit_length())


def plant(leaves: list[str], up: int) -> tuple[bytes, str]:
    """(nodes in van Emde Boas order, root) of a subtree that goes ``up`` levels up."""
    places = _places(up + 1)
    nodes = bytearray(32 * ((1 << (up + 1)) - 1))
    for at, x in zip(places[up].tolist(), leaves):
        nodes[32 * at:32 * at + 32] = bytes.fromhex(x)
    n = len(leaves)
    for d in range(up - 1, -1, -1):
        kids, n = places[d + 1].tolist(), -(-n // 2)
        last = len(leaves) - 1 >> (up - d - 1)      # the last child there is
        for j, at in zip(range(n), places[d].tolist()):
            a = kids[2 * j]
            data = nodes[32 * a:32 * a + 32].hex()
            if 2 * j < last:
                b = kids[2 * j + 1]
                data += nodes[32 * b:32 * b + 32].hex()
            nodes[32 * at:32 * at + 32] = hashlib.sha256(data.encode()).digest()
    return bytes(nodes), nodes[:32].hex() if up or leaves else ""


def siblings(nodes: bytes, n: int, up: int, i: int) -> list[str]:
    """Path of leaf ``i`` to the subtree's root, upwards: "<" or ">" and the sibling's digest
    (standing left or right of the node), or "" for a node without sibling."""
    out, places, last = [], _places(up + 1), n - 1
    for d in range(up, 0, -1):
        j = i ^ 1
        if j <= last:
            at = 32 * int(places[d][j])
            out.append(("<" if j < i else ">") + nodes[at:at + 32].hex())
        else:
            out.append("")
        i, last = i >> 1, last >> 1
    return out


def fold(x: str, path: list[str]) -> str:
    for s in path:
        x = h((s[1:] + x if s[:1] == "<" else x + s[1:]).encode())
    return x


def proof(path: list[str]) -> str:
    return h("".join(s[1:] for s in path).encode())


# ------------------------------------------------------------------ leaves
def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(n_chars: Column | None = None) -> Column:
    """H of a row of documents, its fields with their byte counts; ``n_chars`` replaces that."""
    cols = [n_chars if c == "n_chars" and n_chars is not None else F.col(c) for c in FIELDS]
    return F.sha2(F.concat(*[_field(c) for c in cols]), 256)


def _grouped(lang: Column) -> Column:
    """A group's key: no language sorts first, then languages by their bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def numbered(docs: DataFrame) -> DataFrame:
    """(g, i, doc_id, leaf, now): the leaves of each language by doc_id (none first; ties by
    leaf), and the digest that each row has now."""
    some = docs.select(*[F.col(f"`{c}`").alias(c) for c in FIELDS])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    rows = some.select(_grouped(F.col("lang")).alias("g"), "doc_id", leaf().alias("leaf"),
                       F.when(hit, leaf(more)).alias("now"))
    return row_number_by(rows, ["doc_id", "leaf"], ["g"], out="i").withColumn("i", F.col("i") - 1)


# ------------------------------------------------------------------ trees
BUILT = "g string, block long, n long, up int, nodes binary, root string, extra array<struct<doc_id: bigint, now: string>>"


def _build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        nodes, ups, roots, ns = [], [], [], []
        for leaves, blocks in zip(b.column("leaves"), b.column("blocks").to_pylist()):
            leaves = leaves.as_py()
            up = height(len(leaves), blocks == 1)
            x, root = plant(leaves, up)
            nodes.append(x)
            ups.append(up)
            roots.append(root)
            ns.append(len(leaves))
        yield pa.RecordBatch.from_arrays(
            [b.column("g"), b.column("block"), pa.array(ns, pa.int64()), pa.array(ups, pa.int32()), pa.array(nodes, pa.binary()),
             pa.array(roots, pa.string()), b.column("extra")], ["g", "block", "n", "up", "nodes", "root", "extra"])


def tier(nodes: DataFrame) -> DataFrame:
    """Subtrees over ``nodes`` (g, i, h, extra), stored: one row for each aligned 2**HEIGHT."""
    last = nodes.groupBy("g").agg((F.floor(F.max("i") / (1 << HEIGHT)) + 1).alias("blocks"))
    rows = nodes.groupBy("g", F.floor(F.col("i") / (1 << HEIGHT)).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("i", "h", "extra"))).alias("x"))   # at most 2**HEIGHT
    rows = rows.join(last, "g").select("g", "block", "blocks", F.col("x.h").alias("leaves"), F.col("x.extra").alias("extra"))
    return stored(rows.mapInArrow(_build, BUILT), "merkle")


def forest(nodes: DataFrame) -> list[DataFrame]:
    """All tiers of the trees over ``nodes`` (one tree for each ``g``), lowest first."""
    tiers = [tier(nodes)]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        below = tiers[-1]
        several = below.filter("block > 0").select("g").distinct()
        up = below.join(several, "g", "left_semi").select("g", F.col("block").alias("i"), F.col("root").alias("h"), F.lit(None).cast(
            "struct<doc_id: bigint, now: string>").alias("extra"))
        tiers.append(tier(up))
    return tiers


def _paths(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for g, block, n, up, nodes, upper, root in zip(*[b.column(c).to_pylist() for c in (
                "g", "block", "n", "up", "nodes", "upper", "tree")]):
            paths = [siblings(nodes, n, up, i) + (upper or []) for i in range(n)]
            first = block << HEIGHT
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(paths, pa.list_(pa.string())),
                 pa.array([root] * n, pa.string())], ["g", "i", "path", "tree"])


def crowned(tiers: list[DataFrame]) -> DataFrame:
    """The lowest tier's subtrees with ``upper`` (the path from their root to the tree's) and
    ``tree`` (the tree's root): paths come down tier by tier."""
    above = None
    for k, t in enumerate(reversed(tiers)):
        if above is None:
            t = t.withColumn("upper", F.lit(None).cast("array<string>")).withColumn("tree", F.col("root"))
        else:
            up = above.mapInArrow(_paths, "g string, i long, path array<string>, tree string")
            t = t.join(up.select("g", F.col("i").alias("block"), F.col("path").alias("upper"), "tree"), ["g", "block"], "left")
            t = t.withColumn("tree", F.coalesce("tree", "root"))
        above = t
    return above


def _audit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a subtree's leaves: leaf, roots, digest of the siblings, root folded from the
    digest that the row has now."""
    for b in it:
        for n, up, nodes, upper, tree, crown, root, extra in zip(*[b.column(c).to_pylist() for c in (
                "n", "up", "nodes", "upper", "tree", "crown", "whole", "extra")]):
            places = _places(up + 1)[up]
            rest = (upper or []) + crown
            ids, leaves, proofs, folded = [], [], [], []
            for i in range(n):
                at = 32 * int(places[i])
                own = nodes[at:at + 32].hex()
                path = siblings(nodes, n, up, i) + rest
                ids.append(extra[i]["doc_id"])
                leaves.append(own)
                proofs.append(proof(path))
                folded.append(fold(extra[i]["now"] or own, path))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(leaves), pa.array([tree] * n), pa.array([root] * n), pa.array(proofs),
                 pa.array(folded), pa.array([x == root for x in folded], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def manifest(docs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(tiers of the languages' trees, tiers of the tree over their roots), stored. The last
    row of the last tier of the second holds the root of everything."""
    rows = numbered(docs).select("g", "i", F.col("leaf").alias("h"), F.struct(
        F.col("doc_id").cast("long").alias("doc_id"), "now").alias("extra"))
    tiers = forest(rows)
    subroots = tiers[0].filter("false").select("g", F.col("root").alias("h"))
    for t in tiers:     # a tree ends in the tier where it has one subtree
        alone = t.groupBy("g").agg(F.max("block").alias("last"), F.max_by("root", "block").alias("h")).filter("last = 0")
        subroots = subroots.unionByName(alone.select("g", "h"))
    # a finished tree is not carried on, so each language is there once
    order = row_number_by(subroots, ["g"], out="i").select(F.lit("").alias("g"), (F.col("i") - 1).alias("i"), "h", F.struct(
        F.lit(None).cast("long").alias("doc_id"), F.col("g").alias("now")).alias("extra"))
    return tiers, forest(order)


def audited(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of
    ``docs``, after the tampering of the contract (n_chars + 1 where 7 divides the crc32 of the
    decimal doc_id).

    Cases: a null in any column enters the leaf as "-"; rows without doc_id come first within
    their language and are not tampered with, null n_chars stays null; rows without a language
    form a tree of their own; repeated rows are leaves of their own, equal doc_ids in order of
    their leaves; texts of any length are hashed whole; an empty table gives no rows; other
    columns are not read.
    """
    tiers, top = manifest(docs)
    langs = crowned(top).mapInArrow(_crowns, "g string, crown array<string>, whole string")
    return crowned(tiers).join(langs, "g").mapInArrow(
        _audit, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _crowns(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The languages' paths to the root of everything."""
    for b in it:
        for n, up, nodes, upper, tree, extra in zip(*[b.column(c).to_pylist() for c in (
                "n", "up", "nodes", "upper", "tree", "extra")]):
            paths = [siblings(nodes, n, up, i) + (upper or []) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x["now"] for x in extra], pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array([tree] * n, pa.string())],
                ["g", "crown", "whole"])

"""Best-fit packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so one histogram (at most ``cap`` rows) says all
that the packing needs. On it the driver rounds the large lengths up to the largest of their
equal-cardinality group, optimises configurations of the few sizes (column generation), puts
actual lengths into the slots, largest first, and places what is left by best fit in
decreasing order. The plan is a table of runs: "pieces number a to b of length l go to the
sequences from s on, at offset o". Its size depends on the capacity, not on the corpus.
Pieces are numbered within their length in parallel (by hash range, with offsets from the
counts), however many share a length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_bpe, slices
from .common import partitions, stored

GROUPS = 64             # sizes that the configurations are made of
SMALL_SHARE = 8         # lengths up to cap / SMALL_SHARE are small
ROUNDS = 4000           # configurations tried at most


def piece_lengths(n: int, cap: int) -> list[int]:
    """Lengths of a document's pieces; only the first of several may be short."""
    return [n] if n <= cap else [n % cap] * (n % cap > 0) + [cap] * (n // cap)


def _pieces(path: str, cap: int, end_id: int, payload: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for b in it:
            for at, texts in slices(b.column("text")):
                rows: list[tuple] = []
                for i, ids in enumerate(bpe.encode(texts)):
                    ids = np.append(ids, end_id).astype("<u4")
                    start = 0
                    for piece, n in enumerate(piece_lengths(len(ids), cap)):
                        raw = ids[start:start + n].tobytes()
                        rows.append((at + i, piece, start, n, zlib.crc32(raw), raw if payload else None))
                        start += n
                row, piece, start, n, crc, raw = zip(*rows)
                cols = [b.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * payload,
                                                 ["id", "piece", "start", "length", "ids_crc32", "ids"][:5 + payload])
    return run


def pieces(docs: DataFrame, path: str, cap: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
           payload: bool = False) -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * payload
    return d.mapInArrow(_pieces(path, cap, end_id, payload), schema)


def _configurations(sizes: np.ndarray, demand: np.ndarray, cap: int) -> list[tuple[int, np.ndarray]]:
    """(times, items by size): the whole parts of a linear-programming optimum over the ways
    to fill a sequence with the given sizes, by column generation."""
    k = len(sizes)
    basis = np.diag(cap // sizes).astype(float)
    x = demand / (cap // sizes)
    for _ in range(ROUNDS):
        value = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(cap + 1)
        last = np.full(cap + 1, -1)
        for c in range(int(sizes.min()), cap + 1):      # the most valuable filling of c tokens
            got = np.where(sizes <= c, best[c - np.minimum(sizes, c)] + value, 0.0)
            g = int(got.argmax())
            if got[g] > best[c - 1] + 1e-12:
                best[c], last[c] = got[g], g
            else:
                best[c], last[c] = best[c - 1], -1
        if best[cap] <= 1 + 1e-7:
            break
        col, c = np.zeros(k), cap
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                col[last[c]] += 1
                c -= int(sizes[last[c]])
        d = np.linalg.solve(basis, col)
        up = d > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, d, 1), np.inf)
        out = int(ratio.argmin())
        x = x - ratio[out] * d
        x[out] = ratio[out]
        basis[:, out] = col
    return [(int(t), basis[:, j].astype(int)) for j, t in enumerate(np.floor(x + 1e-9)) if t >= 1]


def plan(counts: dict[int, int], cap: int) -> tuple[np.ndarray, int]:
    """Runs (length, first number, pieces, first sequence, offset) for ``counts`` pieces of
    each length, sorted, and the number of sequences."""
    left = {n: c for n, c in counts.items() if c > 0}
    open_: list[tuple[int, list[int], int]] = []        # times, lengths within, room
    if cap in left:
        open_.append((left.pop(cap), [cap], 0))
    large = sorted((n for n in left if n > cap // SMALL_SHARE), reverse=True)
    total = sum(left[n] for n in large)
    groups: list[list[int]] = []
    met = 0
    for n in large:     # equal-cardinality groups of whole lengths
        if not groups or met >= len(groups) * total / GROUPS:
            groups.append([])
        groups[-1].append(n)
        met += left[n]
    if groups:
        demand = np.array([sum(left[n] for n in g) for g in groups], float)
        for times, items in _configurations(np.array([g[0] for g in groups]), demand, cap):
            slots = [g for g, a in enumerate(items) for _ in range(a)]
            while times and slots:     # actual lengths, largest first
                now, take = [], times
                spare = dict(left)
                for i, g in enumerate(slots):
                    if i == len(slots) - 1:     # the last slot takes the largest length that fits
                        n = next((n for n in large if n <= cap - sum(now) and spare.get(n, 0) > 0), None)
                    else:
                        n = next((n for n in groups[g] if spare.get(n, 0) > 0), None)
                    if n is not None:
                        spare[n] -= 1
                        now.append(n)
                if not now:
                    break
                for n in set(now):
                    take = min(take, left[n] // now.count(n))
                for n in now:
                    left[n] -= take
                open_.append((take, sorted(now, reverse=True), cap - sum(now)))
                times -= take
    room: dict[int, list[tuple[int, list[int]]]] = {}
    for times, now, r in open_:
        room.setdefault(r, []).append((times, now))
    free = sorted(room)
    for n in sorted((n for n in left if left[n] > 0), reverse=True):
        c = left[n]
        while c:        # best fit: the smallest room that takes it
            i = bisect_left(free, n)
            if i == len(free):
                per = min(c, cap // n)
                times = max(1, c // per) if per == cap // n else 1
                new, r = (times, [n] * per), cap - per * n
                c -= times * per
            else:
                r = free[i]
                times, now = room[r].pop()
                per = min(r // n, c)
                take = min(times, c // per)
                if times > take:
                    room[r].append((times - take, now))
                if not room[r]:
                    del room[r], free[i]
                new, r = (take, now + [n] * per), r - per * n
                c -= take * per
            if r not in room:
                free.insert(bisect_left(free, r), r)
            room.setdefault(r, []).append(new)
    runs, number, seq = [], dict.fromkeys(counts, 0), 0
    for r in sorted(room):
        for times, now in room[r]:
            at = 0
            for n in now:
                runs.append((n, number[n], times, seq, at))
                number[n] += times
                at += n
            seq += times
    return np.array(sorted(runs), np.int64).reshape(-1, 5), seq


def _place(shared):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = runs[:, 0] << 44 | runs[:, 1]
        for b in it:
            n, number = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "number"))
            i = np.searchsorted(key, n << 44 | number, "right") - 1
            seq = runs[i, 3] + number - runs[i, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(runs[i, 4])],
                                             [*b.schema.names[:-1], "sequence_id", "offset"])
    return run


def _numbered(p: DataFrame) -> DataFrame:
    """Pieces with a number from 0 within their length, dealt by hash ranges of the id."""
    ranges = 2 * partitions(p.sparkSession)
    p = p.withColumn("range", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(ranges)))
    size = p.groupBy("length", "range").count()
    base = F.sum("count").over(Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    size = size.select("length", "range", F.coalesce(base, F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("length", "range").orderBy("id", "piece", "ids_crc32"))
    p = p.withColumn("rank", rank).join(size, ["length", "range"])
    return p.withColumn("number", F.col("base") + F.col("rank") - 1)


def pack(docs: DataFrame, path: str, cap: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Cases: a null or empty text is the end id alone; texts of any length are cut only above
    ``cap`` ids; repeated rows and rows without doc_id are packed like others; an empty table
    gives no rows; other columns are not read.
    """
    p = stored(pieces(docs, path, cap, end_id, id_col, text_col), "pieces")
    counts = {r[0]: r[1] for r in p.groupBy("length").count().collect()}       # at most cap rows
    runs, _ = plan(counts, cap)
    shared = docs.sparkSession.sparkContext.broadcast(runs)
    n = _numbered(p).select("id", "piece", "start", "length", "ids_crc32", "number")
    out = n.mapInArrow(_place(shared), "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def sequences(docs: DataFrame, packed: DataFrame, path: str, cap: int = 2048, end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences' little-endian unsigned 32-bit ids. A sequence
    has at most ``cap`` ids, so its group is bounded."""
    p = pieces(docs, path, cap, end_id, id_col, text_col, payload=True)
    same = (p["id"].eqNullSafe(packed[id_col])) & (p["piece"] == packed["piece"]) & (p["ids_crc32"] == packed["ids_crc32"])
    j = p.join(packed.select(id_col, "piece", "ids_crc32", "sequence_id", "offset"), same)
    j = j.select("sequence_id", "offset", "ids").dropDuplicates(["sequence_id", "offset"])
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return j.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda x: x["ids"]), "")).alias("ids"))

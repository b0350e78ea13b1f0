"""Training-order materialisation of token-ID sequences.

Documents become ids (with an end id) in sequences of LENGTH; the last of a document is padded.
Sequences are numbered in input order; a keyed Feistel permutation with cycle-walking sends
each number to a slot of its own in 0..N-1, so any reader can compute the order forwards and
backwards from the key. Range partitions of the slots are shards, one file each, of records of
one fixed size: the record of slot s begins at byte (s mod SHARD) * stride of its shard. A
reader that stops at slot s goes on there.

A record: document id (signed 64 bits), piece (32), length (32), ids (unsigned 16 bits each, padded
with PAD), and a line feed, which is the text writer's separator (cast to text keeps bytes).

The order of the input counts, so the documents are a stored table: its files and their
splits are read alike twice, once to count sequences by split, once to write them. The
second reading fails if its count differs.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import byte_bpe, slices
from .common import checkpoint_dir, partitions

LENGTH, SHARD, END, PAD = 512, 4096, 50256, 0
ROUNDS = 6
HEAD = 16               # bytes before the ids


def stride(length: int = LENGTH) -> int:
    return HEAD + 2 * length + 1


class Feistel:
    """A keyed permutation of 0..n-1: balanced Feistel rounds on the least even number of bits,
    repeated on results beyond the range (cycle-walking)."""

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.keys = [int.from_bytes(hashlib.sha256(f"{key}|{i}".encode()).digest()[:8], "little") for i in range(ROUNDS)]

    def _f(self, x: np.ndarray, k: int) -> np.ndarray:
        x = (x ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return x & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        h, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> h, x & mask
        for k in keys:
            left, right = right, left ^ self._f(right, k)
        return right << h | left        # halves swapped, so that reversed keys undo it

    def _walk(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), keys)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], keys)
        return x.astype(np.int64)

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._walk(number, self.keys)

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1])


def _count(path: str, length: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, n = byte_bpe(path), 0
        for b in it:
            for _, texts in slices(b.column("text")):
                n += sum(len(x) // length + 1 for x in bpe.encode(texts))       # ids and the end id
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["split", "n"])
    return run


def _records(path: str, length: int, end_id: int, shared):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, counts, order = shared.value
        bpe, mine = byte_bpe(path), TaskContext.get().partitionId()
        at = first.get(mine, 0)
        for b in it:
            for row, texts in slices(b.column("text")):
                ids = b.column("id").slice(row, len(texts)).to_pylist()
                records = []
                for i, x in zip(ids, bpe.encode(texts)):
                    x = np.append(x, end_id).astype("<u2")
                    for piece, a in enumerate(range(0, len(x), length)):
                        part = x[a:a + length]
                        head = struct.pack("<qII", -2**63 if i is None else i, piece, len(part))
                        records.append(head + np.pad(part, (0, length - len(part)), constant_values=PAD).tobytes())
                slot = order.slot(np.arange(at, at + len(records)))
                at += len(records)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(records, pa.binary())], ["slot", "record"])
        if at != first.get(mine, 0) + counts.get(mine, 0):
            raise RuntimeError("the documents were read in another way than when they were counted; store them first")
    return run


def write_shards(docs: DataFrame, path: str, key: str, folder: str, length: int = LENGTH, shard: int = SHARD,
                 end_id: int = END, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write the shards ``folder``/shard=<k>/*.txt and return the number of sequences.

    Cases: a null or empty text is a sequence of the end id alone; a document of any length
    is cut in full; repeated rows are sequences of their own; a null doc_id is written as
    -2**63; an empty table writes no shard; other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = dict(d.mapInArrow(_count(path, length), "split int, n long").collect())       # one row per input split
    first, total = {}, 0
    for s in sorted(counts):
        first[s], total = total, total + counts[s]
    if not total:
        return 0
    shared = spark.sparkContext.broadcast((first, counts, Feistel(total, key)))
    r = d.mapInArrow(_records(path, length, end_id, shared), "slot long, record binary")
    r = r.withColumn("shard", F.floor(F.col("slot") / shard).cast("long"))
    shards = -(-total // shard)
    tasks = min(shards, partitions(spark))      # each writes a range of shards
    r = r.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("shard", "slot")
    r.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("compression", "none").text(folder)
    return total


def read_shards(spark, folder: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(slot, doc_id, piece, length, ids binary) read back from the files, a shard a row of the
    scan (SHARD records: bounded), each record from its place."""
    step = stride(length)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k, content in zip(b.column("shard").to_pylist(), b.column("content")):
                raw = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, step)
                head = raw[:, :HEAD].copy()
                doc = head[:, :8].copy().view("<i8").ravel()
                n = head[:, 12:16].copy().view("<u4").ravel().astype(np.int64)
                ids = [r[HEAD:HEAD + 2 * m].tobytes() for r, m in zip(raw, n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k * shard + np.arange(len(raw))), pa.array(doc, mask=doc == -2**63),
                     pa.array(head[:, 8:12].copy().view("<u4").ravel().astype(np.int64)), pa.array(n), pa.array(ids, pa.binary())],
                    ["slot", "doc_id", "piece", "length", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    shard_of: Column = F.regexp_extract("path", r"shard=([0-9]+)/", 1).cast("long")
    return files.select(shard_of.alias("shard"), "content").mapInArrow(run, "slot long, doc_id long, piece long, length long, ids binary")


def materialise(docs: DataFrame, path: str, key: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Write the shards into a new folder of the shared checkpoint folder and return what they
    hold: slot, shard, byte_offset, doc_id, piece, length, ids_crc32, folder."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/vialflow-shards-{uuid.uuid4().hex}"
    schema = "slot long, shard long, byte_offset long, doc_id long, piece long, length long, ids_crc32 long"
    if not write_shards(docs, path, key, folder, length, shard):
        return spark.createDataFrame([], schema + ", folder string")
    r = read_shards(spark, folder, length, shard)
    return r.select("slot", F.floor(F.col("slot") / shard).alias("shard"), (F.col("slot") % shard * stride(length)).alias("byte_offset"),
                    "doc_id", "piece", "length", F.crc32("ids").alias("ids_crc32"), F.lit(folder).alias("folder"))

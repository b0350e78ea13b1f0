"""Packing: the library's ids, gapless sequences, close to the fewest possible."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vialflow.llm import packing as P
from vialflow.llm.bpe import ByteBpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def valid(counts, cap):
    runs, n = P.plan(dict(counts), cap)
    got, use = collections.Counter(), collections.defaultdict(list)
    for length, first, times, seq, at in runs.tolist():
        assert first == got[length]
        got[length] += times
        for x in range(times):
            use[seq + x].append((at, length))
    assert got == collections.Counter({k: v for k, v in counts.items() if v})
    assert sorted(use) == list(range(n))
    for v in use.values():
        at = 0
        for o, length in sorted(v):
            assert o == at
            at += length
        assert at <= cap
    return n


@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
@settings(max_examples=40, deadline=None)
def test_plans_are_valid(counts):
    n = valid(counts, 64)
    total = sum(k * v for k, v in counts.items())
    assert n * 64 >= total and (not total or n <= 1 + 2 * total / 64)


def test_plan_is_close_to_the_bound():
    random.seed(1)
    counts = collections.Counter(min(2048, int(random.expovariate(1 / 700)) + 1) for _ in range(30000))
    n = valid(counts, 2048)
    assert n <= 1.01 * sum(k * v for k, v in counts.items()) / 2048


def expected(rows, cap):
    tok, out = Tokenizer.from_file(PATH), []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        start = 0
        for piece, n in enumerate(P.piece_lengths(len(ids), cap)):
            out.append((i, piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start += n
        assert start == len(ids)
    return sorted(out, key=repr)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = P.pack(docs, PATH).cache()
    got = packed.collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == expected(rows, 2048)
    use = collections.defaultdict(list)
    for r in got:
        use[r.sequence_id].append((r.offset, r.length))
    for v in use.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 2048
    assert len(use) <= 1.03 * sum(r.length for r in got) / 2048 + 1
    raw = {r.sequence_id: bytes(r.ids) for r in P.sequences(docs, packed, PATH).collect()}
    assert all(zlib.crc32(raw[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32 for r in got)


def test_odd_rows(spark):
    rows = [(None, "a"), (1, None), (2, ""), (2, ""), (3, "word " * 9000), (4, "<|endoftext|> x"), (5, "a\x1c\x85 \n b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("length", F.lit(1)).withColumn("id", F.lit("x"))
    got = P.pack(df, PATH).collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == expected(rows, 2048)
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_ids_are_those_of_the_library():
    random.seed(1)
    chars = [*" \n\t\r\x1c\x1f\x85\xa0", chr(0x1680), chr(0x2003), chr(0x2028), chr(0x3000), chr(0x200B), *"ab'sé1漢.,'ll𝕳"]
    texts = ["".join(random.choices(chars, k=random.randrange(40))) for _ in range(4000)] + ["<|endoftext|> a", "", "x" * 3000, "a, b. c.d,e"]
    tok = Tokenizer.from_file(PATH)
    b = ByteBpe(PATH)
    for part in (texts[:1500], texts[1500:]):
        assert [x.tolist() for x in b.encode(part)] == [e.ids for e in tok.encode_batch(part, add_special_tokens=False)]

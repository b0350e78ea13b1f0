"""Training order: a permutation, whole documents, fixed records, the same order each time."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vialflow.llm import training_order as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.integers(1, 3000), st.text(max_size=8))
@settings(max_examples=40, deadline=None)
def test_feistel_is_a_permutation(n, key):
    f = T.Feistel(n, key)
    s = f.slot(np.arange(n))
    assert sorted(s.tolist()) == list(range(n))
    assert f.number(s).tolist() == list(range(n))


def expected(rows, length):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    out = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, T.END]
        for p, a in enumerate(range(0, len(ids), length)):
            part = ids[a:a + length]
            out.append((i, p, len(part), zlib.crc32(np.array(part, "<u2").tobytes())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,shard", [(512, 64), (100, 4096)])
def test_shards_hold_every_sequence_once(spark, length, shard):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = T.materialise(docs, PATH, "k", length, shard).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got), key=repr) == expected(rows, length)
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n))
    slots = {r.slot: r for r in got}
    order = T.Feistel(n, "k")
    first = [slots[int(s)] for s in order.slot(np.arange(n))]       # in input order a document's pieces follow each other
    assert [(r.doc_id, r.piece) for r in first] == [(i, p) for i, t in rows for p in range(sum(1 for x in got if x.doc_id == i))]
    again = T.materialise(docs, PATH, "k", length, shard).collect()
    assert {(r.slot, r.doc_id, r.piece) for r in again} == {(r.slot, r.doc_id, r.piece) for r in got}
    other = T.materialise(docs, PATH, "another", length, shard).collect()
    assert {(r.slot, r.doc_id, r.piece) for r in other} != {(r.slot, r.doc_id, r.piece) for r in got}
    # a reader seeks to a record without reading the ones before it
    r = got[len(got) // 2]
    folder = f"{r.folder.removeprefix('file:')}/shard={r.shard}"
    files = [f for f in os.listdir(folder) if f.endswith(".txt")]
    assert len(files) == 1
    with open(f"{folder}/{files[0]}", "rb") as f:
        f.seek(r.byte_offset)
        raw = f.read(T.stride(length))
    assert int.from_bytes(raw[:8], "little") == r.doc_id and zlib.crc32(raw[16:16 + 2 * r.length]) == r.ids_crc32


def test_odd_rows(spark):
    schema = "doc_id long, text string, slot int, shard int"
    rows = [(None, "a b", 1, 1), (1, None, 1, 1), (1, None, 1, 1), (2, "", 1, 1), (3, "word " * 9000, 1, 1)]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    got = T.materialise(df, PATH, "k").collect()
    assert sorted(((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got), key=repr) == expected([r[:2] for r in rows], T.LENGTH)
    assert T.materialise(spark.createDataFrame([], schema), PATH, "k").count() == 0

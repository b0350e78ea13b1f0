"""The agenda against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from vialflow.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def test_agenda_alone_is_exact():
    random.seed(4)
    a = S.Agenda(PATH)
    chars = [*" \n\t\r", S.MARK, chr(0xA0), chr(0x3000), *"ab'sé1漢.,'ll<unk></s>𝕳\x00"]
    texts = ["".join(random.choices(chars, k=random.randrange(30))) for _ in range(5000)]
    texts += ["", "  ", "a " * 3000, "x" * 3000, " " * 70, "Hello, world. It's 3.14", "▁▁"]
    a.learn({c for t in texts for c in a.chunks(t)})
    assert a.differences == 0
    want = a.lib.encode(texts, num_threads=1)
    assert [a.of_text(t)[1:] for t in texts] == [(",".join(map(str, w)), d) for w, d in zip(want, a.lib.decode(want))]


def test_cache_turns_over(monkeypatch):
    monkeypatch.setattr(S, "CACHE", 20)
    a = S.Agenda(PATH)
    for i in range(30):
        t = " ".join(f"w{j}" for j in range(i, i + 25))
        a.learn(set(a.chunks(t)))
        assert a.of_text(t)[1] == ",".join(map(str, a.lib.encode(t)))
    assert len(a.seen) + len(a.old) < 200


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in S.encode(docs, PATH, digests=True).collect()}
    full = {r.doc_id: r for r in S.encode(docs, PATH).collect()}
    for r in docs.collect():
        ids = lib.encode(r.text)
        g = got[r.doc_id]
        assert (g.n_tokens, g.batch_differences) == (len(ids), 0)
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
        assert full[r.doc_id].ids == ids and full[r.doc_id].decoded == lib.decode(ids)


def test_odd_rows(spark):
    rows = [(None, "a"), (1, None), (2, ""), (2, ""), (3, "word " * 9000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("ids", F.lit("x"))
    got = S.encode(df, PATH).collect()
    assert sorted((r.n_tokens for r in got)) == [0, 0, 0, 1, 9001]
    assert S.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0

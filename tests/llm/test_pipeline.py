"""Every pipeline stage against a brute-force version on a small table."""

import re

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as C
from test_exact_dedup import expected as exact
from test_jaccard_join import brute
from test_packing import expected as pieces
from vialflow.llm import surrogates, toxicity
from vialflow.llm.common import stored, table

ROOT = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, ROOT, "documents")
    kept = [docs]
    for name, stage in C.STAGES:
        kept.append(stored(stage(spark, kept[-1], ROOT), name))
    tables = [{r.doc_id: r for r in k.collect()} for k in kept[:-1]]
    for k in kept[1:-1]:
        assert k.columns == docs.columns and k.dtypes == docs.dtypes
    flagged = {r.doc_id for r in toxicity.judge(docs, table(spark, ROOT, "labels"))[0].collect() if r.flagged}
    assert set(tables[1]) == set(tables[0]) - flagged
    rows = [(i, r.text) for i, r in tables[1].items()]
    assert set(tables[2]) == {i for i, keep, *_ in exact(rows) if i == keep}
    rows = [(i, r.text) for i, r in tables[2].items()]
    assert set(tables[3]) == {i for i, (_, c) in brute(rows, 5, 4, 5).items() if i == c}
    assert set(tables[4]) == set(tables[3])
    for i, r in tables[3].items():
        found = re.search(r"[\w.]+@mail\d\.example\.com|AKIA[A-Z0-9]{16}", r.text)
        assert (tables[4][i].text != r.text) or not found
        assert tables[4][i].n_chars == len(tables[4][i].text)
        if found:
            assert found[0] not in tables[4][i].text
    rows = [(i, r.text) for i, r in tables[4].items()]
    assert sorted((tuple(r[:5]) for r in kept[-1].collect()), key=repr) == pieces(rows, 2048)
    assert public_tokenizers.path("byte_bpe_50k.json") and surrogates.KEY


def test_run(spark):
    out = C.run(spark, ROOT)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_columns_named_like_helpers(spark):
    """Every stage but the last keeps further columns, whatever their names."""
    docs = table(spark, ROOT, "documents").limit(40)
    odd = ["_kept", "_keep_id", "_toxic_score", "_entities", "a.b", "row", "node", "key", "score", "h1"]
    for c in odd:
        docs = docs.withColumn(c, F.lit(c))
    docs = stored(docs, "odd")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, ROOT)
        assert out.columns == docs.columns, name
        assert all(r[c] == c for r in out.collect() for c in odd), name
    assert stored(C.STAGES[-1][1](spark, docs, ROOT), "odd").count()


def test_empty_tables_and_texts(spark):
    docs = table(spark, ROOT, "documents")
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), ROOT).count() == 0, name
    some = spark.createDataFrame([(10**9, None, "en", None, None), (10**9 + 2, "", None, "s", 0), (None, "a b", "en", "s", 3)], docs.schema)
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, some, ROOT).count() == (2 if name == "exact_dedup" else 3), name

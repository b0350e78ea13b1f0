"""Lexical search against a plain scorer and its SQL."""

import math
import random
import re

import pytest

from vialflow.llm import lexical_search
from vialflow.llm.lexical_search import counted, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, limit=50):
    counts = [(d, terms(t)) for d, t in docs]
    n_docs = sum(1 for _, t in counts if t)
    total = sum(len(t) for _, t in counts)
    df = {}
    for _, t in counts:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        rows = []
        for d, t in counts:
            if not t:
                continue
            m = 100 - 50 + (50 * len(t) * n_docs) // total
            s = 0
            for x in set(terms(text)):
                tf = t.count(x)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    s += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                rows.append((-s, d is None, d or 0))
        for i, (s, none, d) in enumerate(sorted(rows)[:limit]):
            out.append((item, i + 1, None if none else d, -s))
    return out


def key(r):
    return tuple((v is None, v or 0) for v in r)


@pytest.mark.parametrize("text", ["", "A,b;A é9_x", "ß Ünder\x85x y z", "@[`{/:", "Ab" * 9, "x\ty\nz\x0bq \xa0k"])
def test_terms_are_those_of_the_pattern(text):
    got = sorted(t.decode() for t in counted(text).elements())
    assert got == sorted(terms(text))


def test_long_text_is_split_between_terms(monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT", 7)
    text = "one Two three  four,five six" * 9 + "longerthanasegment"
    assert sorted(t.decode() for t in counted(text).elements()) == sorted(terms(text))


def frames(spark, docs, items, parts=3):
    d = spark.createDataFrame([(*x, "q", i) for i, x in enumerate(docs)], "doc_id long, text string, term string, block int").repartition(parts)
    return d, spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, slot int")


def corpus(n, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É1", "the", "THE"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))][::-1]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([1, 3, 30])))) for i in range(n)]
    return docs, [(j, " ".join(r.choices(vocabulary, k=r.choice([1, 4, 25])))) for j in range(9)]


@pytest.mark.parametrize("limit", [1, 5, 50])
def test_like_a_plain_scorer(spark, limit):
    docs, items = corpus(400, limit)
    docs += [(3, docs[3][1]), (None, docs[4][1]), (None, None), (901, ""), (902, "--- !!"), (903, "the " * 3000)]
    docs += [(1000 + i, "w1 w2 the") for i in range(70)]        # a long tie
    items += [(3, "w1 w2"), (None, "w1"), (77, None), (78, "unheardof"), (79, "!")]
    got = [tuple(r) for r in search(*frames(spark, docs, items), limit=limit).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=key) == sorted(plain(docs, items, limit), key=key)


def test_nothing_to_search(spark):
    docs, items = corpus(5, 1)
    d, i = frames(spark, docs, items)
    assert search(d.limit(0), i).count() == 0
    assert search(d, i.limit(0)).count() == 0
    assert search(d.limit(0), i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_matches_sql(spark):
    from conftest import SF001
    from vialflow.llm.queries import QUERIES, SQL
    from vialflow.plans.compare import duck
    name = "op12_term_pipeline"
    got = QUERIES[name](spark, SF001).toArrow()
    want = duck(SF001).sql(SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    cols = sorted(got.column_names)
    assert sorted(zip(*[got.column(c).to_pylist() for c in cols])) == sorted(zip(*[want.column(c).to_pylist() for c in cols]))
    assert got.num_rows

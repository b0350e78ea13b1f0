"""Closed syncmers against a plain Python version; the edited text and the next document."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from vialflow.llm import syncmers as S


def h64(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain(text):
    """Every distinct anchor, long words cut by their content."""
    w = []
    for x in re.findall(r"[^\x20\x09-\x0D]+", text):
        at = 0
        for j in range(len(x) - 1 if len(x) > S.PART else 0):
            if h64(x[j], x[j + 1]) % S.CUT == 0:
                w.append(x[at:j + 1])
                at = j + 1
        w.append(x[at:])
    if len(w) < S.K:
        got = [(h64(x), i) for i, x in enumerate(w)]
    else:
        inner = [h64(*w[i:i + S.S]) for i in range(len(w) - S.S + 1)]
        got = [(h64(*w[i:i + S.K]), i) for i in range(len(w) - S.K + 1)
               if min(inner[i:i + S.K - S.S + 1]) in (inner[i], inner[i + S.K - S.S])]
    first = {}
    for h, p in sorted(got):
        first.setdefault(h, p)
    return sorted(first.items())


def text_of(anchors):
    return " ".join(f"{h % (1 << 64):x}:{p:x}" for h, p in anchors)


def near(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """rows (doc_id, text), doc_ids unique."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for j, (i, t) in enumerate(rows):
        nxt = rows[(j + 1) % len(rows)][1]
        m = len(t) // 3
        e = t[:len(t) - m] + nxt[:m]
        a, b, c = plain(t), plain(e), plain(nxt)
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), text_of(a), text_of(b), near(a, b), near(a, c))
    return out


@pytest.mark.parametrize("ranges", [1, 7])
def test_like_plain_python(spark, ranges):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(-5, None), (-6, ""), (-7, "a"), (-8, "  \n"), (-9, "é漢" * 40), (10**9, "one two three four"), (10**9 + 1, "𝕳 x " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("own_h", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in S.fingerprints(df.repartition(5), ranges=ranges).collect()}
    assert got == expected(rows)


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(None, "x y z"), (None, None), (3, "same words here"), (3, "same words here"), (4, "same words here")]
    got = S.fingerprints(spark.createDataFrame(rows, schema), ranges=3).collect()
    assert len(got) == 5
    assert len({r.fingerprint for r in got if r.n_chars == 15}) == 1
    assert S.fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = S.fingerprints(spark.createDataFrame([(1, "a b c d e f g")], schema)).first()
    assert one.near_next == 1.0


def test_matches_give_positions(spark):
    a = "zero " + " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(a[5:], a)], "s string, t string")
    df = S.with_anchors(S.with_anchors(df, "s", "a"), "t", "b")
    got = df.select(S.matches(F.col("a_h"), F.col("a_p"), F.col("b_h"), F.col("b_p")).alias("m")).first().m
    assert got and {x.p2 - x.p1 for x in got} == {1}


def test_query_keeps_every_anchor(spark, tmp_path):
    from vialflow.llm.queries import op8_closed_syncmers
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(-5, None), (-6, ""), (-7, "a"), (-8, "  \n"), (-9, "é漢" * 40), (-10, "𝕳é漢字x\u2028y" * 9 + " z"), (10**9, "one two three four")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in op8_closed_syncmers(spark, str(tmp_path)).collect()}
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    most = 0
    for j, (i, t) in enumerate(rows):
        nxt = rows[(j + 1) % len(rows)][1]
        m = len(t) // 3
        e = t[:len(t) - m] + nxt[:m]
        a, b, c = plain(t), plain(e), plain(nxt)
        most = max(most, len(a))
        assert got[i] == (len(t), hashlib.sha256(e.encode()).hexdigest(), text_of(a), text_of(b), near(a, b), near(a, c))
    assert len(got) == len(rows) and most > 64


def test_passage_shared_by_long_texts_and_insertion_in_a_long_run(spark):
    words = [f"w{i}" for i in range(6000)]
    a, b = words[:3000], words[2900:]        # the last 100 words of one begin the other
    run = "".join(chr(0x4E00 + i * i * 7919 % 5000) for i in range(3000))
    df = spark.createDataFrame([(" ".join(a), " ".join(b), run, run[:5] + "x" + run[5:])], "s string, t string, u string, v string")
    for c in "stuv":
        df = S.with_anchors(df, c, f"{c}_")
    got = df.select(S.matches(F.col("s__h"), F.col("s__p"), F.col("t__h"), F.col("t__p")).alias("m"),
                    S.likeness(F.col("u__h"), F.col("v__h")).alias("near")).first()
    assert len(got.m) > 20 and {x.p1 - x.p2 for x in got.m} == {2900}
    assert got.near > 0.95

"""The classifier's held-out accuracy, thresholds, and rows of every kind."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vialflow.llm import toxicity as T

SCHEMA = "doc_id long, text string, lang string"


def corpus(n, seed=1):
    random.seed(seed)
    syl = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti", "ve", "zo"]
    word = lambda: "".join(random.choices(syl, k=random.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        y = int(i % 5 == 0)
        lang = "en" if i % 2 else "de"
        t = [word() for _ in range(random.randrange(20, 120))]
        if y:
            for _ in range(5):
                t[random.randrange(len(t))] = random.choice(["grufel", "snork"]) if lang == "en" else "knorz" + word()
        docs.append((i, " ".join(t), lang))
        labels.append((i, y))
    return docs, labels


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = corpus(2500)
    d, l = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    out, model, by = T.judge(d, l)
    return d, l, dict(labels), {r.doc_id: r for r in out.collect()}, model, by


def test_held_out_accuracy(judged):
    _, _, y, got, _, by = judged
    held = [i for i in y if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 300
    assert np.mean([(got[i].score >= 0.5) == y[i] for i in held]) > 0.95
    assert np.mean([got[i].flagged == y[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_scores_do_not_depend_on_the_batch(judged):
    d, _, _, got, model, _ = judged
    rows = d.limit(50).collect()
    one = [float(model.scores(pa.array([r.text]))[0]) for r in rows]
    assert np.allclose(one, [got[r.doc_id].score for r in rows], atol=1e-5)


def test_last_words_count(judged):
    model = judged[4]
    filler = "ba ke lo mi " * 20000
    low, high = model.scores(pa.array([filler, filler + "grufel snork grufel"]))
    assert high > low


def test_rejected_documents_go(spark, judged):
    d, l, y, got, _, _ = judged
    kept = T.drop_toxic(d.withColumn("score", F.lit("own")), l)
    assert kept.columns == [*d.columns, "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.flagged}


def test_odd_rows(spark, judged):
    _, l, *_ = judged
    rows = [(None, "ba", "en"), (1, None, None), (2, "", "xx"), (2, "", "xx"), (3, " \n ", "en"), (4, "x" * 100000, "en")]
    out, _, by = T.judge(spark.createDataFrame(rows, SCHEMA), l)
    got = out.collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.threshold == 0.5 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert T.judge(empty, l)[0].count() == 0
    assert T.judge(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "doc_id long, toxic int"))[0].count() == 6


def test_thresholds_are_calibrated_on_few_labels(judged):
    _, _, y, got, _, by = judged
    known = [i for i in y if zlib.crc32(str(i).encode()) % 5]
    own = [i for i in known if zlib.crc32(f"{i} calibrate".encode()) % T.CALIBRATION_SHARE == 0]
    assert sum(y[i] for i in known) < T.FIT_ROWS and set(by) == {"en", "de", None}
    for lang, t in ((k, v) for k, v in by.items() if k):
        n = {k: sum(y[i] == k and got[i].lang == lang for i in known) for k in (0, 1)}
        rows = [(got[i].score, y[i]) for i in own if got[i].lang == lang]
        w = {k: n[k] / sum(v == k for _, v in rows) for k in (0, 1)}

        def wrong(at):
            return sum(w[v] * ((s >= at) != v) for s, v in rows)

        assert wrong(t) <= min(wrong(k / T.BINS) for k in range(1, T.BINS + 1)) + T.POOLED_ROWS


def test_classes_are_weighted_by_their_true_counts(spark):
    scored = [(i, 0.2, "en") for i in range(40)] + [(100 + i, 0.2, "en") for i in range(30)] + [(200 + i, 0.8, "en") for i in range(30)]
    scored += [(1000 + i, 0.5, "en") for i in range(400)]
    labels = [(i, 0, True) for i in range(40)] + [(100 + i, 1, True) for i in range(30)] + [(200 + i, 1, True) for i in range(30)]
    labels += [(1000 + i, 1, False) for i in range(400)]
    by = T.thresholds(spark.createDataFrame(scored, "id long, score double, lang string"),
                      spark.createDataFrame(labels, "id long, toxic int, calibrates boolean"))
    assert by["en"] <= 0.2      # 460 toxic rows against 40: half of them below outweighs all clean ones


def test_overlong_text_is_left_out_alone(spark, monkeypatch):
    docs, labels = corpus(1500)
    first = min((i for i, _ in labels if zlib.crc32(str(i).encode()) % 5), key=lambda i: zlib.crc32(f"{i} fit".encode()))
    docs[first] = (first, "ba ke " * 200_000, "en")
    monkeypatch.setattr(T, "FIT_CHARS", 1_000_000)
    model, _ = T.fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    p = model.scores(pa.array([docs[i][1] for i in held]))
    assert np.mean([(s >= 0.5) == labels[i][1] for s, i in zip(p, held)]) > 0.9

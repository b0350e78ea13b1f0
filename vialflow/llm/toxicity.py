"""Toxicity of whole texts by a convolutional classifier: hashed word embeddings, filters of
several widths, max pooling, trained in numpy.

A word's embedding is the sum of the rows that its hash, its leading bytes and its last bytes
select, so unseen inflections of a known stem still score. A text's features are the maxima
over all its positions, so a text of any length counts in full. The model is fitted on the
driver on a bounded sample of labelled rows (FIT_ROWS of each class, FIT_CHARS characters in
all). A fixed hash share of the labelled rows is kept from the fit and only calibrates the
thresholds by language, whatever the size of the input; scores use all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import stored

BITS, DIM, FILTERS, WIDTHS = 15, 16, 12, (1, 2, 3)
HEADS, TAIL = (3, 4, 5, 6), 4
FIT_ROWS, FIT_CHARS = 4000, 60_000_000
STEPS, BATCH, RATE, MET_IN = 600, 32, 0.08, 5
BINS = 1000
POOLED_ROWS = 30        # weight of all languages' error rates in the threshold of each
CALIBRATION_SHARE = 5   # one in so many labelled rows calibrates and is not fitted
ROWS = 500              # texts scored at once


class Texts:
    """The words of some texts as rows of distinct words, with two empty places behind each
    text; a text without words has one empty place more, which is its only position."""

    def __init__(self, texts: pa.Array):
        feats, at = words.hashed(texts, HEADS, TAIL)
        _, first, place = np.unique(feats[0], return_index=True, return_inverse=True)
        self.buckets = np.stack([(words.mix(f[first]) >> np.uint64(64 - BITS)).astype(np.int64) for f in feats], 1)
        n = np.diff(at)
        size = np.maximum(n, 1)
        self.start = np.concatenate(([0], np.cumsum(size + 2)[:-1])) if len(n) else np.zeros(0, np.int64)
        self.size = size
        total = int((size + 2).sum())
        self.word = np.full(total, len(first), np.int64)      # len(first): the empty word
        self.word[np.repeat(self.start - at[:-1], n) + np.arange(int(n.sum()))] = place
        self.valid = np.ones(total, bool)
        ends = self.start + size
        self.valid[ends] = self.valid[ends + 1] = False

    def embed(self, table: np.ndarray) -> np.ndarray:
        return np.vstack([table[self.buckets].sum(1), np.zeros((1, table.shape[1]), table.dtype)])

    def responses(self, e: np.ndarray, w: list[np.ndarray]) -> list[np.ndarray]:
        """By width, the filters' sums at every position (minus infinity outside texts)."""
        out = []
        for filters in w:
            r = (e @ filters[0])[self.word]
            for j in range(1, len(filters)):
                r[:-j] += (e @ filters[j])[self.word[j:]]
            r[~self.valid] = -np.inf
            out.append(r)
        return out


class Model:
    fitted = False      # both classes were there to fit to

    def __init__(self, seed: int = 11):
        g = np.random.default_rng(seed)
        self.table = g.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
        self.w = [g.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        n = FILTERS * len(WIDTHS)
        self.b, self.out, self.bias = np.zeros(n, np.float32), g.normal(0, 0.3, n).astype(np.float32), np.zeros(1, np.float32)
        self.shift = 0.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        t = Texts(texts)
        r = t.responses(t.embed(self.table), self.w)
        top = np.concatenate([np.maximum.reduceat(x, t.start) for x in r], 1)
        return np.maximum(top + self.b, 0) @ self.out + self.bias[0]

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        z = np.concatenate([self.logits(texts.slice(i, ROWS)) for i in range(0, len(texts), ROWS)]).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z + self.shift, -40, 40)))

    def fit(self, texts: pa.Array, y: np.ndarray, seed: int = 5) -> Model:
        g = np.random.default_rng(seed)
        # a row of the table that few texts select tells them apart but teaches nothing
        met = np.zeros(1 << BITS, np.int64)
        for i in range(0, len(y), ROWS):
            t = Texts(texts.slice(i, ROWS))
            for s, n in zip(t.start.tolist(), t.size.tolist()):
                u = np.unique(t.word[s:s + n])
                met[np.unique(t.buckets[u[u < len(t.buckets)]])] += 1
        rare = met < MET_IN
        self.table[rare] = 0
        params = [self.table, *self.w, self.b, self.out, self.bias]
        seen = [np.full(p.shape, 0.01, np.float32) for p in params]

        def step(i: int, rows, grad: np.ndarray) -> None:
            seen[i][rows] += grad * grad
            params[i][rows] -= RATE * grad / np.sqrt(seen[i][rows])

        cut = np.repeat(np.arange(len(WIDTHS)), FILTERS)
        for _ in range(-(-STEPS * BATCH // len(y))):
            order = g.permutation(len(y))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                t = Texts(texts.take(pa.array(rows)))
                e = t.embed(self.table)
                r = np.concatenate(t.responses(e, self.w), 1)
                where = np.stack([s + r[s:s + n].argmax(0) for s, n in zip(t.start.tolist(), t.size.tolist())])
                h = np.take_along_axis(r, where, 0) + self.b
                a = np.maximum(h, 0)
                p = 1 / (1 + np.exp(-np.clip(a @ self.out + self.bias[0], -40, 40)))
                dz = ((p - y[rows]) / len(rows)).astype(np.float32)
                dh = dz[:, None] * self.out * (h > 0)
                de = np.zeros_like(e)
                for i, k in enumerate(WIDTHS):
                    mine = np.flatnonzero(cut == i)
                    dw = np.zeros_like(self.w[i])
                    for j in range(k):
                        u = t.word[where[:, mine] + j]              # texts x filters
                        dw[j] = np.einsum("nf,nfd->df", dh[:, mine], e[u])
                        np.add.at(de, u, dh[:, mine][:, :, None] * self.w[i][j].T[None])
                    step(1 + i, slice(None), dw)
                n = 1 + len(WIDTHS)
                step(n, slice(None), dh.sum(0))
                step(n + 1, slice(None), a.T @ dz)
                step(n + 2, slice(None), dz.sum(keepdims=True))
                hit = np.flatnonzero(np.abs(de[:-1]).sum(1))
                ids, inv = np.unique(t.buckets[hit].ravel(), return_inverse=True)
                live = ~rare[ids]
                dt = np.zeros((len(ids), DIM), np.float32)
                np.add.at(dt, inv.ravel(), np.repeat(de[hit], t.buckets.shape[1], 0))
                step(0, ids[live], dt[live])
        return self


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labels(labels: DataFrame, id_col: str) -> DataFrame:
    """One label of each doc_id outside the held-out fifth; rows without id or label go."""
    l = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    l = l.filter("id is not null and toxic in (0, 1)").filter(~held_out(F.col("id")))
    return l.groupBy("id").agg(F.max("toxic").alias("toxic"))


def calibrates(id_col: Column) -> Column:
    return F.crc32(F.concat(id_col.cast("string"), F.lit(" calibrate")).cast("binary")) % CALIBRATION_SHARE == 0


def _within(lengths: list[tuple[int, int]]) -> list[int]:
    """Of (id, characters) in order, the ids of what fits into FIT_CHARS; a text that does not
    fit is left out alone."""
    out, used = [], 0
    for i, n in lengths:
        if used + n <= FIT_CHARS:
            out.append(i)
            used += n
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """(model, all labelled rows outside the held-out fifth; ``calibrates`` marks those that it
    has not seen and that only calibrate). Without both classes among the fitted rows the model
    stays untrained and scores near one half of the prior."""
    known = stored(_labels(labels, id_col).withColumn("calibrates", calibrates(F.col("id"))), "labels")
    fitted = known.filter("not calibrates").drop("calibrates")
    count = dict(fitted.groupBy("toxic").count().collect())      # two rows
    pick = F.crc32(F.concat(F.col("id").cast("string"), F.lit(" fit")).cast("binary"))
    sample = None
    for y in (0, 1):
        one = fitted.filter(F.col("toxic") == y).orderBy(pick, "id").limit(FIT_ROWS)
        sample = one if sample is None else sample.unionByName(one)
    sample = stored(sample, "sample")       # at most 2 * FIT_ROWS rows
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = stored(texts.join(F.broadcast(sample), "id").dropDuplicates(["id"]), "fit")
    lengths = chosen.select("id", F.length("text").alias("c"), pick.alias("p")).orderBy("p", "id").select("id", "c").collect()
    within = chosen.sparkSession.createDataFrame([(i,) for i in _within([tuple(r) for r in lengths])], "id long")
    got = chosen.join(F.broadcast(within), "id").orderBy(pick, "id").toArrow()
    y = got.column("toxic").to_numpy().astype(np.float32)
    model = Model()
    if 0 < y.sum() < len(y):
        model.fit(got.column("text").combine_chunks(), y)
        model.fitted = True
        # the sample holds the classes in other shares than all labelled rows
        model.shift = float(np.log((1 - y.mean()) / y.mean()) - np.log(count[0] / count[1]))
    return model, known


def _scoring(model, schema_names: list[str], text_col: str, name: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in it:
            s = pa.array(m.scores(b.column(schema_names.index(text_col))))
            yield pa.RecordBatch.from_arrays([*b.columns, s], [*schema_names, name])
    return run


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxic_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: toxic likelier) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_scoring(shared, docs.columns, text_col, name), f"{fields}, `{name}` double")


def thresholds(scored: DataFrame, known: DataFrame) -> dict[str | None, float]:
    """By language, the score that parts its labelled rows with the fewest errors (the middle
    of the range that does). The errors are those of the calibrating rows, each class weighted
    up to all labelled rows of the language, and the error rates of all languages together
    count like POOLED_ROWS further rows: a language with few labelled rows stays near the common
    threshold, one with none has it (key None). From counts by language, label and score bin;
    without calibrating rows of both classes all keep one half."""
    own = F.when(F.col("calibrates"), F.floor(F.col("score") * BINS))       # null: a row that only counts
    got = scored.join(known, "id").groupBy("lang", "toxic", own.alias("bin")).count().collect()     # languages x bins
    table: dict[str | None, np.ndarray] = {}
    every: dict[str | None, np.ndarray] = {}
    pooled, total = np.zeros((2, BINS + 2)), np.zeros(2)
    for lang, toxic, b, n in got:
        every.setdefault(lang, np.zeros(2))[toxic] += n
        total[toxic] += n
        if b is not None:
            table.setdefault(lang, np.zeros((2, BINS + 2)))[toxic, int(b) + 1] += n
            pooled[toxic, int(b) + 1] += n
    if not pooled.sum(1).all():
        return {}

    def least(c: np.ndarray) -> float:
        wrong = np.cumsum(c[1]) + c[0].sum() - np.cumsum(c[0])     # with bins up to this one taken as clean
        best = np.flatnonzero(wrong <= wrong.min() + 1e-6)
        return float(np.clip(np.median(best) / BINS, 1 / BINS, 1))
    common = pooled / pooled.sum(1, keepdims=True) * (total / total.sum())[:, None]
    out = {None: least(common)}
    for lang, c in table.items():
        if lang is not None:
            n = c.sum(1, keepdims=True)
            out[lang] = least(POOLED_ROWS * common + c / np.maximum(n, 1) * every[lang][:, None])
    return out


def threshold_of(lang: Column, by: dict[str, float]) -> Column:
    common = F.lit(by.get(None, 0.5))
    pairs = [x for k, v in sorted((k, v) for k, v in by.items() if k is not None) for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), lang), common) if pairs else common


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[DataFrame, Model, dict[str, float]]:
    """(doc_id, score, lang, threshold, flagged for every row; the model; the thresholds).

    Cases: null and empty texts get the score of a text without words; rows without doc_id
    are scored and never held out; a language without labelled rows, or none, uses the common threshold;
    repeated rows score alike; empty tables give no rows and an untrained model; further
    columns are not read.
    """
    model, known = fit(docs, labels, id_col, text_col)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    scored = stored(with_scores(narrow, model, name="score").drop("text"), "scores")
    by = thresholds(scored, known)
    t = threshold_of(F.col("lang"), by)
    return scored.select(F.col("id").alias(id_col), "score", "lang", t.alias("threshold"), (F.col("score") >= t).alias("flagged")), model, by


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose score reaches their language's threshold; the rows are
    judged one by one, columns unchanged. Without labels of both classes nothing is rejected."""
    model, known = fit(docs, labels, id_col, text_col)
    if not model.fitted:
        return docs
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    labelled = with_scores(narrow.join(known.select("id"), "id", "left_semi"), model, name="score").drop("text")
    by = thresholds(labelled, known)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(_scoring_rows(shared, at), schema)
    return scored.filter(F.col("score") < threshold_of(F.col("row").getField(lang_col).cast("string"), by)).select("row.*")


def _scoring_rows(model, at: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in it:
            row = b.column(0)
            yield pa.RecordBatch.from_arrays([row, pa.array(m.scores(row.flatten()[at].cast(pa.string())))], ["row", "score"])
    return run

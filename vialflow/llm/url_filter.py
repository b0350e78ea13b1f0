"""URL filter: host and path rules, and for the rest two variable-order Markov models.

URLs that a rule decides train two models of the bytes of whole URLs, of accepted and of
rejected ones. A context is what stands before a byte, up to LONGEST bytes of it; it is kept
where a model has seen it MIN_SEEN times and smoothed into the context one byte shorter
(Witten-Bell), so every place is predicted from as far back as the URLs bear out. The score is
the difference of the log-likelihoods per byte, its threshold is calibrated on all labelled
URLs, each scored by the models of the other fold.

A smoothed log-likelihood is a sum of one weight for each substring: what a kept context takes
off for being left and what a byte seen behind it gives back. So the model is a table (hash of
the substring, weights) that is counted, smoothed level by level and looked up by joins, and may
grow with the corpus: blocks of different URLs ask for the weights of the substrings they hold,
and nothing is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LONGEST, MIN_SEEN = 8, 4
FOLDS, BINS = 2, 4000
SYMBOLS, END = 257, 256         # bytes and the end of the text
CHUNK = 1 << 18                 # places of a text handled at once
BLOCK_BYTES = 1 << 20           # about the text of a block
SPAN = 8.0              # scores are binned from -SPAN to SPAN
# fixed values: the rules of the contract
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
EMPTY = 1                       # hash of the substring without bytes
# the counts that a model rests on, by (fold, class): all of a class, or those of the other fold
MODELS = [(view, y) for view in ("all", 0, 1) for y in (0, 1)]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule's text, its verdict) of the longest rule that fits, null without one."""
    text, verdict = None, None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)) if text is None else text.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def _symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each text closed by END, and each text's first place."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, off, data = texts.buffers()
    at = np.frombuffer(off, np.int64)[:n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    starts = at + np.arange(n + 1)
    out = np.full(starts[-1], END, np.int64)
    out[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(at))] = raw
    return out, starts


def _substrings(c: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """(length, place, hash, hash without the last symbol, hash without the first) of the
    substrings of up to LONGEST + 1 symbols, CHUNK places at a time."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(c))
    for a in range(0, len(c), CHUNK):
        b = min(a + CHUNK, len(c))
        sym = c[a:b + LONGEST].astype(np.uint64) + np.uint64(1)
        h = np.full(len(sym) + 1, EMPTY, np.uint64)
        for n in range(1, LONGEST + 2):
            if n > len(sym):
                break
            longer = h[:len(sym) - n + 1] * _FACTOR + sym[n - 1:]
            at = np.flatnonzero(left[a:b][:len(longer)] >= n)
            yield n, at + a, longer[at].view(np.int64), h[at].view(np.int64), h[at + 1].view(np.int64)
            h = longer


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        c, starts = _symbols(b.column("text"))
        of = np.repeat(b.column("fold").to_numpy() * 2 + b.column("good").to_numpy(), np.diff(starts))
        times = np.repeat(b.column("n").to_numpy(), np.diff(starts))
        for n, at, h, ctx, low in _substrings(c, starts):
            k, first, which = np.unique(h, return_index=True, return_inverse=True)
            counts = np.bincount(which * 4 + of[at], times[at], 4 * len(k)).astype(np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(ctx[first]), pa.array(low[first]), pa.array(np.full(len(k), n - 1, np.int32)),
                                              *(pa.array(counts[:, j]) for j in range(4))], ["h", "ctx", "low", "level", *_N])


_N = [f"n{f}{y}" for f in range(FOLDS) for y in (0, 1)]


def _rests_on(view, y: int, prefix: str = "n") -> Column:
    return sum((F.col(f"{prefix}{f}{y}") for f in range(FOLDS) if f != view), F.lit(0))


def train(texts: DataFrame) -> tuple[DataFrame, dict]:
    """The weights (h, w_all, w_0, w_1) of substrings, and each view's weight of a place; views:
    all labelled URLs, and those outside of fold 0 or 1. ``texts``: text, fold, good, n."""
    grams = texts.mapInArrow(_count, "h long, ctx long, low long, level int, " + ", ".join(f"{c} long" for c in _N))
    grams = stored(grams.groupBy("h").agg(*[F.min(c).alias(c) for c in ("ctx", "low", "level")], *[F.sum(c).alias(c) for c in _N]), "url-grams")
    # (seen, kinds) of every context that any model may keep
    sums = [F.sum(_rests_on(v, y)).alias(f"seen_{v}{y}") for v, y in MODELS]
    kinds = [F.sum((_rests_on(v, y) > 0).cast("long")).alias(f"kinds_{v}{y}") for v, y in MODELS]
    contexts = stored(grams.groupBy("ctx").agg(*sums, *kinds).filter(
        F.greatest(*[F.col(f"seen_all{y}") for y in (0, 1)]) >= MIN_SEEN), "url-contexts")
    total = contexts.filter(F.col("ctx") == EMPTY).first()
    left = {f"{v}{y}": F.log(F.col(f"kinds_{v}{y}") / (F.col(f"seen_{v}{y}") + F.col(f"kinds_{v}{y}"))) for v, y in MODELS}
    both = {v: total is not None and min(total[f"seen_{v}{y}"] for y in (0, 1)) >= MIN_SEEN for v, _ in MODELS}

    def ratio(v, column):
        return (column(f"{v}1") - column(f"{v}0") if both[v] else F.lit(0.0)).alias(f"w_{v}")

    views = list(both)
    parts = [contexts.select(F.col("ctx").alias("h"), *[
        ratio(v, lambda m: F.when(F.col(f"seen_{m}") >= MIN_SEEN, left[m]).otherwise(0.0)) for v in views]).filter(F.col("h") != EMPTY)]
    shorter = None
    for level in range(LONGEST + 1):
        here = grams.filter(F.col("level") == level).join(contexts, "ctx")
        if shorter is None:
            here = here.select("*", *[F.lit(1 / SYMBOLS).alias(f"low_{v}{y}") for v, y in MODELS])
        else:
            here = here.join(shorter.select(F.col("h").alias("low"), *[F.col(f"p_{v}{y}").alias(f"low_{v}{y}") for v, y in MODELS]), "low")
        p = [F.when(F.col(f"seen_{v}{y}") >= MIN_SEEN, (_rests_on(v, y) + F.col(f"kinds_{v}{y}") * F.col(f"low_{v}{y}"))
                    / (F.col(f"seen_{v}{y}") + F.col(f"kinds_{v}{y}"))).otherwise(F.col(f"low_{v}{y}")).alias(f"p_{v}{y}") for v, y in MODELS]
        here = here.select("*", *p)
        gain = [ratio(v, lambda m: F.when(F.col(f"seen_{m}") >= MIN_SEEN, F.log(F.col(f"p_{m}") / F.col(f"low_{m}")) - left[m]).otherwise(0.0)) for v in views]
        shorter = stored(here.select("h", *[f"p_{v}{y}" for v, y in MODELS], *gain), "url-level")
        parts.append(shorter.select("h", *[f"w_{v}" for v in views]))
    table = reduce(DataFrame.unionByName, parts).groupBy("h").agg(*[F.sum(f"w_{v}").alias(f"w_{v}") for v in views])
    place = {v: 0.0 for v in views}
    for v in views:
        if both[v]:
            x = [math.log(total[f"kinds_{v}{y}"] / (total[f"seen_{v}{y}"] + total[f"kinds_{v}{y}"])) for y in (0, 1)]
            place[v] = x[1] - x[0]
    return stored(table.filter(F.greatest(*[F.abs(f"w_{v}") for v in views]) > 0), "url-weights"), place


def _ask(t: pa.Table) -> pa.Table:
    """The different substrings of a block's texts."""
    c, starts = _symbols(t.column("text").combine_chunks())
    found = np.zeros(0, np.int64)
    parts, size = [], 0
    for _, _, h, _, _ in _substrings(c, starts):
        parts.append(np.unique(h))
        size += len(parts[-1])
        if size > 8 * CHUNK:
            found, parts, size = np.unique(np.concatenate([found, *parts])), [], 0
    found = np.unique(np.concatenate([found, *parts]))
    return pa.table({"block": pa.array(np.full(len(found), t.column("block")[0].as_py(), np.int64)), "h": pa.array(found)})


def _score(place: dict):
    def run(texts: pa.Table, weights: pa.Table) -> pa.Table:
        c, starts = _symbols(texts.column("text").combine_chunks())
        order = np.argsort(weights.column("h").to_numpy())
        keys = weights.column("h").to_numpy()[order]
        n = np.diff(starts)
        owner = np.repeat(np.arange(len(n)), n)
        total = {v: np.zeros(len(n)) for v in place}
        w = {v: weights.column(f"w_{v}").to_numpy()[order] for v in place}
        for _, at, h, _, _ in _substrings(c, starts) if len(keys) else ():
            i = np.searchsorted(keys, h)
            hit = np.flatnonzero(keys[np.minimum(i, len(keys) - 1)] == h)
            for v in place:
                total[v] += np.bincount(owner[at[hit]], w[v][i[hit]], len(n))
        out = {name: texts.column(name) for name in ("text", "fold", "good", "n")}
        for v, base in place.items():
            out[f"s_{v}"] = pa.array(np.where(n > 1, np.round(total[v] / n + base, 9), 0.0))
        return pa.table(out)
    return run


def scores(texts: DataFrame, weights: DataFrame, place: dict) -> DataFrame:
    """``texts`` (text, fold, good, n; every text once) with the score by each view's models."""
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(size // BLOCK_BYTES + 1)))
    asked = blocks.groupBy("block").applyInArrow(_ask, "block long, h long")
    got = asked.join(weights, "h").select("block", "h", *[f"w_{v}" for v in place])
    return blocks.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(
        _score(place), "text string, fold long, good long, n long, " + ", ".join(f"s_{v} double" for v in place))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict (allow or block), score (null where a rule
    decides), threshold. The models train on and score the URL as it is, with scheme, query and
    fragment; host and path are for the rules and the output.

    Cases: a null URL and one without ``://`` have an empty host and path and fit no rule; the
    latter is scored by its characters, and a text without characters scores 0; with fewer than
    MIN_SEEN symbols of labelled URLs of either kind the models know nothing, all scores are 0
    and all such URLs are allowed; repeated rows count as often as they occur; an empty table
    gives no rows; other columns are not read.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        F.coalesce(url, F.lit("")).alias("text"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    good = F.when(F.col("by_rule") == "allow", 1).when(F.col("by_rule") == "block", 0).cast("long")
    texts = rows.groupBy("text").agg(F.min(good).alias("good"), F.count(F.lit(1)).alias("n"))
    texts = stored(texts.withColumn("fold", (F.crc32(F.col("text").cast("binary")) % FOLDS).cast("long")), "urls")
    known = texts.filter("good is not null")
    weights, place = train(known)
    scored = stored(scores(texts, weights, place), "url-scores")
    threshold = _threshold(scored.filter("good is not null"))
    own = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    out = rows.join(scored.select("text", F.col("s_all").alias("score")), "text")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"),
                      F.when(F.col("rule").isNull(), F.col("score")).alias("score"), F.lit(threshold).alias("threshold"))


def _threshold(known: DataFrame) -> float:
    """The score that parts labelled URLs best by the mean of both classes' error shares, from
    counts by score bin; each URL by the models of the other fold."""
    score = F.when(F.col("fold") == 0, F.col("s_0")).otherwise(F.col("s_1"))
    b = F.floor((F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), score)) + SPAN) * (BINS / (2 * SPAN)))
    table = np.zeros((2, BINS + 2))
    for good, k, n in known.groupBy("good", b.alias("bin")).agg(F.sum("n")).collect():     # at most 2 * (BINS + 1) rows
        table[good, int(k) + 1] += n
    if not table.sum(1).all():
        return 0.0
    share = table / table.sum(1, keepdims=True)
    wrong = np.cumsum(share[1]) + 1 - np.cumsum(share[0])       # with bins up to this one blocked
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(np.median(best)) * 2 * SPAN / BINS - SPAN

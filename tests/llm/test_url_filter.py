"""Rules and the likelihood ratio against plain Python."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from vialflow.llm import url_filter as U

SCHEMA = "page_id long, url string"


def parse(u):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def symbols(t):
    return [*t.encode(), U.END]


class Plain:
    """The smoothed model, count by count."""

    def __init__(self, texts):
        self.n, self.total, self.kinds = Counter(), Counter(), Counter()
        for t in texts:
            c = symbols(t)
            for i in range(len(c)):
                for k in range(min(i, U.LONGEST) + 1):
                    self.n[tuple(c[i - k:i + 1])] += 1
        for g, n in self.n.items():
            self.total[g[:-1]] += n
            self.kinds[g[:-1]] += 1

    def p(self, ctx, x):
        low = self.p(ctx[1:], x) if ctx else 1 / U.SYMBOLS
        if self.total[ctx] < U.MIN_SEEN:
            return low
        return (self.n[(*ctx, x)] + self.kinds[ctx] * low) / (self.total[ctx] + self.kinds[ctx])

    def log(self, t):
        c = symbols(t)
        return sum(math.log(self.p(tuple(c[max(0, i - U.LONGEST):i]), c[i])) for i in range(len(c)))


def ratio(a, b, t):
    return (a.log(t) - b.log(t)) / (len(t.encode()) + 1) if t else 0


def test_like_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = [(-1, None), (-2, "no scheme"), (-3, "HTTP://EXAMPLE.NET/EN/x"), (-4, "http://net"), (-5, "http://net/"), (-6, "http://a.net?x=/en/"),
           (-7, "x://org/fr/?q"), (-8, "http://notexample.net/en/"), (-9, "http://é.org/ÉA#f"), (-10, "a://b://c/d"), (-11, "http://x.example.com/de/1\n2")]
    rows = [(r.page_id, r.url) for r in pages.collect()] + odd
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit(1)).withColumn("host", F.lit("h")).repartition(3)).collect()}
    good, bad = [], []
    for i, u in rows:
        h, p = parse(u)
        r, v = rule(h, p)
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, r), u
        if v:
            (good if v == "allow" else bad).append(u)
            assert got[i].verdict == v and got[i].score is None
    a, b = Plain(good), Plain(bad)
    for i, u in rows[::7] + odd:
        if got[i].rule is None:
            assert abs(got[i].score - ratio(a, b, u or "")) < 1e-4
            assert got[i].verdict == ("allow" if got[i].score >= got[i].threshold else "block")


def test_learns_and_takes_empty_tables(spark):
    rows = [(i, f"http://good{i % 9}.example.net/en/{i}") for i in range(200)] + [(1000 + i, f"http://casino{i % 9}.net/win/{i}") for i in range(200)]
    rows += [(5000, "http://casino5.info/win/77"), (5001, "http://good3.example.info/en/5")]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[5000], got[5001]) == ("block", "allow")
    assert U.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = U.judge(spark.createDataFrame([(1, "http://a.info/"), (1, "http://a.info/"), (None, None)], SCHEMA)).collect()
    assert [r.verdict for r in alone] == ["allow"] * 3


def test_query_reads_whole_urls(spark, tmp_path):
    from vialflow.llm.queries import op9_markov_urls
    rows = [(i, f"https://s{i % 9}.example.net/en/p?view=article#top{i % 7}") for i in range(200)]
    rows += [(1000 + i, f"http://s{i % 9}.net/en/p?win=jackpot#casino{i % 7}") for i in range(200)]
    odd = [(5000, "https://s1.info/p?view=article#top"), (5001, "https://s1.info/p?win=jackpot#casino"), (5002, "view article top"),
           (5003, "win jackpot casino"), (5004, None), (5005, "")]
    spark.createDataFrame(rows + odd, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in op9_markov_urls(spark, str(tmp_path)).collect()}
    a, b = Plain([u for i, u in rows if i < 1000]), Plain([u for i, u in rows if i >= 1000])
    for i, u in odd:
        assert abs(got[i].score - ratio(a, b, u or "")) < 1e-4
        assert got[i].rule is None and got[i].verdict == ("allow" if got[i].score >= got[i].threshold else "block")
    assert (got[5000].host, got[5000].path) == (got[5001].host, got[5001].path) == ("s1.info", "/p")
    assert (got[5000].verdict, got[5001].verdict) == ("allow", "block")
    assert got[5002].score > got[5003].score and (got[5002].host, got[5002].path) == ("", "")
    assert got[5004].score == got[5005].score == 0


def test_contexts_grow_with_the_evidence(spark, monkeypatch):
    monkeypatch.setattr(U, "BLOCK_BYTES", 200)
    rows = [(i, f"http://s{i % 9}.example.net/en/x?id=1{i % 13}") for i in range(300)] + [(1000 + i, f"http://s{i % 9}.net/en/x?id=9{i % 13}") for i in range(300)]
    # the same bytes in another order: only contexts beyond three bytes part them
    rows += [(2000 + i, f"http://s{i % 9}.example.net/en/abcdeX") for i in range(60)] + [(3000 + i, f"http://s{i % 9}.net/en/ubcdeX") for i in range(60)]
    rows += [(4000 + i, f"http://s{i % 9}.example.net/en/ubcdeY") for i in range(60)] + [(5000 + i, f"http://s{i % 9}.net/en/abcdeY") for i in range(60)]
    odd = [(9000, "http://s1.info/x?id=1"), (9001, "http://s1.info/x?id=9"), (9002, "q abcdeX"), (9003, "q abcdeY"), (9004, "é" * 70000)]
    got = {r.page_id: r.score for r in U.judge(spark.createDataFrame(rows + odd, SCHEMA).repartition(4)).collect()}
    a, b = Plain([u for i, u in rows if ".example.net/" in u]), Plain([u for i, u in rows if ".example.net/" not in u])
    for i, u in odd:
        assert abs(got[i] - ratio(a, b, u)) < 1e-4
    assert got[9000] > got[9001] and got[9002] > got[9003]

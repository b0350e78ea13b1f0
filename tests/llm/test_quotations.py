"""Quotation linking against a plain Python version."""

import random

from pyspark.sql import functions as F

from vialflow.llm import quotations as Q

SCHEMA = "conv_id long, turn long, role string, text string"


def sizes(p):
    """Hash -> size of a paragraph, its lines and its sentences."""
    one = " ".join(p.split())
    cut = [i for i, x in enumerate(one) if x == " " and one[i - 1] in ".!?"]
    parts = [p, *p.split("\n"), *[one[i:j] for i, j in zip([0, *cut], [*cut, len(one)])]]
    return {Q.digest(x): sum(not y.isspace() for y in x) for x in parts if x.strip()}


def plain(rows):
    own, quotes, turns = {}, {}, {}
    for c, t, _, text in rows:
        if c is None or t is None:
            continue
        turns.setdefault(c, set()).add(t)
        for level, p in Q.paragraphs(text or ""):
            if level:
                q = quotes.setdefault((c, t), {}).setdefault(Q.digest(p), [level, {}])
                q[0] = min(q[0], level)
                for h, n in sizes(p).items():
                    q[1][h] = max(n, q[1].get(h, 0))
            else:
                for h in sizes(p):
                    own.setdefault(h, set()).add((c, t))
    out = {}
    for c, ts in turns.items():
        for t in ts:
            links = []
            for level, parts in quotes.get((c, t), {}).values():
                found = []
                for h, n in parts.items():
                    here = [u for k, u in own.get(h, ()) if k == c and u < t]
                    there = [x for x in own.get(h, ()) if x[0] != c]
                    if here:
                        found.append((-n, False, -max(here), c, max(here)))
                    elif there:
                        k, u = min(there)
                        found.append((-n, True, -u, k, u))
                if found:
                    _, outside, back, k, u = min(found)
                    links.append((outside, level, back, k, u))
            b = min(links) if links else None
            before = max((u for u in ts if u < t), default=None)
            parent = b[4] if b and not b[0] else before
            out[c, t] = [len(quotes.get((c, t), {})), len(links), parent, b and b[3], b and b[4]]
    for (c, t), v in out.items():
        d, u = 0, t
        while out[c, u][2] is not None:
            d, u = d + 1, out[c, u][2]
        v += [u, d]
    return {k: tuple(v[:7]) for k, v in out.items()}


def linked(spark, rows, **kw):
    return Q.link(spark.createDataFrame(rows, SCHEMA))


def test_levels_and_attribution():
    text = "Hi\n\nOn Monday A wrote:\n> first line\n> goes on\n>> deeper\n>\n> last\nmine > not a quote"
    assert Q.paragraphs(text) == [(0, "Hi"), (1, "first line\ngoes on"), (2, "deeper"), (1, "last"), (0, "mine > not a quote")]
    assert Q.digest("A  b\nC") == Q.digest("a b c")


def test_like_plain_python(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 4)
    random.seed(5)
    said, rows = ["the common line"], []
    for c in range(12):
        for t in range(random.choice([1, 3, 30])):
            parts = []
            for _ in range(random.randrange(4)):
                if random.random() < 0.5:
                    of = random.choice(said).split("\n")
                    of = random.choice([of, of[:1], of[-1:], " ".join(of).split(". ")[:1]])      # whole, a line, a sentence
                    parts.append("\n".join(">" * random.choice([1, 1, 2]) + " " + x for x in of))
                else:
                    p = random.choice([f"words {random.randrange(60)}", "the common line", "two\nlines %d" % random.randrange(9),
                                       "One of %d. Two of\n%d. Three" % (random.randrange(5), random.randrange(5))])
                    said.append(p)
                    parts.append(p)
            rows.append((c, t, "user", "\n\n".join(parts)))
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.parent_turn, r.quoted_conv, r.quoted_turn, r.root_turn, r.depth) for r in linked(spark, rows).collect()}
    assert got == plain(rows)
    assert all(">" not in r.clean_text for r in linked(spark, rows).collect())
    seen = set()
    for r in Q.conversations(linked(spark, rows)).coalesce(1).sortWithinPartitions("conv_id", "depth", "turn").collect():
        assert r.parent_turn is None or (r.conv_id, r.parent_turn) in seen
        seen.add((r.conv_id, r.turn))


def test_odd_rows(spark):
    rows = [(None, 1, "u", "> x"), (1, None, "u", "y"), (2, 0, None, None), (2, 1, "u", ""), (2, 1, "u", ""), (2, 2, "u", "> " + "z " * 40000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("hash", F.lit(1)).withColumn("before", F.lit(2))
    got = Q.link(df).collect()
    assert len(got) == 6
    assert [r.depth for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.turn)] == [0, 1, 1, 2]
    assert Q.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_links_parts_of_paragraphs_and_other_conversations(spark, tmp_path):
    from vialflow.llm.queries import op2_quotation_links
    rows = [(1, 0, "u", "First line here\nSecond line here\nThird one"), (1, 1, "u", "other"), (1, 2, "u", "> Second line here\n\nI agree"),
            (1, 3, "u", "> First line here\nyes\n> Third one\n\n> never said"),
            (2, 0, "u", "Alpha beta gamma. Delta epsilon\nzeta eta. Theta iota."), (2, 1, "u", "x"), (2, 2, "u", "> Delta\n> epsilon zeta eta.\nno"),
            (3, 0, "u", "> Said by many"), (3, 1, "u", "Said by many"), (4, 5, "u", "so\nSaid by many"), (5, 1, "u", "Said by many"),
            (6, 0, "u", "Thanks.\nThe long passage of this text."), (6, 1, "u", "Thanks."), (6, 2, "u", "> Thanks.\n> The long passage of this text.\n> changed"),
            (None, 1, "u", "> a\n> b")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.parent_turn, r.quoted_conv, r.quoted_turn) for r in op2_quotation_links(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert got[1, 2] == (1, 1, 0, 1, 0)
    assert got[1, 3] == (3, 2, 0, 1, 0)
    assert got[2, 2] == (1, 1, 0, 2, 0)
    assert got[3, 0] == (1, 1, None, 4, 5)
    assert got[6, 2] == (1, 1, 0, 6, 0)      # the longest passage decides
    assert got[None, 1] == (1, 0, None, None, None)

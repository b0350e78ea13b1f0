"""Main text by minimum cut: the cut against all labellings, the reader and whole pages."""

import html as htmllib
import itertools
import random
import re

import numpy as np
import pytest

from vialflow.llm import main_text as M
from vialflow.llm.page_blocks import read

A = "The river crossed the old valley before noon, and people who lived there kept their boats ready."
B = "Nobody expected the second flood, which came two weeks later and took the bridge."
BODY = [A, B, f"{A} {A}", f"{B} {A}", B]
LINKS = "<ul>" + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "News", "Sport", "About us", "Contact")) + "</ul>"


def paras(texts, tag="p"):
    return "".join(f"<{tag}>{t}</{tag}>" for t in texts)


# ------------------------------------------------------------------ the cut
def cost(labels, odds, links):
    c = sum(max(0, o) if not x else max(0, -o) for x, o in zip(labels, odds))
    return c + sum(w for a, b, w in links if labels[a] != labels[b])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_a_least_labelling(seed):
    r = random.Random(seed)
    n = r.randint(1, 9)
    odds = [r.randint(-6, 6) for _ in range(n)]
    links = [(i, i + 1, r.randint(1, 6)) for i in range(n - 1)]
    links += [(*sorted(r.sample(range(n), 2)), r.randint(1, 6)) for _ in range(r.randint(0, 6)) if n > 1]
    least = min(cost(x, odds, links) for x in itertools.product([False, True], repeat=n))
    assert cost(M.cut(odds, links), odds, links) == least
    assert cost(M.flow_labels(odds, links), odds, links) == least


def test_cut_of_a_long_doubtful_chain():
    r = random.Random(3)
    n = 20000
    odds = [r.choice([-2, -1, 1, 2]) for _ in range(n)]
    links = [(i, i + 1, 2) for i in range(n - 1)]
    # least cost along a chain by dynamic programming
    best = [max(0, odds[0]), max(0, -odds[0])]
    for o in odds[1:]:
        best = [max(0, o) + min(best[0], best[1] + 2), max(0, -o) + min(best[1], best[0] + 2)]
    assert cost(M.cut(odds, links), odds, links) == min(best)


# ------------------------------------------------------------------ the reader
@pytest.mark.parametrize("page, blocks", [
    ("<p>a<b>b</b> c<br>d<p>e", ["ab c d", "e"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
    ("a &lt;b&gt; &eacute;&#233; c&nbsp;&amp d", ["a <b> éé c & d"]),
    ("a < b and 3<4 c", ["a < b and 3<4 c"]),
    ("<p title=\"x > y\" data-q='a\"b'>one</p><p class=it's>two</p>", ["one", "two"]),
    ("<script>var t=\"</p>\";</script>a<!-- <p>no</p> -->b<style>p{}</style>", ["ab"]),
    ("<title>t</title><svg><text>no</text></svg>x<select><option>no</select>", ["x"]),
    ("<table><tr><td>x<td>y</table>z", ["x", "y", "z"]),
    ("</p></div>x</b>", ["x"]), ("", []), ("<", ["<"]), ("x<arti", ["x"]),
])
def test_blocks(page, blocks):
    assert [b.text for b in read(page).blocks] == blocks


def test_long_broken_pages_are_read_in_one_pass():
    read('<a href="' * 50000)
    read("<b>" * 50000 + "x" + "</i>" * 50000)
    assert len(read("<p>x" * 50000).blocks) == 50000


# ------------------------------------------------------------------ pages
PAGES = {
    "no marks": (f"<body><div>{LINKS}</div><div><h1>The flood of the year</h1>{paras(BODY)}</div><div><a href=x>Terms</a> | <a href=y>Privacy</a> © 2024 Acme</div>",
                 ["The flood of the year", *BODY]),
    "only div": (f'<div id="top">{LINKS}</div><div><div>{paras(BODY, "div")}</div></div><div class="sidebar"><h3>Latest</h3><p>{A}</p></div>'
                 '<div id="footer">© 2024 Acme. All rights reserved.</div>', BODY),
    "main": (f"<header><h1>Site name</h1>{LINKS}</header><main><h1>Title here</h1>{paras(BODY)}<aside><p>{A}</p></aside><p>Short end.</p></main><footer><p>{A}</p></footer>",
             ["Title here", *BODY, "Short end."]),
    "comments inside": (f'<article><h1>T</h1>{paras(BODY)}<section id="comments"><h2>3 comments</h2><div class="comment"><p>{A}</p></div><article><p>{B}</p></article></section></article>',
                        ["T", *BODY]),
    "comments after": (f'<article><header><h1>T</h1></header>{paras(BODY)}</article><div class="comments-area"><ol class="comment-list"><li><article><p>{A}</p></article></li></ol>'
                       "<form><textarea>x</textarea><label>Name</label></form></div>", ["T", *BODY]),
    "notice and form": (f'<div class="cookie-notice"><p>We use cookies. {A}</p></div><div class="content"><h2>T</h2>{paras(BODY)}<div class="newsletter"><form><p>Sign up, it is free.</p></form></div><p>{A}</p></div>',
                        ["T", *BODY, A]),
    "page in a form": (f'<form id="f"><div class="nav">{LINKS}</div><div class="post-body"><h1>T</h1>{paras(BODY)}</div></form>', ["T", *BODY]),
    "advert inside": (f'<div class="story"><p>{A}</p><div class="ad-slot">Buy now and save, it is cheap.</div><p>{B}</p><p>No.</p></div>', [A, B, "No."]),
    "teasers": (f"<article><h1>T</h1>{paras(BODY)}</article><div><article><h2><a href=x>Other</a></h2><p>Read this now.</p></article></div>", ["T", *BODY]),
    "title outside": (f'<main><h1>Title</h1><article>{paras(BODY)}</article><section class="related"><h2>More</h2>{LINKS}</section></main>', ["Title", *BODY]),
    "hidden": (f'<article><p>{A}</p><p hidden>x</p><p style="display:none">y</p><p>tail</p></article>', [A, "tail"]),
    "cut off": (f"<article><h1>T<p>{A}<p><b>{B}<footer>f", ["T", A, B]),
    "short": (f"<nav>{LINKS}</nav><article><p>Be.</p></article><footer>&copy; x</footer>", ["Be."]),
    "parts": (f"<article><p>{A}</p><ul><li>First thing</li><li>Second thing</li></ul><blockquote>{B}</blockquote><pre>a  b</pre></article>",
              [A, "First thing", "Second thing", B, "a b"]),
    "bare": ("<p>Hello world</p>", ["Hello world"]), "text": (A, [A]),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, want = PAGES[name]
    assert M.main_text(page) == "\n\n".join(want)


def plain(page):
    """The article of the given tables' pages, from their one template."""
    inner = re.split(r"</article>|<footer", page[page.index("<article>") + 9:])[0]
    parts = [" ".join(htmllib.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"<(?:/?p|/?h1)>", inner)]
    return "\n\n".join(x for x in parts if x)


def test_query_on_the_given_table(spark):
    from conftest import SF001
    from vialflow.llm.queries import QUERIES
    got = {r.page_id: r for r in QUERIES["op13_cut_extraction"](spark, SF001).collect()}
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, plain(p.html), len(plain(p.html)))


def test_fitted_weights_keep_the_pages(spark):
    from conftest import SF001
    w = M.fit(spark.read.parquet(f"{SF001}/pages.parquet"))
    assert not np.array_equal(w, M.UNFITTED)
    for page, want in (v for k, v in PAGES.items() if k not in ("bare",)):
        assert M.main_text(page, w) == "\n\n".join(want)


def test_rows_of_every_kind(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", f"<article><p>{A}</p></article>", None), (4, "u", "<p>  </p>", "x")]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string")
    got = sorted(M.extract(df).collect(), key=str)
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got), key=str) == sorted(
        [(1, "u", "", 0), (1, "u", "", 0), (2, None, "", 0), (None, "u", A, len(A)), (4, "u", "", 0)], key=str)
    assert M.extract(df.limit(0)).count() == 0

"""Main text of HTML pages: blocks labelled by a minimum cut.

Method: each block of text (``page_blocks``) is a node. Its cost of being called boilerplate is
its capacity from the source, its cost of being called content its capacity to the sink: the
log-odds of a classifier, split by sign. Blocks next to each other, and the next block in the
same element, are joined by edges that weigh more the nearer they stand in the tree. The
maximum flow's cut is the labelling of least cost; where two cost the same, content wins.

The classifier adds what the surroundings say (fixed log-odds: inside the page's article or
outside it, inside a menu, a form, comments) and what the text says: log-odds of a linear
discriminant over lengths, links and punctuation, fitted here to blocks whose surroundings
leave no doubt, and a little for the kind of element (not fitted: which elements a corpus uses
says nothing about another page's). The fit takes the pages of the FIT_PAGES smallest hashes; only
sums over their blocks, whole numbers, reach the driver.

Scale: pages are labelled by the tasks that read them, one at a time; nothing is shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .page_blocks import Page, read

FIT_PAGES = 4000
UNIT = 1000         # capacities are whole numbers of thousandths
IN_ARTICLE, BESIDE, OUTSIDE, AWAY = 3.5, -1.0, -3.0, -6.0    # log-odds of the surroundings
TITLE = 2.5         # a first heading beside the article
PLAIN = 1.5         # a page whose elements say nothing at all
RIGHTS = -2.0       # a short line with a copyright sign outside the article
MOST = 2.5          # the fitted log-odds stay within +- this
KIND = {"p": 0.8, "blockquote": 0.8, "pre": 0.8, "h1": 0.8, "h2": 0.5, "h3": 0.5, "li": -0.4, "td": -0.4, "th": -0.4, "dt": -0.4}
SPREAD = 30.0       # a feature's standard deviation within a class counts as so many hundredths more
NEXT, SAME_PARENT, REACH = 1.2, 0.8, 3.0    # edges: next block, next in the element, decay by distance
WHOLE = 0.7         # a form or banner with so much of the text is the page's frame, not a part
N_FEATURES = 7
# general text log-odds, alone where a corpus has no sure blocks: constant, then one for each feature
UNFITTED = np.array([-2.4, 0.8, -3.0, 1.0, 0.5, -0.5, -0.8, -1.0])


# ------------------------------------------------------------------ classifier
def features(page: Page) -> np.ndarray:
    """Whole numbers (hundredths), so sums over blocks are the same in any order."""
    out = np.zeros((len(page.blocks), N_FEATURES), np.int64)
    for i, b in enumerate(page.blocks):
        t, n = b.text, len(b.text)
        out[i] = (100 * np.log1p(min(b.words, 200)),
                  100 * b.linked // n,
                  100 * (t[-1] in ".!?:;…。！？\"'”»)"),
                  min(100, 1000 * sum(map(t.count, ",;，、")) // b.words),
                  100 * sum(map(str.isdigit, t[:400])) // min(n, 400),
                  min(100, 100 * sum(map(t.count, "|©·»›•")) // b.words),
                  100 * (b.linked * 10 >= n * 9 and b.words < 12))
    return out


def surroundings(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds from the surroundings, 1 / 0 / -1: surely content, surely not, unsure)."""
    n, m = len(page.blocks), len(page.parent)
    odds, sure = np.zeros(n), np.full(n, -1)
    mass = [0] * m
    total = 0
    for b in page.blocks:
        w = max(0, len(b.text) - b.linked)
        total += w
        if b.element >= 0:
            mass[b.element] += w
    for e in range(m - 1, -1, -1):
        if page.parent[e] >= 0:
            mass[page.parent[e]] += mass[e]
    state, home = [""] * m, [-1] * m        # state of each element, innermost article-like element
    for e in range(m):
        up = page.parent[e]
        s, own = state[up] if up >= 0 else "", page.hint[e]
        h = home[up] if up >= 0 else -1
        if own == "h":      # a header inside the article belongs to it
            own = "" if s == "+" and h >= 0 else "-"
        if own == "-" and mass[e] > WHOLE * total and page.tag[e] not in ("nav", "footer", "aside"):
            own = ""
        if s == "c":
            own = ""
        if own in ("-", "c"):
            s, h = own, -1
        elif own:
            s, h = "+", e
        state[e], home[e] = s, h
    # the article: of the strongest kind of element there is, the one with most text
    best = -1
    for kind in "321":
        some = [e for e in range(m) if page.hint[e] == kind and state[e] == "+" and mass[e] > (0 if kind != "1" else 0.3 * total)]
        if some:
            best = max(some, key=lambda e: (mass[e], -e))
            break
    inside, beside = set(), set()
    if best >= 0:
        up = page.parent[best]
        around = set()
        while up >= 0:
            if page.hint[up] in ("1", "2", "3"):
                around.add(up)
            up = page.parent[up]
        for e in range(m):
            up = page.parent[e]
            if e == best or up in inside:
                inside.add(e)
            elif e in around or up in beside:
                beside.add(e)
    for i, b in enumerate(page.blocks):
        e = b.element
        s = state[e] if e >= 0 else ""
        if s in ("-", "c"):
            odds[i], sure[i] = AWAY, 0
        elif best >= 0:
            if e in inside:
                odds[i], sure[i] = IN_ARTICLE, 1
            else:
                odds[i] = BESIDE if e in beside else OUTSIDE
                odds[i] += TITLE if e >= 0 and page.tag[e] == "h1" else 0
        if sure[i] != 1 and b.words < 30 and "©" in b.text:
            odds[i] += RIGHTS
    if best < 0 and not (sure == 0).any():
        odds += PLAIN
    return odds, sure


def weights(sums: np.ndarray) -> np.ndarray:
    """Linear discriminant from (class, 1 + features, 1 + features) sums of products, half way
    from the general weights: a corpus of one template knows little about another's pages."""
    n = sums[:, 0, 0]
    if min(n) < 20:
        return UNFITTED
    mean = sums[:, 0, 1:] / n[:, None]
    within = sum(sums[c, 1:, 1:] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)) / 2
    w = np.linalg.solve(within + SPREAD ** 2 * np.eye(N_FEATURES), mean[1] - mean[0])
    return (np.concatenate([[-(mean[0] + mean[1]) @ w / 2], w * 100]) + UNFITTED) / 2


def _sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 + N_FEATURES
    for b in it:
        got = np.zeros((2, size, size), np.int64)
        for html in b.column("html").to_pylist():
            page = read(html)
            if page.blocks:
                x = np.concatenate([np.ones((len(page.blocks), 1), np.int64), features(page)], axis=1)
                _, sure = surroundings(page)
                for c in (0, 1):
                    got[c] += x[sure == c].T @ x[sure == c]
        yield pa.RecordBatch.from_arrays([pa.array(range(got.size), pa.int32()), pa.array(got.ravel())], ["i", "v"])


def fit(pages: DataFrame) -> np.ndarray:
    """Weights of the text's log-odds, from the pages of the FIT_PAGES smallest hashes."""
    key = F.xxhash64("html")
    last = pages.filter("html is not null").select(key.alias("k")).orderBy("k").limit(FIT_PAGES).agg(F.max("k")).first()[0]
    if last is None:
        return UNFITTED
    got = pages.filter(key <= last).dropDuplicates(["html"]).select("html").mapInArrow(_sums, "i int, v long").groupBy("i").agg(F.sum("v")).collect()
    sums = np.zeros(2 * (1 + N_FEATURES) ** 2)
    for i, v in got:
        sums[i] = v
    return weights(sums.reshape(2, 1 + N_FEATURES, 1 + N_FEATURES))


# ------------------------------------------------------------------ minimum cut
def edges(page: Page) -> list[tuple[int, int, int]]:
    """(block, block, capacity): next blocks, and the next block of the same parent element."""
    out, last = [], {}
    for i, b in enumerate(page.blocks):
        if i:
            out.append((i - 1, i, round(UNIT * NEXT * np.exp(-max(0, distance(page, page.blocks[i - 1].element, b.element) - 2) / REACH))))
        parent = page.parent[b.element] if b.element >= 0 else -1
        if parent in last and last[parent] < i - 1:
            out.append((last[parent], i, round(UNIT * SAME_PARENT)))
        last[parent] = i
    return [e for e in out if e[2] > 0]


def distance(page: Page, a: int, b: int) -> int:
    """Steps between two elements through the tree."""
    n = 0
    depth = page.depth
    while a != b:
        da, db = depth[a] if a >= 0 else -1, depth[b] if b >= 0 else -1
        if da >= db:
            a = page.parent[a]
        else:
            b = page.parent[b]
        n += 1
    return n


def cut(odds: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling (True: content) of least cost: -odds of a positive node labelled False, odds
    of a negative one labelled True, and each edge between unlike labels. A node that outweighs
    all its edges keeps its sign in any least labelling, so it is settled first and its edges
    become its neighbours' odds; what is left goes through the maximum flow."""
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in links:
        near[a][b] = near[a].get(b, 0) + c
        near[b][a] = near[b].get(a, 0) + c
    pull = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or not (odds[i] >= pull[i] or -odds[i] > pull[i]):
            continue
        label[i] = odds[i] >= pull[i]
        for j, c in near[i].items():
            if label[j] is None:
                odds[j] += c if label[i] else -c
                pull[j] -= c
                todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {x: k for k, x in enumerate(rest)}
        inner = [(place[i], place[j], c) for i in rest for j, c in near[i].items() if i < j and label[j] is None]
        for i, x in zip(rest, flow_labels([odds[i] for i in rest], inner)):
            label[i] = x
    return label


def flow_labels(odds: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Labels by a maximum flow in layers: a node is content unless it can still reach the sink."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a, b, c, back):
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            arc(source, i, x, 0)
        elif x < 0:
            arc(i, sink, -x, 0)
    for a, b, c in links:
        arc(a, b, c, c)
    while True:
        layer = [-1] * (n + 2)
        layer[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] and layer[to[e]] < 0:
                    layer[to[e]] = layer[u] + 1
                    queue.append(to[e])
        if layer[sink] < 0:
            break
        tried = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(cap[e] for e in path)
                full = None
                for k, e in enumerate(path):
                    cap[e] -= least
                    cap[e ^ 1] += least
                    if full is None and not cap[e]:
                        full = k
                u = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[u] < len(out[u]):
                e = out[u][tried[u]]
                if cap[e] and layer[to[e]] == layer[u] + 1:
                    break
                tried[u] += 1
            if tried[u] < len(out[u]):
                path.append(out[u][tried[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                tried[u] += 1
            else:
                break
    reach = [False] * (n + 2)
    reach[sink] = True
    queue = deque([sink])
    while queue:
        u = queue.popleft()
        for e in out[u]:
            if cap[e ^ 1] and not reach[to[e]]:
                reach[to[e]] = True
                queue.append(to[e])
    return [not reach[i] for i in range(n)]


# ------------------------------------------------------------------ pages
def labelled(page: Page, w: np.ndarray) -> list[bool]:
    """Whether each block of a page is content."""
    if not page.blocks:
        return []
    odds, _ = surroundings(page)
    text = np.clip(w[0] + features(page) @ w[1:] / 100, -MOST, MOST)
    kind = np.array([KIND.get(page.tag[b.element], 0.0) if b.element >= 0 else 0.0 for b in page.blocks])
    return cut(np.round(UNIT * (odds + text + kind)).astype(int).tolist(), edges(page))


def main_text(html: str | None, w: np.ndarray = UNFITTED) -> str:
    page = read(html)
    return "\n\n".join(b.text for b, keep in zip(page.blocks, labelled(page, w)) if keep)


def _extract(w: np.ndarray):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [main_text(x, w) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page: its main text, blocks in page
    order joined by an empty line, white space inside a block as one space.

    Cases: null and empty pages, and pages without text, give an empty text; page_id and url
    are passed on, nulls too; repeated rows give repeated results; pages of any length are read
    whole; broken markup is read as far as it goes; an empty table gives no rows; other columns
    are not read.
    """
    some = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in some.schema}
    return some.mapInArrow(_extract(fit(some.select("html"))), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")

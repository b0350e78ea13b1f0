"""Blocks of text of an HTML page, with what their surroundings say about them.

A reader of tags with the implied ends that matter for text (p, li, table parts, links);
block-level elements part blocks, inline ones do not, a line break is white space. Scripts,
styles, titles, controls and drawings have no text. Reading is one pass over the page.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from typing import NamedTuple

# ------------------------------------------------------------------ fixed values
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table
 tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
MUTE_TAGS = frozenset("svg math select button template object canvas video audio datalist map".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                  "th": ("tr", "table"), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
# tags, and words of class, id and role, of what is not the article
AWAY_TAGS = frozenset("nav footer aside form menu dialog search".split())
AWAY_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense aside banner breadcrumb breadcrumbs complementary
 consent contentinfo cookie cookies copyright dialog disclaimer footer form gdpr header hidden legal login masthead menu modal nav
 navbar navigation newsletter notice notification overlay pager pagination popular popup privacy promo promoted promotion
 recommended recommendations related search share sharing sidebar signin signup skip social sponsor sponsored subscribe
 subscription teaser teasers toolbar topbar trending widget widgets alert outbrain taboola""".split())
TALK_WORDS = frozenset("comment comments commentary commentlist disqus discussion replies reply respond responses".split())
HOME_WORDS = frozenset("article articlebody body content entry main page post story text".split())
NOT_WORDS = frozenset("no non not has with without".split())

_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<attrs>(?:[^>\"']|\"[^\"]{0,4096}\"|'[^']{0,4096}')*+)>|(?P<loose>[^>]*)(?:>|\Z))"
    r"|[!?/][^>]*(?:>|\Z))", re.S)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    text: str
    words: int
    linked: int         # characters inside links
    element: int        # the block-level element it stands in


class Page(NamedTuple):
    blocks: list[Block]
    parent: list[int]   # of each element; -1 for the page
    depth: list[int]
    tag: list[str]
    hint: list[str]     # own hint: "-" away, "c" reader comments, "1".."3" article, "" none


@lru_cache(maxsize=1 << 14)
def hint(tag: str, attrs: str) -> str:
    if tag in ("html", "body", "head"):
        return ""
    said: list[str] = []
    hidden = False
    home = "3" if tag == "article" else "2" if tag == "main" else ""
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
        elif name == "itemprop":
            home = "3" if value.lower() == "articlebody" else home
        elif name != "style":
            for one in value.split():
                words = [w.lower() for w in _WORD.findall(one)]
                if not NOT_WORDS & set(words):
                    said += words
                if name == "role":
                    home = "3" if one.lower() == "article" else "2" if one.lower() == "main" else home
    words = set(said)
    if words & TALK_WORDS:
        return "c"
    if hidden or tag in AWAY_TAGS or words & (AWAY_WORDS - {"header"}):
        return "-"
    if tag == "header" or "header" in words:
        return "h"
    return home or ("1" if words & HOME_WORDS else "")


def read(html: str | None) -> Page:
    page = Page([], [], [], [], [])
    if not html:
        return page
    stack: list[tuple[str, int]] = []       # open elements; -1 for inline ones
    count: dict[str, int] = {}
    parts: list[str] = []
    linked, mute = 0, 0
    owner = -1

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.blocks.append(Block(text, text.count(" ") + 1, min(linked, len(text)), owner))
            parts.clear()
        linked = 0

    def pop():
        nonlocal owner, mute
        name, e = stack.pop()
        count[name] -= 1
        if e >= 0:
            flush()
            owner = page.parent[e]
        mute -= name in MUTE_TAGS

    def close(names, within=()):
        """End the nearest of ``names``, unless one of ``within`` is nearer."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in within:
                return

    def say(text):
        nonlocal linked
        if mute or not text:
            return
        if "&" in text:
            text = unescape(text)
        if count.get("a"):
            linked += len(" ".join(text.split()))
        parts.append(text)

    at = 0
    while m := _TAG.search(html, at):
        if m.start() > at:
            say(html[at:m.start()])
        at = m.end()
        name = m.group("name")
        if not name:
            continue
        name = name.lower()
        if m.group("end"):
            if count.get(name):
                # an inline end does not reach out of its block
                close((name,), () if name in BLOCK_TAGS or name in MUTE_TAGS else BLOCK_TAGS)
            continue
        if name in RAW_TAGS:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
            continue
        if name in VOID_TAGS:
            if name == "hr":
                flush()
            elif name == "br":
                parts.append(" ")
            continue
        if name in BLOCK_TAGS:
            if count.get("p"):
                close(("p",), ("td", "th", "caption", "button"))
            if name in CLOSED_BY_SAME and any(count.get(s) for s in SAME.get(name, (name,))):
                close(SAME.get(name, (name,)), CLOSED_BY_SAME[name])
            flush()
            e = len(page.parent)
            page.parent.append(owner)
            page.depth.append(page.depth[owner] + 1 if owner >= 0 else 0)
            page.tag.append(name)
            page.hint.append(hint(name, m.group("attrs") or m.group("loose") or ""))
            stack.append((name, e))
            owner = e
        else:
            if name == "a" and count.get("a"):
                close(("a",), BLOCK_TAGS)
            stack.append((name, -1))
            mute += name in MUTE_TAGS
        count[name] = count.get(name, 0) + 1
    say(html[at:])
    flush()
    return page

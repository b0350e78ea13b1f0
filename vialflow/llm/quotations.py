"""Quotation linking in conversations.

Each message is parsed into paragraphs with their quote level (the number of leading ``>``);
attribution lines in front of a quotation ("... wrote:") go with it. Normalised paragraphs,
their lines and their sentences are hashed, so a quotation of a part of a paragraph links, also
when it was wrapped anew. A passage of a quoted paragraph is found in the latest earlier message
of its conversation that has it as its own, or else in the first message of another
conversation; the paragraph links by its longest passage that is found. A message replies to the message that its shallowest linked quotation of the conversation is
from, or else to the turn before. Texts keep their own paragraphs only; depth and root of the
reply tree give the reply order: (conv_id, root_turn, depth, turn) puts every message behind
the one it replies to.

"Latest earlier" works on blocks of BLOCK turns (the latest within the block, or else the
latest of the blocks before), so a conversation or a line that holds a third of all rows is
split; original paragraphs are aggregated before they are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored

BLOCK = 1024
_QUOTE = re.compile(r"(?:[ \t]{0,3}>)+[ \t]?")
_SAID = re.compile(r"^\s*(?:on|am|le|el)\b.{0,200}\b(?:wrote|schrieb|écrit|escribió)\b.{0,80}:\s*$", re.I)

_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")


def paragraphs(text: str) -> list[tuple[int, str]]:
    """(level, text) of runs of non-blank lines of one quote level, in order."""
    out: list[tuple[int, list[str]]] = []
    open_ = False
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        m = _QUOTE.match(line)
        level = m.group().count(">") if m else 0
        body = line[m.end():] if m else line
        if not body.strip():
            open_ = False
        elif open_ and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
            open_ = True
    got = []
    for i, (level, lines) in enumerate(out):
        if i + 1 < len(out) and out[i + 1][0] > level and _SAID.match(lines[-1]):
            lines = lines[:-1]
        if lines:
            got.append((level, "\n".join(lines)))
    return got


def digest(text: str) -> int:
    """64-bit hash of a passage without regard to case, line breaks and spacing."""
    norm = " ".join(text.casefold().split())
    return int.from_bytes(hashlib.blake2b(norm.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def passages(paragraph: str) -> dict[int, int]:
    """Size by hash of a paragraph, of its lines and of its sentences; sentences
    do not depend on line breaks."""
    parts = [paragraph, *paragraph.split("\n"), *_SENTENCE.split(" ".join(paragraph.split()))]
    return {digest(x): len("".join(x.split())) for x in parts if x.strip()}


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own text and, for each passage of each quoted paragraph, the paragraph's hash and level
    and the passage's hash and size."""
    for b in it:
        clean, quoted, levels, parts, sizes = [], [], [], [], []
        for t in b.column("text").to_pylist():
            ps = paragraphs(t or "")
            clean.append(None if t is None else "\n\n".join(p for level, p in ps if not level))
            least: dict[tuple[int, int], tuple[int, int]] = {}
            for level, p in ps:
                if level:
                    h = digest(p)
                    for part, size in passages(p).items():
                        was = least.get((h, part), (level, size))
                        least[h, part] = min(level, was[0]), max(size, was[1])
            quoted.append([h for h, _ in least])
            parts.append([x for _, x in least])
            levels.append([x for x, _ in least.values()])
            sizes.append([x for _, x in least.values()])
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("conv", "turn", "role")), pa.array(clean, pa.string()), pa.array(quoted, longs), pa.array(levels, ints),
             pa.array(parts, longs), pa.array(sizes, ints)], ["conv", "turn", "role", "clean", "quoted", "levels", "parts", "sizes"])


def _own(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of a message's own passages."""
    for b in it:
        found, at = [], []
        for i, t in enumerate(b.column("text").to_pylist()):
            own = {h for level, p in paragraphs(t or "") if not level for h in passages(p)}
            found += own
            at += [i] * len(own)
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("conv").take(rows), b.column("turn").take(rows), pa.array(found, pa.int64())], ["conv", "turn", "hash"])


def latest_before(rows: DataFrame, keys: list[str], turn: str, is_source: str) -> DataFrame:
    """``rows`` with ``before``: the largest ``turn`` below the row's own among the rows with the
    same keys for which ``is_source`` holds. ``turn`` is a whole number."""
    rows = rows.withColumn("_block", F.floor(F.col(turn) / BLOCK))
    source = F.when(F.col(is_source), F.col(turn))
    per = rows.groupBy(*keys, "_block").agg(F.max(source).alias("_last"))
    so_far = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_block", F.max("_last").over(so_far).alias("_carry"))      # a row for each block
    within = Window.partitionBy(*keys, "_block").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_near", F.max(source).over(within))
    return rows.join(per, [*keys, "_block"]).withColumn("before", F.coalesce("_near", "_carry")).drop("_near", "_carry", "_block")


def link(messages: DataFrame) -> DataFrame:
    """Per row of ``messages`` (conv_id, turn, role, text): conv_id, turn, role, clean_text,
    n_quotes, n_linked, parent_turn, quoted_conv, quoted_turn, root_turn, depth. Quotes are
    quoted paragraphs.

    Cases: a null text stays null and quotes nothing; an empty one has no paragraphs; rows
    without conv_id or turn have no parent and no root; rows that repeat a conversation and
    turn are parts of one message and share its links; a message that quotes itself or a later
    one links elsewhere or not at all; an empty table gives no rows; other columns are not
    read.
    """
    m = messages.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parsed = stored(m.mapInArrow(_parse, "conv long, turn long, role string, clean string, quoted array<long>, levels array<int>, "
                                         "parts array<long>, sizes array<int>"), "parsed")
    placed = parsed.filter("conv is not null and turn is not null")
    quotes = placed.select("conv", "turn", F.explode(F.arrays_zip("quoted", "levels", "parts", "sizes")).alias("q"))
    quotes = quotes.groupBy("conv", "turn", F.col("q.quoted").alias("quote"), F.col("q.parts").alias("hash")).agg(
        F.min("q.levels").alias("level"), F.max("q.sizes").alias("size"))
    quotes = stored(quotes, "quotes")
    own = m.filter("conv is not null and turn is not null").select("conv", "turn", "text").mapInArrow(_own, "conv long, turn long, hash long")
    own = stored(own.join(quotes.select("hash").distinct(), "hash", "left_semi").distinct(), "own")
    both = quotes.select("conv", "hash", "turn", "quote", "level", "size", F.lit(False).alias("is_own")).unionByName(
        own.select("conv", "hash", "turn", F.lit(True).alias("is_own")), allowMissingColumns=True)
    found = latest_before(both, ["conv", "hash"], "turn", "is_own").filter("not is_own")
    first = own.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("first"))
    # and the first message of all conversations but the first's
    rest = own.join(first, "hash").filter("conv <> first.conv").groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("second"))
    found = found.join(first.join(rest, "hash", "left"), "hash", "left")
    elsewhere = F.when(F.col("before").isNull(), F.when(F.col("first.conv") != F.col("conv"), F.col("first")).otherwise(F.col("second")))
    here = F.when(F.col("before").isNotNull(), F.struct(F.col("conv"), F.col("before").alias("turn")))
    found = found.select("conv", "turn", "quote", "level", "size", F.coalesce(here, elsewhere).alias("to"), F.col("before").isNull().alias("outside"))
    longest = F.struct((-F.col("size")).alias("size"), "outside", (-F.col("to.turn")).alias("back"), F.col("to.conv").alias("c"), F.col("to.turn").alias("t"))
    per = found.groupBy("conv", "turn", "quote").agg(F.min("level").alias("level"), F.min(F.when(F.col("to").isNotNull(), longest)).alias("by"))
    best = per.groupBy("conv", "turn").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("by").alias("n_linked"),
        F.min(F.when(F.col("by").isNotNull(), F.struct("by.outside", "level", "by.back", "by.c", "by.t"))).alias("b"))
    nodes = placed.select("conv", "turn", F.lit(True).alias("any")).distinct()
    nodes = latest_before(nodes, ["conv"], "turn", "any").drop("any").join(best, ["conv", "turn"], "left")
    inside = ~F.coalesce(F.col("b.outside"), F.lit(True))
    nodes = nodes.select("conv", "turn", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                         F.when(inside, F.col("b.t")).otherwise(F.col("before")).alias("parent"),
                         F.col("b.c").alias("quoted_conv"), F.col("b.t").alias("quoted_turn"))
    nodes = stored(nodes, "links")
    tree = _depths(nodes.select("conv", "turn", "parent"))
    out = parsed.join(nodes, ["conv", "turn"], "left").join(tree, ["conv", "turn"], "left")
    return out.select(F.col("conv").alias("conv_id"), "turn", "role", F.col("clean").alias("clean_text"),
                      F.coalesce("n_quotes", F.size(F.array_distinct("quoted")).cast("long")).alias("n_quotes"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
                      F.col("parent").alias("parent_turn"), "quoted_conv", "quoted_turn", "root_turn", "depth")


def _depths(nodes: DataFrame) -> DataFrame:
    """(conv, turn, root_turn, depth) by pointer doubling: every round halves the way to the
    root, on unique keys."""
    now = stored(nodes.select("conv", "turn", F.coalesce("parent", "turn").alias("up"),
                              F.col("parent").isNotNull().cast("long").alias("depth")), "depths")
    while True:
        above = now.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        new = stored(now.join(above, ["conv", "up"]).select("conv", "turn", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                                                             (F.col("more") > 0).alias("moved")), "depths")
        moved = not new.filter("moved").isEmpty()
        drop_stored(now)
        now = new.drop("moved")
        if not moved:
            return now.select("conv", "turn", F.col("up").alias("root_turn"), "depth")


def conversations(linked: DataFrame) -> DataFrame:
    """The linked messages in reply order, ranges of conversations a partition: a message comes
    behind the one it replies to."""
    order = ["conv_id", "root_turn", "depth", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "clean_text", "parent_turn", "depth")

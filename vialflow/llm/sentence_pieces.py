"""SentencePiece BPE by a score-ordered agenda of adjacent symbol pairs, with decoding.

A text is cut where no piece of the vocabulary crosses: before a run of spaces (a piece holds
spaces only in front), around line feeds (in no piece) and between a Latin letter and a full
stop or comma. In a chunk every adjacent pair
whose concatenation is a piece waits in a heap, best score first, then leftmost; the best
is merged and its new neighbours join the heap. Symbols outside the vocabulary become their
UTF-8 bytes. Each worker keeps the chunks it has met (at most CACHE). For every Arrow batch
the new chunks are encoded and decoded by the sentencepiece library as well; where the agenda
differs, the library's result is used and counted.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices

MARK = "▁"              # stands for a space
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
CACHE = 400_000         # chunks met lately; as many older ones are kept beside them


class Agenda:
    """The merges of a merge-type (BPE) model with byte fallback, identity normalisation and a
    dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        special = [self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_byte(i) for i in range(n)]
        self.id = {self.lib.id_to_piece(i): i for i in range(n) if not special[i]}
        self.score = {p: self.lib.get_score(i) for p, i in self.id.items()}
        self.byte = [self.lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.of_byte = {i: b for b, i in enumerate(self.byte)}
        self.piece = {i: p for p, i in self.id.items()}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece holds a space behind another character")
        feed = "" if any("\n" in p for p in self.id) else r"\n"
        rest = rf" +[^ {feed}]*|[^ {feed}]+" + (r"|\n" if feed else "")
        if any(re.search(rf"[{LATIN}][.,]", p) for p in self.id):
            self.cut = re.compile(rest)
        else:
            self.cut = re.compile(rf" *[{LATIN}]+(?=[.,])|{rest}")
        self.seen: dict[str, tuple[int, str, str | None]] = {}
        self.old: dict[str, tuple[int, str, str | None]] = {}
        self.differences = 0

    def encode(self, chunk: str) -> list[int]:
        """Ids of one chunk (spaces as MARK)."""
        symbol: list[str | None] = list(chunk)
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        score, heap, push, pop = self.score.get, [], heapq.heappush, heapq.heappop
        for i in range(n - 1):
            s = symbol[i] + symbol[i + 1]
            if (v := score(s)) is not None:
                heap.append((-v, i, i + 1, s))
        heapq.heapify(heap)
        while heap:
            _, left, right, s = pop(heap)
            a, b = symbol[left], symbol[right]
            if a is None or b is None or after[left] != right or a + b != s:
                continue        # one of the two has been merged since
            symbol[left], symbol[right] = s, None
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                t = s + symbol[nxt]
                if (v := score(t)) is not None:
                    push(heap, (-v, left, nxt, t))
            prev = before[left]
            if prev >= 0:
                t = symbol[prev] + s
                if (v := score(t)) is not None:
                    push(heap, (-v, prev, left, t))
        out = []
        for s in symbol:
            if s is not None:
                i = self.id.get(s)
                out += [i] if i is not None else [self.byte[b] for b in s.encode("utf-8", "replace")]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids of one chunk (MARK as spaces)."""
        raw = b"".join(bytes([self.of_byte[i]]) if i in self.of_byte else self.piece[i].encode() for i in ids)
        return raw.decode("utf-8", "replace").replace(MARK, " ")

    def chunks(self, text: str) -> list[str]:
        """The text's chunks behind the dummy prefix; none for an empty text."""
        return self.cut.findall(" " + text.replace(MARK, " ")) if text else []

    def learn(self, chunks: set[str]) -> None:
        """Encode and decode new chunks, and check them against the library."""
        if len(self.seen) > CACHE:
            self.old, self.seen = self.seen, {}
        new = []
        for c in chunks:
            if c not in self.seen:
                got = self.old.get(c)
                if got is None:
                    new.append(c)
                else:
                    self.seen[c] = got
        # the library puts a space in front: a chunk's own, or one to take off again
        lead = [c.startswith(" ") for c in new]
        theirs = self.lib.encode([c[1:] if l else c for c, l in zip(new, lead)], num_threads=1)
        back = self.lib.decode(theirs, num_threads=1)
        for c, l, t, d in zip(new, lead, theirs, back):
            mine = self.encode(c.replace(" ", MARK))
            text = self.decode(mine)
            if l and c != " ":
                if mine != t or text != " " + d:
                    self.differences += 1
                    mine, text = t, " " + d
            self.seen[c] = (len(mine), ",".join(map(str, mine)), None if text == c else text)

    def of_text(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text) of a text whose chunks are learnt."""
        chunks = self.chunks(text)
        got = [self.seen[c] for c in chunks]
        return sum([g[0] for g in got]), ",".join([g[1] for g in got]), "".join([c if g[2] is None else g[2] for c, g in zip(chunks, got)])[1:]


_ready: dict[str, Agenda] = {}


def agenda(path: str) -> Agenda:
    """The worker's agenda of this model."""
    if path not in _ready:
        _ready[path] = Agenda(path)
    return _ready[path]


def _encoded(path: str, full: bool):
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = agenda(path)
        for b in it:
            for at, texts in slices(b.column("text")):
                was = a.differences
                a.learn({c for t in texts for c in a.chunks(t)})
                got = [a.of_text(t) for t in texts]
                ids = b.column("id").slice(at, len(texts))
                n = pa.array([g[0] for g in got], pa.int64())
                if full:
                    yield pa.RecordBatch.from_arrays(
                        [ids, n, pa.array([[int(x) for x in g[1].split(",")] if g[0] else [] for g in got], pa.list_(pa.int32())),
                         pa.array([g[2] for g in got], pa.string())], ["id", "n_tokens", "ids", "decoded"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [ids, n, pa.array([sha(g[1]) for g in got]), pa.array([sha(g[2]) for g in got]),
                         pa.array([a.differences - was] * len(got), pa.int64())],
                        ["id", "n_tokens", "ids_sha256", "decoded_sha256", "batch_differences"])
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens and the ids and decoded text; with ``digests``
    their SHA-256 instead, and the number of new chunks of the row's batch on which agenda and
    library differed.

    Cases: a null text counts as empty and has no ids; a text of any length is encoded whole;
    repeated rows and rows without doc_id give rows like others; an empty table gives none;
    other columns are not read.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "ids_sha256 string, decoded_sha256 string, batch_differences long" if digests else "ids array<int>, decoded string"
    return d.mapInArrow(_encoded(path, not digests), f"id long, n_tokens long, {schema}").withColumnRenamed("id", id_col)

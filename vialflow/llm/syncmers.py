"""Document fingerprints of closed syncmers (DataFrame operations only).

A text's symbols are its words (runs of other than ASCII white space). A word longer than PART
characters is cut where a hash of two neighbouring characters says so (every CUT characters on
average), so text without spaces has symbols too and an insertion moves no later cut. Of every
K symbols in a row the inner S-symbol substrings are hashed; the K-mer is an anchor when its
smallest inner hash stands first or last. That depends on the K-mer alone, so an edit changes
only the anchors that it touches. The fingerprint has every distinct anchor with the symbol
position where it first stands; likeness is the exact Jaccard similarity.

Characters as symbols were measured first: at about a microsecond a character in Spark's
higher-order functions the budget does not hold them, words need a sixth of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, partitions, sampled_splitters

K, S, PART, CUT = 5, 2, 12, 6


def _bound(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def symbols_sql(text: str) -> str:
    """SQL of the symbols array<string> of a text column."""
    ends = f"j + 1 < size(c) and pmod(xxhash64(y, get(c, j + 1)), {CUT}) = 0"
    cut = f"split(array_join(transform(c, (y, j) -> case when {ends} then concat(y, ' ') else y end), ''), ' ')"
    parts = _bound("regexp_extract_all(x, '(?s).', 0)", "c", cut)
    words = f"regexp_extract_all({text}, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    return f"flatten(transform({words}, x -> case when char_length(x) <= {PART} then array(x) else {parts} end))"


def anchors_sql(text: str) -> str:
    """SQL of the anchors array<struct<h, p>> of a text column, smallest hashes first, each
    hash once. A text of fewer than K symbols has its symbols as anchors."""
    w = K - S       # the last inner substring begins w symbols after the first
    inner = ", ".join(f"get(w, i + {j})" for j in range(S))
    kmer = ", ".join(f"get(w, i + {j})" for j in range(K))
    between = ", ".join(f"get(h, i + {j})" for j in range(1, w))
    hashes = f"transform(sequence(0, greatest(size(w) - {S}, 0)), i -> xxhash64({inner}))"
    chosen = f"filter(sequence(0, size(w) - {K}), i -> least(get(h, i), get(h, i + {w})) <= least({between}))"
    few = "transform(w, (x, i) -> named_struct('h', xxhash64(x), 'p', i))"
    many = f"transform({chosen}, i -> named_struct('h', xxhash64({kmer}), 'p', i))"
    found = _bound(hashes, "h", f"case when size(w) < {K} then {few} else {many} end")
    raw = _bound(symbols_sql(text), "w", found)
    once = "filter(a, (x, i) -> i = 0 or x.h <> get(a, i - 1).h)"
    return _bound(f"sort_array({raw})", "a", once)


def fingerprint(h: Column, p: Column) -> Column:
    """The anchors as text: hash:position in hexadecimal, smallest hash first."""
    return F.array_join(F.zip_with(h, p, lambda x, y: F.concat(F.lower(F.hex(x)), F.lit(":"), F.lower(F.hex(y)))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of both that both have; 1 for two without any. Each side has a hash
    once."""
    same = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(same / F.greatest(F.size(a) + F.size(b) - same, F.lit(1)))


def matches(h1: Column, p1: Column, h2: Column, p2: Column) -> Column:
    """Shared anchors with their positions in both texts: array<struct<h, p1, p2>>, smallest
    hashes first. Both sides are sorted together, so equal hashes stand side by side."""
    def side(h, p, n):
        return F.zip_with(h, p, lambda x, y: F.struct(x.alias("h"), F.lit(n).alias("side"), y.alias("p")))

    def pairs(s):
        after = F.transform(s, lambda x, i: F.when(F.get(s, i + 1)["h"] == x["h"], F.struct(
            x["h"].alias("h"), x["p"].alias("p1"), F.get(s, i + 1)["p"].alias("p2"))))
        return F.filter(after, lambda x: x.isNotNull())

    return F.element_at(F.transform(F.array(F.sort_array(F.concat(side(h1, p1, 1), side(h2, p2, 2)))), pairs), 1)


def with_anchors(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` with the anchors' hashes and positions of a text column as <prefix>_h, <prefix>_p."""
    found = df.withColumn(f"{prefix}_a", F.expr(anchors_sql(f"`{text}`")))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"{prefix}_a.h").alias(f"{prefix}_h"),
                        F.col(f"{prefix}_a.p").alias(f"{prefix}_p"))


def with_next(rows: DataFrame, key: str, carry: list[str], ranges: int | None = None) -> DataFrame:
    """``rows`` with the struct ``next`` of the columns ``carry`` of the row that follows in
    descending order of the string column ``key``; the first row follows the last.

    Sampled keys cut ranges. A cut is the largest key of its range, and its row also goes to
    the range above, whose last row it follows; the row with the largest key also goes to the
    lowest range. So one window over ranges does, and no range is a single task's table.
    """
    n = ranges or 2 * partitions(rows.sparkSession)
    top = rows.agg(F.max(key).alias("k"), F.count(F.lit(1)).alias("n")).first()
    cuts = sampled_splitters(rows.select(F.col(key).alias("k")), n, top["n"])
    k = F.col(key)
    here = F.struct(bucket_of(k, cuts, below=True).alias("range"), F.lit(0).alias("as"))
    above = F.struct((bucket_of(k, cuts, below=True) + 1).alias("range"), F.lit(1).alias("as"))
    wrap = F.struct(F.lit(0).alias("range"), F.lit(2).alias("as"))
    places = F.when(k == F.lit(top["k"]), F.array(here, above, wrap) if cuts and top["k"] in cuts else F.array(here, wrap))
    if cuts:
        places = places.when(k.isin(cuts) if len(cuts) <= 64 else F.array_contains(F.array(*map(F.lit, cuts)), k), F.array(here, above))
    places = places.otherwise(F.array(here))
    dealt = rows.withColumn("_place", F.explode(places))
    w = Window.partitionBy("_place.range").orderBy(F.greatest(F.col("_place.as"), F.lit(1)), F.col(key).desc())
    return dealt.withColumn("next", F.lead(F.struct(*carry)).over(w)).filter("_place.as = 0").drop("_place")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, for the text edited by the next document's beginning (see ``with_next``).

    Cases: a null text counts as empty: no anchors, an empty fingerprint, likeness 1 to another
    empty text and 0 to any other; rows without doc_id come last in the order, rows with one
    doc_id in the order of their texts' hashes; a single row follows itself; an empty table
    gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    order = F.coalesce(F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit(-2**63))), 16, "0"), F.lit(""))
    rows = rows.withColumn("key", F.concat(order, F.lit("/"), F.lpad(F.hex(F.xxhash64("text")), 16, "0")))
    # anchors can outgrow their text: only texts are shuffled
    both = with_next(rows, "key", ["text"], ranges).withColumn("next_text", F.col("next.text"))
    both = with_anchors(with_anchors(both, "text", "own"), "next_text", "next")
    n = F.length("text")
    m = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - m), F.col("next.text").substr(F.lit(1), m))
    e = with_anchors(both.select("id", "own_h", "own_p", "next_h", n.cast("long").alias("n_chars"),
                                 edited.alias("edited")), "edited", "new")
    return e.select(F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    fingerprint(F.col("own_h"), F.col("own_p")).alias("fingerprint"),
                    fingerprint(F.col("new_h"), F.col("new_p")).alias("edited_fingerprint"),
                    likeness(F.col("own_h"), F.col("new_h")).alias("near_edited"),
                    likeness(F.col("own_h"), F.col("next_h")).alias("near_next"))

"""Surrogates for personal data (DataFrame operations only).

Entities are found by one pattern and typed. Each distinct entity (type and normalised value)
gets a keyed surrogate of the same type: characters are replaced within their class (digit,
Latin, Cyrillic; upper and lower case), names by names of the same gender and script, card
numbers keep a right check digit, e-mail domains become reserved ones. Equal entities get
equal surrogates in whatever format they are written, so references stay linked.

Collision check: an entity claims ATTEMPTS surrogates. A claimed value goes to the entity that
claims it first; values that occur in the corpus go to none. An entity takes its earliest
claim that it won, so no two entities share a surrogate and none equals an original. One
claim of every entity is a long keyed form that no other entity has.

The texts are scanned twice and only those with entities are joined with their surrogates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ATTEMPTS = 6
KEY = "vialflow surrogate key"      # the default; give your own

# fixed values: titles with the gender that they tell, and given names by gender and script
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа"),
    "n": ("Dr", "Prof", "Доктор"),
}
GIVEN = {
    ("m", "l"): ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Carlos", "Pierre", "Hans"),
    ("f", "l"): ("Mary", "Anna", "Linda", "Sarah", "Laura", "Emma", "Julia", "Maria", "Claire", "Lucia", "Karin", "Helen"),
    ("n", "l"): ("Alex", "Robin", "Kim", "Sascha", "Dominique", "Noa", "Jamie", "Charlie"),
    ("m", "c"): ("Иван", "Пётр", "Сергей", "Андрей", "Николай", "Олег"),
    ("f", "c"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина"),
    ("n", "c"): ("Саша", "Женя", "Валя", "Слава"),
}

_NAME = r"\p{Lu}[\p{L}'-]+"
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + ")"
_ANY_GIVEN = "(?:" + "|".join(sorted({n for ns in GIVEN.values() for n in ns}, key=lambda n: (-len(n), n))) + ")"
# type, pattern; earlier types win where two fit one place
PATTERNS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("secret", r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}"),
    ("assigned", r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?\"?[^\s\"'<>,;]{6,}"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?"),
    ("card", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}"),
    ("ip", r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"),
    ("name", rf"{_TITLE}\.? {_NAME}(?: {_NAME})?|{_ANY_GIVEN} {_NAME}"),
)
ENTITY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for _, p in PATTERNS) + r")(?![\p{L}\p{N}])"


def entities_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def type_of(e: Column) -> Column:
    out = None
    for kind, p in PATTERNS:
        fits = e.rlike(f"^(?:{p})$")
        out = F.when(fits, F.lit(kind)) if out is None else out.when(fits, F.lit(kind))
    return out.otherwise(F.lit("other"))


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, "[^0-9]", "")


def _gender(e: Column) -> Column:
    out = None
    for g in ("m", "f", "n"):
        fits = e.rlike("^(?:" + "|".join((*TITLES[g], *GIVEN[g, "l"], *GIVEN[g, "c"])) + r")[. ]")
        out = F.when(fits, F.lit(g)) if out is None else out.when(fits, F.lit(g))
    return out.otherwise(F.lit("n"))


def _norm(kind: Column, e: Column) -> Column:
    """What makes two writings the same entity. For names: gender, script, and the names without
    title."""
    bare = F.regexp_replace(e, rf"^{_TITLE}\.? ", "")
    script = F.when(bare.rlike(r"\p{IsCyrillic}"), F.lit("c")).otherwise(F.lit("l"))
    value = F.regexp_extract(e, r"^(?:[A-Za-z_-]+)\s?[=:]\s?\"?(.*)$", 1)
    return (F.when(kind == "email", F.lower(e)).when(kind.isin("card", "phone", "ssn"), _digits(e))
            .when(kind == "iban", F.regexp_replace(e, " ", ""))
            .when(kind == "assigned", value)
            .when(kind == "name", F.concat_ws("|", _gender(e), script, F.lower(bare))).otherwise(e))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _stream(key: str, seed: Column) -> Column:
    """64 keyed pseudo-random numbers from 0 to 255, repeated where a value is longer."""
    digits = F.concat(*[F.sha2(F.concat(F.lit(f"{key}|{i}|"), seed), 256) for i in range(2)])
    return _bound(digits, lambda h: F.transform(F.sequence(F.lit(0), F.lit(63)),
                                                lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("int")))


CLASSES = (("0-9", "0123456789"), ("a-f", "abcdef"), ("g-z", "abcdefghijklmnopqrstuvwxyz"), ("A-Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
           ("ß-öø-ÿ", "àâäáçèéêëìíîïñòóôöùúûü"), ("А-ЯЁ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦ"), ("а-яё", "абвгдежзиклмнопрстуфхцч"))


def _replaced(value: Column, stream: Column) -> Column:
    """Each character replaced within its class; others stay. a-f stay hexadecimal in values
    of hexadecimal digits only."""
    def one(c: Column, r: Column, hexadecimal: Column) -> Column:
        out = None
        for chars, to in CLASSES:
            new = F.substring(F.lit(to), r % len(to) + 1, F.lit(1))
            if chars == "a-f":
                wide = F.substring(F.lit(CLASSES[2][1]), r % 26 + 1, F.lit(1))
                new = F.when(hexadecimal, new).otherwise(wide)
            out = F.when(c.rlike(f"[{chars}]"), new) if out is None else out.when(c.rlike(f"[{chars}]"), new)
        return out.otherwise(c)

    def all_of(s: Column) -> Column:
        return _bound(value.rlike("^[0-9a-f]{8,}$"), lambda x: F.array_join(
            F.transform(F.split(value, ""), lambda c, i: _bound(F.element_at(s, i % 64 + 1), lambda r: one(c, r, x))), ""))
    return _bound(stream, all_of)


def _with_check_digit(digits: Column) -> Column:
    """The digits with the last one replaced by the Luhn check digit."""
    body = F.reverse(F.split(F.substring(digits, F.lit(1), F.length(digits) - 1), ""))
    def part(c, i):
        d = c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    total = F.aggregate(F.transform(body, part), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.lit(10) - total % 10) % 10).cast("string"))


def _pick(names: tuple[str, ...], r: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), r % len(names) + 1)


def _candidate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The attempt-th surrogate of an entity, in normal form."""
    seed = F.concat_ws("|", kind, norm, attempt.cast("string"))
    return _bound(_stream(key, seed), lambda s: _bound(_replaced(norm, s), lambda plain: _bound(
        _usual(key, kind, norm, s, plain), lambda usual: _claim(key, kind, norm, attempt, seed, usual))))


def _usual(key: str, kind: Column, norm: Column, s: Column, plain: Column) -> Column:
    """The surrogate of the entity's own form."""
    host = F.element_at(F.split(norm, "@"), -1)
    labels = F.split(host, r"\.")
    top = F.when(F.element_at(labels, -1).isin("com", "net", "org"), F.element_at(labels, -1)).otherwise(F.lit("org"))
    inner = F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x: _replaced(x, _stream(key, F.concat(F.lit("host|"), x))))
    email = F.concat(_replaced(F.element_at(F.split(norm, "@"), 1), s), F.lit("@"), F.concat_ws(".", inner, F.lit("example"), top))
    ip = F.concat_ws(".", F.element_at(s, 1) % 223 + 1, F.element_at(s, 2), F.element_at(s, 3), F.element_at(s, 4))
    first = F.substring(norm, 1, 1)
    card = _with_check_digit(F.concat(first, F.substring(plain, F.lit(2), F.length(norm) - 1)))
    # digits of a telephone number: a leading 1 stays (country), the next is 2 to 9
    phone = F.concat(F.when(first == "1", F.concat(F.lit("1"), (F.element_at(s, 60) % 8 + 2).cast("string"))).otherwise(
        F.concat(first, F.substring(plain, 2, 1))), F.substring(plain, F.lit(3), F.length(norm)))
    iban = F.concat(F.substring(norm, 1, 2), F.substring(plain, F.lit(3), F.length(norm)))
    aws = F.concat(F.lit("AKIA"), F.substring(plain, F.lit(5), F.length(norm)))
    p = F.split(norm, r"\|")
    words = F.split(F.element_at(p, 3), " ")
    given = None
    for (g, c), names in GIVEN.items():
        fits = (F.element_at(p, 1) == g) & (F.element_at(p, 2) == c)
        one = _pick(names, F.element_at(s, 61))
        given = F.when(fits, one) if given is None else given.when(fits, one)
    family = F.initcap(_replaced(F.element_at(words, -1), s))
    name = F.concat_ws("|", F.element_at(p, 1), F.element_at(p, 2),
                       F.when(F.size(words) > 1, F.concat(F.lower(given), F.lit(" "), F.lower(family))).otherwise(F.lower(family)))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
             .when(kind == "iban", iban).when((kind == "secret") & norm.startswith("AKIA"), aws).when(kind == "name", name).otherwise(plain))


def _claim(key: str, kind: Column, norm: Column, attempt: Column, seed: Column, usual: Column) -> Column:
    # the last claim: the usual one with a keyed ending of its own
    ending = F.translate(F.substring(F.sha2(F.concat(F.lit(f"{key}|end|"), seed), 256), 1, 16), "0123456789", "ghijklmnop")
    long = (F.when(kind == "email", F.concat(F.element_at(F.split(usual, "@"), 1), ending, F.lit("@"), F.element_at(F.split(usual, "@"), -1)))
            .when(kind.isin("card", "phone", "ssn"), F.concat(usual, F.translate(ending, "abcdefghijklmnop", "0123456789012345")))
            .otherwise(F.concat(usual, ending)))
    return F.when(attempt < ATTEMPTS - 1, usual).otherwise(long).substr(F.lit(1), F.length(norm) + 40)


def _formatted(kind: Column, e: Column, new: Column) -> Column:
    """A surrogate in normal form, written the way the entity ``e`` is."""
    def digits_into(pattern: Column) -> Column:
        # the i-th digit of the writing takes the i-th digit of the surrogate; more go behind
        chars = F.split(pattern, "")
        upto = F.transform(chars, lambda c, i: F.length(_digits(F.substring(pattern, F.lit(1), i + 1))))
        put = F.zip_with(chars, upto, lambda c, n: F.when(c.rlike("[0-9A-Z]"), F.substring(new, n, F.lit(1))).otherwise(c))
        return F.concat(F.array_join(put, ""), F.substring(new, F.length(_digits(pattern)) + 1, F.lit(64)))
    groups = F.regexp_replace(new, "(.{4})(?=.)", "$1 ")
    title = F.regexp_extract(e, rf"^({_TITLE}\.? )", 1)
    name = F.initcap(F.element_at(F.split(new, r"\|"), 3))
    shouted = F.when(e.rlike(r"^[^\p{Ll}]+$"), F.upper(name)).otherwise(name)
    lead = F.regexp_extract(e, r"^([A-Za-z_-]+\s?[=:]\s?\"?)", 1)
    mail = F.when(e.rlike("^[^a-z]+$"), F.upper(new)).otherwise(new)
    return (F.when(kind.isin("card", "phone", "ssn"), digits_into(e))
            .when((kind == "iban") & e.contains(" "), groups).when(kind == "name", F.concat(title, shouted))
            .when(kind == "assigned", F.concat(lead, new)).when(kind == "email", mail).otherwise(new))


def surrogate_table(found: DataFrame, key: str = KEY) -> DataFrame:
    """(entity, kind, surrogate) for the distinct writings in the column ``entity``."""
    w = found.select("entity").distinct().withColumn("kind", type_of(F.col("entity")))
    w = stored(w.withColumn("norm", _norm(F.col("kind"), F.col("entity"))), "writings")
    known = w.select("kind", "norm").distinct()
    claims = known.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1))))
    claims = stored(claims.withColumn("new", _candidate(key, F.col("kind"), F.col("norm"), F.col("attempt"))), "claims")
    rank = F.xxhash64("norm")
    taken = known.select("kind", F.col("norm").alias("new"), F.lit(-1).alias("attempt"), F.lit(0).cast("long").alias("rank"), F.lit(None).cast("string").alias("owner"))
    wanted = claims.select("kind", "new", "attempt", rank.alias("rank"), F.col("norm").alias("owner")).unionByName(taken)
    owner = wanted.groupBy("kind", "new").agg(F.min(F.struct("attempt", "rank", "owner")).alias("o"))
    won = owner.filter("o.owner is not null").select("kind", "new", F.col("o.owner").alias("norm"), "o.attempt")
    best = won.groupBy("kind", "norm").agg(F.min(F.struct("attempt", "new")).alias("b"))
    got = w.join(best, ["kind", "norm"], "left").withColumn("new", F.coalesce("b.new", F.raise_error(F.lit("no surrogate is free: use another key"))))
    return got.select("entity", "kind", _formatted(F.col("kind"), F.col("entity"), F.col("new")).alias("surrogate"))


def with_surrogates(docs: DataFrame, text_col: str = "text", key: str = KEY, counts: str | None = None) -> DataFrame:
    """``docs`` with every entity in the texts replaced; other columns unchanged. ``counts``
    names a further column with the number of entities.

    Cases: null and empty texts stay; a text of any length is treated whole; rows without
    doc_id and repeated rows are treated alike (the join is on the text's own hash, not on
    an id); an empty table gives no rows; a column named like a helper is kept.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    t = F.col(f"`{text_col}`")
    found = docs.select(t.alias("text")).filter(t.rlike(ENTITY)).select(F.xxhash64("text").alias("h1"), F.crc32(F.col("text").cast("binary")).alias("h2"),
                                                                      entities_of(F.col("text")).alias("es"))
    found = stored(found.groupBy("h1", "h2").agg(F.first("es").alias("es")), "entities")
    table = stored(surrogate_table(found.select(F.explode("es").alias("entity")), key), "surrogates")
    place = found.select("h1", "h2", F.posexplode("es").alias("i", "entity")).join(table, "entity")
    per = place.groupBy("h1", "h2").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "surrogate"))), lambda x: x["surrogate"]).alias("new"))
    has = F.coalesce(t.rlike(ENTITY), F.lit(False))
    row = docs.select(F.struct(*names).alias("row"))
    text = F.col(f"row.`{text_col}`")
    hit = docs.filter(has).select(F.struct(*names).alias("row")).withColumn("h1", F.xxhash64(text)).withColumn("h2", F.crc32(text.cast("binary")))
    hit = hit.join(per, ["h1", "h2"])
    parts = F.split(text, ENTITY, -1)
    new = F.array_join(F.transform(parts, lambda x, i: F.concat(x, F.coalesce(F.get(F.col("new"), i), F.lit("")))), "")
    cols = [new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    more = ([F.size("new").alias(counts)], [F.lit(0).alias(counts)]) if counts else ([], [])
    return hit.select(*cols, *more[0]).unionByName(docs.filter(~has).select(*names, *more[1]))

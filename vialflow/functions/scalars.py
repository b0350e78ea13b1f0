"""Column-expression helpers. Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's labels (calendar in Spanish,
# Monday = 0; short labels used by the charts).
# ---------------------------------------------------------------------------
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
               "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTH_SHORT = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]
WEEKDAY_SHORT = ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]
# Defaults used when an event has no hypothesis / no vehicle / unknown hour.
UNKNOWN_HYPOTHESIS = "Desconocida"
UNKNOWN_VEHICLE = "Otro"
UNKNOWN_HOUR = -1


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- dates
def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> DATE; malformed text gives NULL instead of failing the job (ANSI on)."""
    return F.try_to_date(col(c), fmt)


def quarter(c) -> Column:
    return F.quarter(col(c))


def month_name(c) -> Column:
    """Spanish month name from a DATE (``date_format`` would give English)."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(col(c)))


def weekday_name(c) -> Column:
    return weekday_name_of(F.weekday(col(c)))


def weekday_name_of(idx) -> Column:
    """Spanish weekday name of a Monday = 0 index."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), col(idx) + 1)


def month_short(m) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_SHORT]), col(m))


def weekday_short(d) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_SHORT]), F.pmod(col(d), F.lit(7)) + 1)


def date_key(c) -> Column:
    """Smart calendar key yyyymmdd: deterministic, no global numbering window."""
    d = col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


# ----------------------------------------------------------------- hours
def parse_hour(c, mode: str = "split") -> Column:
    """Hour of an ``HH:mm:ss`` text, in the three flavours found in the reference.

    split         text before ':' as int; NULL/bad -> NULL (callers fill -1)   '9:30:00' -> 9
    prefix        first two characters if all digits, else NULL    '9:30:00' -> NULL, '9' -> 9
    zero_default  NULL or empty text -> 0.0, else text before ':' as double, bad -> NaN '9:30:00' -> 9.0
    """
    h = col(c)
    head = F.get(F.split(h, ":"), 0)
    if mode == "split":
        return head.try_cast("int")
    if mode == "prefix":
        p = F.substring(h, 1, 2)
        return F.when(p.rlike("^[0-9]+$"), p.try_cast("int"))
    if mode == "zero_default":
        return F.when(h.isNull() | (h == ""), F.lit(0.0)).otherwise(
            F.coalesce(head.try_cast("double"), F.lit(float("nan"))))
    raise ValueError(f"unknown hour mode {mode!r}")


# ----------------------------------------------------------------- arrays
def first_of(arr, field: str | None = None) -> Column:
    """Null-safe first element (``arr[0]`` would fail on empty arrays under ANSI)."""
    e = F.get(col(arr), 0)
    return e.getField(field) if field else e


def safe_size(arr) -> Column:
    """Length with 0 for a missing list (``size(NULL)`` is NULL under ANSI and -1 under
    the legacy setting; both become 0)."""
    a = col(arr)
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(a))


def empty_array(elem_type: str = "string") -> Column:
    return F.array().cast(f"array<{elem_type}>")


# ----------------------------------------------------------------- rounding
def int_div(a, b) -> Column:
    """Exact integral division of two integral columns (SQL ``div``)."""
    return F.call_function("div", col(a), col(b))


def round_ratio(num, den, scale: int = 1, digits: int = 1) -> Column:
    """round(num * scale / den, digits) with exact half-up rounding, as DOUBLE.

    Computed on integers so the result does not depend on binary near-ties, and never
    turns into a DECIMAL (``1000.0`` literals do in Spark). NULL when den = 0.
    """
    num, den = col(num).cast("long"), col(den).cast("long")
    k = 2 * scale * 10 ** digits
    q = int_div(num * F.lit(k) + den, den * F.lit(2))
    return F.when(den != 0, q.cast("double") / F.lit(float(10 ** digits)))


def rate_or_zero(num, den, scale: int = 1000, digits: int = 1) -> Column:
    """Guarded rate (F17): 0 when the denominator is 0."""
    return F.coalesce(round_ratio(num, den, scale, digits), F.lit(0.0))


# ----------------------------------------------------------------- labels
def truncate_label(c, n: int) -> Column:
    s = col(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("…"))).otherwise(s)


def hour_label(h, suffix: str = "h") -> Column:
    return F.concat(F.lpad(col(h).cast("string"), 2, "0"), F.lit(suffix))


def capitalise(c) -> Column:
    """Upper first letter, lower the rest (``initcap`` would capitalise every word)."""
    s = col(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def thousands(n) -> Column:
    """12345 -> '12.345' (dot as thousands separator)."""
    return F.translate(F.format_number(col(n).cast("double"), 0), ",", ".")


def recode(c, mapping: dict, default=None) -> Column:
    """Value recode with default (keeps the value itself when default is None)."""
    fallback = col(c) if default is None else F.lit(default)
    if not mapping:
        return fallback
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, col(c)), fallback)


def band(ratio, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """Strictly-greater threshold bands, first match wins."""
    r = col(ratio)
    e = None
    for cut, label in cuts:
        e = F.when(r > cut, label) if e is None else e.when(r > cut, label)
    return e.otherwise(otherwise)

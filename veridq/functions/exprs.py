"""Scalar primitives as ``Column`` factories.

All of them are built-in expressions: they stay inside whole-stage codegen
(higher-order ``transform`` in :func:`title_case` is evaluated inline) and
never leave the JVM.  Python string semantics are reproduced explicitly where
Spark's defaults differ (``strip``, ``title``, ``isupper``, ``float()``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veridq import spec

__all__ = [
    "col_of",
    "ustrip",
    "is_blank",
    "not_blank",
    "digits",
    "parse_date",
    "parse_number",
    "is_finite",
    "age_years",
    "is_future",
    "in_domain",
    "is_all_upper",
    "is_all_lower",
    "title_case",
    "null_token",
    "pct",
    "round1",
    "phone_format",
    "date_shape",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: str | Column) -> Column:
    """F2 — Python ``str.strip()``: removes every Unicode whitespace character
    from both ends (``F.trim`` only removes spaces)."""
    return F.btrim(col_of(c), F.lit(spec.PY_WHITESPACE))


def is_blank(c: str | Column, stripped: Column | None = None) -> Column:
    """F1 — null or whitespace-only."""
    s = stripped if stripped is not None else ustrip(c)
    return col_of(c).isNull() | (s == F.lit(""))


def not_blank(c: str | Column, stripped: Column | None = None) -> Column:
    s = stripped if stripped is not None else ustrip(c)
    return col_of(c).isNotNull() & (s != F.lit(""))


def digits(c: str | Column) -> Column:
    """F3 — keep only (Unicode) decimal digits: one replacement a run of other characters."""
    return F.regexp_replace(col_of(c), r"\P{Nd}++", "")


def parse_date(c: str | Column, formats: Iterable[str], stripped: Column | None = None) -> Column:
    """F4 — first format that parses (strict calendar, 4-digit year, 1–2 digit
    month/day, whole string); null otherwise.  Input is stripped first.
    Year 0 is rejected as in Python.

    A value of the plain ISO shape can match no format but ISO and is cast, which costs a
    fraction of the formatters; those run for the other shapes."""
    formats = list(formats)
    s = stripped if stripped is not None else ustrip(c)
    d = F.coalesce(*[F.call_function("try_to_date", s, F.lit(f)) for f in formats])
    other = F.when(F.year(d) >= 1, d)
    if spec.ISO not in formats or any("/" not in f for f in formats if f != spec.ISO):
        return other
    # no digit, no date: literals and blanks need no formatter
    return F.when(s.rlike(_ISO_SHAPE), s.try_cast("date")).when(s.rlike("[0-9]"), other)


_ISO_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"

# Python float() grammar after strip, in character classes only (a group in a loop would
# recurse per character): "_" only between digits; then sign, digits, optional fraction
# and exponent; or inf / infinity / nan.
_MISPLACED = r"(?:^|[^0-9])_|_(?:[^0-9]|$)"
_DECIMAL = r"^[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?$"
_INFINITE = r"^[+-]?(?i:inf|infinity)$"
_NAN = r"^[+-]?(?i:nan)$"


def parse_number(c: str | Column, stripped: Column | None = None) -> Column:
    """F5 — Python ``float(str(v).strip())``; null when Python would raise.

    Spark's cast alone also accepts ``1.5f``/``12d`` and rejects ``1_000``;
    the regex guards restore Python's grammar.  What is a plain decimal as it stands needs
    one test."""
    s = stripped if stripped is not None else ustrip(c)
    plain = F.regexp_replace(s, "_", "")
    number = F.when(~s.rlike(_MISPLACED) & plain.rlike(_DECIMAL), plain.try_cast("double"))
    rest = F.when(s.rlike(_NAN), F.lit(float("nan"))).when(s.rlike(_INFINITE), s.try_cast("double")).otherwise(number)
    return F.when(s.rlike(_DECIMAL), s.try_cast("double")).otherwise(rest)


def is_finite(n: Column) -> Column:
    return ~F.isnan(n) & (F.abs(n) != F.lit(float("inf")))


def age_years(d: Column, as_of: _dt.date) -> Column:
    """F7 — ``(as_of - d).days / 365.25``."""
    return F.datediff(F.lit(as_of), d) / F.lit(spec.DAYS_PER_YEAR)


def is_future(c: str | Column, as_of: _dt.date, formats=spec.FUTURE_FLAG_FORMATS, stripped: Column | None = None) -> Column:
    """F8 — parseable (given formats) and after ``as_of``; false otherwise."""
    return F.coalesce(parse_date(c, formats, stripped) > F.lit(as_of), F.lit(False))


def in_domain(c: str | Column, values: Iterable[str], stripped: Column | None = None) -> Column:
    """F9 — ``strip().lower() in values``."""
    s = stripped if stripped is not None else ustrip(c)
    return F.lower(s).isin(*list(values))


def is_all_upper(c: str | Column) -> Column:
    """F10 — Python ``isupper()``: at least one cased char, none lower/title."""
    v = col_of(c)
    return v.rlike(r"\p{IsUppercase}") & ~v.rlike(r"[\p{IsLowercase}\p{Lt}]")


def is_all_lower(c: str | Column) -> Column:
    """F10 — Python ``islower()``."""
    v = col_of(c)
    return v.rlike(r"\p{IsLowercase}") & ~v.rlike(r"[\p{IsUppercase}\p{Lt}]")


def title_case(c: str | Column) -> Column:
    """F11 — Python ``str.title()``: upper-case after every non-cased char,
    lower-case the rest (``initcap`` differs on ``O'brien``/``Mary-jane``).  One word of
    ASCII letters needs no split into runs."""
    v = col_of(c)
    word = lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))
    runs = F.regexp_extract_all(v, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), 0)
    return F.when(v.rlike(r"^[A-Za-z]+\z"), word(v)).otherwise(F.array_join(F.transform(runs, word), ""))


def null_token(c: str | Column, token: str | None) -> Column:
    """F12 — render null as pandas' ``str(pd.NA)`` when ``token`` is set."""
    return F.coalesce(col_of(c), F.lit(token)) if token is not None else col_of(c)


def round1(x: Column) -> Column:
    return F.round(x, 1)


def pct(part: Column, total: Column) -> Column:
    """F13 — ``round(part / total * 100, 1)``; null on an empty table."""
    return F.round(F.lit(100.0) * part / F.nullif(total, F.lit(0)), 1)


def phone_format(stripped: Column) -> Column:
    """Ordered phone format catalogue; first match wins (P3)."""
    out = F.lit(spec.PHONE_OTHER)
    for name, pattern in reversed(spec.PHONE_FORMATS):
        out = F.when(stripped.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def date_shape(stripped: Column) -> Column:
    """Ordered, case-insensitive date-shape catalogue (P4)."""
    out = F.lit(spec.DATE_OTHER)
    for name, pattern in reversed(spec.DATE_SHAPES):
        out = F.when(stripped.rlike("(?i)" + pattern), F.lit(name)).otherwise(out)
    return out


def memo_columns(fn):
    """Reuse built ``Column`` expression trees within one Spark application.

    Column trees are immutable, unresolved expressions; building one costs a JVM
    round trip per node, which dominates driver-side planning for wide rule sets.
    Keyed by the application id and the arguments' ``repr``."""
    import functools

    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        from pyspark import SparkContext

        sc = SparkContext._active_spark_context
        app = sc.applicationId if sc is not None else None
        key = (app, repr(args), repr(sorted(kwargs.items())))
        if key not in cache:
            cache[key] = fn(*args, **kwargs)
        return cache[key]

    return wrapper

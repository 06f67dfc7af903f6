"""String column expressions.

Everything compiles to JVM expressions (regex via Java patterns), so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# H1
def strip(x, chars: str | None = None) -> Column:
    """Trim blanks, or the given characters (e.g. quotes) on both ends."""
    return F.trim(_c(x)) if chars is None else F.btrim(_c(x), F.lit(chars))


def strip_quotes(x) -> Column:
    return F.btrim(F.trim(_c(x)), F.lit("'\""))


# H2
def split_take(x, sep: str, i: int) -> Column:
    """Part ``i`` (0-based, negative from the end) of a literal separator split."""
    return F.split_part(_c(x), F.lit(sep), F.lit(i + 1 if i >= 0 else i))


# H3
def substr(x, pos: int, length: int) -> Column:
    return F.substring(_c(x), pos, length)


# H4
def capitalize(x) -> Column:
    """First character upper-case, the rest lower-case (Python ``str.capitalize``)."""
    s = _c(x)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


# H5
def zero_pad(x, width: int) -> Column:
    return F.lpad(_c(x).cast("string"), width, "0")


# H6
def first_char(x) -> Column:
    return F.substring(_c(x), 1, 1)


# H7
def composite_key(*cols, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


# H8
def parse_amount(x) -> Column:
    """``$12.50`` / ``1,234.5`` -> 12.5 / 1234.5; unparsable -> null."""
    return F.regexp_replace(_c(x), r"[^0-9.\-]", "").try_cast("double")


def unit_value(x, factors: dict[str, float]) -> Column:
    """``'18.6 km/kg'`` -> 18.6 * factors['km/kg'] (unknown unit -> value)."""
    s = F.trim(_c(x))
    num = F.split_part(s, F.lit(" "), F.lit(1)).try_cast("double")
    unit = F.split_part(s, F.lit(" "), F.lit(2))
    out = num
    for u, f in factors.items():
        out = F.when(unit == F.lit(u), num * F.lit(f)).otherwise(out)
    return out


# H9
def char_count(x, ch: str) -> Column:
    return F.regexp_count(_c(x), F.lit(_regex_escape(ch)))


def _regex_escape(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\-/" else c for c in s)


# H10 -- fixed patterns for URLs, e-mail addresses and phone numbers.
URL_RE = r"(?i)\b(?:https?://|www\.)\S+"
EMAIL_RE = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE_RE = r"\+?\d[\d\-\s().]{7,}\d"


def count_matches(x, pattern: str | Column) -> Column:
    pat = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.regexp_count(_c(x), pat)


def count_urls(x) -> Column:
    return count_matches(x, URL_RE)


def count_emails(x) -> Column:
    return count_matches(x, EMAIL_RE)


def count_phones(x) -> Column:
    return count_matches(x, PHONE_RE)


def count_literal_ci(x, needle) -> Column:
    """Occurrences of another column's value (case-insensitive, literal)."""
    pat = F.concat(F.lit("(?i)\\Q"), _c(needle), F.lit("\\E"))
    return F.when(F.length(_c(needle)) > 0, F.regexp_count(_c(x), pat)).otherwise(F.lit(0))


# H11
def count_class(x, cls: str) -> Column:
    """Number of characters in a Unicode class, e.g. ``\\p{Ll}`` or ``\\p{L}``."""
    return F.length(F.regexp_replace(_c(x), f"[^{cls}]", ""))


def class_ratio(x, cls: str, over: str | None = None) -> Column:
    """Count of class / length (or / count of ``over`` class); 0/0 -> 0."""
    den = F.length(_c(x)) if over is None else count_class(x, over)
    return F.coalesce(F.try_divide(count_class(x, cls).cast("double"), den.cast("double")), F.lit(0.0))


# H12 -- fixed values: emoji code-point ranges.
EMOJI_RE = ("[\\x{1F300}-\\x{1F5FF}\\x{1F600}-\\x{1F64F}\\x{1F680}-\\x{1F6FF}"
            "\\x{1F700}-\\x{1F77F}\\x{1F780}-\\x{1F7FF}\\x{1F800}-\\x{1F8FF}"
            "\\x{1F900}-\\x{1F9FF}\\x{1FA00}-\\x{1FA6F}\\x{1FA70}-\\x{1FAFF}"
            "\\x{2600}-\\x{26FF}\\x{2700}-\\x{27BF}]")


def count_emoji(x) -> Column:
    return F.regexp_count(_c(x), F.lit(EMOJI_RE))


# H19
def first_json_name(x, field: str = "name") -> Column:
    """First element's ``field`` of a JSON-like list of dicts (single quotes ok)."""
    schema = f"array<struct<{field}:string>>"
    parsed = F.from_json(_c(x), schema, {"allowSingleQuotes": "true"})
    return F.try_element_at(parsed, F.lit(1)).getField(field)


# B13
def to_number(x, typ: str = "double") -> Column:
    """pandas ``to_numeric(errors='coerce')``: bad values -> null."""
    return _c(x).try_cast(typ)


def bool_to_int(x) -> Column:
    return _c(x).cast("boolean").cast("int")

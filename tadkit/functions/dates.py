"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# H20
def parse_date(x, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date with a pattern; unparsable -> null (``errors='coerce'``)."""
    return F.try_to_timestamp(F.trim(_c(x)), F.lit(fmt)).cast("date")


def parse_ts(x, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(F.trim(_c(x)), F.lit(fmt))


def ymd(y, m, d) -> Column:
    return F.make_date(_c(y), _c(m), _c(d))


def year_month(x) -> Column:
    """``yyyyMM`` as an integer (replaces a row UDF in the source)."""
    return F.date_format(_c(x), "yyyyMM").cast("int")


def epoch_micros(x) -> Column:
    """Microseconds since epoch of a timestamp / timestamp_ntz (UTC wall clock)."""
    return F.unix_micros(_c(x).cast("timestamp"))


# H21 -- fixed values: weekday letters Monday..Sunday used by the source.
WEEKDAY_LETTERS = "LMXJVSD"


def weekday_letter(x) -> Column:
    return F.element_at(F.array(*[F.lit(ch) for ch in WEEKDAY_LETTERS]), F.weekday(_c(x)) + 1)


def time_parts(x) -> list[Column]:
    return [F.hour(_c(x)).alias("hour"), F.month(_c(x)).alias("month"),
            F.weekday(_c(x)).alias("weekday"), weekday_letter(x).alias("weekday_letter")]


# H22 -- numpy's timedelta64(1, 'Y') is 365.2425 days.
DAYS_PER_YEAR = 365.2425


def years_between(later, earlier, digits: int = 1) -> Column:
    days = F.datediff(_c(later).cast("date"), _c(earlier).cast("date"))
    return F.round(days / F.lit(DAYS_PER_YEAR), digits)


# H23 -- fixed values: month names (English and Spanish) in calendar order.
MONTHS_EN = ["January", "February", "March", "April", "May", "June", "July",
             "August", "September", "October", "November", "December"]
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
             "agosto", "septiembre", "octubre", "noviembre", "diciembre"]


def month_name(m, lang: str = "en", abbrev: bool = False) -> Column:
    names = MONTHS_EN if lang == "en" else MONTHS_ES
    if abbrev:
        names = [n[:3] for n in names]
    return F.element_at(F.array(*[F.lit(n) for n in names]), _c(m).cast("int"))


def month_number(name, lang: str = "en") -> Column:
    names = MONTHS_EN if lang == "en" else MONTHS_ES
    key = F.lower(F.substring(F.trim(_c(name)), 1, 3))
    mp = F.create_map(*[v for i, n in enumerate(names) for v in (F.lit(n[:3].lower()), F.lit(i + 1))])
    return mp[key]


def month_start_sequence(start, periods: int) -> Column:
    """Array of the next ``periods`` month starts after ``start``."""
    first = F.add_months(F.trunc(_c(start).cast("date"), "month"), 1)
    return F.sequence(first, F.add_months(first, periods - 1), F.expr("INTERVAL 1 MONTH"))

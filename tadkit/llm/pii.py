r"""Format-preserving pseudonyms of personal data by keyed Feistel networks.

Candidates are found by pattern, validated (card and IBAN check digits, number
ranges, calendar dates) and replaced by a keyed permutation of their own
format: letters stay letters, digits digits, valid numbers valid numbers and
dates dates.  The permutation depends on the key and the kind alone, so equal
values get equal pseudonyms in every document, and different values different
ones.  What is not searched for is listed in the README.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_EDGE, _STOP = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_GAP = r"(?:[ ./-]?\(|\)[ ./-]?|[ ./-])?"             # what may stand between two digits of a phone number
_LETTERS, _LETTERS36 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"

# Searches, in turn: kind, what stands before, a candidate, what stands behind,
# and whether candidates may overlap.  Each sees what those before it have left, so
# a candidate that fails its validation hides nothing from the others.
SEARCHES = [
    # Labels are given back one by one (a full stop may end the sentence), 126 of them at most.
    ("email", r"(?<![\p{L}0-9._%+-])", r"[\p{L}0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}", "", False),
    ("secret", "", r"(?i:token|secret|api_?key|password)\s?[=:]\s?[\"'][0-9A-Fa-f]{16,}[\"']", "", False),
    ("iban", _EDGE, r"[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)", _STOP, True),
    ("phone", "", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", _STOP, False),
    ("ssn", _EDGE, r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _STOP, False),
    ("date", _EDGE, r"[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}", r"(?![0-9A-SU-Za-z]|T(?![0-9]{2}))", False),
    ("date", _EDGE, r"[0-9]{2}(?:[./][0-9]{2}[./]|-[0-9]{2}-)[0-9]{4}", _STOP, False),
    ("ip", _EDGE + r"(?<![0-9]\.)", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", r"(?!\.?[0-9A-Za-z])", False),
    # Cards as they are printed, at every group of a row of numbers.
    ("card", _EDGE, r"(?:[0-9]{13,19}|[0-9]{4}(?<s>[ -])(?:[0-9]{4}\k<s>[0-9]{4}\k<s>[0-9]{4}|[0-9]{6}\k<s>[0-9]{4,5}"
                    r"|[0-9]{3}\k<s>[0-9]{3}\k<s>[0-9]{3}))", _STOP, True),
    # Phones in other groupings, then national ones: 3-3-4 and those with a leading 0, which look like no date or address.
    ("phone", "", r"\+[0-9](?:" + _GAP + r"[0-9]){6,14}", _STOP, False),
    ("phone", _EDGE, r"(?:1[ .-])?(?:\(?[0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", _STOP, False),
    ("phone", _EDGE + r"(?<![0-9][ ./-])(?![0-9]{2}[./-][0-9]{2}[./-][0-9]{2,4}" + _STOP + r"|[0-9]+(?:\.[0-9]+){3})",
     r"\(?0[1-9][0-9]{0,3}(?:\) ?|[ ./-])[0-9](?:[ ./-]?[0-9]){4,11}", _STOP, False),
    # Cards in other groupings, from the left.
    ("card", _EDGE, r"[0-9](?:[ -]?[0-9]){12,18}", _STOP, False),
]
ANY = "|".join(before + candidate + behind for _, before, candidate, behind, _ in SEARCHES)
_HINT = r"@|[0-9][ ./()-]{0,2}[0-9]|[=:]\s?[\"']"      # every candidate holds one of these
# What is searched: words with a digit, an @ or a quoted hexadecimal value, the two words before them and,
# between and behind them, short words in capitals (groups of an IBAN) and those that begin with = or :.
_WORD = r"[^\s0-9@\"']*+(?:[\"'](?![0-9A-Fa-f]{16})[^\s0-9@\"']*+)*+[0-9@\"']\S*+"
REGION = r"(?<!\S)(?:\S++\s++){0,2}?" + _WORD + r"(?:\s++(?:" + _WORD + r"|[A-Z]{1,4}(?![0-9A-Za-z])\S*+|[=:]\S*+))*+"
_COLD = ""                                           # kind of the parts that hold nothing to search


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _round(key: str, tag: Column, i: Column, half: Column, modulus: Column) -> Column:
    """The round function: 60 bits of a keyed digest, modulo the size of a half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus


def feistel(a: Column, b: Column, m: Column, n: Column, key: str, tag: Column) -> Column:
    """A keyed permutation of the pairs (a < m, b < n): struct(a, b)."""
    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(F.when(odd, (s["a"] + _round(key, tag, i, s["b"], m)) % m).otherwise(s["a"]).alias("a"),
                        F.when(odd, s["b"]).otherwise((s["b"] + _round(key, tag, i, s["a"], n)) % n).alias("b"))
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _power(base: int, n: Column) -> Column:
    """base ** n, at least 1 (exact: at most 26 ** 6)."""
    return F.element_at(F.array(*[F.lit(base ** k) for k in range(7)]), n + 1)


def permute_string(s: Column, base: int, key: str, tag: str) -> Column:
    """Permutes a string over the first ``base`` of 0-9a-p, in chunks of 12
    symbols, each of which is a Feistel network of its two halves."""
    def number(x: Column) -> Column:
        return F.coalesce(F.conv(x, base, 10).cast("long"), F.lit(0))

    def symbols(x: Column, n: Column) -> Column:
        return F.when(n > 0, F.lpad(F.lower(F.conv(x.cast("string"), 10, base)), n, "0")).otherwise("")

    def chunk(c: Column) -> Column:
        u, v = F.floor(F.length(c["part"]) / 2).cast("int"), F.ceil(F.length(c["part"]) / 2).cast("int")
        got = feistel(number(F.substring(c["part"], F.lit(1), u)), number(F.substring(c["part"], u + 1, v)),
                      _power(base, u), _power(base, v), key, F.concat(F.lit(tag), c["i"].cast("string")))
        return let(got, lambda g: F.concat(symbols(g["a"], u), symbols(g["b"], v)))

    def whole(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.length(w) - 1) / 12).cast("int"))
        parts = F.transform(starts, lambda i: F.struct(i.alias("i"), F.substring(w, i * 12 + 1, F.lit(12)).alias("part")))
        return F.when(w == "", w).otherwise(F.array_join(F.transform(parts, chunk), ""))
    return let(s, whole)


def refill(text: Column, symbols: str, new: Column) -> Column:
    """``text`` with its characters of the class ``symbols`` replaced, one by one, by those of ``new``; case stays."""
    def whole(t: Column) -> Column:
        def at(i: Column) -> Column:
            def char(c: Column) -> Column:
                k = F.length(F.regexp_replace(F.substring(t["old"], F.lit(1), i), f"[^{symbols}]", ""))
                n = F.substring(t["new"], k, F.lit(1))
                return F.when(~c.rlike(f"[{symbols}]"), c).when(c.rlike("[A-Z]"), F.upper(n)).otherwise(n)
            return let(F.substring(t["old"], i, F.lit(1)), char)
        filled = F.array_join(F.transform(F.sequence(F.lit(1), F.length(t["old"])), at), "")
        return F.when(t["new"] == "", t["old"]).otherwise(filled)
    return let(F.struct(text.alias("old"), new.alias("new")), whole)


def _only(text: Column, symbols: str) -> Column:
    return F.regexp_replace(text, f"[^{symbols}]", "")


def permute_digits(text: Column, key: str, tag: str) -> Column:
    return let(text, lambda t: refill(t, "0-9", permute_string(_only(t, "0-9"), 10, key, tag)))


def _letters(text: Column, key: str, tag: str) -> Column:
    low = F.translate(_only(F.lower(text), "a-z"), _LETTERS, _LETTERS36)
    return refill(text, "A-Za-z", F.translate(permute_string(low, 26, key, tag), _LETTERS36, _LETTERS))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum, the last digit counted once."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        v = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return s + v - F.when(v > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(text: Column, key: str) -> Column:
    def made(digits: Column) -> Column:
        body = permute_string(F.substring(digits, F.lit(1), F.length(digits) - 1), 10, key, "card")
        full = let(body, lambda x: F.concat(x, ((10 - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits) % 10 == 0, refill(text, "0-9", full)).otherwise(text)
    return let(_only(text, "0-9"), made)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of an IBAN's number (letters are 10 to 35)."""
    def add(s: Column, i: Column) -> Column:
        v = F.conv(F.substring(text, i, F.lit(1)), 36, 10).cast("int")
        return (s * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _iban(text: Column, key: str) -> Column:
    """Blanks between the groups stay."""
    def filled(plain: Column) -> Column:
        land, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))

        def made(new: Column) -> Column:
            return F.concat(land, F.lpad((98 - _mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0"), new)
        valid = _mod97(F.concat(body, land, F.substring(plain, 3, 2))) == 1
        return F.when(valid, refill(text, "0-9A-Z", let(permute_digits(body, key, "iban"), made))).otherwise(text)
    return let(F.replace(text, F.lit(" "), F.lit("")), filled)


def _beginnings(text: Column) -> Column:
    """The beginnings of a grouped candidate that end with a group and have an IBAN's length."""
    def all_of(groups: Column) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "))
        return F.filter(made, lambda m: F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34))
    return let(F.split(text, " "), all_of)


def _ssn(text: Column, key: str) -> Column:
    """Areas 001-899 without 666 (898), groups 01-99 and serials 0001-9999."""
    area, group, serial = (F.substring(text, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    got = feistel(area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"))

    def show(g: Column) -> Column:
        a, rest = g["a"] + 1, g["b"]
        return F.format_string("%03d-%02d-%04d", a + (a >= 666).cast("int"), F.floor(rest / 9999) + 1, rest % 9999 + 1)
    return F.when(valid, let(got, show)).otherwise(text)


def _ip(text: Column, key: str) -> Column:
    def made(o: Column) -> Column:
        got = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, F.lit("ip"))
        new = let(got, lambda g: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(g["a"] / 256), g["a"] % 256, F.floor(g["b"] / 256), g["b"] % 256)]))
        return F.when(F.array_max(o) < 256, new).otherwise(text)
    return let(F.transform(F.split(text, r"\."), lambda x: x.cast("int")), made)


def _month_first(text: Column, key: str) -> Column:
    """Dates MM/dd of 1900 to 2099 that cannot be dd/MM (days 13 to 31), permuted
    among themselves, so none meets a pseudonym written dd/MM: pairs (month,
    day) are permuted until the day exists."""
    sep, month, day, year = (F.substring(text, 3, 1), *[F.substring(text, i, n).try_cast("int") for i, n in ((1, 2), (4, 2), (7, 4))])

    def shown(s: Column) -> Column:
        return F.format_string("%04d-%02d-%02d", F.floor(s["a"] / 12) + 1900, s["a"] % 12 + 1, s["b"] + 13)

    def step(s: Column, i: Column) -> Column:
        there = (i > 1) & F.try_to_date(shown(s), "yyyy-MM-dd").isNotNull()
        return F.when(there, s).otherwise(feistel(s["a"], s["b"], F.lit(2400), F.lit(19), key, F.lit("date-month-first")))
    valid = year.between(1900, 2099) & (day > 12) & F.try_to_date(
        F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2)), "yyyy-MM-dd").isNotNull()
    start = F.struct(((year - 1900) * 12 + month - 1).cast("long").alias("a"), (day - 13).cast("long").alias("b"))
    got = let(F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, step), shown)      # a day is missing 1 time in 30
    new = let(got, lambda d: F.concat(F.substring(d, 6, 2), sep, F.substring(d, 9, 2), sep, F.substring(d, 1, 4)))
    return F.when(valid, new).otherwise(text)


def _date(text: Column, key: str) -> Column:
    """Days are permuted within 365 * 200 days from 1900-01-01; the order of
    year, month and day and the separators stay.  What is no date dd/MM may be
    one MM/dd."""
    iso, days = text.rlike(r"\A[0-9]{4}"), 365 * 200
    sep = F.when(iso, F.substring(text, 5, 1)).otherwise(F.substring(text, 3, 1))
    ymd = F.when(iso, F.replace(text, F.lit("/"), F.lit("-"))).otherwise(F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)))
    epoch = F.lit("1900-01-01").cast("date")

    def made(n: Column) -> Column:
        got = feistel(F.floor(n / 200), n % 200, F.lit(365), F.lit(200), key, F.lit("date"))
        day = let(got, lambda g: F.date_add(epoch, (g["a"] * 200 + g["b"]).cast("int")))
        new = let(day, lambda d: F.when(iso, F.concat(F.date_format(d, "yyyy"), sep, F.date_format(d, "MM"), sep, F.date_format(d, "dd"))).otherwise(
            F.concat(F.date_format(d, "dd"), sep, F.date_format(d, "MM"), sep, F.date_format(d, "yyyy"))))
        return F.when(n.between(0, days - 1), new).when(iso, text).otherwise(_month_first(text, key))
    return let(F.datediff(F.try_to_date(ymd, "yyyy-MM-dd"), epoch), made)


def _email(text: Column, key: str) -> Column:
    """All letters and digits before the last label change."""
    body, last = F.regexp_extract(text, r"\A(.*)\.([^.]*)\z", 1), F.regexp_extract(text, r"\A(.*)\.([^.]*)\z", 2)
    return F.concat(permute_digits(_letters(body, key, "email"), key, "email"), F.lit("."), last)


def _secret(text: Column, key: str) -> Column:
    parts = r"\A([^\"']*.)(.*)(.)\z"

    def made(value: Column) -> Column:
        new = refill(value, "0-9A-Fa-f", permute_string(F.lower(value), 16, key, "secret"))
        # Digits may become letters, so the case of the whole value is kept.
        return F.when(value == F.upper(value), F.upper(new)).otherwise(F.lower(new))
    return F.concat(F.regexp_extract(text, parts, 1), let(F.regexp_extract(text, parts, 2), made), F.regexp_extract(text, parts, 3))


def _phone(text: Column, key: str) -> Column:
    """The country code stays."""
    code = F.regexp_extract(text, r"\A\+[0-9]{1,3}(?=[ ./(-])", 0)
    return F.concat(code, permute_digits(F.substring(text, F.length(code) + 1, F.length(text)), key, "phone"))


_MAKERS = {"email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "ssn": _ssn, "date": _date, "ip": _ip,
           "card": _card}


def _part(old: Column, kind: Column, new: Column) -> Column:
    return F.struct(kind.cast("string").alias("kind"), old.alias("old"), new.alias("new"))


def _search(parts: Column, search: tuple, key: str) -> Column:
    """Parts (kind, old, new) of a text, those without a kind cut further at what ``search`` finds valid."""
    kind, before, candidate, behind, overlap = search

    def part(p: Column) -> Column:
        found = F.regexp_extract_all(p["old"], F.lit(f"{before}(?=({candidate}){behind})" if overlap else f"{before}({candidate}){behind}"), F.lit(1))
        found = F.flatten(F.transform(found, _beginnings)) if kind == "iban" else found
        made = F.transform(F.array_distinct(found), lambda c: _part(c, F.lit(kind), _MAKERS[kind](c, key)))

        def cut(values: Column) -> Column:
            exact = F.concat(F.lit(rf"{before}(?:\Q"), F.array_join(F.transform(values, lambda v: v["old"]), r"\E|\Q"), F.lit(rf"\E){behind}"))
            gaps = F.transform(F.split(p["old"], exact, -1), lambda g: _part(g, F.lit(None), g))
            hits = F.transform(F.regexp_extract_all(p["old"], exact, F.lit(0)), lambda m: F.element_at(F.filter(values, lambda v: v["old"] == m), 1))
            return F.filter(F.flatten(F.zip_with(gaps, hits, lambda g, h: F.array(g, h))), lambda x: x.isNotNull())
        longest = F.array_sort(F.filter(made, lambda v: v["new"] != v["old"]), lambda a, b: F.length(b["old"]) - F.length(a["old"]))
        return F.when(p["kind"].isNotNull(), F.array(p)).otherwise(
            let(longest, lambda values: F.when(F.size(values) > 0, cut(values)).otherwise(F.array(p))))
    return F.flatten(F.transform(parts, part))


def _regions(t: Column) -> Column:
    """A text as parts: what is to be searched (no kind) and what lies between."""
    between = F.transform(F.split(t, REGION, -1), lambda g: _part(g, F.lit(_COLD), g))
    inside = F.transform(F.regexp_extract_all(t, F.lit(REGION), F.lit(0)), lambda r: _part(r, F.lit(None), r))
    return F.filter(F.flatten(F.zip_with(between, inside, lambda a, b: F.array(a, b))), lambda x: x.isNotNull())


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced, and ``pii_found``: array of (kind, old,
    new) of what was changed, in order of place.

    * Null texts stay null, with an empty list; empty texts stay empty.
    * Candidates that fail their validation stay as they are, and are searched for other values.
    * Whole texts are searched; texts without digit pair, @ or quoted value are passed on.
    * Rows are independent: repeated rows get the same result.
    * Other columns are kept; a column named pii_found is replaced.
    """
    t = F.col(text)
    d = docs.withColumn("_pii", F.when(t.rlike(_HINT) & t.rlike(ANY), _regions(t)).otherwise(F.array()))
    for search in SEARCHES:                     # columns of their own: one nested expression has too many lambdas for the analyzer
        d = d.withColumn("_pii", _search(F.col("_pii"), search, key))
    parts = F.col("_pii")
    return d.withColumns({text: F.when(F.size(parts) == 0, t).otherwise(F.array_join(F.transform(parts, lambda p: p["new"]), "")),
                          "pii_found": F.filter(parts, lambda p: p["kind"] != _COLD)}).drop("_pii")

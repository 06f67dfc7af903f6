"""Pseudonyms: formats kept, permutations without collisions, valid check digits."""

import datetime
import itertools
import re

from pyspark.sql import functions as F

from tadkit.llm.pii import feistel, luhn_sum, permute_string, pseudonymise

KEY = "test-key"


def luhn(text):
    d = [int(c) for c in text if c.isdigit()]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(reversed(d))) % 10 == 0


def test_feistel_is_a_permutation(spark):
    d = spark.range(35 * 12).select(feistel(F.floor(F.col("id") / 12), F.col("id") % 12, F.lit(35), F.lit(12), KEY, F.lit("t")).alias("g"))
    got = {(r.g.a, r.g.b) for r in d.collect()}
    assert got == set(itertools.product(range(35), range(12)))


def test_strings_are_permuted_within_their_alphabet(spark):
    for base, symbols, n in ((10, "0123456789", 3), (26, "0123456789abcdefghijklmnop", 2)):
        words = ["".join(w) for w in itertools.product(symbols, repeat=n)]
        d = spark.createDataFrame([(w,) for w in words], "s string")
        got = [r[0] for r in d.select(permute_string(F.col("s"), base, KEY, "t")).collect()]
        assert sorted(got) == sorted(words) and got != words
    long = spark.createDataFrame([("1" * 40,), ("",)], "s string").select(permute_string(F.col("s"), 10, KEY, "t")).collect()
    assert re.fullmatch("[0-9]{40}", long[0][0]) and long[1][0] == ""


def test_kinds(spark):
    valid = ["4111 1111 1111 1111", "4111111111111111", "378282246310005", "+1 (017) 555-7713", "und.34@mail7.example.com", "1.2.3.254",
             "2020-02-29", "31.12.1999", "01/02/1950", "123-45-6789", "DE89370400440532013000", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']
    invalid = ["4111111111111112", "1.2.3.256", "1.2.3.4.5", "2021-02-29", "99.99.2020", "666-45-6789", "000-45-6789", "DE00370400440532013000", "x@y",
               "12345", "v4.0"]
    rows = [(i, f"see {t}, ok") for i, t in enumerate(valid + invalid)]
    got = {r.doc_id: r.text for r in pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    out = [got[i][4:-4] for i in range(len(rows))]
    assert out[len(valid):] == invalid
    new = out[:len(valid)]
    assert all(a != b for a, b in zip(valid, new))
    for i in (0, 1, 2):
        assert luhn(new[i]) and re.sub(r"\d", "9", new[i]) == re.sub(r"\d", "9", valid[i])
    assert re.sub(" ", "", new[0]) == new[1]                       # the same number in another format stays linked
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[3]) and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", new[4])
    assert all(0 <= int(x) < 256 for x in new[5].split(".")) and datetime.date.fromisoformat(new[6])
    assert datetime.datetime.strptime(new[7], "%d.%m.%Y") and datetime.datetime.strptime(new[8], "%d/%m/%Y")
    area, group, serial = map(int, new[9].split("-"))
    assert 0 < area < 900 and area != 666 and group and serial
    digits = "".join(str(int(c, 36)) for c in new[10][4:] + new[10][:4])
    assert new[10][:2] == "DE" and int(digits) % 97 == 1
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', new[11])


VALUES = ["4111 1111 1111 1111", "378282246310005", "+1 (017) 555-7713", "und.34@mail7.example.com", "1.2.3.254", "2020-02-29", "01/02/1950",
          "123-45-6789", "DE89370400440532013000", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']


def test_values_at_the_end_of_a_sentence(spark):
    ends = ["", ".", "...", "!", "?", ",", ". Thanks", ")", "\n"]
    rows = [(f"Write to {v}{e}", v, e) for v in VALUES for e in ends]
    got = pseudonymise(spark.createDataFrame(rows, "text string, v string, e string"), KEY).collect()
    for r in got:
        assert [f.old for f in r.pii_found] == [r.v] and r.text == f"Write to {r.pii_found[0].new}{r.e}"
    labels = "x@" + "a." * 20_000
    assert pseudonymise(spark.createDataFrame([(labels,)], "text string"), KEY).first().text == labels


def check_found(spark, cases):
    """Each text with the values that must be found in it, in order; all the rest must stay."""
    got = pseudonymise(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string"), KEY).collect()
    for r in got:
        text, values = cases[r.i]
        assert [f.old for f in r.pii_found] == values, (text, r.pii_found)
        for f in r.pii_found:
            assert f.new != f.old and (f.kind != "card" or luhn(f.new))
            text = text.replace(f.old, f.new, 1)
        assert r.text == text


def test_values_beside_other_numbers(spark):
    card, amex, plain = "4111 1111 1111 1111", "3782-822463-10005", "4111111111111111"
    check_found(spark, [
        (f"{card} 123", [card]), (f"order 12 {card}", [card]), (f"12 {card} 34", [card]), (f"1234 5678 {card} 5678 99", [card]),
        (f"{plain} 01/02/1950", [plain, "01/02/1950"]), (f"{plain} 10.0.0.1", [plain, "10.0.0.1"]),
        (f"{plain} 123-45-6789 {amex}-12", [plain, "123-45-6789", amex]), (f"7 {amex} 2020-02-29 8", [amex, "2020-02-29"]),
        (f"{plain} 378282246310005 1", [plain, "378282246310005"]), (f"99.99.2020 {plain} 1.2.3.256", [plain]),
        ("411111 1111111111", ["411111 1111111111"]), (f"a@b.example, {card}, a@b.example.org", ["a@b.example", card, "a@b.example.org"])])


def test_printed_forms(spark):
    iban, card = "DE89 3704 0044 0532 0130 00", "4111 1111 1111 1111"
    phones = ["+33 1 23 45 67 89", "+44 (0)20 7946 0958", "+49 151 2345 67890", "+33612345678", "555-123-4567", "(555) 123-4567",
              "1-555-123-4567", "01 23 45 67 89", "030/1234567", "(020) 7946 0958"]
    check_found(spark, [(f"call {p}, ok", [p]) for p in phones] + [
        (f"pay {iban}.", [iban]), (f"{iban} {card}", [iban, card]), (f"{iban} 1234 NL91 ABNA 0417 1643 00 EUR", [iban, "NL91 ABNA 0417 1643 00"]),
        ("DE89370400440532013000", ["DE89370400440532013000"]), ("NO93 8601 1117 947", ["NO93 8601 1117 947"]),
        ("at 2020-02-29T10:00:00Z", ["2020-02-29"]), ("12/25/1990 and 25/12/1990", ["12/25/1990", "25/12/1990"]), ("02.29.2020", ["02.29.2020"]),
        (f"+1 017 555 7713 {card}", ["+1 017 555 7713", card]), (f"+33 1 23 45 67 89, {card}", ["+33 1 23 45 67 89", card]),
        ("DE00 3704 0044 0532 0130 00", []), ("born 31-12-1990, 2020/02/29", ["31-12-1990", "2020/02/29"]), ("to jö@example.com", ["jö@example.com"]),
        ("02/30/2020 13/13/2020 2020-02-29Tea 2020-02-29x", []), ("2.3.4 05.99.2020 1234567 01.02.03.999", [])])


def test_values_that_span_words(spark):
    """Letters alone, a keyword or a sign may stand in a word of a value without digits."""
    secret = 'token = "abcdefabcdefabcdef"'
    check_found(spark, [
        (f"my api_key : 'abcdefabcdefabcdef' and {secret}", ["api_key : 'abcdefabcdefabcdef'", secret]), (f"x1{secret} l'été", [secret]),
        ("pay NL91 ABNA 0417 1643 00 now", ["NL91 ABNA 0417 1643 00"]), (f"in 5 {secret}, 01/02/1950", [secret, "01/02/1950"]),
        ("no value here, l'été d'or \"quoted\" a=b", []), ("word " * 50 + "1.2.3.4 " + "word " * 50 + "x@y.org", ["1.2.3.4", "x@y.org"]),
        ("tab\t2020-02-29\nline 5\n030/1234567", ["2020-02-29", "030/1234567"])])


def test_printed_forms_stay_valid_and_linked(spark):
    rows = [("DE89 3704 0044 0532 0130 00",), ("DE89370400440532013000",), ("555-123-4567",), ("+1 555 123 4567",)]
    got = {r.v: r.text for r in pseudonymise(spark.createDataFrame(rows, "text string").selectExpr("text", "text as v"), KEY).collect()}
    grouped, plain, national, foreign = (got[r[0]] for r in rows)
    assert grouped.replace(" ", "") == plain and re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", grouped)
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert foreign == "+1 " + national.replace("-", " ")


def test_month_first_dates_are_permuted_among_themselves(spark):
    days = [datetime.date(1995, 1, 1) + datetime.timedelta(i) for i in range(1500)]
    rows = [(d.strftime(f),) for d in days for f in ("%m/%d/%Y", "%d/%m/%Y") if f == "%d/%m/%Y" or d.day > 12]
    got = [r.text for r in pseudonymise(spark.createDataFrame(rows, "text string").selectExpr("text", "text as v"), KEY).collect()]
    assert len(set(got)) == len(rows) == len(set(rows)) and sum(old == new for (old,), new in zip(rows, got)) < 5
    for (old,), new in zip(rows, got):
        assert datetime.datetime.strptime(new, "%m/%d/%Y" if int(old[3:5]) > 12 else "%d/%m/%Y") and (int(old[3:5]) > 12) == (int(new[3:5]) > 12)


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "4111111111111111", None), (3, "4111111111111111", None), (4, "x " * 100_000 + "4111111111111111", "c"),
            (5, "A.B1@C.COM a.b1@c.com", "d")]
    d = pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, pii_found string"), KEY)
    got = [(r.doc_id, r.text, len(r.pii_found)) for r in d.orderBy("doc_id").collect()]
    assert got[0][1:] == (None, 0) and got[1][1:] == ("", 0)
    assert got[2] == got[3] and got[4][1].endswith(got[2][1]) and got[4][2] == 1
    a, b = got[5][1].split(" ")
    assert a == b.upper() and a != "A.B1@C.COM"
    assert d.limit(0).collect() == []


def test_another_key_gives_other_pseudonyms(spark):
    d = spark.createDataFrame([(1, "call +1 (017) 555-7713")], "doc_id long, text string")
    assert pseudonymise(d, "a").first().text != pseudonymise(d, "b").first().text == pseudonymise(d, "b").first().text


def test_secret_without_digits(spark):
    d = spark.createDataFrame([(1, "password='abcdefabcdefabcdefab'")], "doc_id long, text string")
    r = pseudonymise(d, KEY).first()
    assert len(r.pii_found) == 1 and re.fullmatch("password='[0-9a-f]{20}'", r.text)


def test_luhn_sum(spark):
    d = spark.createDataFrame([("79927398713",), ("4111111111111112",)], "s string").select(luhn_sum(F.col("s")).alias("x")).collect()
    assert [r.x % 10 for r in d] == [0, 1]

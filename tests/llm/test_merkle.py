"""Merkle manifest: equal to a tree built in plain Python, for odd rows too."""

from hashlib import sha256
from zlib import crc32

from pyspark.sql import functions as F

from tadkit.llm.merkle import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def brute(rows):
    """Result rows by levels of whole trees."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    trees = {}
    for lang, rs in langs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        levels = [[leaf(*r) for r in rs]]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        trees[lang] = levels
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    high, out = [[trees[x][-1][0] for x in order]], []
    while len(high[-1]) > 1:
        high.append([h(high[-1][i:i + 2]) for i in range(0, len(high[-1]), 2)])
    root = high[-1][0]
    for lang, rs in langs.items():
        for i, r in enumerate(rs):
            touched = r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            now, proof = leaf(*r[:4], r[4] + 1) if touched else leaf(*r), []
            for part, i in ((trees[lang], i), (high, order.index(lang))):
                for level in part[:-1]:
                    other = level[i ^ 1] if i ^ 1 < len(level) else ""
                    now, i = h([other, now] if i & 1 else [now, other]), i // 2
                    proof.append(other)
            folded = now
            out.append((r[0], leaf(*r), trees[lang][-1][0], root, h(proof), folded, folded == root))
    return out


def check(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("leaf", F.lit(1)).withColumn("_one", F.lit(2))
    got = [tuple(r) for r in manifest(d).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(i, f"text {i} é", "en", "s", i) for i in range(20)]
    rows += [(None, None, None, None, None), (None, "", None, "s", 3), (7, "text 7 é", "en", "s", 7), (7, "other", "en", "s", 7),
             (3, "x" * 2_000_000, "", "", 5), (5, "a", "ø", "s", None), (2**62, "b", "z", None, -4)]
    check(spark, rows)


def test_several_segments(spark):
    """One lang holds most rows: its tree has several segments, one of them with a single node in its last run."""
    rows = [(i, f"t{i}", "en", "s", i) for i in range(700)] + [(i, "t", "fr", "s", i) for i in range(257)] + [(9, "t", "de", "s", 1)]
    check(spark, rows)


def test_equal_rows_share_records(spark):
    """Segments of equal rows have equal digests; each row is still proved once."""
    check(spark, [(4, "same", "en", "s", 4)] * 1100)


def test_subroots_are_put_together_two_at_a_time(spark):
    """One lang, three and several segments of langs: the root of one is its subroot."""
    check(spark, [(i, "t", "en", "s", i) for i in range(5)])
    check(spark, [(i, "t", ("en", "fr", None)[i % 3], "s", i) for i in range(9)])
    check(spark, [(i, "t", f"l{i % 300}", "s", i) for i in range(350)])


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_changed_text_breaks_the_proof_of_its_row_alone(spark):
    rows = [(i, "t", "en", "s", None) for i in range(40)]
    assert all(r.verified for r in manifest(spark.createDataFrame(rows, SCHEMA)).collect())
    rows = [(i, "t", "en", "s", 1) for i in range(40)]
    got = {r.doc_id for r in manifest(spark.createDataFrame(rows, SCHEMA)).collect() if not r.verified}
    assert got == {i for i in range(40) if crc32(str(i).encode()) % 7 == 0}

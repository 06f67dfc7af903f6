"""Near duplicates: known cases, edge cases and brute force."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tadkit.llm.bytetext import shingle_sets
from tadkit.llm.neardup import band_keys, components, drop_near_duplicates, jaccard_at_least, near_duplicates, signature

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(LOW))
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(texts):
    s = sets_of(texts)
    comp = {i: i for i in s}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(s[a] & s[b])
            if both and 100 * both >= 75 * (len(s[a]) + len(s[b]) - both):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i)) for i in ids}


def check(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_small_table_equals_brute_force(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()])


def test_chain_of_near_copies_and_a_hub_missing(spark):
    """Copies of a base that is not there, some of them linked to a few others only."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.choice(160, int(rng.integers(0, 12)), replace=False):
            w[at] = f"x{rng.integers(1 << 40)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([f"c{i + k}" for k in range(40)])) for i in range(40)]       # each links to its neighbours
    check(spark, rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "a b c d e"), (8, "A b\tC d e"), (9, "x" * 100_000)]
    check(spark, rows)
    d = spark.createDataFrame([(None, "q r s t u v", "k"), (3, "q r s t u v", None), (3, "q r s t u v", None), (9, "q r s t u v", "z")],
                              "doc_id long, text string, comp string")
    got = near_duplicates(d).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got) == sorted([(-1, None, True), (3, 3, True), (3, 3, True), (9, 3, False)])
    kept = drop_near_duplicates(d)
    assert kept.columns == d.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3]
    assert near_duplicates(d.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (300, 200)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 200: 100, 300: 100}


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.sets(st.integers(0, 2**63), min_size=1, max_size=60))
def test_jaccard_is_exact(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert jaccard_at_least(x, y, 75) == (100 * len(a & b) >= 75 * len(a | b))


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a = np.concatenate([both, rng.integers(0, 2**63, 200, dtype=np.uint64)])
    b = np.concatenate([both, rng.integers(0, 2**63, 200, dtype=np.uint64)])
    x, y = signature(a, 240, 11), signature(b, 240, 11)
    assert abs((x == y).mean() - 0.6) < 0.12
    assert len(set(band_keys(x, 48, 5)) & set(band_keys(y, 48, 5))) > 0


@pytest.mark.parametrize("texts", [["one two three four five six", "", None, "ÄÖ x y z", "a\x1cb c d e f"]])
def test_shingles_follow_the_definition(texts):
    import pyarrow as pa
    got = [len(s) for s in shingle_sets(pa.array(texts, pa.string()), 5)]
    assert got == [len(s) for s in sets_of(enumerate(texts)).values()]


@pytest.mark.parametrize("name", ["op3_warc_normalise", "op9_minhash_near_dedup"])
def test_against_sql(spark, name):
    from tadkit.llm.queries import ORACLE, QUERIES
    from tadkit.plans.verify import compare, duck
    st_ = compare(spark, duck(SMALL), name, QUERIES[name], ORACLE[name], SMALL)
    assert st_["status"].startswith("ok"), st_


def test_rows_of_one_id_with_other_texts_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, a), (5, b), (3, b), (7, a + " more"), (9, "quite another text of its own")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(d).collect()} == {(5, 3), (3, 3), (7, 3), (9, 9)}
    assert sorted(r.doc_id for r in drop_near_duplicates(d).collect()) == [3, 9]
    rows += [(11, a), (11, "one"), (11, "two words")]
    got = {(r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 3), (3, 3), (7, 3), (9, 9), (11, 3)}

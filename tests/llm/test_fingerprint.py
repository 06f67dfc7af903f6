"""Fingerprints: homomorphic, order-independent, and the edits against plain Python."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tadkit.llm.fingerprint import Fingerprint, compare_edits

SMALL = "/root/testdata/sf0.001"
PARAS = st.lists(st.text(st.characters(blacklist_characters="\n", blacklist_categories=["Cs"]), max_size=40), max_size=6)


@settings(max_examples=100, deadline=None)
@given(PARAS, PARAS, st.randoms())
def test_homomorphic(a, b, rnd):
    def of(paragraphs):
        return Fingerprint.of("\n".join(paragraphs).encode())
    both = a + b
    rnd.shuffle(both)
    assert of(both) == of(a) + of(b) and of(both) - of(b) == of(a)
    assert Fingerprint.parse(of(a).text()) == of(a) and of(a).likeness(of(a)) == 1.0


def edits(texts):
    for i, t in enumerate(texts):
        k = len(t) // 4
        yield (t[:len(t) - k] if k else t) + texts[(i + 1) % len(texts)][:k]


def check(got, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in rows]
    want = sorted((d, len(t), hashlib.sha256(e.encode()).hexdigest(), Fingerprint.of(t.encode()).text(), Fingerprint.of(e.encode()).text())
                  for (d, _), t, e in zip(rows, texts, edits(texts)) if d is not None)
    assert sorted(tuple(r)[:5] for r in got if r.doc_id is not None) == want and len(got) == len(rows)


def test_small_table(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = compare_edits(d.repartition(5), buckets=7).collect()
    check(got, [tuple(r) for r in d.collect()])
    assert sum(r.near_edited for r in got) / len(got) > 0.7 and sum(r.near_next for r in got) / len(got) < 0.1
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_edge_cases(spark):
    rows = [(None, "né"), (1, None), (1, "abcd\nefgh"), (1, "abcd\nefgh"), (2, ""), (5, "ü" * 100_000), (6, "\n\n")]
    d = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, bucket double")
    check(compare_edits(d).collect(), rows)
    check(compare_edits(d, buckets=1).collect(), rows)
    one = compare_edits(d.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert compare_edits(d.limit(0)).collect() == []
    zero = Fingerprint()
    assert zero.likeness(Fingerprint()) == 1.0 and zero.likeness(Fingerprint.of(b"abc")) == 0.0

"""Best-fit packing: every id once, whole documents, few sequences."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tadkit.llm.bestfit import ByteTokenizer, cut_lengths, openings, pack_best_fit, resolve, sweep

SMALL = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, id long, length string, seq int"


def ids(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


def check(rows, docs):
    """Pieces give back the ids of each document and sequences are gapless; the number of sequences and of tokens."""
    tok = Tokenizer.from_file(PATH)
    want = []
    for doc, text in docs:
        raw, at = ids(tok, text), 0
        for i, n in enumerate(cut_lengths(len(raw) // 4, 2048)):
            want.append((doc, i, at, n, zlib.crc32(raw[4 * at:4 * (at + n)])))
            at += n
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for ps in seqs.values():
        at = 0
        for offset, n in sorted(ps):
            assert offset == at
            at += n
        assert at <= 2048
    return len(seqs), sum(r.length for r in rows)


def test_documents(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    n, tokens = check(pack_best_fit(d, PATH).collect(), [tuple(r) for r in d.collect()])
    assert n <= 1.01 * -(-tokens // 2048)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " "), (None, "a  b\n \n c "), (None, "a  b\n \n c "), (4, "x" * 70_000), (5, "word " * 20_000),
            (6, "it's <|endoftext|>  they'll\t\tgo"), (6, "other text")]
    d = spark.createDataFrame([r + (0, "z", 1) for r in rows], SCHEMA)
    check(pack_best_fit(d, PATH).collect(), rows)


def test_empty_table(spark):
    assert pack_best_fit(spark.createDataFrame([], SCHEMA), PATH).count() == 0


@pytest.mark.parametrize(("words", "rows", "least"), [(699, 300, 150), (99, 600, 30), (1299, 50, 50)])
def test_one_length_holds_all_rows(spark, words, rows, least):
    docs = [(i, " ".join(["the"] * words)) for i in range(rows)]
    n, _ = check(pack_best_fit(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect(), docs)
    assert least <= n <= 1.04 * least + 1


def test_ids_with_the_pieces(spark):
    d = spark.createDataFrame([(1, "some words, and more")], "doc_id long, text string")
    assert pack_best_fit(d, PATH, with_ids=True).first().ids == ids(Tokenizer.from_file(PATH), "some words, and more")


_TEXT = st.text(st.one_of(st.sampled_from(list("ab.,'s 7\n\t éİ 　\x1ć'…")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(_TEXT, max_size=6))
def test_ids_are_those_of_the_tokenizer(texts):
    tok, words = Tokenizer.from_file(PATH) if not hasattr(check, "tok") else check.tok, getattr(check, "words", None) or ByteTokenizer(PATH)
    check.tok, check.words = tok, words
    got = words.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_character_is_taken_alike():
    """Letter, digit, blank or neither: both tokenizers must class each character the same way."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    tok, fast = Tokenizer.from_file(PATH), ByteTokenizer(PATH)
    for lo in (*range(0, 0x20000, 0x4000), 0x2FC00, 0x30000, 0xE0000):
        texts = [f"a{c}b1{c}2!{c}? {c} {c}{c} a'{c}s" for c in map(chr, range(lo, lo + 0x4000)) if not 0xD800 <= ord(c) < 0xE000]
        want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        assert fast.encode(texts) == want


def test_long_runs_of_blanks():
    tok, fast = Tokenizer.from_file(PATH), ByteTokenizer(PATH)
    for t in (" " * 400_000 + "a", "\n \t" * 100_000, "x" * 300_000, "a" + " " * 99_999):
        assert np.frombuffer(fast.encode([t])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 1), st.integers(1, 3)), max_size=40), st.integers(1, 5))
def test_buckets_match_as_one_sweep(rows, buckets):
    """Sweeps of ranges and the ranks between them place as many pieces as one sweep over all, each in a gap that holds it."""
    rows = sorted(rows, key=lambda r: (-r[0], r[1]))
    size, kind, slots = ([r[i] for r in rows] for i in range(3))
    whole, _ = sweep(size, kind, slots)
    cuts = [len(rows) * b // buckets for b in range(buckets + 1)]
    counts, placed = {}, 0
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        found, left = sweep(size[lo:hi], kind[lo:hi], slots[lo:hi])
        placed += sum(f >= 0 for f in found)
        assert all(size[lo + f] >= size[lo + i] for i, f in enumerate(found) if f >= 0)
        counts[b] = (sum(k == 1 and f < 0 for k, f in zip(kind[lo:hi], found)), sum(n for n, k in zip(left, kind[lo:hi]) if k == 0))
    met = resolve(counts)
    assert all(g < p for p, _, _, g, _ in met)
    assert placed + sum(m[2] for m in met) == sum(f >= 0 for f in whole)


def test_openings_follow_volume_and_what_fits_nowhere():
    assert openings({1500: 3, 100: 5}, {}, 2048) == (1500, 3)
    assert openings({100: 5}, {600: 1}, 2048) == (100, 0)
    assert openings({700: 4}, {600: 9}, 2048) == (700, 2)

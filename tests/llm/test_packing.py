"""Packing: every id once, in order, and little padding."""

import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tadkit.llm.packing import Packer, WordTokenizer, close_leftovers, pack

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs):
    """Pieces cover the ids of each document, sequences are gapless and bounded."""
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        ps = sorted(by_doc[doc], key=lambda r: r.start)
        at = 0
        for p in ps:
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids) // 4
            assert p.ids_crc32 == zlib.crc32(ids[4 * at:4 * (at + p.length)])
            at += p.length
        assert at == len(ids) // 4
    pad = total = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        total += at
        pad += 0 if at & (at - 1) == 0 else 2048 - at
    return pad / max(1, total)


def test_small_table(spark):
    d = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert check(pack(d.repartition(3), PATH).collect(), d.collect()) < 0.01


def test_edge_cases(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "word " * 30_000, None), (4, "x" * 5_000, 1), (5, " \n\t", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, offset long")
    check(pack(d, PATH).collect(), [r[:2] for r in rows])
    same = spark.createDataFrame([(7, "a b"), (7, "a b"), (None, "c")], "doc_id long, text string")
    got = pack(same, PATH).collect()
    assert sorted((r.doc_id or -1, r.length) for r in got) == [(-1, 2), (7, 3), (7, 3)]
    assert pack(same.limit(0), PATH).collect() == []
    assert pack(d, PATH, with_ids=True).where("ids is null").count() == 0


WORDS = st.lists(st.sampled_from(["Word", "İstanbul", "ΣΑΣ", "straße", "e\u0301te\u0301", "it's", "don't'", "'s", "a--", "1a", "x²", "<|endoftext|>", "\u3000", "\x1c",
                                  "ﬁn", "!!", "日本語", "\ue000", "end.", "\"q\"", "ǅ", "\u0301a"]), max_size=12).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | WORDS)
def test_words_give_the_ids_of_the_whole_text(text):
    want = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert WordTokenizer(PATH).encode([text, text + " " + text])[0] == want
    marked = WordTokenizer(PATH).encode(["\ue000 a\ue000 \ue000\ue000", "b"])
    assert marked[0] == np.array(Tokenizer.from_file(PATH).encode("\ue000 a\ue000 \ue000\ue000", add_special_tokens=False).ids, "<u4").tobytes()


def test_letters_that_are_more_in_lower_case_before_every_mark():
    odd = [chr(c) for c in range(0x30000) if chr(c).isalpha() and not chr(c).lower().isalpha()]
    assert "İ" in odd
    words = [f"{w}{m}" for c in odd for m in string.punctuation for w in (c, f"TAKS{c}", f"{c}a")] + ["TAKSİ. GAZETESİ, ok"]
    tok = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(words, add_special_tokens=False)]
    assert WordTokenizer(PATH).encode(words) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 6))
def test_bounded_space(lengths, space):
    p = Packer(32, space, 4)
    closed = []
    for i, n in enumerate(lengths):
        closed += p.add((i, 0, bytes(4 * n), n))
        assert len(p._gaps) <= space
    assert all(sum(len(q[2]) // 4 for q in w) > 28 for w in closed)
    closed += close_leftovers(list(p.leftovers()), 32)
    got = {}
    for w in closed:
        size = sum(len(q[2]) // 4 for q in w)
        assert size <= 32
        for doc, start, ids, _ in w:
            got.setdefault(doc, []).append((start, len(ids) // 4))
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(got[i]):
            assert start == at
            at += size
        assert at == n


@pytest.mark.parametrize("left", [1, 5, 31])
def test_last_window_is_cut_at_powers_of_two(left):
    sizes = [sum(len(q[2]) // 4 for q in w) for w in close_leftovers([[(0, 0, bytes(4 * left), left)]], 32)]
    assert sum(sizes) == left and all(s & (s - 1) == 0 for s in sizes)

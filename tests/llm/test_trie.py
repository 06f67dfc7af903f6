"""Prefix trie: equal to a trie built in plain Python, in one block and in many."""

import random
from hashlib import sha256
from zlib import crc32

import pytest

from tadkit.llm.trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, lang string, n_convs long"


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = 0 if c is None else crc32(str(c).encode()) % 6
        base = None if c is None else c - (abs(c) % 100) * (1 if c > 0 else -1)
        head = convs.get(base, []) if c is not None else []
        built[c] = tuple(head[:h] + own[h:])
    nodes = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes.setdefault(t[:d], []).append(c)
    least = {p: min((c for c in cs if c is not None), default=None) for p, cs in nodes.items()}
    kids = {p: 0 for p in nodes}
    leaves, saved = dict(kids), dict(kids)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, cs in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in nodes.items():
        ends = sorted((c for c in cs if built[c] == p), key=lambda c: (c is not None, c or 0))
        sha = sha256(",".join("null" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(cs), kids[p], leaves[p], saved[p], sha))
    return sorted(out, key=repr)


def got(spark, rows, **kw):
    d = prefix_trie(spark.createDataFrame([r + ("x", 1) for r in rows], SCHEMA), **kw)
    d = d.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in d.collect()), key=repr)


def talk(rng, n, words, long=0):
    """Conversations with few different turns, so that many share prefixes and some are equal."""
    rows = []
    for c in range(n):
        turns = rng.choice([0, 1, 2, 3, 5, 8]) + (long if c % 50 == 7 else 0)
        rows += [(c, t, rng.choice(["user", "assistant"]), f"t{rng.randrange(words)}é") for t in range(max(turns, 1))]
    return rows


@pytest.mark.parametrize("block_rows", [4096, 9])
def test_equals_a_trie_of_all_prefixes(spark, block_rows):
    rows = talk(random.Random(3), 250, 2, long=40)
    assert got(spark, rows, block_rows=block_rows) == brute(rows)


def test_many_copies_and_one_common_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)] + [(c, 0, "user", "same 0") for c in range(300, 500)]
    rows += [(c, 1, "user", f"own {c}") for c in range(300, 500)]
    assert got(spark, rows, block_rows=16) == brute(rows)


def test_nulls_repeats_and_missing_bases(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (205, 0, "user", "x"), (101, None, None, "n"), (101, 0, "user", None),
            (101, 0, "user", None), (100, 0, "user", "y" * 300_000), (-7, 3, "user", "neg"), (-101, 0, "u", "v"), (-100, 0, "u", "w"), (0, 0, "", "")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, block_rows=8) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []

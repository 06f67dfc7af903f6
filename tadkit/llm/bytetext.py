"""Vectorised work on the UTF-8 bytes of Arrow text columns.

Words are found and hashed with numpy over the bytes of many documents at
once; no Python string is made.  A word's hash is a polynomial over its bytes
modulo 2**64, read off prefix sums, and then mixed, so it does not depend on
where the word stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19          # bytes worked on at once (a longer text is worked on alone)
_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)


def _space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return t


SPACE = _space_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


def text_chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows, each of at most
    ``CHUNK_BYTES`` or of one row.  Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each run of ``inside`` bytes that stays within a
    row, and the number of words of each row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    n = len(data)
    up, down = _POWERS.get(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes other than ASCII white space, A-Z
    lower-cased) of all rows, and the number of words of each row."""
    starts, ends, counts = word_spans(data, offsets, ~SPACE[data])
    return hash_spans(LOWER[data], starts, ends), counts


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its ``width``-word shingles.

    A row of fewer words gives one hash of all its words, a row without words
    an empty set.
    """
    mult = np.uint64(0xD6E8FEB86659FD93)
    for _a, _b, data, offsets in text_chunks(column):
        words, counts = hash_words(data, offsets)
        ends = np.cumsum(counts)
        m = len(words) - width + 1
        if m > 0:
            sh = words[:m].copy()
            for j in range(1, width):
                sh = sh * mult + words[j:j + m]
            sh = mix(sh)
        for e, c in zip(ends.tolist(), counts.tolist()):
            s = e - c
            if c >= width:
                yield np.unique(sh[s:e - width + 1])
            elif c:
                h = np.uint64(c)
                with np.errstate(over="ignore"):
                    for w in words[s:e]:
                        h = h * mult + w
                yield mix(np.array([h ^ np.uint64(0x5851F42D4C957F2D)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)

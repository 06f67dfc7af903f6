"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps ``open_windows`` windows.  A piece goes to the window it
fits best; when none fits, the fullest is emitted.  Documents longer than a
window, and pieces that meet a window with a wide gap when none fits, are cut
so that their head closes the fullest window.  What stays open at the end of
a partition is merged with the leftovers of ``merge`` neighbouring partitions.
"""

from __future__ import annotations

import os
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.llm.common import prepare, written

CACHE_WORDS = 1_000_000      # words whose ids a worker remembers at most
CACHE_WORD_CHARS = 100       # longer ones are not remembered
_MARK = "\ue000"             # stands between words that are encoded together


class WordTokenizer:
    """Token ids of texts by a tokenizer that never joins text across blanks.

    Words between blanks and line ends are encoded once and remembered, which
    gives the ids of the whole text: the tokenizer drops white space and
    looks at nothing beyond it.  It also parts letters from the marks behind
    them, so a word of letters and such marks is put together from both.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._mark = np.array(self._ids_of([_MARK])[0], "<u4")
        vocabulary = self._tok.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, bool)         # ids that end a run of letters
        self._last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._ids: dict[str, bytes] = {"": b""}
        self._parts: dict[str, bytes] = {"": b""}

    def _ids_of(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word.  Words are encoded in one text, a mark between
        them; if the marks cannot be told from the words, one by one."""
        ids = np.array(self._ids_of([f" {_MARK} ".join(words)])[0], "<u4")
        m = len(self._mark)
        at = np.lib.stride_tricks.sliding_window_view(ids, m) if len(ids) >= m else np.zeros((0, m), "<u4")
        at = np.flatnonzero((at == self._mark).all(axis=1))
        if len(at) != len(words) - 1 or any(_MARK in w for w in words):
            return [np.array(i, "<u4").tobytes() for i in self._ids_of(words)]
        raw = ids.tobytes()
        starts, ends = [0, *(4 * (at + m)).tolist()], [*(4 * at).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(starts, ends)]

    def _encode_letters(self, runs: list[str]) -> list[bytes]:
        """Ids of each run of letters; each ends with an id that ends a run."""
        ids = np.array(self._ids_of([" ".join(runs)])[0], "<u4")
        ends = 4 * (np.flatnonzero(self._last[ids]) + 1)
        if len(ends) != len(runs):                                        # letters that fold to something else
            return self._encode_words(runs)
        raw, ends = ids.tobytes(), ends.tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: list[str]) -> None:
        simple, runs, marks, hard = [], [], [], []
        for w in words:
            run = w.rstrip(string.punctuation)
            if not run.isalpha():
                hard.append(w)
            elif run.isascii():
                simple.append(w)
                runs.append(run.lower())
                marks.append(w[len(run):])
            elif run.lower().isalpha():
                simple.append(w)
                runs.append(run)
                marks.append(w[len(run):])
            else:                                # more than letters in lower case: its marks meet those behind
                hard.append(w)
        parts = self._parts
        for known, new, encode in ((parts, set(runs).difference(parts), self._encode_letters),
                                   (parts, set(marks).difference(parts), self._encode_words), (self._ids, hard, self._encode_words)):
            new = list(new)
            for i in range(0, len(new), 2000):
                known.update(zip(new[i:i + 2000], encode(new[i:i + 2000])))
        self._ids.update(zip(simple, [parts[r] + parts[m] for r, m in zip(runs, marks)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words = set().union(*split) if split else set()
        new = words.difference(self._ids)
        if len(self._ids) + len(new) > CACHE_WORDS:
            self._forget()
            new = words.difference(self._ids)
        self._learn(list(new))
        get = self._ids.__getitem__
        out = [b"".join(map(get, ws)) for ws in split]
        for w in new:
            if len(w) > CACHE_WORD_CHARS:
                self._ids.pop(w, None)
                self._parts.pop(w, None)
        return out


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer, with what it remembers, for all its tasks."""
    return WordTokenizer(path)


class Packer:
    """Places pieces (doc, start, ids, doc_tokens) into windows of ``size`` tokens."""

    def __init__(self, size: int, open_windows: int, min_cut: int):
        self.size, self.limit, self.min_cut = size, open_windows, min_cut
        self._gaps: list[tuple[int, int]] = []           # (free tokens, window), ascending
        self._open: dict[int, list[tuple]] = {}
        self._next = count()

    def _new(self, piece: tuple) -> None:
        w = next(self._next)
        self._open[w] = [piece]
        insort(self._gaps, (self.size - len(piece[2]) // 4, w))

    def _emit(self) -> list[tuple]:
        """The fullest window, closed."""
        _, w = self._gaps.pop(0)
        return self._open.pop(w)

    def _cut(self, piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, start, ids, total = piece
        return (doc, start, ids[:4 * n], total), (doc, start + n, ids[4 * n:], total)

    def _fill(self, piece: tuple) -> tuple[list[tuple], tuple]:
        """The fullest window closed with the head of ``piece``; the rest of it."""
        gap, w = self._gaps[0]
        head, rest = self._cut(piece, gap)
        self._open[w].append(head)
        return self._emit(), rest

    def add(self, piece: tuple) -> Iterator[list[tuple]]:
        """Place a piece; yields the windows this closes."""
        if len(piece[2]) // 4 > self.size and self._gaps and self._gaps[0][0] >= self.min_cut:
            closed, piece = self._fill(piece)
            yield closed
        while len(piece[2]) // 4 > self.size:
            head, piece = self._cut(piece, self.size)
            yield [head]
        while True:
            n = len(piece[2]) // 4
            at = bisect_left(self._gaps, (n, -1))
            if at < len(self._gaps):                     # the least gap that holds it
                gap, w = self._gaps.pop(at)
                self._open[w].append(piece)
                if gap == n:
                    yield self._open.pop(w)
                else:
                    insort(self._gaps, (gap - n, w))
                return
            if len(self._gaps) < self.limit:
                self._new(piece)
                return
            if self._gaps[0][0] >= self.min_cut:
                closed, piece = self._fill(piece)
                yield closed
            else:
                yield self._emit()

    def leftovers(self) -> Iterator[list[tuple]]:
        """The open windows, fullest first."""
        while self._gaps:
            yield self._emit()


def close_leftovers(windows: list[list[tuple]], size: int) -> Iterator[list[tuple]]:
    """Refill windows one after the other, cutting pieces, until one partial
    window is left; it is cut at powers of two, which need no padding."""
    now, room = [], size
    cut = Packer(size, 1, 1)._cut
    for piece in (p for w in windows for p in w):
        while len(piece[2]) // 4 >= room:
            head, piece = cut(piece, room)
            yield [*now, head]
            now, room = [], size
        if piece[2]:
            now.append(piece)
            room -= len(piece[2]) // 4
    left = size - room
    while left:
        part, n = [], 1 << (left.bit_length() - 1)
        left -= n
        while n:
            piece = now.pop(0)
            if len(piece[2]) // 4 > n:
                piece, rest = cut(piece, n)
                now.insert(0, rest)
            part.append(piece)
            n -= len(piece[2]) // 4
        yield part


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [c.split()[0] for c in _PIECE.split(", ")] + ["ids", "partition"]


def _rows(windows: list[tuple[int | None, list[tuple]]], partition: int | None, with_ids: bool) -> pa.RecordBatch:
    """Pieces of windows (sequence id or None for leftovers, pieces) as a batch."""
    cols: list[list] = [[] for _ in _NAMES]
    for seq, pieces in windows:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            row = (doc, start, n, zlib.crc32(ids), total, seq, at, ids if with_ids or seq is None else None,
                   partition if seq is None else None)
            for c, v in zip(cols, row):
                c.append(v)
            at += n
    types = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=_NAMES)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, open_windows: int = 64, end_id: int = 1,
         min_cut: int = 32, merge: int = 64, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (its little-endian unsigned 32-bit ids, null unless
    ``with_ids``).  ``tokenizer`` is the file of a tokenizer that drops white space.

    * Null and empty texts are one token, ``end_id``.
    * Texts of any length are cut into windows; a worker holds the ids of one
      batch of documents and of the open windows.
    * Repeated rows and null doc_ids are packed each for itself.
    * An empty table gives no rows; extra columns are ignored.
    * A sequence is short of ``size`` by less than ``min_cut``, or of a length
      that is a power of two (the last ones of ``merge`` partitions).
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, number = Packer(size, open_windows, min_cut), count(part << 32)
        words = word_tokenizer(tokenizer)
        for batch in batches:
            closed = []
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, tokens in zip(ids, words.encode(texts)):
                tokens += end
                closed += [(next(number), w) for w in packer.add((doc, 0, tokens, len(tokens) // 4))]
            yield _rows(closed, part, with_ids)
        yield _rows([(None, w) for w in packer.leftovers()], part, with_ids)

    def last(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        rows = sorted(table.select(["doc_id", "start", "ids", "doc_tokens", "partition"]).to_pylist(),
                      key=lambda r: (-len(r["ids"]), r["partition"], r["doc_id"] is None, r["doc_id"] or 0, r["start"]))
        packer, number = Packer(size, open_windows, min_cut), count((1 << 30) + group << 32)
        closed = []
        for r in rows:
            closed += packer.add((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
        closed += close_leftovers(list(packer.leftovers()), size)
        return pa.Table.from_batches([_rows([(next(number), w) for w in closed], None, with_ids)]) \
            .drop_columns(["partition"])

    pieces = written(docs.mapInArrow(first, f"{_PIECE}, ids binary, partition long"), "pieces")
    merged = pieces.where("partition is not null").withColumn("group", F.expr(f"partition div {merge}")) \
        .groupBy("group").applyInArrow(last, f"{_PIECE}, ids binary")
    return pieces.where("partition is null").drop("partition").unionByName(merged)

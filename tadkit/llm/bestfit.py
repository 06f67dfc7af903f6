"""Bulk-synchronous best-fit packing of whole documents.

Documents longer than a sequence are cut; pieces of full length are sequences
by themselves.  The others are packed in supersteps.  Unplaced pieces and the
gaps of open sequences are range-sorted by size into buckets.  Each bucket is
swept once from its largest size down: a piece takes its successor, the
smallest free gap at or above its size.  Pieces that find none in their
bucket take what the buckets above have left, conflicts being resolved by rank:
the counts of each bucket say which ranks of pieces meet which ranks of gaps.
Then gaps are updated, sequences are opened for the largest pieces left if the
gaps cannot hold the rest, and the next superstep begins.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, count
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tadkit.llm.common import drop_table, prepare, written

LONG_RUN = 100_000           # characters of white space
LEAST_BUCKETS, BUCKET_ROWS, DRAWS = 16, 131_072, 4096

_BLANKS = re.compile(r"\s{%d}" % LONG_RUN)
# Fixed value: the pre-tokens of byte-level tokenizers.
_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECE = "id long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """Token ids of texts by the file of a byte-level tokenizer.

    The vocabulary is given to ``tiktoken``, whose pre-tokens and merges are the same
    and which is several times as fast.  Texts that hold an added token, or so long
    a run of white space that its pattern cannot pass over it, go through
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        added = {t.content for t in self._tok.get_added_tokens_decoder().values()}
        self._added = re.compile("|".join(map(re.escape, added)) if added else r"(?!)")
        spec, byte = json.loads(self._tok.to_str()), _byte_of()
        pre, model, vocabulary = spec["pre_tokenizer"] or {}, spec["model"], self._tok.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in added}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or merged != sorted(merged):
            raise ValueError(f"{path} is no byte-level tokenizer whose ids follow its merges")
        self._fast = Encoding("fast", pat_str=_PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for t in texts:
            if self._added.search(t) or (len(t) > LONG_RUN and _BLANKS.search(t)):
                ids = np.array(self._tok.encode(t, add_special_tokens=False).ids, "<u4")
            else:
                ids = self._fast.encode_to_numpy(t, disallowed_special=()).astype("<u4", copy=False)
            out.append(ids.tobytes())
        return out


@lru_cache(maxsize=1)
def byte_tokenizer(path: str) -> ByteTokenizer:
    """The worker's tokenizer, for all its tasks."""
    return ByteTokenizer(path)


def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones behind a first that may be shorter."""
    return ([n % size] if n % size else []) + [size] * (n // size)


def sweep(sizes: list[int], kinds: list[int], slots: list[int]) -> tuple[list[int], list[int]]:
    """One pass over rows in descending size, gaps (kind 0) before pieces (kind 1) of a size.

    Each piece takes a slot of the gap pushed last, the smallest that holds it.
    Gives for each piece the row of its gap, -1 if there is none, and for each gap the
    slots left.
    """
    found, left, free = [-1] * len(sizes), list(slots), []
    for i, kind in enumerate(kinds):
        if kind == 0:
            free.append(i)
        elif free:
            g = free[-1]
            found[i] = g
            left[g] -= 1
            if not left[g]:
                free.pop()
    return found, left


def resolve(counts: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of the pieces left in each bucket meet which ranks of the slots left above it.

    ``counts`` has (pieces, slots) left by bucket, buckets by descending size.  Rows: bucket of
    the pieces, first rank, number, bucket of the slots, first rank.
    """
    free: list[list[int]] = []
    out = []
    for bucket in sorted(counts):
        pieces, slots = counts[bucket]
        at = 0
        while at < pieces and free:
            n = min(pieces - at, free[-1][1])
            free[-1][1] -= n
            out.append((bucket, at, n, free[-1][0], free[-1][1]))
            at += n
            if not free[-1][1]:
                free.pop()
        if slots:
            free.append([bucket, slots])
    return out


def openings(pieces: dict[int, int], gaps: dict[int, int], size: int) -> tuple[int, int]:
    """(s, n): sequences are opened for all pieces longer than s and for n of those of length s.

    At least what does not fit any gap, by volume; of what the gaps cannot hold
    together half, so that later pieces still find gaps that suit them.
    """
    volume = sum(n * c for n, c in pieces.items())
    room = sum(n * c for n, c in gaps.items())
    widest = max(gaps, default=0)
    beyond = max(0, volume - room) / size
    need = max(ceil(beyond / 2 if beyond > 8 else beyond), ceil(sum(n * c for n, c in pieces.items() if n > widest) / size))
    if not gaps:
        need = max(need, sum(c for n, c in pieces.items() if 2 * n > size))
    for n in sorted(pieces, reverse=True):
        if need <= pieces[n]:
            return n, need
        need -= pieces[n]
    return 0, 0


def _sweeping(key: tuple, table: pa.Table) -> pa.Table:
    cols = {c: table.column(c).to_numpy() for c in ("size", "kind", "slots", "id")}
    order = np.lexsort((cols["id"], cols["kind"], -cols["size"].astype(np.int64)))
    size, kind, slots, ident = (cols[c][order] for c in ("size", "kind", "slots", "id"))
    found, left = sweep(size.tolist(), kind.tolist(), slots.tolist())
    found, left = np.array(found, np.int64), np.array(left, np.int64)
    piece = kind == 1
    lone = piece & (found < 0)
    rank = np.where(piece, np.cumsum(lone) - 1, np.cumsum(np.where(piece, 0, left)) - np.where(piece, 0, left))
    keep = piece | (left > 0)
    return pa.table({"bucket": pa.array(np.full(keep.sum(), key[0].as_py(), np.int32)), "kind": pa.array(kind[keep].astype(np.int32)),
                     "size": pa.array(size[keep].astype(np.int32)), "id": pa.array(ident[keep]),
                     "seq": pa.array(ident[np.maximum(found, 0)][keep], mask=(found < 0)[keep]),
                     "rank": pa.array(rank[keep]), "free": pa.array(np.where(piece, lone, left)[keep].astype(np.int64))})


_SWEPT = "bucket int, kind int, size int, id long, seq long, rank long, free long"


def superstep(state: DataFrame, step: int, size: int, pieces: dict[int, int], gaps: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Placements (id, seq, length) of a superstep and the state after it.

    ``state`` has kind (0 gap, 1 piece), size and id; ``pieces`` and ``gaps`` count its rows by size.
    """
    spark = state.sparkSession
    cut, need = openings(pieces, gaps, size)
    draw = F.pmod(F.xxhash64("id", F.lit(step)), F.lit(DRAWS))
    below, opened = 0, 0                                        # draws of length ``cut`` that are opened, and how many pieces that is
    if need:
        drawn = state.where((F.col("kind") == 1) & (F.col("size") == cut)).groupBy(draw.alias("draw")).count().collect()    # DRAWS rows at most
        for d, n in sorted(drawn):
            if opened < need:
                below, opened = d + 1, opened + n
    opens = (F.col("kind") == 1) & ((F.col("size") > cut) | ((F.col("size") == cut) & (draw < below)))
    marked = state.withColumn("opens", opens)
    left = {n: c for n, c in pieces.items() if n < cut} | ({cut: pieces[cut] - opened} if pieces.get(cut, 0) > opened else {})
    longest, shortest = max(left, default=size), min(left, default=1)
    now = marked.select(F.when(F.col("opens"), 0).otherwise(F.col("kind")).alias("kind"),
                        F.when(F.col("opens"), size - F.col("size")).otherwise(F.col("size")).cast("int").alias("room"), "id")
    now = now.where((F.col("kind") == 1) | (F.col("room") >= shortest))
    # A gap is offered as slots, each of which holds any piece left.
    slots = F.when(F.col("kind") == 0, F.greatest(F.lit(1), F.expr(f"room div {longest}"))).otherwise(1).cast("int")
    now = now.withColumn("slots", slots).withColumn("size", F.when(F.col("kind") == 0, F.expr("room div slots")).otherwise(F.col("room")).cast("int"))
    rows = _expected(pieces, gaps, cut, opened, size, longest, shortest)
    buckets = spark.createDataFrame(_buckets(rows, size), "size int, first int, parts int")       # a row a size at most
    dealt = now.join(F.broadcast(buckets), "size").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("bucket"), "kind", "size", "slots", "id")
    swept = written(dealt.groupBy("bucket").applyInArrow(_sweeping, _SWEPT), "swept")
    counts: dict[int, list[int]] = {}
    for r in swept.where("seq is null").groupBy("bucket", "kind").agg(F.sum("free").alias("n")).collect():    # two rows a bucket
        counts.setdefault(r.bucket, [0, 0])[1 - r.kind] = r.n
    met = resolve({b: tuple(c) for b, c in counts.items()})
    links = list(accumulate((m[2] for m in met), initial=0))
    schema = "bucket int, first long, last long, link long"
    ranks = spark.createDataFrame([(b, a, a + n, k) for (b, a, n, _, _), k in zip(met, links)], schema)
    slots = spark.createDataFrame([(b, a, a + n, k) for (_, _, n, b, a), k in zip(met, links)], schema)
    lone = swept.where("kind = 1 and seq is null").alias("p").join(
        ranks.alias("r"), F.expr("p.bucket = r.bucket and p.rank >= r.first and p.rank < r.last"), "left")
    lone = lone.selectExpr("p.size", "p.id", "r.link + p.rank - r.first as link")
    free = swept.where("kind = 0").alias("g").join(slots.alias("r"), F.expr("g.bucket = r.bucket and g.rank < r.last and g.rank + g.free > r.first"))
    free = free.selectExpr("g.id as seq", "explode(sequence(r.link + greatest(g.rank, r.first) - r.first, r.link + least(g.rank + g.free, r.last) - r.first - 1)) as link")
    across = lone.where("link is not null").join(free, "link").select("id", "seq", F.col("size").alias("length"))
    inside = swept.where("seq is not null").select("id", "seq", F.col("size").alias("length"))
    first = marked.where("opens").select("id", F.col("id").alias("seq"), F.col("size").alias("length"))
    placed = written(inside.unionByName(across).unionByName(first), "placed")
    rooms = now.where("kind = 0").select(F.col("id").alias("seq"), "room") \
        .unionByName(placed.where("id <> seq").select("seq", (-F.col("length")).alias("room"))) \
        .groupBy("seq").agg(F.sum("room").cast("int").alias("size")).where("size > 0")
    rest = lone.where("link is null").select(F.lit(1).alias("kind"), "size", "id") \
        .unionByName(rooms.select(F.lit(0).alias("kind"), "size", F.col("seq").alias("id")))
    after = written(rest, "state")
    drop_table(swept)
    return placed, after


def _expected(pieces: dict[int, int], gaps: dict[int, int], cut: int, opened: int, size: int, longest: int, shortest: int) -> dict[int, int]:
    """Rows by size that are dealt to buckets."""
    rooms, rows = dict(gaps), {}
    for n, c in pieces.items():
        new = c if n > cut else opened if n == cut else 0
        rooms[size - n] = rooms.get(size - n, 0) + new
        rows[n] = rows.get(n, 0) + c - new
    for n, c in rooms.items():
        if n >= shortest:
            n //= max(1, n // longest)
            rows[n] = rows.get(n, 0) + c
    return rows


def _buckets(rows: dict[int, int], size: int) -> list[tuple[int, int, int]]:
    """(size, first bucket, number of buckets): descending sizes share a bucket until it
    is full, a size with more rows gets several."""
    most = max(1, min(BUCKET_ROWS, sum(rows.values()) // LEAST_BUCKETS))
    out, bucket, held = [], 0, 0
    for n in range(size, 0, -1):
        here = rows.get(n, 0)
        parts = max(1, -(-here // most))
        if held and (parts > 1 or held + here > most):
            bucket, held = bucket + 1, 0
        out.append((n, bucket, parts))
        if parts > 1:
            bucket, held = bucket + parts, 0
        else:
            held += here
    return out


def pack_best_fit(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and ids, its little-endian unsigned 32-bit ids, if ``with_ids``).

    ``tokenizer`` is the file of a byte-level tokenizer.

    * Null and empty texts are one token, ``end_id``.
    * Documents of more than ``size`` tokens are cut into pieces of ``size``, the first of which may
      be shorter; others stay whole.
    * Repeated rows and null doc_ids are packed each for itself; equal lengths are dealt by hash.
    * An empty table gives no rows; extra columns are ignored.
    * A superstep is two shuffles of (size, id); as each either places pieces or opens
      sequences by volume, their number grows with the logarithm of the rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    names = [c.split()[0] for c in _PIECE.split(", ")] + ["ids"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        tok = byte_tokenizer(tokenizer)
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), tok.encode([t or "" for t in batch.column("text").to_pylist()])):
                tokens, start = tokens + end, 0
                for i, n in enumerate(cut_lengths(len(tokens) // 4, size)):
                    ids = tokens[4 * start:4 * (start + n)]
                    for c, v in zip(cols, (number, doc, i, start, n, zlib.crc32(ids), ids if with_ids else None)):
                        c.append(v)
                    start, number = start + n, number + 1
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    pieces = written(docs.mapInArrow(cut, f"{_PIECE}, ids binary"), "pieces")
    full = pieces.where(F.col("length") == size).select("id", F.col("id").alias("seq"), F.col("length").cast("int").alias("length"))
    state = pieces.where(F.col("length") < size).select(F.lit(1).alias("kind"), F.col("length").cast("int").alias("size"), "id")
    placed = full
    for step in count():
        counts: dict[int, dict[int, int]] = {0: {}, 1: {}}
        for r in state.groupBy("kind", "size").count().collect():        # two rows a size at most
            counts[r.kind][r.size] = r["count"]
        if not counts[1]:
            break
        now, after = superstep(state, step, size, counts[1], counts[0])
        placed = placed.unionByName(now)
        if step:
            drop_table(state)
        state = after
    before = F.sum("length").over(Window.partitionBy("seq").orderBy(F.col("length").desc(), "id").rowsBetween(Window.unboundedPreceding, -1))
    at = placed.select("id", F.col("seq").alias("sequence_id"), F.coalesce(before, F.lit(0)).cast("long").alias("offset"))
    out = pieces.join(at, "id").drop("id")
    return out if with_ids else out.drop("ids")

"""Near-duplicate documents by circulant MinHash.

One permutation scatters the shingles over ``bins`` positions; a second one,
``table``, gives each position its rank.  Coordinate k of the signature is the
least ``table[(position + k) mod bins]`` over a document's shingles: all
coordinates come from two permutations, the second shifted circularly.  The
coordinates are cut into bands; documents that share a band are candidates,
and every link is confirmed on the full sets of shingles.

Copies (equal sets) are one class with one signature.  The candidates of a band
are first compared with its hub, the member that meets most others, not with
each other.  What this links needs no further test.  Where bands of a hub still
hold several components, its members of different components are compared in
blocks, first by their whole signatures, then by the full sets of those that
may be similar, and only links are reported.  So no link between components is
lost, and a group of thousands of near copies costs about one comparison a
member, as far as they are similar to its hub.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.llm.bytetext import mix, shingle_sets
from tadkit.llm.common import drop_table, give_back, prepare, written
from tadkit.operators.graph import components

BINS = 1 << 20
SPLIT = 256          # members compared in one slice of a pivot's group
BLOCK = 512          # members of a hub in one block
BLOCK_SHINGLES = 2_000_000


@lru_cache(maxsize=2)
def _ranks(coords: int, seed: int) -> np.ndarray:
    """Row p holds the ranks of positions p .. p + coords - 1 (circular)."""
    table = np.random.default_rng(seed).permutation(BINS).astype(np.uint32)
    ring = np.concatenate([table, table[:coords - 1]])
    return np.lib.stride_tricks.sliding_window_view(ring, coords)


def signature(shingles: np.ndarray, coords: int, seed: int) -> np.ndarray:
    """Circulant MinHash signature of a non-empty set of 64-bit hashes."""
    ranks = _ranks(coords, seed)
    at = (mix(shingles ^ np.uint64(seed * 2 + 1)) >> np.uint64(44)).astype(np.int64)
    best = np.full(coords, BINS, np.uint32)
    for i in range(0, len(at), 2048):
        np.minimum(best, ranks[at[i:i + 2048]].min(axis=0), out=best)
    return best


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of the signature; the band's number is part of it."""
    parts = sig.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return h.view(np.int64)


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, width: int, bands: int, rows: int, seed: int) -> DataFrame:
    """doc_id, n (set size), d1 and d2 (128-bit digest of the set), keys (its
    bands), low (the low byte of each coordinate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, keys, low = [], [], [], [], []
            for s in shingle_sets(batch.column("text"), width):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    d1.append(int(mix(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                    d2.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                sig = signature(s, bands * rows, seed) if len(s) else None
                keys.append([] if sig is None else band_keys(sig, bands, rows))
                low.append(None if sig is None else sig.astype(np.uint8).tobytes())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                                   pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                                   pa.array(low, pa.binary())], names=["doc_id", "n", "d1", "d2", "keys", "low"])
        give_back()
    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, keys array<long>, low binary")


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (pivot, id) whose full sets reach the similarity.

    Each slice of a pivot's members is sorted behind the pivot's own text and
    streamed, so a task holds one pivot's set and one member at a time.
    """
    sized = pairs.withColumn("slice", F.expr(f"cast(pmod(xxhash64(id, 7), 1 + members div {SPLIT}) as int)"))
    heads = sized.select("pivot", "slice").distinct().join(texts.withColumnRenamed("id", "pivot"), "pivot") \
        .select("pivot", "slice", F.lit(None).cast("long").alias("id"), "text")
    tails = sized.join(texts, "id").select("pivot", "slice", "id", "text")
    rows = heads.unionByName(tails).repartition("pivot", "slice").sortWithinPartitions("pivot", "slice", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            found_p, found_i = [], []
            cols = [batch.column(c).to_pylist() for c in ("pivot", "slice", "id")]
            for p, s, i, bag in zip(*cols, shingle_sets(batch.column("text"), width)):
                if (p, s) != at:
                    at, own = (p, s), []
                if i is None:
                    own.append(bag)
                elif any(jaccard_at_least(o, bag, percent) for o in own):
                    found_p.append(p)
                    found_i.append(i)
            yield pa.record_batch([pa.array(found_p, pa.int64()), pa.array(found_i, pa.int64())], names=["pivot", "id"])
        own = []
        give_back()
    return rows.mapInArrow(run, "pivot long, id long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, bands: int = 48, rows: int = 5,
                    seed: int = 11) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    * Null and empty texts, and texts of white space: an empty set, linked
      with nothing.  Fewer than ``width`` words: one shingle of all of them.
    * Equal sets are linked whatever their order or number.
    * A null doc_id takes no part in links: component null, kept true.
    * Rows that repeat a doc_id count as one document, linked with whatever
      any of them is linked with; each row is returned.
    * Extra columns are ignored.

    A pair at the similarity of 0.75 shares none of 48 bands of 5 rows with
    probability (1 - 0.75**5)**48 = 2e-6, and less above it.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = written(sketch(docs, width, bands, rows, seed), "sketch")
    classes = sig.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("id"))
    classes = written(classes, "classes")

    # One row for each band of each class; only bands of two classes or more matter.
    rep = sig.where("n > 0").join(classes.select(F.col("id").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"],
                                  "left_semi")
    cells = rep.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"), "n")
    shared = cells.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    live = written(cells.join(shared, "key"), "cells")
    texts = written(docs.join(live.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
                    .select(F.col("doc_id").alias("id"), "text"), "texts")

    # Each member against its band's hub.
    hubs = live.groupBy("id").agg(F.sum("size").alias("met"), F.max("n").alias("n"))
    best = live.select("key", "id").join(hubs, "id").groupBy("key") \
        .agg(F.max(F.struct("met", "id", F.col("n").alias("pivot_n"))).alias("hub")) \
        .select("key", F.col("hub.id").alias("pivot"), F.col("hub.pivot_n").alias("pivot_n"))
    cast = written(live.select("key", "id", "n").join(best, "key"), "hubs")
    tries = cast.where(f"id <> pivot and 100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n)")
    star = written(_links(tries.select("pivot", "id").distinct(), texts, width, percent), "links")
    comp = written(components(star), "comp")

    # Members of different components that share a band, by the band's hub.
    cells = cast.select("key", "id", "n", "pivot").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = cells.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    left = cells.where("id <> pivot").join(mixed, "key", "left_semi").select(F.col("pivot").alias("hub"), "id", "n", "comp").distinct()
    left = left.join(left.groupBy("hub").agg(F.count("*").alias("size"), F.sum("n").alias("mass"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                     .where("lo < hi").select("hub", "size", "mass"), "hub")
    low = sig.where("n > 0").join(left.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi") \
        .select(F.col("doc_id").alias("id"), "low").distinct()
    rest = written(across(left.join(low, "id").join(texts, "id"), width, bands * rows, percent), "links")
    links = star.unionByName(rest)
    comp = written(components(links), "comp")
    for df in (live, cast, texts, star, rest):
        drop_table(df)

    joined = classes.join(comp, "id", "left").select("n", "d1", "d2", F.coalesce("comp", "id").alias("comp"))
    by_class = sig.select("doc_id", "n", "d1", "d2").join(joined, ["n", "d1", "d2"], "left")
    # Rows that repeat a doc_id with other texts link their components.
    several = by_class.where("doc_id is not null and comp is not null").groupBy("doc_id").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b")
    again = written(components(by_class.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("comp").alias("b")).where("b is not null")), "comp")
    by_class = by_class.join(again.select(F.col("id").alias("comp"), F.col("comp").alias("whole")), "comp", "left") \
        .withColumn("comp", F.coalesce("whole", "comp"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return by_class.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def across(members: DataFrame, width: int, coords: int, percent: int) -> DataFrame:
    """Links (a, b) between members of a hub that are of different components.

    ``members`` has hub, id, n, comp, size (members of the hub), mass (their shingles), low and text.
    A hub of more than ``BLOCK`` members, or ``BLOCK_SHINGLES`` shingles, is cut into blocks, and each
    pair of blocks is a group, which a task holds.  Signatures that agree in 4.5 standard
    deviations less than the coordinates expected at the similarity are passed
    over (3e-6 of those at the similarity, and fewer above it).  What a link
    joins within a group is one component from then on.
    """
    p = percent / 100
    least = int(coords * p - 4.5 * (coords * p * (1 - p)) ** 0.5)
    many = F.expr(f"cast(1 + greatest((size - 1) div {BLOCK}, mass div {BLOCK_SHINGLES}) as int)")
    m = members.withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), many).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), many - 1))) \
        .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") <= F.col("other")).alias("left"), "id", "n", "comp", "low", "text")
    m = m.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "id")

    def links(group: list[tuple], same: bool) -> Iterator[tuple[int, int]]:
        a = [g for g in group if g[3]]
        b = a if same else [g for g in group if not g[3]]
        if len({g[6] for g in group}) < 2 or not b:
            return
        ids, ns, comps = (np.array([g[k] for g in b], np.int64) for k in (4, 5, 6))
        low = np.frombuffer(b"".join(g[7] for g in b), np.uint8).reshape(len(b), coords)
        joined: dict[int, int] = {}

        def root(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c
        for g in a:
            ok = (comps != g[6]) & (100 * np.minimum(ns, g[5]) >= percent * np.maximum(ns, g[5]))
            at = np.flatnonzero(ok & (ids > g[4]) if same else ok)
            at = at[(low[at] == np.frombuffer(g[7], np.uint8)).sum(axis=1) >= least]
            for x in at.tolist():
                c, d = root(g[6]), root(b[x][6])
                if c != d and jaccard_at_least(g[8], b[x][8], percent):
                    joined[c] = d
                    yield g[4], b[x][4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def done() -> pa.RecordBatch:
            found = list(links(group, at[1] == at[2]))
            return pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8)), shingle_sets(batch.column("text"), width)):
                if row[:3] != at:
                    if group:
                        yield done()
                    at, group = row[:3], []
                group.append(row)
        if group:
            yield done()
        group = []
        give_back()
    return m.mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    counted = pairs.join(pairs.groupBy("pivot").agg(F.count("*").alias("members")), "pivot")
    return confirm(counted, texts, width, percent).select(F.col("pivot").alias("a"), F.col("id").alias("b"))


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component; rows without doc_id stay, and
    of rows that repeat a doc_id one stays."""
    gone = near_duplicates(docs, **settings).where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null")
    return named.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"]).select(docs.columns) \
        .unionByName(docs.where("doc_id is null"))

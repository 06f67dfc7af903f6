"""Homomorphic multiset hash of documents.

A document is the multiset of its paragraphs (non-empty lines).  Each
paragraph is hashed to a wide vector, and the document's fingerprint is the sum of
these vectors, lane by lane, modulo powers of two: the order of paragraphs
does not matter, and one is inserted or deleted by adding or subtracting its
vector.  16 lanes modulo 2**64 hold a cryptographic hash of the paragraph, for
equality; 256 lanes modulo 2**32 count its 8-byte shingles with random signs,
so that the cosine of two fingerprints estimates how much of the texts agrees.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.llm.bytetext import mix
from tadkit.llm.common import prepare

COUNT_LANES, HASH_LANES, WIDTH = 256, 16, 8
_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64)
_STEPS = [(1 << i, np.uint64(pow(_ODD, 1 << i, 1 << 64))) for i in range(3)]


class Fingerprint:
    """Sum of paragraph vectors; a zero sum is the empty document."""

    def __init__(self, counts: np.ndarray | None = None, hashes: np.ndarray | None = None):
        self.counts = np.zeros(COUNT_LANES, np.uint32) if counts is None else counts
        self.hashes = np.zeros(HASH_LANES, np.uint64) if hashes is None else hashes

    @classmethod
    def of(cls, text: bytes) -> Fingerprint:
        return cls(_shingle_counts(text), _paragraph_hashes(text))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        """With the other's paragraphs inserted."""
        return Fingerprint(self.counts + other.counts, self.hashes + other.hashes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        """With the other's paragraphs deleted."""
        return Fingerprint(self.counts - other.counts, self.hashes - other.hashes)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.counts == other.counts).all() and (self.hashes == other.hashes).all())

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the count lanes (0 if negative)."""
        if self == other:
            return 1.0
        a, b = self.counts.view(np.int32).astype(np.float64), other.counts.view(np.int32).astype(np.float64)
        norm = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0

    def text(self) -> str:
        return base64.b64encode(self.counts.astype("<u4").tobytes() + self.hashes.astype("<u8").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        return cls(np.frombuffer(raw[:4 * COUNT_LANES], "<u4").copy(), np.frombuffer(raw[4 * COUNT_LANES:], "<u8").copy())


def _paragraph_hashes(text: bytes) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(p, person=tag).digest() for p in text.split(b"\n") if p for tag in (b"a", b"b"))
    return np.frombuffer(raw, "<u8").reshape(-1, HASH_LANES).sum(axis=0, dtype=np.uint64)


def _shingle_counts(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(COUNT_LANES, np.uint32)
    line = data == 10
    h = _BYTE[data]
    for width, power in _STEPS:                 # windows of 2, 4, 8 bytes
        if len(h) <= width:
            h = h[:0]
            break
        h = h[:-width] * power + h[width:]
    if len(h):
        breaks = np.concatenate([[0], np.cumsum(line)])
        h = h[breaks[WIDTH:] == breaks[:-WIDTH]]
    short = [int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little")
             for p in text.split(b"\n") if 0 < len(p) < WIDTH]
    if short:
        h = np.concatenate([h, np.array(short, np.uint64)])
    at = (mix(h) & np.uint64(2 * COUNT_LANES - 1)).astype(np.int64)
    signed = np.bincount(at, minlength=2 * COUNT_LANES)
    return (signed[:COUNT_LANES] - signed[COUNT_LANES:]).astype(np.int32).view(np.uint32)


def _points(text: bytes) -> np.ndarray:
    """Byte offsets of the code points."""
    data = np.frombuffer(text, np.uint8)
    return np.flatnonzero((data & 0xC0) != 0x80)


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents laid out so that in each partition the rows of a bucket follow
    one another by doc_id, behind them (is_next = 1) the document that comes
    after the bucket; after the last comes the first."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("_at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    at = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(d.where("doc_id is not null").approxQuantile("_at", at, 0.2 / buckets))) if at else []
    splits = [float("-inf"), *cuts, float("inf")]
    d = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket").transform(d) if cuts else d.withColumn("_bucket", F.lit(0.0))
    d = d.withColumn("bucket", F.col("_bucket").cast("int")).drop("_bucket", "_at")
    # The first document of each bucket goes to the bucket before, too; as many rows as buckets.
    lows = d.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id")).alias("low"))
    filled = sorted(r["bucket"] for r in lows.select("bucket").collect())
    before = spark.createDataFrame([(b, filled[i - 1]) for i, b in enumerate(filled)], "bucket int, target int")
    firsts = d.join(F.broadcast(lows.select("bucket", F.col("low.doc_id").alias("low")).join(before, "bucket")), "bucket") \
        .where(F.col("doc_id").eqNullSafe(F.col("low"))).groupBy("target").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text")) \
        .select("doc_id", "text", F.col("target").alias("bucket"), F.lit(1).alias("is_next"))
    both = d.withColumn("is_next", F.lit(0)).unionByName(firsts)
    return both.repartitionById(len(splits) - 1, F.col("bucket")).sortWithinPartitions("bucket", "is_next", "doc_id", "text")


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def compare_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint of each text, of its edited text (the last quarter of its code
    points replaced by the first as many of the next document), and their likenesses.

    The edited fingerprint is made from the text's own by deleting the
    paragraphs from the edit on and inserting the new ones.

    * Null texts are empty; an empty text has the zero fingerprint, of
      likeness 1 to itself and 0 to others.
    * Documents follow by doc_id (null first), repeated ids by text; the next of
      the last is the first, so a single document is its own next.
    * Whole texts are used, one document and its next at a time.
    * An empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = with_next(docs, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(c) for c in ("doc_id", "text", "bucket", "is_next")]
            cols[1] = cols[1].cast(pa.binary())
            for doc, text, bucket, is_next in zip(*(c.to_pylist() for c in cols)):
                now = (doc, text, Fingerprint.of(text), _points(text), bucket)
                if held is not None and held[4] == bucket:
                    out.append(_edited(held, now))
                held = None if is_next else now
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 7, _TYPES)], names=_NAMES)
    return rows.mapInArrow(run, _OUT)


_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2


def _edited(own: tuple, after: tuple) -> tuple:
    doc, text, print_, points, _ = own
    n = len(points)
    k = n // 4
    cut = int(points[n - k]) if k else len(text)
    k_next = min(k, len(after[3]))
    new = after[1][:int(after[3][k_next]) if k_next < len(after[3]) else len(after[1])]
    edited = text[:cut] + new
    kept = text.rfind(b"\n", 0, cut) + 1               # whole paragraphs before the edit
    other = print_ - Fingerprint.of(text[kept:]) + Fingerprint.of(edited[kept:])
    return (doc, n, hashlib.sha256(edited).hexdigest(), print_.text(), other.text(), print_.likeness(other), print_.likeness(after[2]))

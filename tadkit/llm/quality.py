"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is described by measures of its
characters and words and encoded by a small network; gated attention, learned
from the labels of whole documents alone, weighs the encoded passages, and
the weighted sum is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tadkit.llm.bytetext import SPACE, hash_spans, text_chunks, word_spans
from tadkit.llm.common import give_back, prepare

PASSAGE_WORDS = 64
_GROUPS = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
           "stop": b".,;:?", "shout": b"!", "mark": b"#$%&*@^~", "rule": b"|_=+<>/\\[]{}", "quote": b"\"'()`-", "line": b"\n"}
_CLASS = np.full(256, len(_GROUPS), np.uint8)        # the last class: bytes of other letters
for _i, _chars in enumerate(_GROUPS.values()):
    _CLASS[list(_chars)] = _i
_CLASS[SPACE & (np.arange(256) != 10)] = len(_GROUPS) + 1
_N_CLASSES = len(_GROUPS) + 2
FEATURES = _N_CLASSES + 9


def passages(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, measures of each passage, number of passages of each row) of
    runs of rows.  A text without words is one passage of zeros."""
    for a, b, data, offsets in text_chunks(column):
        starts, ends, words = word_spans(data, offsets, ~SPACE[data])
        n = np.maximum(1, -(-words // PASSAGE_WORDS))
        rows = np.zeros((int(n.sum()), FEATURES))
        if len(starts):
            of_doc = np.repeat(np.arange(b - a), words)
            first_word = np.cumsum(words) - words
            first_passage = np.cumsum(n) - n
            in_doc = np.arange(len(starts)) - first_word[of_doc]
            passage = first_passage[of_doc] + in_doc // PASSAGE_WORDS
            heads = np.flatnonzero(np.diff(passage, prepend=-1))
            at = passage[heads]
            # Bytes from a passage's first word to the next passage or the document's end.
            lo = starts[heads]
            hi = np.minimum(np.append(lo[1:], len(data)), offsets[1:][of_doc[heads]])
            of_byte = np.append(_CLASS[data], np.uint8(_N_CLASSES))
            cuts = np.stack([lo, hi], axis=1).ravel()
            sums = [np.add.reduceat(of_byte == c, cuts, dtype=np.int64)[::2] for c in range(_N_CLASSES)]
            share = np.stack(sums, axis=1) / (hi - lo)[:, None]
            length = (ends - starts).astype(np.float64)
            h = hash_spans(data, starts, ends)
            again = np.zeros(len(h))
            again[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
            order = np.lexsort((h, passage))
            new = np.ones(len(h))
            new[1:] = (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])
            head, tail = _CLASS[data[starts]], _CLASS[data[ends - 1]]
            per_word = np.stack([length, length > 14, again, head == 1, (head == 1) & (tail == 1), (tail >= 3) & (tail <= 6),
                                 (tail == 5) | (tail == 4), length <= 2], axis=1).astype(np.float64)
            count = np.diff(np.append(heads, len(starts)))
            means = np.add.reduceat(per_word, heads, axis=0) / count[:, None]
            means[:, 0] /= 10
            distinct = np.add.reduceat(new, heads) / count
            rows[at] = np.concatenate([share, means, distinct[:, None]], axis=1)
        yield a, rows, n


def _segments(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionModel:
    """Encoder, gated attention and score of bags of passages."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int, gate: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = [rng.standard_normal((FEATURES, hidden)) * 0.3, np.zeros(hidden), rng.standard_normal((hidden, gate)) * 0.3,
                  rng.standard_normal((hidden, gate)) * 0.3, rng.standard_normal(gate) * 0.3, rng.standard_normal(hidden) * 0.3, np.zeros(1)]

    def forward(self, x: np.ndarray, n: np.ndarray) -> tuple:
        w, b, v, u, g, c, d = self.p
        first, bag = _segments(n)
        xs = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(xs @ w + b)
        t, s = np.tanh(h @ v), _sigmoid(h @ u)
        e = (t * s) @ g
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return xs, h, t, s, a, z, z @ c + d, bag, first

    def scores(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(x, n)[6])

    def gradient(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, g, c, d = self.p
        xs, h, t, s, a, z, logit, bag, first = self.forward(x, n)
        dl = (_sigmoid(logit) - y) * weight
        dz = dl[:, None] * c
        dh = a[:, None] * dz[bag]
        da = (h * dz[bag]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, ds = de[:, None] * g * s * (1 - t * t), de[:, None] * g * t * s * (1 - s)
        dh += dt @ v.T + ds @ u.T
        dx = dh * (1 - h * h)
        return [xs.T @ dx, dx.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ dl, dl.sum(keepdims=True)]


def train(bags: list[np.ndarray], y: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, seed: int = 3) -> AttentionModel:
    """Adam over batches of bags; both labels weigh the same in all."""
    x = np.concatenate(bags)
    model = AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3, hidden, gate, seed)
    rng = np.random.default_rng(seed)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    m, v, t = [np.zeros_like(q) for q in model.p], [np.zeros_like(q) for q in model.p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        for i in range(0, len(order), 64):
            at = order[i:i + 64]
            grads = model.gradient(np.concatenate([bags[k] for k in at]), np.array([len(bags[k]) for k in at]), y[at], weight[at] / len(at))
            t += 1
            for j, grad in enumerate(grads):
                grad = grad + 1e-4 * model.p[j]
                m[j] = 0.9 * m[j] + 0.1 * grad
                v[j] = 0.999 * v[j] + 0.001 * grad * grad
                model.p[j] = model.p[j] - rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = 8000, seed: int = 3) -> AttentionModel | float:
    """Fits on at most ``train_rows`` labelled documents, up to half of them of each label,
    chosen by hash, and on all of their passages; of rows that repeat a doc_id one is taken.
    With labels of one kind, or none, the share of label 1 (0.5) is the score of every text."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    draw = F.xxhash64("doc_id", F.lit(seed))
    chosen = known.where("quality > 0").orderBy(draw, "doc_id").limit(train_rows // 2) \
        .unionByName(known.where("quality <= 0").orderBy(draw, "doc_id").limit(train_rows // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("quality").to_pylist()
            bags: list[bytes] = []
            for _a, rows, n in passages(batch.column("text")):
                bags += [rows[i:i + k].astype(np.float32).tobytes() for i, k in zip(np.cumsum(n) - n, n)]
            yield pa.record_batch([pa.array(y, pa.int32()), pa.array(bags, pa.binary()), batch.column("doc_id")], names=["y", "bag", "doc_id"])
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text")).mapInArrow(run, "y int, bag binary, doc_id long").toArrow()
    rows = sorted(zip(sample.column("doc_id").to_pylist(), sample.column("y").to_pylist(), sample.column("bag").to_pylist()))
    y = np.array([r[1] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return train([np.frombuffer(r[2], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in rows], y, seed=seed)


def score_quality(docs: DataFrame, model: AttentionModel | float, out: str = "score") -> DataFrame:
    """``docs`` (all columns) with ``out``: the model's probability of label 1 for each whole text.

    * Null and empty texts, and texts of white space, are one passage of zeros.
    * Repeated rows get equal scores; an empty table gives no rows.
    * A column named ``out`` is replaced.
    """
    prepare(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name != out]
    d = docs.select(*[f.name for f in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for a, rows, n in passages(batch.column("text").cast(pa.string())):
                score[a:a + len(n)] = model.scores(rows, n) if isinstance(model, AttentionModel) else model
            yield pa.record_batch([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, out])
        give_back()
    return d.mapInArrow(run, d.withColumn(out, F.lit(0.0)).schema)


def quality_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.5) of every document."""
    prepare(docs.sparkSession)
    model = fit_quality(docs, labels, **settings)
    scored = score_quality(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows predicted to be of label 0.

    Null and empty texts are scored like one passage of zeros, repeated rows alike; an empty
    table stays empty, and all columns, also one named score, stay as they are.
    """
    prepare(docs.sparkSession)
    own = "_quality_score"
    while own in docs.columns:
        own += "_"
    return score_quality(docs, fit_quality(docs, labels, **settings), own).where(F.col(own) >= 0.5).select(docs.columns)

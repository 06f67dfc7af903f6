"""Severity of toxic language by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector over sparse
word features is shared by all ordered thresholds.  The score is the expected
severity, the sum over k of P(grade > k).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.llm.bytetext import LOWER, hash_spans, mix, text_chunks, word_spans
from tadkit.llm.common import prepare

DIMS = 1 << 20
STEMS = (4, 5, 6, 7)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True


def word_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashed features, features of each row) of runs of rows.

    Words are runs of letters, lower-cased in ASCII and Latin-1.  Each gives
    itself and, for the many forms of inflected words, its beginnings of
    ``STEMS`` bytes.
    """
    for a, _b, data, offsets in text_chunks(column):
        starts, ends, words = word_spans(data, offsets, _LETTER[data])
        low = LOWER[data]
        if len(data):
            accent = np.flatnonzero(data[:-1] == 0xC3) + 1            # À to Þ are C3 80 to C3 9E
            up = accent[(data[accent] >= 0x80) & (data[accent] <= 0x9E) & (data[accent] != 0x97)]
            low[up] += 0x20
        kinds = [hash_spans(low, starts, ends)]
        for k, stem in enumerate(STEMS, 1):
            # A word that is no longer gives itself again, which counts once.
            cut = np.minimum(starts + stem, ends)
            kinds.append(np.where(cut < ends, mix(hash_spans(low, starts, cut) + np.uint64(k)), kinds[0]))
        yield a, (np.stack(kinds, axis=1).ravel() >> np.uint64(44)).astype(np.int32), words * len(kinds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Weights by hashed word, and ascending thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def above(self, margin: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return _sigmoid(margin[:, None] - self.thresholds[None, :])

    def table(self) -> np.ndarray:
        t = np.zeros(DIMS)
        t[self.words] = self.weights
        return t


def _loss_slope(margin: np.ndarray, grade: np.ndarray, theta: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the negative log likelihood by margin and by threshold."""
    edges = np.concatenate([[-np.inf], theta, [np.inf]])
    hi, lo = _sigmoid(edges[grade + 1] - margin), _sigmoid(edges[grade] - margin)
    p = np.maximum(hi - lo, 1e-12)
    d_hi, d_lo = hi * (1 - hi) / p * weight, lo * (1 - lo) / p * weight
    by_theta = np.array([d_lo[grade == k + 1].sum() - d_hi[grade == k].sum() for k in range(len(theta))])
    return d_hi - d_lo, by_theta


def fit_ordinal(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, l1: float = 2e-3, l2: float = 2e-5, steps: int = 300,
                weight: np.ndarray | None = None) -> OrdinalModel:
    """Proximal gradient with an L1 penalty picks the words; they are refitted with a light L2 penalty.

    ``weight`` gives the documents' shares (equal ones, if None).  Below a tenth of documents
    above grade 0 the penalty falls with their share, as the slope of their words does."""
    grades, n = int(grade.max()) + 1, len(grade)
    weight = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    share = np.bincount(grade, weight, minlength=grades)
    l1 *= min(1.0, 10 * (1 - share[0]))
    vocabulary, column = np.unique(feature, return_inverse=True)
    toxic = np.bincount(column, grade[row] > 0, len(vocabulary))
    useful = toxic >= max(3, 0.002 * (grade > 0).sum())       # words seldom seen with a grade tell nothing
    theta0 = np.log(np.cumsum(share)[:-1].clip(1e-6, 1 - 1e-6) / (1 - np.cumsum(share)[:-1]).clip(1e-6, 1))

    def descend(use: np.ndarray, l1: float, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.flatnonzero(use)
        pos = np.full(len(use), -1)
        pos[ids] = np.arange(len(ids))
        on = pos[column] >= 0
        r, c = row[on], pos[column[on]]
        w, theta = np.zeros(len(ids)), theta0.copy()
        gw, gt = np.full(len(ids), 1e-8), np.full(len(theta), 1e-8)
        for k in range(steps):
            dm, dt = _loss_slope(np.bincount(r, w[c], n), grade, theta, weight)
            # The slope is taken of the negative log likelihood: margin up, low grades less likely.
            g = np.bincount(c, dm[r], len(ids)) + l2 * w
            gw, gt = 0.9 * gw + 0.1 * g * g, 0.9 * gt + 0.1 * dt * dt
            rate = 0.05 * (1 - k / steps)               # or words come and go with the last bits of the sums
            step = rate / (np.sqrt(gw) + 1e-4)
            w = w - step * g
            w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            theta = np.maximum.accumulate(theta - rate * dt / (np.sqrt(gt) + 1e-4) + 1e-9 * np.arange(len(theta)))
        return ids, w, theta
    ids, w, theta = descend(useful, l1, 0.0, steps)
    chosen = np.zeros(len(vocabulary), bool)
    chosen[ids[np.abs(w) > 0.05]] = True
    if chosen.any():
        ids, w, theta = descend(chosen, 0.0, l2, steps)
    return OrdinalModel(vocabulary[ids], w, theta)


def severity_grades(row: np.ndarray, feature: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades of documents labelled toxic or not: 0 for clean ones, 1 for toxic
    ones, 2 for those toxic ones that hold more marked features than the median
    of them.  Marked are the features that 5 % of the toxic documents hold and
    that are at least 20 times as frequent there as in clean ones."""
    vocabulary, column = np.unique(feature, return_inverse=True)
    bad = np.bincount(column, toxic[row], len(vocabulary)) / max(1, toxic.sum())
    clean = np.bincount(column, 1 - toxic[row], len(vocabulary)) / max(1, (1 - toxic).sum())
    marked = (bad >= 0.05) & (bad >= 20 * clean)
    hits = np.bincount(row, marked[column], len(toxic))
    return np.where(toxic == 1, 1 + (hits > np.median(hits[toxic == 1])), 0).astype(np.int64)


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = 8000, seed: int = 3) -> OrdinalModel:
    """Fits on at most ``train_rows`` labelled documents and all their features: up to half of
    them toxic and half clean, chosen by hash and weighed by the shares of both among all
    labels; of rows that repeat a doc_id one is taken.  Labels above 1 are taken for grades as they are; without a toxic label every severity is 0."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    draw = F.xxhash64("doc_id", F.lit(seed))
    chosen = known.where("toxic > 0").orderBy(draw, "doc_id").limit(train_rows // 2) \
        .unionByName(known.where("toxic <= 0").orderBy(draw, "doc_id").limit(train_rows // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for _a, features, words in word_features(batch.column("text")):
                for e, k in zip(np.cumsum(words), words):
                    bags.append(np.unique(features[e - k:e]).tobytes())
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array(bags, pa.binary())], names=["doc_id", "toxic", "bag"])
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).mapInArrow(run, "doc_id long, toxic int, bag binary").toArrow()
    rows = sorted(zip(*(sample.column(c).to_pylist() for c in ("doc_id", "toxic", "bag"))))
    label = np.array([max(0, r[1]) for r in rows], np.int64)
    bags = [np.frombuffer(r[2], np.int32) for r in rows]
    if not label.any():
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.array([40.0, 40.0]))
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    feature = np.concatenate(bags).astype(np.int64)
    every = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    bad = label > 0
    weight = np.where(bad, every / bad.sum(), (1 - every) / max(1, (~bad).sum()))
    return fit_ordinal(row, feature, label if label.max() > 1 else severity_grades(row, feature, label), weight=weight)


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected), grade (most probable), p_toxic (of any grade
    above 0), toxic (p_toxic >= 0.5) of every document; a word counts once.

    * Null and empty texts and texts without letters have no feature: the
      severity of the thresholds alone.
    * Whole texts are scored, each row for itself; repeated rows agree.
    * An empty table gives no rows; extra columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            margin = np.zeros(batch.num_rows)
            for a, features, words in word_features(batch.column("text")):
                hot = np.flatnonzero(table[features])
                row = np.repeat(np.arange(len(words)), words)[hot]
                key = np.unique(row * DIMS + features[hot])
                margin[a:a + len(words)] = np.bincount(key // DIMS, table[key % DIMS], len(words))
            above = model.above(margin)
            p = -np.diff(np.concatenate([np.ones((len(margin), 1)), above, np.zeros((len(margin), 1))], axis=1), axis=1)
            yield pa.record_batch([batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(p.argmax(axis=1), pa.int32()),
                                   pa.array(above[:, 0].copy()), pa.array(above[:, 0] >= 0.5)],
                                  names=["doc_id", "severity", "grade", "p_toxic", "toxic"])
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Severity of every document by a model fitted to ``labels.toxic``."""
    prepare(docs.sparkSession)
    return score_toxicity(docs, fit_toxicity(docs, labels, **settings))

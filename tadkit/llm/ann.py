"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts; a small
classifier learns the part of a vector.  Every row is indexed under its most
probable part; a query goes to its several most probable parts, where it is
compared with all rows by the exact measure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tadkit.llm.common import prepare, written

BLOCK_ROWS = 4096        # rows of a part in one block
BLOCK_QUERIES = 1024     # queries of a part in one block


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ids of the ``k`` rows of largest inner product with each row, itself aside."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a:a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, levels: int, rng: np.random.Generator) -> np.ndarray:
    """2**levels parts of equal size (within one) by recursive bisection: the
    slowest mixing direction of the graph, cut at its median, then exchanges
    of the nodes that gain most by moving."""
    n, k = graph.shape
    src, dst = np.repeat(np.arange(n), k), graph.ravel()
    part = np.zeros(n, np.int64)
    for _ in range(levels):
        both = part[src] == part[dst]
        a = np.concatenate([src[both], dst[both]])
        b = np.concatenate([dst[both], src[both]])
        degree = np.bincount(a, minlength=n) + 1e-9
        size = np.bincount(part, minlength=part.max() + 1)

        def centred(v: np.ndarray) -> np.ndarray:
            mean = np.bincount(part, v * degree, len(size)) / np.bincount(part, degree, len(size))
            v = v - mean[part]
            return v / (np.sqrt(np.bincount(part, v * v, len(size)))[part] + 1e-12)
        v = centred(rng.standard_normal(n))
        for _ in range(60):
            v = centred(0.5 * v + 0.5 * np.bincount(a, v[b], n) / degree)

        def median_cut(score: np.ndarray) -> np.ndarray:
            order = np.lexsort((np.arange(n), score, part))
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n) - first[part[order]]
            return (rank >= (size[part] + 1) // 2).astype(np.int64)
        side = median_cut(v)
        for _ in range(8):
            pull = np.bincount(a, 2.0 * side[b] - 1, n) / degree
            new = median_cut(pull + 0.3 * (2 * side - 1) + 1e-3 * v)
            if (new == side).all():
                break
            side = new
        part = 2 * part + side
    return part


class Router:
    """A network of one hidden layer that gives the probable parts of vectors."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, seed: int, hidden: int = 128, epochs: int = 60):
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        self.scale = 1.0 / (np.abs(x).sum() / max(1, x.size) + 1e-12)
        p = [rng.standard_normal((d, hidden)) / np.sqrt(d), np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden),
             np.zeros(parts)]
        m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        xs = x * self.scale
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            rate = 3e-3 * (1 - epoch / epochs) + 1e-5
            for a in range(0, len(x), 256):
                at = order[a:a + 256]
                h = np.maximum(xs[at] @ p[0] + p[1], 0)
                g = _softmax(h @ p[2] + p[3])
                g[np.arange(len(at)), part[at]] -= 1
                g /= len(at)
                gh = (g @ p[2].T) * (h > 0)
                t += 1
                for i, grad in enumerate((xs[at].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    grad = grad + 1e-4 * p[i]
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    p[i] = p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.p = p

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x * self.scale) @ self.p[0] + self.p[1], 0)
        return h @ self.p[2] + self.p[3]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(sample: np.ndarray, parts: int, recall: float, neighbours: int, seed: int) -> tuple[Router, int]:
    """A router of at most ``parts`` parts, and the number of parts to probe so
    that rows kept aside find ``recall`` of their neighbours in the sample."""
    rng = np.random.default_rng(seed)
    held = len(sample) // 9
    test, x = sample[:held], sample[held:]
    levels = max(0, min(int(np.log2(parts)), int(np.log2(max(len(x), 1) / 16)) if len(x) >= 32 else 0))
    if not levels:
        return Router(x, np.zeros(len(x), np.int64), 1, seed, epochs=0), 1
    graph = neighbour_graph(x, min(neighbours, len(x) - 1))
    router = Router(x, balanced_parts(graph, levels, rng), 1 << levels, seed)
    own = router.logits(x).argmax(axis=1)
    near = np.argpartition(-(test @ x.T), min(2 * neighbours, len(x)) - 1, axis=1)[:, :2 * neighbours]
    place = np.argsort(np.argsort(-router.logits(test), axis=1), axis=1)
    ranks = np.take_along_axis(place, own[near], axis=1).ravel()
    found = np.cumsum(np.bincount(ranks, minlength=1 << levels)) / len(ranks)
    return router, int(min(np.searchsorted(found, recall) + 1, 1 << levels))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, dim)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k rows of ``c`` nearest to each query, itself aside: exact inner
    products, ties to smaller ids.  Equal vectors are compared once; of each
    the k + 1 smallest ids can be among the nearest."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], np.ascontiguousarray(c[order])
    _, first, which = np.unique(c.view(np.dtype((np.void, c.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    u = c[first]
    members = np.argsort(which, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(which))])
    s = q @ u.T
    slack = 1e-9 * (np.abs(q).sum(axis=1) * np.abs(u).max() + 1e-300)
    keep = min(k + 1, len(u))
    floor = np.partition(s, len(u) - keep, axis=1)[:, len(u) - keep] - slack
    out: tuple[list, list, list] = ([], [], [])
    for i, own in enumerate(q_ids.tolist()):
        at = np.flatnonzero(s[i] >= floor[i])
        exact = (u[at] * q[i]).sum(axis=1)
        sizes = np.minimum(bounds[at + 1] - bounds[at], k + 1)
        if (sizes == 1).all():
            ids, scores = c_ids[members[bounds[at]]], exact
        else:
            ids = np.concatenate([c_ids[members[bounds[a]:bounds[a] + n]] for a, n in zip(at, sizes)])
            scores = np.repeat(exact, sizes)
        other = ids != own
        ids, scores = ids[other], scores[other]
        top = np.lexsort((ids, -scores))[:k]
        out[0].extend([own] * len(top))
        out[1].extend(ids[top].tolist())
        out[2].extend(scores[top].tolist())
    return out


def nearest(vectors: DataFrame, query: str = "vec_id % 20 = 0", k: int = 20, parts: int = 32, sample_rows: int = 9216,
            recall: float = 0.94, neighbours: int = 10, seed: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k rows of largest inner
    product found for each row that fulfils ``query``.

    ``sample_rows`` rows, chosen by hash, are fetched to fit the index; all
    rows are indexed.  Parts are searched in blocks of ``BLOCK_ROWS`` rows and
    ``BLOCK_QUERIES`` queries, however large they are.

    * Vectors that are null, zero, or hold nulls, NaN or infinities, those of
      a length other than the commonest, and rows without vec_id take no part.
    * Of rows that repeat a vec_id the one of the least vector takes part.
    * Ties go to the smaller vec_id; fewer rows than k give fewer neighbours.
    * An empty table gives no rows; extra columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine & F.exists("v", lambda x: x != 0))
    v = written(v.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    dims = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = dims["d"] if dims else 1
    v = v.where(F.size("v") == dim)
    sample = v.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample_rows).select("v").toArrow()
    x = _matrix(sample.column("v").combine_chunks(), dim) if len(sample) else np.zeros((0, dim))
    router, probes = fit(x, parts, recall, neighbours, seed)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                part = router.logits(_matrix(b.column("v"), dim)).argmax(axis=1)
                yield pa.record_batch([b.column("vec_id"), pa.array(part, pa.int64()), b.column("v")], names=["vec_id", "part", "v"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                logit = router.logits(_matrix(b.column("v"), dim))
                best = np.argsort(-logit, axis=1, kind="stable")[:, :probes]
                at = pa.array(np.repeat(np.arange(b.num_rows), best.shape[1]))
                yield pa.record_batch([b.column("vec_id").take(at), pa.array(best.ravel(), pa.int64()), b.column("v").take(at)],
                                      names=["vec_id", "part", "v"])
    indexed = written(v.mapInArrow(index, "vec_id long, part long, v array<double>"), "indexed")
    queries = v.where(query).mapInArrow(route, "vec_id long, part long, v array<double>")

    # Blocks of each part; one row for each part comes to the driver.
    rows = indexed.groupBy("part").agg(F.count("*").alias("n"), F.count(F.when(F.expr(query), 1)).alias("q"))
    total = rows.agg(F.sum("q")).first()[0] or 0
    sizes = rows.select("part", F.expr(f"cast(1 + (n - 1) div {BLOCK_ROWS} as int)").alias("cbs"))
    qbs = 1 + int(total * min(1.0, probes / max(1, len(router.p[3])))) // BLOCK_QUERIES
    c = indexed.join(F.broadcast(sizes), "part") \
        .withColumn("cb", F.pmod(F.xxhash64("vec_id", F.lit(1)), "cbs").cast("int")) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qbs - 1)))).select("part", "cb", "qb", "vec_id", "v")
    q = queries.join(F.broadcast(sizes), "part") \
        .withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(qbs)).cast("int")) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("cbs") - 1))).select("part", "cb", "qb", "vec_id", "v")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple = ([], [], [])
        if len(left) and len(right):
            found = best_of_block(*(f(t) for t in (left, right) for f in (
                lambda t: np.asarray(t.column("vec_id")), lambda t: _matrix(t.column("v").combine_chunks(), dim))), k)
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])
    block = ["part", "cb", "qb"]
    found = q.groupBy(*block).cogroup(c.groupBy(*block)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

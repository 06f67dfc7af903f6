"""Clustering, segmentation and anomaly detection.

* k-means / bisecting k-means / Gaussian mixtures are ``pyspark.ml``.
* The kNN classifier scores queries in Arrow batches against the rows it is fitted
  on, or by the metric index of ``operators.metric`` if they are many; DBSCAN finds
  neighbours by that index, as does exact k nearest.  None makes a table of pairs.
* Isolation trees are grown one group per tree on bounded samples, which is
  that algorithm's definition.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tadkit.operators import metric
from tadkit.operators.metric import MetricIndex, around, build_index, in_radius, k_nearest, meet, vectors, within
from tadkit.session import written


# ---------------------------------------------------------------------------
# vector helpers on array<double>
def to_array(col: str) -> Column:
    return F.col(col).cast("array<double>")


def distance(a, b, p: float = 2.0) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    if p == 2:
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))
    if p == 1:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v)
    s = F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(p))), F.lit(0.0), lambda s, v: s + v)
    return F.pow(s, F.lit(1.0 / p))


def mean_vector(df: DataFrame, vec: str, by: Sequence[str] = (), out: str = "centroid") -> DataFrame:
    """Element-wise mean of an array column per group (partial-aggregated)."""
    by = list(by)
    x = df.select(*by, F.posexplode(vec).alias("_i", "_v"))
    g = x.groupBy(*by, "_i").agg(F.avg("_v").alias("_m"))
    return g.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias(out))


# N1 / N2 ---------------------------------------------------------------------
def kmeans(df: DataFrame, features: str, k: int, seed: int = 42, pred: str = "cluster"):
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=pred).fit(df)


def elbow_table(spark, df: DataFrame, features: str, ks: Sequence[int], seed: int = 42) -> DataFrame:
    """Inertia (training cost) and silhouette (squared Euclidean, Spark's
    definition) for each k on a cached input."""
    base = df.select(features).cache()
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="cluster")
    rows = []
    for k in ks:
        m = kmeans(base, features, k, seed)
        rows.append((int(k), float(m.summary.trainingCost), float(ev.evaluate(m.transform(base)))))
    base.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def silhouettes(df: DataFrame, key: str, vec: str, cluster: str) -> DataFrame:
    """Silhouette of every row (squared Euclidean): key, cluster, silhouette.

    A row's mean squared distance to a cluster follows from the cluster's count, sum
    and sum of squared norms, so no pairs are made; one such row a cluster is held
    by every task.  The only row of a cluster has 0, as has every row where there is one
    cluster.  Rows without vector or cluster are dropped.
    """
    x = df.filter(F.col(vec).isNotNull() & F.col(cluster).isNotNull()).select(key, cluster, to_array(vec).alias("_x"))
    sq = F.aggregate("_x", F.lit(0.0), lambda s, v: s + v * v)
    stats = x.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("sq")).join(mean_vector(x, "_x", [cluster], "m"), cluster).collect()
    at = {r[cluster]: i for i, r in enumerate(stats)}
    n, sq = np.array([r.n for r in stats], float), np.array([r.sq for r in stats])
    total = np.array([r.m for r in stats], float).reshape(len(stats), -1) * n[:, None]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["_x"]).astype(float) if len(b) else np.zeros((0, total.shape[1]))
            own, rows = b[cluster].map(at).to_numpy(int), np.arange(len(b))
            far = np.maximum(n * (v * v).sum(axis=1)[:, None] - 2 * v @ total.T + sq, 0)          # sums of squared distances
            a = far[rows, own] / np.maximum(n[own] - 1, 1)
            mean = far / n
            mean[rows, own] = np.inf
            other = mean.min(axis=1)
            top = np.maximum(a, other)
            s = np.where((n[own] > 1) & np.isfinite(other) & (top > 0), (other - a) / np.where(top > 0, top, 1), 0.0)
            yield pd.DataFrame({key: b[key], cluster: b[cluster], "silhouette": s})
    types = dict(x.dtypes)
    return x.mapInPandas(score, f"`{key}` {types[key]}, `{cluster}` {types[cluster]}, silhouette double")


def silhouette_spread(scores: DataFrame, cluster: str) -> DataFrame:
    """Per cluster: rows, least silhouette, quartiles, mean and the share below 0."""
    from tadkit.operators.aggregate import grouped_quantiles
    scores = written(scores, "silhouettes")
    q = grouped_quantiles(scores, [cluster], "silhouette", [0.25, 0.5, 0.75], alias="q")
    q = q.groupBy(cluster).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    s = scores.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.min("silhouette").alias("least"), F.avg("silhouette").alias("mean"),
                                    F.avg((F.col("silhouette") < 0).cast("double")).alias("negative_share"))
    return s.join(q, cluster)


# N3 ------------------------------------------------------------------------
def cluster_indices(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Davies-Bouldin and Calinski-Harabasz from centroids and two aggregates."""
    x = df.select(cluster, to_array(vec).alias("_x"))
    cen = mean_vector(x, "_x", [cluster], "_c")
    gm = mean_vector(x, "_x", [], "_g")
    j = x.join(cen, cluster)
    per = j.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.avg(distance("_x", "_c")).alias("s"),
                                 F.sum(F.pow(distance("_x", "_c"), 2)).alias("w"))
    per = per.join(cen, cluster)
    a = per.select(F.col(cluster).alias("i"), F.col("s").alias("si"), F.col("_c").alias("ci"))
    b = per.select(F.col(cluster).alias("j"), F.col("s").alias("sj"), F.col("_c").alias("cj"))
    # the index is defined over all pairs of clusters, of one summary row each
    pairs = a.join(b, F.col("i") != F.col("j")).withColumn("_r", (F.col("si") + F.col("sj")) / distance("ci", "cj"))
    db = pairs.groupBy("i").agg(F.max("_r").alias("_m")).agg(F.avg("_m")).scalar()
    g = F.array(*[F.lit(float(v)) for v in gm.first()["_g"]])   # one d-vector, bounded
    tot = per.agg(F.sum(F.col("n") * F.pow(distance("_c", g), 2)).alias("B"), F.sum("w").alias("W"),
                  F.sum("n").alias("N"), F.count(F.lit(1)).alias("K"))
    ch = (F.col("B") / (F.col("K") - 1)) / (F.col("W") / (F.col("N") - F.col("K")))
    return tot.select(db.alias("davies_bouldin"), ch.alias("calinski_harabasz"), "K", "N")


# N4 / N5 -----------------------------------------------------------------------
def gmm_table(spark, df: DataFrame, features: str, ks: Sequence[int], seed: int = 42) -> DataFrame:
    """Log-likelihood, BIC and AIC of full-covariance mixtures for each k."""
    base = df.select(features).cache()
    n = base.count()
    d = len(base.first()[0])
    rows = []
    for k in ks:
        m = GaussianMixture(k=k, seed=seed, featuresCol=features).fit(base)
        ll = float(m.summary.logLikelihood)
        params = k * d + k * d * (d + 1) / 2 + (k - 1)
        rows.append((int(k), ll, -2 * ll + params * math.log(n), -2 * ll + 2 * params))
    base.unpersist()
    return spark.createDataFrame(rows, "k int, log_likelihood double, bic double, aic double")


def mixture_outliers(df: DataFrame, features: str, k: int, min_share: float = 0.05, seed: int = 42) -> DataFrame:
    """Drop rows whose mixture component holds less than ``min_share`` of rows."""
    m = GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="_comp").fit(df)
    pred = m.transform(df)
    shares = pred.groupBy("_comp").agg(F.count(F.lit(1)).alias("_n"))
    n = shares.agg(F.sum("_n")).scalar()
    keep = shares.filter(F.col("_n") / n >= min_share).select("_comp")
    return pred.join(keep, "_comp", "left_semi").drop("_comp", "probability")


# N6 ------------------------------------------------------------------------
def bisecting(df: DataFrame, features: str, k: int, seed: int = 42):
    return BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)


_KNN_BLOCK = 64              # queries scored at once


# M12 / L12 / O11 -------------------------------------------------------------------
def _k_nearest(q_ids: Iterable, q: Iterable, ref_ids: Sequence, ref: np.ndarray, k: int, p: float, exclude_self: bool) -> pd.DataFrame:
    """The k of ``ref`` (ids ascending) nearest to each query.

    Euclidean distances of a block of queries are first had by one matrix product, which is a
    little off; the references that may be among the k by it are then measured exactly.
    """
    out: list[tuple] = []
    near = min(len(ref_ids), k + int(exclude_self))
    own, xs = list(q_ids), [np.asarray(x, float) for x in q] if near else []
    norms = (ref * ref).sum(axis=1)
    fast = p == 2 and bool(np.isfinite(norms).all())
    top, head = norms.max(initial=0), min(len(ref_ids), 32 * near)

    def measured(i: int, at: np.ndarray | slice) -> np.ndarray:
        gap = np.abs(ref[at] - xs[i])
        return np.sqrt((gap * gap).sum(axis=1)) if p == 2 else gap.max(axis=1) if np.isinf(p) else (gap ** p).sum(axis=1) ** (1 / p)

    for start in range(0, len(xs), _KNN_BLOCK):
        block = xs[start:start + _KNN_BLOCK]
        squares = np.array([(x * x).sum() for x in block])
        rough = None
        if fast and np.isfinite(squares).all():
            rough = np.stack(block) @ ref.T
            rough *= -2
            rough += norms                                     # less the query's own square, the same in a row
            off = 2e-12 * (squares + top)
            bound = np.partition(rough[:, :head], near - 1, axis=1)[:, near - 1] + off
        for r in range(len(block)):
            i, among = start + r, slice(None)
            if rough is not None:
                among = np.flatnonzero(rough[r] <= bound[r])
                left = rough[r, among]
                among = among[left <= np.partition(left, near - 1)[near - 1] + off[r]]
            dist = measured(i, among)
            at = np.flatnonzero(dist <= np.partition(dist, near - 1)[near - 1])        # ids ascend, so ties go to the smaller
            at = at[np.argsort(dist[at], kind="stable")]
            ids = at if rough is None else among[at]
            found = [(ref_ids[j], float(v)) for j, v in zip(ids, dist[at]) if not (exclude_self and ref_ids[j] == own[i])][:k]
            out += [(own[i], j, v, n) for n, (j, v) in enumerate(found, 1)]
    return pd.DataFrame(out, columns=["query_id", "ref_id", "dist", "rank"])


knn_exact = k_nearest           # among all references


def knn(queries: DataFrame, refs: DataFrame, key: str, vec: str, k: int, p: float = 2.0, exclude_self: bool = False,
        held_rows: int = 100_000) -> DataFrame:
    """k nearest references of every query row, among all references: (query_id, ref_id, dist, rank),
    by Minkowski distance ``p``, ties to the smaller ref_id.

    Up to ``held_rows`` references are held as one matrix by every task, which scores queries in Arrow
    batches; more of them are searched by the metric index (``k_nearest``).  Both are exact.
    """
    spark = refs.sparkSession
    kt, rt = dict(queries.dtypes)[key], dict(refs.dtypes)[key]
    q = queries.filter(F.col(vec).isNotNull()).select(F.col(key).alias("query_id"), to_array(vec).alias("x"))
    refs = refs.filter(F.col(key).isNotNull() & F.col(vec).isNotNull()).select(F.col(key).alias("id"), to_array(vec).alias("x"))
    if refs.count() > held_rows:
        return _knn_searched(q, refs, k, p, exclude_self)
    train = refs.toArrow()
    ids = train.column("id").to_pylist()
    order = np.argsort(np.asarray(ids), kind="stable") if ids else np.zeros(0, int)
    ids = [ids[i] for i in order]
    m = vectors(train.column("x"))[order] if ids else np.zeros((0, 0))
    held = spark.sparkContext.broadcast((ids, m))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ref_ids, ref = held.value
        for pdf in batches:
            yield _k_nearest(pdf["query_id"], pdf["x"], ref_ids, ref, k, p, exclude_self)
    return q.mapInPandas(search, f"query_id {kt}, ref_id {rt}, dist double, rank int")


def _knn_searched(q: DataFrame, refs: DataFrame, k: int, p: float, exclude_self: bool) -> DataFrame:
    """``knn`` by the metric index: a query row is known by a number, as keys may repeat or be null."""
    q = written(q.withColumn("id", F.monotonically_increasing_id()), "query-rows")
    own = refs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] if exclude_self else 0      # references a query must leave out, at most
    near = k_nearest(q.select("id", "x"), refs, "id", "x", k + own, p).withColumnRenamed("query_id", "id")
    near = near.join(q.select("id", "query_id"), "id")
    if exclude_self:
        near = near.filter(~F.col("query_id").eqNullSafe(F.col("ref_id"))) \
            .withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("dist", "ref_id"))).filter(F.col("rank") <= k)
    return near.select("query_id", "ref_id", "dist", "rank")


# N8 ------------------------------------------------------------------------
def dbscan(df: DataFrame, key: str, vec: str, eps: float, min_samples: int = 5, p: float = 2.0, cells: int | None = None) -> DataFrame:
    """DBSCAN labels (noise = -1), clusters numbered by their smallest core key
    (an integer column).

    1. Points of one small box (side eps / d**(1/p) over all d dimensions) are
       neighbours, so a box of ``min_samples`` points has core points only; the
       others look for ``min_samples`` neighbours, in the nearest cells first, and
       compare no more once they have them.
    2. Core points of a box are one node, known by its least key.  Nodes are linked in
       the nearest cells first; then those outside the largest component so found meet all
       others.  A task compares no points that it knows to be connected.
    3. Components of the nodes by ``graph.components``, however many rounds that
       takes; border points take the smallest label among their core neighbours.

    Neighbours are found by the metric index (``metric.meet``) over all
    coordinates, of which ``cells`` is the number of cells.  Rows without key or vector are dropped.
    """
    index, x = _indexed(df, key, vec, p, cells)
    return _dbscan(index, x, key, eps, min_samples)


def _indexed(df: DataFrame, key: str, vec: str, p: float, cells: int | None = None) -> tuple[MetricIndex | None, DataFrame]:
    x = df.select(F.col(key).alias("id"), to_array(vec).alias("x")).filter("id is not null and x is not null")
    return build_index(x.withColumn("tag", F.col("id").cast("long")), "x", p, cells)


def _passes(p: float, whole: bool) -> tuple:
    """Whether to be quick, pass by pass; if not ``whole``, quick is all."""
    return (False,) if p == 2 else (True, False) if whole else (True,)


def _count_to(enough: int, p: float, whole: bool = True):
    """Neighbours of each left point (a, n): of those that have ``enough`` not all, and if not ``whole`` perhaps too few."""
    def visit(tags: np.ndarray):
        found: list[tuple] = []

        def feed(own, x, bound, columns, y, allowed):
            total = np.zeros(len(own), np.int64)
            for quick in _passes(p, whole):
                total[few := np.flatnonzero(total < enough)] = 0
                for at in range(0, len(y), metric.TILE_ROWS):
                    few = few[total[few] < enough]
                    if not len(few):
                        break
                    i, _ = within(x[few], y[at:at + metric.TILE_ROWS], bound[few], p, quick)
                    total[few] += np.bincount(i, minlength=len(few))
            found.append((own, total))
        return feed, lambda: [np.concatenate([f[i] for f in found]) if found else np.array([], np.int64) for i in (0, 1)]
    return visit


def _linked(p: float, whole: bool = True):
    """Pairs (a, b) by which the left and right tags that have points in reach of each other are connected; if
    not ``whole``, perhaps not all of them are."""
    def visit(tags: np.ndarray):
        names, node = np.unique(tags, return_inverse=True)
        others: dict[int, int] = {}                      # left tags that are no right ones
        root = np.arange(len(names))                     # of each of both, as far as linked

        def numbers(own):
            nonlocal root
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            for i in np.flatnonzero(names[at] != own):
                at[i] = others.setdefault(int(own[i]), len(names) + len(others))
            if len(root) < len(names) + len(others):
                root = np.concatenate([root, np.arange(len(root), len(names) + len(others))])
            return at

        def link(a, b):
            nonlocal root
            a, b = root[a], root[b]
            pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
            if not pairs.shape[1]:
                return
            up: dict[int, int] = {}

            def top(v):
                while (w := up.get(v, v)) != v:
                    up[v] = up.get(w, w)
                    v = w
                return v
            for v, w in pairs.T.tolist():
                v, w = top(v), top(w)
                if v != w:
                    up[max(v, w)] = min(v, w)
            to = np.arange(len(root))
            to[list(up)] = [top(v) for v in list(up)]
            root = to[root]

        def feed(own, x, bound, columns, y, allowed):
            mine, theirs = numbers(own), node[columns]
            for quick in _passes(p, whole):
                for at in range(0, len(y), metric.TILE_ROWS):
                    there, other = theirs[at:at + metric.TILE_ROWS], y[at:at + metric.TILE_ROWS]
                    a, b = root[mine], root[there]
                    seen, n = np.unique(b, return_counts=True)
                    most = seen[n.argmax()]               # what belongs to it already is not compared with each other
                    for rows, some in ((a != most, np.ones(len(b), bool)), (a == most, b != most)):
                        if rows.any() and some.any():
                            i, j = within(x[rows], other[some], bound[rows], p, quick)
                            link(mine[rows][i], there[some][j])

        def close():
            ids = np.concatenate([names, np.array(list(others), names.dtype)])
            moved = np.flatnonzero(root != np.arange(len(root)))
            return [ids[moved], ids[root[moved]]]
        return feed, close
    return visit


def _least(p: float):
    """The least tag in reach of each left point (id, tag)."""
    def visit(tags: np.ndarray):
        found: list[tuple] = []

        def feed(own, x, bound, columns, y, allowed):
            low = np.full(len(own), np.iinfo(np.int64).max)
            for at in range(0, len(y), metric.TILE_ROWS):
                i, j = within(x, y[at:at + metric.TILE_ROWS], bound, p)
                np.minimum.at(low, i, tags[columns[at + j]])
            some = low < np.iinfo(np.int64).max
            found.append((own[some], low[some]))
        return feed, lambda: [np.concatenate([f[i] for f in found]) if found else np.array([], np.int64) for i in (0, 1)]
    return visit


def _dbscan(index: MetricIndex | None, x: DataFrame, key: str, eps: float, min_samples: int) -> DataFrame:
    """``dbscan`` of indexed points (id, x, tag, cell)."""
    from tadkit.operators.frame import add_row_id
    from tadkit.operators.graph import components
    if index is None:
        return x.select(F.col("id").alias(key), F.lit(-1).alias("cluster"))
    p = index.p
    side = (eps if np.isinf(p) else eps / index.pivots.shape[1] ** (1 / p)) * (1 - 1e-12)
    box = F.transform("x", lambda v: F.floor(v / side))
    x = x.withColumn("box", box)
    x = written(x.join(x.groupBy("box").agg(F.count(F.lit(1)).alias("size")), "box").drop("box"), "points")
    eps_of = F.lit(float(eps)).alias("bound")
    near = around(metric.NEAR_ROWS)
    staged = int(index.rows.sum()) > 8 * metric.NEAR_ROWS

    def close_by(index: MetricIndex, to_pivots: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return near(index, to_pivots, bound) & in_radius(index, to_pivots, bound)
    left, counts = x.filter(F.col("size") < min_samples).select("tag", "x", eps_of), []
    for reach in (close_by, in_radius) if staged else (in_radius,):
        n = meet(index, left, x, reach, _count_to(min_samples, p, reach is in_radius), "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
        counts.append(written(n.filter(F.col("n") >= min_samples).select(F.col("a").alias("id")), "counted"))
        if reach is close_by:
            left = written(left.join(counts[0].select(F.col("id").alias("tag")), "tag", "left_anti"), "left")
    loose = functools.reduce(DataFrame.unionByName, counts)
    core = x.join(x.filter(F.col("size") >= min_samples).select("id").unionByName(loose), "id", "left_semi")
    core = core.withColumn("box", box)
    core = written(core.join(core.groupBy("box").agg(F.min("tag").alias("head")), "box").select("id", "x", "cell", "head"), "core")

    nodes = written(core.select(F.col("head").alias("tag"), "x", "cell").distinct(), "nodes")        # points of one place are one
    comp = components(meet(index, nodes.select("tag", "x", eps_of), nodes, close_by if staged else in_radius, _linked(p, not staged), "a long, b long"))
    label = core.join(comp.select(F.col("id").alias("head"), "comp"), "head", "left").select("id", "x", "cell", F.coalesce("comp", "head").alias("tag"))
    label = written(label, "labels")
    if staged:
        parts = written(label.select("tag", "x", "cell").distinct(), "parts")
        most = parts.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "tag").first()
        some = parts.filter(F.col("tag") != F.lit(most["tag"] if most else 0)).select("tag", "x", eps_of)
        comp = components(meet(index, some, parts, in_radius, _linked(p), "a long, b long"))
        label = label.join(comp.select(F.col("id").alias("tag"), "comp"), "tag", "left").select("id", "x", "cell", F.coalesce("comp", "tag").alias("tag"))
        label = written(label, "labels")

    left = written(x.join(core.select("id"), "id", "left_anti").select("tag", "x", eps_of), "left")
    border = meet(index, left, label.select("tag", "x", "cell").distinct(), in_radius, _least(p), "id long, tag long").groupBy("id").agg(F.min("tag").alias("tag"))
    found = label.select("id", "tag").unionByName(border)
    ids = add_row_id(found.select("tag").distinct(), ["tag"], alias="cluster").withColumn("cluster", (F.col("cluster") - 1).cast("int"))
    return x.select("id").join(found.join(ids, "tag"), "id", "left").select(F.col("id").alias(key), F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def dbscan_sweep(df: DataFrame, key: str, vec: str, epss: Sequence[float], ps: Sequence[float], min_samples: int = 5) -> DataFrame:
    """Clusters and noise rows of each eps x p: (eps, p, clusters, noise).  The points are indexed once a p."""
    rows = {}                                # one row each, so the plans of all the clusterings are not held at once
    for p in ps:
        index, x = _indexed(df, key, vec, p)
        for eps in epss:
            r = _dbscan(index, x, key, eps, min_samples).agg(
                F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("clusters"), F.count_if(F.col("cluster") < 0).alias("noise")).first()
            rows[eps, p] = (float(eps), float(p), r["clusters"], r["noise"])
    return df.sparkSession.createDataFrame([rows[eps, p] for eps in epss for p in ps], "eps double, p double, clusters long, noise long")


# N9 ------------------------------------------------------------------------
def _c_factor(n: float) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow_tree(X: np.ndarray, rng: np.random.Generator, limit: int):
    feat, thr, left, right, size = [], [], [], [], []

    def build(idx, depth):
        node = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= limit or len(idx) <= 1:
            return node
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        ok = np.where(hi > lo)[0]
        if len(ok) == 0:
            return node
        f = int(rng.choice(ok))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[node], thr[node] = f, t
        mask = sub[:, f] < t
        left[node] = build(idx[mask], depth + 1)
        right[node] = build(idx[~mask], depth + 1)
        return node

    build(np.arange(len(X)), 0)
    return feat, thr, left, right, size


def isolation_forest(df: DataFrame, key: str, vec: str, n_trees: int = 100, sample_size: int = 256,
                     contamination: float = 0.01, seed: int = 42) -> DataFrame:
    """Isolation forest scores and outlier flags.

    1. rows are drawn for the trees (each tree gets ``sample_size`` rows, a
       bounded group) and every tree is grown in its own ``applyInPandas``
       group;
    2. the forest (n_trees x < 2*sample_size nodes) is broadcast and path
       lengths are computed batch-wise in ``mapInPandas``;
    3. the threshold is the (1 - contamination) quantile of the scores.
    """
    spark = df.sparkSession
    x = df.select(F.col(key).alias("_id"), to_array(vec).alias("_x"))
    n = x.count()
    psi = min(sample_size, n)
    want = 3.0 * psi * n_trees                        # expected candidate rows, ~3 * psi per tree
    copies = max(1, math.ceil(want / max(n, 1)))
    frac = min(1.0, want / max(n * copies, 1))
    rep = x.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(copies)))).sample(fraction=frac, seed=seed)
    rep = rep.withColumn("_tree", (F.rand(seed + 1) * n_trees).cast("int")).withColumn("_u", F.rand(seed + 2))
    w = Window.partitionBy("_tree").orderBy("_u", "_id", "_k")
    samp = rep.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi).select("_tree", "_x")
    limit = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["_tree"].iloc[0])
        X = np.array(pdf["_x"].tolist(), dtype=float)
        f, th, l, r, s = _grow_tree(X, np.random.default_rng(seed * 100003 + t), limit)
        return pd.DataFrame({"_tree": [t], "feat": [f], "thr": [th], "left": [l], "right": [r], "size": [s]})

    trees = samp.groupBy("_tree").applyInPandas(
        grow, "_tree int, feat array<int>, thr array<double>, left array<int>, right array<int>, size array<int>")
    forest = [(np.array(t["feat"]), np.array(t["thr"]), np.array(t["left"]), np.array(t["right"]), np.array(t["size"]))
              for t in trees.collect()]                    # bounded: n_trees * < 2 * psi nodes
    bc = spark.sparkContext.broadcast(forest)
    cpsi = _c_factor(psi)

    def score(it):
        for pdf in it:
            X = np.array(pdf["_x"].tolist(), dtype=float)
            m = len(X)
            total = np.zeros(m)
            for feat, thr, left, right, size in bc.value:
                node = np.zeros(m, dtype=int)
                depth = np.zeros(m)
                active = feat[node] >= 0
                while active.any():
                    idx = np.where(active)[0]
                    nd = node[idx]
                    go_left = X[idx, feat[nd]] < thr[nd]
                    node[idx] = np.where(go_left, left[nd], right[nd])
                    depth[idx] += 1
                    active = feat[node] >= 0
                total += depth + np.array([_c_factor(s) for s in size[node]])
            h = total / len(bc.value)
            yield pd.DataFrame({"_id": pdf["_id"], "score": np.power(2.0, -h / cpsi)})

    scored = x.mapInPandas(score, f"_id {dict(x.dtypes)['_id']}, score double")
    from tadkit.operators.aggregate import quantile_values
    scored = written(scored, "scores")
    cut = quantile_values(scored, ["score"], [1 - contamination])[("score", float(1 - contamination))]
    return scored.select(F.col("_id").alias(key), "score", (F.col("score") > F.lit(cut)).alias("outlier"))


# N10 -----------------------------------------------------------------------
def recluster_largest(df: DataFrame, features: str, cluster: str, k: int, seed: int = 42) -> DataFrame:
    """Split the largest cluster again with k-means; labels become ``c`` or ``c.s``."""
    big = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), cluster).first()[cluster]
    part = df.filter(F.col(cluster) == big)
    sub = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="_sub").fit(part).transform(part)
    rest = df.filter(F.col(cluster) != big).withColumn("label", F.col(cluster).cast("string"))
    sub = sub.withColumn("label", F.concat(F.col(cluster).cast("string"), F.lit("."), F.col("_sub").cast("string"))).drop("_sub")
    return rest.unionByName(sub)


# N13 -----------------------------------------------------------------------
def label_agreement(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Agreement of two labellings of the same rows, per ``by``: n, the Rand index adjusted
    for chance (Hubert and Arabie; 1 if both have one and the same class), and the share of
    rows whose ``b`` is the commonest of their ``a`` (ties do not matter).

    From the contingency table, so the rows are aggregated once.  Rows with a null label are dropped.
    """
    by = list(by)
    cell = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))

    def pairs(c: str) -> Column:
        n = F.col(c).cast("double")
        return n * (n - 1) / 2
    both = cell.groupBy(*by).agg(F.sum(pairs("_n")).alias("_ab"), F.sum("_n").alias("n"))
    row = cell.groupBy(*by, "_a").agg(F.sum("_n").alias("_m"), F.max("_n").alias("_top"))
    row = row.groupBy(*by).agg(F.sum(pairs("_m")).alias("_pa"), F.sum("_top").alias("_top"))
    col = cell.groupBy(*by, "_b").agg(F.sum("_n").alias("_m")).groupBy(*by).agg(F.sum(pairs("_m")).alias("_pb"))
    on = [F.lit(1).alias("_j")] if not by else by
    t = functools.reduce(lambda x, y: x.join(y, by or ["_j"]), [d if by else d.select("*", *on) for d in (both, row, col)])
    chance = F.try_divide(F.col("_pa") * F.col("_pb"), pairs("n"))
    top = (F.col("_pa") + F.col("_pb")) / 2
    ari = F.when(top == F.coalesce(chance, top), 1.0).otherwise((F.col("_ab") - chance) / (top - chance))
    return t.select(*by, "n", ari.alias("adjusted_rand"), (F.col("_top") / F.col("n")).alias("matched_share"))


def share_drift(df: DataFrame, cluster: str, period: str) -> DataFrame:
    """Share of each cluster in each period, and its change since the period before
    (since 0 where the cluster is new): period, cluster, n, share, drift (null in the first
    period).  Clusters that a period has not are rows with n = 0; null periods and clusters are dropped.
    """
    x = df.filter(F.col(cluster).isNotNull() & F.col(period).isNotNull())
    n = x.groupBy(period, cluster).agg(F.count(F.lit(1)).alias("n"))
    whole = n.groupBy(period).agg(F.sum("n").alias("_all"))
    cells = n.select(cluster).distinct().withColumn(period, F.explode(n.agg(F.sort_array(F.collect_set(period))).scalar()))
    grid = cells.join(n, [period, cluster], "left").join(whole, period).select(period, cluster, F.coalesce("n", F.lit(0)).alias("n"), "_all")
    share = F.col("n") / F.col("_all")
    before = Window.partitionBy(cluster).orderBy(period)
    return grid.select(period, cluster, "n", share.alias("share"), (share - F.lag(share).over(before)).alias("drift"))


def predictions_as_array(pred: DataFrame, col: str = "probability", out: str = "proba") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col(col)))

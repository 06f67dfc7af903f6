"""Registered queries: clustering, segmentation, anomaly detection."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tadkit.operators import aggregate as ag
from tadkit.operators import models as md
from tadkit.operators import segment as sg
from tadkit.operators import stats as st
from tadkit.plans.registry import query
from tadkit.session import Tables, written

_DIMS = 64


def _emb(spark, d):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", "label", "embedding", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _principal(e, k=8):
    """The first principal components of all coordinates, in which a full
    covariance can be estimated from few rows."""
    return PCA(k=k, inputCol="features", outputCol="_pc").fit(e).transform(e).drop("features").withColumnRenamed("_pc", "features")


@query("n1_kmeans_assign")
def n1_kmeans(spark, d):
    e = _emb(spark, d)
    m = sg.kmeans(e, "features", 10)
    return m.transform(e).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("n2_elbow_silhouette")
def n2_elbow(spark, d):
    return sg.elbow_table(spark, _emb(spark, d), "features", [2, 3, 4, 5, 6])


@query("n2_silhouette_spread", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x) ^ 2) AS s, count(*) AS n FROM e a, e b GROUP BY ALL),
o AS (SELECT vec_id, label, max(CASE WHEN other = label THEN s / (n - 1) END) AS a, min(CASE WHEN other <> label THEN s / n END) AS b FROM d GROUP BY ALL),
s AS (SELECT label, (b - a) / greatest(a, b) AS v FROM o)
SELECT label, count(*) AS n, round(min(v), 6) AS least, round(avg(v), 6) AS mean, avg((v < 0)::INT::DOUBLE) AS negative_share,
       round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3
FROM s GROUP BY label""")
def n2_spread(spark, d):
    """How the silhouettes of a labelling spread inside each class."""
    t = sg.silhouette_spread(sg.silhouettes(Tables(spark, d).embeddings, "vec_id", "embedding", "label"), "label")
    return t.select("label", "n", "negative_share", *[F.round(c, 6).alias(c) for c in ("least", "mean", "q1", "median", "q3")])


@query("n3_davies_bouldin_calinski", """
WITH e AS (SELECT label, vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent AS (SELECT label, i, avg(v) AS c FROM e GROUP BY 1, 2),
g AS (SELECT i, avg(v) AS c FROM e GROUP BY 1),
dd AS (SELECT e.vec_id, e.label, sqrt(sum((v - c) * (v - c))) AS dist FROM e JOIN cent USING (label, i) GROUP BY 1, 2),
per AS (SELECT label, count(*) AS n, avg(dist) AS s, sum(dist * dist) AS w FROM dd GROUP BY 1),
cc AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m
       FROM cent a JOIN cent b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
db AS (SELECT avg(mx) AS db FROM (SELECT la, max((pa.s + pb.s) / m) AS mx FROM cc
       JOIN per pa ON pa.label = la JOIN per pb ON pb.label = lb GROUP BY la)),
bb AS (SELECT sum(per.n * bd) AS b FROM per JOIN (SELECT label, sqrt(sum((cent.c - g.c) * (cent.c - g.c))) ^ 2 AS bd
       FROM cent JOIN g USING (i) GROUP BY 1) USING (label)),
tt AS (SELECT sum(w) AS w, sum(n) AS nn, count(*) AS k FROM per)
SELECT round(db, 6) AS davies_bouldin, round((b / (k - 1)) / (w / (nn - k)), 6) AS calinski_harabasz,
       k AS "K", CAST(nn AS BIGINT) AS "N" FROM db, bb, tt""")
def n3_indices(spark, d):
    e = Tables(spark, d).embeddings
    r = sg.cluster_indices(e, "embedding", "label")
    return r.select(F.round("davies_bouldin", 6).alias("davies_bouldin"),
                    F.round("calinski_harabasz", 6).alias("calinski_harabasz"), "K", "N")


@query("n4_gaussian_mixture_bic_aic")
def n4_gmm(spark, d):
    return sg.gmm_table(spark, _principal(_emb(spark, d)).select("features"), "features", [2, 3, 4])


@query("n4_mixture_membership")
def n4_membership(spark, d):
    """Probability of each component for each row."""
    e = _principal(_emb(spark, d))
    m = GaussianMixture(k=3, seed=42, featuresCol="features").fit(e)
    return m.transform(e).select("vec_id", F.posexplode(vector_to_array("probability")).alias("component", "probability"))


@query("n5_mixture_outlier_filter")
def n5_outliers(spark, d):
    """Rows of mixture components holding < 5% of rows are dropped."""
    return sg.mixture_outliers(_principal(_emb(spark, d)), "features", 6).select("vec_id", "label")


@query("n6_bisecting_kmeans")
def n6_bisect(spark, d):
    e = _emb(spark, d)
    return sg.bisecting(e, "features", 4).transform(e).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


_N8_EPS = {2.0: [0.2, 0.35, 1.16], 1.0: [0.2, 0.35, 7.3]}
_N8_SQL = """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
dist AS (SELECT a.vec_id AS a, b.vec_id AS b, {dist} AS d FROM e a, e b),
nb AS (SELECT p, eps, a, b FROM dist JOIN (VALUES {grid}) g(p, eps) ON {on}),
core AS (SELECT p, eps, a FROM nb GROUP BY ALL HAVING count(*) >= 4),
ce AS (SELECT nb.* FROM nb JOIN core c USING (p, eps, a) JOIN core d ON nb.p = d.p AND nb.eps = d.eps AND nb.b = d.a),
reach AS (SELECT p, eps, a AS id, a AS seen FROM core
          UNION SELECT r.p, r.eps, r.id, ce.b FROM reach r JOIN ce ON ce.p = r.p AND ce.eps = r.eps AND ce.a = r.seen),
lab AS (SELECT p, eps, id, min(seen) AS l FROM reach GROUP BY ALL),
bord AS (SELECT nb.p, nb.eps, nb.a AS id, min(lab.l) AS l FROM nb JOIN lab ON nb.p = lab.p AND nb.eps = lab.eps AND nb.b = lab.id
         WHERE NOT EXISTS (SELECT 1 FROM core WHERE core.p = nb.p AND core.eps = nb.eps AND core.a = nb.a) GROUP BY ALL),
al AS (SELECT * FROM lab UNION ALL SELECT * FROM bord)
"""


@query("n8_dbscan", _N8_SQL.format(dist="list_distance(a.x, b.x)", grid="(2.0, 1.16)", on="d <= eps") + """,
ids AS (SELECT l, dense_rank() OVER (ORDER BY l) - 1 AS c FROM (SELECT DISTINCT l FROM al))
SELECT e.vec_id, CAST(coalesce(c, -1) AS INTEGER) AS cluster FROM e LEFT JOIN al ON e.vec_id = al.id LEFT JOIN ids ON al.l = ids.l""")
def n8_dbscan(spark, d):
    """DBSCAN of the whole embeddings (noise = -1)."""
    return sg.dbscan(Tables(spark, d).embeddings, "vec_id", "embedding", eps=1.16, min_samples=4)


@query("n8_dbscan_sweep", _N8_SQL.format(
    dist="[list_sum(list_transform(range(1, len(a.x) + 1), lambda i: abs(a.x[i] - b.x[i]))), list_distance(a.x, b.x)]",
    grid=", ".join(f"({p}, {eps})" for p, es in _N8_EPS.items() for eps in es), on="d[p::INT] <= eps") + f"""
SELECT g.eps::DOUBLE AS eps, g.p::DOUBLE AS p, count(DISTINCT l) AS clusters, (SELECT count(*) FROM e) - count(l) AS noise
FROM (VALUES {", ".join(f"({p}, {eps})" for p, es in _N8_EPS.items() for eps in es)}) g(p, eps)
LEFT JOIN al ON al.p = g.p AND al.eps = g.eps GROUP BY g.p, g.eps""")
def n8_sweep(spark, d):
    """Clusters and noise for eps x Minkowski p over the whole embeddings; of the
    last eps of each p, about a third of the vectors have four within it."""
    e = Tables(spark, d).embeddings.select("vec_id", F.col("embedding").alias("x"))
    return sg.dbscan_sweep(e, "vec_id", "x", _N8_EPS[1.0], [1.0], min_samples=4) \
        .unionByName(sg.dbscan_sweep(e, "vec_id", "x", _N8_EPS[2.0], [2.0], min_samples=4))


@query("n9_isolation_forest")
def n9_iforest(spark, d):
    e = Tables(spark, d).embeddings
    return sg.isolation_forest(e, "vec_id", "embedding", n_trees=50, contamination=0.02)


@query("n10_recluster_largest")
def n10_recluster(spark, d):
    e = _emb(spark, d)
    base = sg.kmeans(e, "features", 3, pred="cluster0").transform(e)
    out = sg.recluster_largest(base, "features", "cluster0", 2)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("label", "segment")


@query("n11_warm_clustering_anova")
def n11_warm(spark, d):
    """Mixture labels, then ANOVA F of every feature across them (k best)."""
    e = _principal(_emb(spark, d))
    lab = GaussianMixture(k=4, seed=1, featuresCol="features", predictionCol="seg").fit(e).transform(e)
    lab = written(lab.select("seg", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_DIMS)]), "labelled")
    scores = st.anova_f(lab, "seg", [f"e{i}" for i in range(_DIMS)])
    return st.select_k_best(scores, 4)


@query("n12_explain_clusters_tree")
def n12_explain(spark, d):
    e = _emb(spark, d)
    lab = sg.kmeans(e, "features", 4).transform(e).withColumn("cluster", F.col("cluster").cast("double"))
    tree = DecisionTreeClassifier(labelCol="cluster", maxDepth=4).fit(lab)
    return md.coefficient_frame(spark, tree, [f"e{i}" for i in range(_DIMS)])


@query("n13_cluster_profile", """
SELECT CAST(c_mktsegment AS VARCHAR) AS c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS c_acctbal
FROM customer GROUP BY 1 UNION ALL SELECT 'overall', count(*), round(avg(c_acctbal), 6) FROM customer""")
def n13_profile(spark, d):
    """Archetypes of segments beside the overall mean (the profile table)."""
    c = Tables(spark, d).customer
    return ag.archetypes(c, "c_mktsegment", ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("n13_cluster_tests", """
WITH r AS (SELECT c_mktsegment AS g, rank() OVER (ORDER BY c_acctbal)
                  + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS rk FROM customer),
s AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM r GROUP BY 1),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(rs * rs / n) AS q FROM s),
ti AS (SELECT sum(c * c * c - c) AS tt FROM (SELECT count(*) AS c FROM customer GROUP BY c_acctbal)),
h AS (SELECT (12.0 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - tt / (nn * nn * nn - nn)) AS h FROM t, ti)
SELECT 'kruskal' AS test, round(h, 6) AS stat, round(exp(-h / 2) * (1 + h / 2), 6) AS p_value FROM h""")
def n13_tests(spark, d):
    """Kruskal-Wallis test of a feature across segments (profile test table)."""
    c = Tables(spark, d).customer
    kw = st.kruskal_wallis(c, "c_mktsegment", "c_acctbal")
    return kw.select(F.lit("kruskal").alias("test"), F.round("h", 6).alias("stat"), F.round("p_value", 6).alias("p_value"))


_STABLE_SQL = """
WITH o AS (SELECT o_custkey AS c, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY ALL),
x AS (SELECT c, CAST(y AS INTEGER) AS y, CAST(CASE WHEN v < 200000 THEN 0 WHEN v < 500000 THEN 1 ELSE 2 END AS INTEGER) AS k FROM o)
"""


def _spend_bands(spark, d):
    """Customers by what they spend in a year, in three classes."""
    o = Tables(spark, d).orders.groupBy(F.col("o_custkey").alias("c"), F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    return o.select("c", "y", F.when(F.col("v") < 200000, 0).when(F.col("v") < 500000, 1).otherwise(2).alias("k"))


@query("n13_share_drift_per_year", _STABLE_SQL + """,
g AS (SELECT y, k, count(x.c) AS n FROM (SELECT DISTINCT y FROM x) CROSS JOIN (SELECT DISTINCT k FROM x) LEFT JOIN x USING (y, k) GROUP BY ALL),
s AS (SELECT y, k, n, n / sum(n) OVER (PARTITION BY y) AS share FROM g)
SELECT y, k, n, round(share, 9) AS share, round(share - lag(share) OVER (PARTITION BY k ORDER BY y), 9) AS drift FROM s""")
def n13_drift(spark, d):
    """Share of each class of customers per year and its change."""
    s = sg.share_drift(_spend_bands(spark, d), "k", "y")
    return s.select("y", "k", "n", F.round("share", 9).alias("share"), F.round("drift", 9).alias("drift"))


@query("n13_label_agreement_per_year", _STABLE_SQL + """,
p AS (SELECT b.y, a.k AS a, b.k AS b FROM x a JOIN x b ON a.c = b.c AND b.y = a.y + 1),
t AS (SELECT y, a, b, count(*) AS n FROM p GROUP BY ALL),
i AS (SELECT y, sum(n * (n - 1) / 2.0) AS ab, sum(n) AS n FROM t GROUP BY y),
ra AS (SELECT y, sum(m * (m - 1) / 2.0) AS pa, sum(top) AS top FROM (SELECT y, a, sum(n) AS m, max(n) AS top FROM t GROUP BY ALL) GROUP BY y),
rb AS (SELECT y, sum(m * (m - 1) / 2.0) AS pb FROM (SELECT y, b, sum(n) AS m FROM t GROUP BY ALL) GROUP BY y)
SELECT y, CAST(n AS BIGINT) AS n, round((ab - pa * pb / (n * (n - 1) / 2.0)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2.0)), 9) AS adjusted_rand,
       round(top / n, 9) AS matched_share FROM i JOIN ra USING (y) JOIN rb USING (y)""")
def n13_agreement(spark, d):
    """Agreement of customers' classes with those of the year before."""
    x = _spend_bands(spark, d)
    p = x.select("c", (F.col("y") + 1).alias("y"), F.col("k").alias("a")).join(x.withColumnRenamed("k", "b"), ["c", "y"])
    g = sg.label_agreement(p, "a", "b", ["y"])
    return g.select("y", "n", F.round("adjusted_rand", 9).alias("adjusted_rand"), F.round("matched_share", 9).alias("matched_share"))

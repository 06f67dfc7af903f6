"""Registered queries: supervised learning and evaluation (M1-M24, K18, L).

Model fits are checked by row counts (no SQL can refit them); every metric
table is checked against DuckDB on deterministic scores derived from the
fixture tables.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tadkit.operators import features as fe
from tadkit.operators import metrics as mt
from tadkit.operators import models as md
from tadkit.operators.frame import hash_split
from tadkit.operators.segment import knn
from tadkit.plans.registry import query
from tadkit.session import Tables, scratch_path


def _orders_xy(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("double").alias("label"),
                    (F.col("o_totalprice") / 1000).alias("price"), F.month("o_orderdate").cast("double").alias("month"),
                    (F.year("o_orderdate") - 1995).cast("double").alias("year"),
                    F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"))


_OX = ["price", "month", "year", "prio"]


def _lineitem_xy(spark, d):
    li = Tables(spark, d).lineitem
    return li.select(F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount", "l_tax")


_LX = ["l_quantity", "l_discount", "l_tax"]


def _emb(spark, d, dims=64):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", F.col("label").cast("double").alias("label"), "embedding",
                    *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)])


@query("m1_linear_regression", """
WITH x AS (SELECT l_extendedprice AS y, l_quantity AS a, l_discount AS b, l_tax AS c FROM lineitem),
s AS (SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(a, c) AS ac,
             covar_pop(b, b) AS bb, covar_pop(b, c) AS bc, covar_pop(c, c) AS cc, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy,
             var_pop(y) AS yy FROM x),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM s),
w AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS wa,
             (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS wb,
             (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM d),
f AS (SELECT *, my - wa * ma - wb * mb - wc * mc AS w0 FROM w),
e AS (SELECT avg((y - w0 - wa * a - wb * b - wc * c) ^ 2) AS mse, avg(abs(y - w0 - wa * a - wb * b - wc * c)) AS mae FROM x, f)
SELECT feature, round(value, 4) AS value FROM (
  SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'intercept', 'r2', 'rmse', 'mae', 'n']) AS feature,
         unnest([wa, wb, wc, w0, 1 - mse / yy, sqrt(mse), mae, n::DOUBLE]) AS value FROM f, e)""")
def m1_ols(spark, d):
    """OLS coefficients and fit summary (K18 coefficient table)."""
    x = md.with_features(_lineitem_xy(spark, d), _LX)
    m = md.linear_regression().fit(x)
    s = md.regression_summary(m)
    rows = md.coefficient_table(m, _LX) + [(k, float(v)) for k, v in s.items()]
    return spark.createDataFrame(rows, "feature string, value double").withColumn("value", F.round("value", 4))


@query("m2_ridge_lasso_elastic_net")
def m2_reg(spark, d):
    x = md.with_features(_lineitem_xy(spark, d), _LX).cache()
    rows = []
    for name, reg, l1 in [("ridge", 1.0, 0.0), ("lasso", 1.0, 1.0), ("elastic_net", 1.0, 0.5)]:
        m = md.linear_regression(reg, l1).fit(x)
        rows += [(name, f, v) for f, v in md.coefficient_table(m, _LX)]
    return spark.createDataFrame(rows, "model string, feature string, value double")


@query("m3_logistic_regression_penalties")
def m3_logit(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX).cache()
    n = x.count()
    rows = []
    for pen in ["l2", "l1", "elasticnet"]:
        m = md.logistic(C=1.0, n=n, penalty=pen, maxIter=50).fit(x)
        rows += [(pen, f, v) for f, v in md.coefficient_table(m, _OX)]
    return spark.createDataFrame(rows, "penalty string, feature string, value double")


@query("m4_linear_classifier_penalty_search")
def m4_sgd(spark, d):
    """Hinge (LinearSVC) over the strength of its penalty, log loss (logistic)
    over the strength and the kind: l2, elastic net, l1."""
    x = md.with_features(_orders_xy(spark, d), _OX).select("label", "features").cache()
    ev = BinaryClassificationEvaluator(labelCol="label")
    out = None
    svm, logit = md.linear_svm(maxIter=10), LogisticRegression(maxIter=10)
    for name, est, grid in [("hinge", svm, {svm.regParam: [0.01, 0.1]}),
                            ("log", logit, {logit.regParam: [0.01, 0.1], logit.elasticNetParam: [0.0, 0.5, 1.0]})]:
        cv = md.grid_search(est, grid, ev, folds=2).fit(x)
        t = md.cv_table(spark, cv).withColumn("loss", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


@query("m4_hinge_penalties")
def m4_hinge(spark, d):
    """Weights of the hinge classifier under each penalty, on standardised columns."""
    x = fe.standardize(_orders_xy(spark, d), _OX)
    rows = []
    for name, ratio in (("l2", 0.0), ("elasticnet", 0.5), ("l1", 1.0)):
        m = md.hinge_fit(x, "label", _OX, alpha=0.02, l1_ratio=ratio)
        rows += [(name, c, float(v), m["objective"]) for c, v in zip([*_OX, "intercept"], [*m["coef"], m["intercept"]])]
    return spark.createDataFrame(rows, "penalty string, feature string, value double, objective double")


@query("m5_linear_svm")
def m5_svm(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    m = md.linear_svm(maxIter=20).fit(x)
    return m.transform(x).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("m6_linear_discriminant")
def m6_lda(spark, d):
    """Class means + pooled covariance from one aggregate; linear scores."""
    e = _emb(spark, d)
    cols = [f"e{i}" for i in range(64)]
    m = md.lda_fit(e, "label", cols)
    pred = md.lda_project(md.lda_predict(e, m), m)
    return pred.select("vec_id", "label", "prediction", "ld_1", "ld_2")


@query("m7_decision_tree_importances")
def m7_tree(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    m = md.tree(max_depth=4).fit(x)
    return spark.createDataFrame(md.coefficient_table(m, _OX), "feature string, value double")


@query("m7_decision_tree_rules")
def m7_rules(spark, d):
    """The tree's rules, a row a line, with the features' names."""
    x = md.with_features(_orders_xy(spark, d), _OX)
    text = md.tree(max_depth=4).fit(x).toDebugString
    for i, name in enumerate(_OX):
        text = text.replace(f"feature {i} ", f"{name} ")
    lines = [line for line in text.splitlines()[1:] if line.strip()]
    return spark.createDataFrame([(i, len(line) - len(line.lstrip()), line.strip()) for i, line in enumerate(lines)],
                                 "line int, depth int, rule string")


@query("m8_random_forest")
def m8_forest(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    c = md.forest(n_trees=20, maxDepth=5).fit(x)
    r = md.forest(n_trees=20, regression=True, maxDepth=5).fit(md.with_features(_lineitem_xy(spark, d), _LX))
    rows = [("classifier", f, v) for f, v in md.coefficient_table(c, _OX)]
    rows += [("regressor", f, v) for f, v in md.coefficient_table(r, _LX)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


@query("m9_gradient_boosted_trees")
def m9_gbt(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    m = md.boosted(max_iter=10, maxDepth=3).fit(x)
    return md.probability_of(m.transform(x)).select("o_orderkey", "label", "prediction", "p1")


@query("m10_multilayer_perceptron")
def m10_mlp(spark, d):
    e = md.array_features(_emb(spark, d), "embedding")
    m = md.mlp(64, [32, 16], 10, maxIter=50).fit(e)
    return m.transform(e).select("vec_id", "label", "prediction")


@query("m11_generalisation_table")
def m11_table(spark, d):
    x = hash_split(md.with_features(_orders_xy(spark, d), _OX), "o_orderkey", 0.3)
    tr, te = x.filter("sample = 'train'"), x.filter("sample = 'test'")
    models = {"logistic": LogisticRegression(maxIter=30).fit(tr), "tree": md.tree(4).fit(tr),
              "forest": md.forest(10, maxDepth=4).fit(tr)}
    return md.generalisation_table(spark, models, {"train": tr, "test": te})


_KNN_K = 39


def _knn_ranked(spark, d):
    """Last 30% of rows (by id) are queries, the rest references; exact kNN."""
    from tadkit.operators.frame import temporal_split
    e = temporal_split(_emb(spark, d), "vec_id", 0.3)
    train, test = e.filter("sample = 'train'"), e.filter("sample = 'test'")
    nb = knn(test, train, "vec_id", "embedding", _KNN_K)
    lab = train.select(F.col("vec_id").alias("ref_id"), F.col("label").alias("ref_label"))
    truth = test.select(F.col("vec_id").alias("query_id"), F.col("label").alias("true_label"))
    return nb.join(lab, "ref_id").join(truth, "query_id")


_KNN_SQL = f"""WITH e AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS x,
                  row_number() OVER (ORDER BY vec_id) AS rn, count(*) OVER () AS n FROM embeddings),
q AS (SELECT * FROM e WHERE rn > floor(n * (1 - 0.3))), r AS (SELECT * FROM e WHERE rn <= floor(n * (1 - 0.3))),
p AS (SELECT q.vec_id AS query_id, q.label AS true_label, r.vec_id AS ref_id, r.label AS ref_label,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, r.x), r.vec_id) AS rank FROM q, r),
t AS (SELECT * FROM p WHERE rank <= {_KNN_K})
"""


@query("m12_knn_classifier_k_sweep", _KNN_SQL + f""",
v AS (SELECT k, query_id, true_label, ref_label, count(*) AS v FROM t, range(1, {_KNN_K + 1}) ks(k) WHERE rank <= k
      GROUP BY ALL),
pr AS (SELECT k, query_id, true_label, arg_min(ref_label, (-v, ref_label)) AS pred FROM v GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS k, round(avg(CAST(pred = true_label AS DOUBLE)), 9) AS accuracy FROM pr GROUP BY k""")
def m12_knn(spark, d):
    """kNN majority vote; accuracy for k = 1..39 from one ranked table."""
    ranked = _knn_ranked(spark, d)
    votes = ranked.withColumn("k", F.explode(F.sequence(F.col("rank").cast("int"), F.lit(_KNN_K)))) \
        .groupBy("k", "query_id", "true_label", "ref_label").agg(F.count(F.lit(1)).alias("v"))
    pred = votes.groupBy("k", "query_id", "true_label").agg(
        F.min_by("ref_label", F.struct(-F.col("v"), F.col("ref_label"))).alias("pred"))
    return pred.groupBy("k").agg(F.round(F.avg((F.col("pred") == F.col("true_label")).cast("double")), 9).alias("accuracy"))


@query("m12_knn_regressor", _KNN_SQL + """,
pr AS (SELECT query_id, true_label, avg(ref_label) AS pred FROM t WHERE rank <= 5 GROUP BY ALL)
SELECT round(avg(abs(true_label - pred)), 9) AS mae, round(avg((true_label - pred) ^ 2), 9) AS mse,
       round(sqrt(avg((true_label - pred) ^ 2)), 9) AS rmse, round(1 - avg((true_label - pred) ^ 2) / var_pop(true_label), 9) AS r2
FROM pr""")
def m12_knn_reg(spark, d):
    ranked = _knn_ranked(spark, d)
    pred = ranked.filter(F.col("rank") <= 5).groupBy("query_id", "true_label").agg(F.avg("ref_label").alias("pred"))
    m = mt.regression_metrics(pred, "true_label", "pred")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("m13_cross_validated_score")
def m13_cv(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    lr = LogisticRegression(maxIter=20)
    cv = md.grid_search(lr, {lr.regParam: [0.01]}, BinaryClassificationEvaluator(), folds=3).fit(x)
    return md.cv_table(spark, cv)


@query("m14_grid_search")
def m14_grid(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    rf = md.forest(10)
    cv = md.grid_search(rf, {rf.maxDepth: [3, 5], rf.numTrees: [5, 10]}, BinaryClassificationEvaluator(), folds=2).fit(x)
    return md.cv_table(spark, cv)


@query("m15_random_search")
def m15_random(spark, d):
    x = md.with_features(_orders_xy(spark, d), _OX)
    lr = LogisticRegression(maxIter=20)
    cv = md.random_search(lr, {lr.regParam: [0.0, 0.001, 0.01, 0.1, 1.0], lr.elasticNetParam: [0.0, 0.5, 1.0]}, 4,
                          BinaryClassificationEvaluator(), folds=2).fit(x)
    return md.cv_table(spark, cv)


@query("m16_pca_size_sweep")
def m16_sweep(spark, d):
    e = _emb(spark, d, 64)
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return md.pca_sweep(spark, e, [f"e{i}" for i in range(64)], "label", [2, 4, 8],
                        lambda: LogisticRegression(maxIter=50), ev)


# ---- metrics on deterministic scores ----------------------------------------
def _scored(spark, d):
    o = Tables(spark, d).orders
    score = F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")) / 3000.0
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
                    score.alias("score"), (score > 0.5).cast("int").alias("pred"),
                    F.when(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"), "train").otherwise("test").alias("sample"))


_SCORED = """WITH s AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
  datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 3000.0 AS score,
  CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 3000.0 > 0.5 AS INTEGER) AS pred,
  CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS sample FROM orders)
"""


@query("m17_binary_metrics", _SCORED + """,
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s)
SELECT round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy,
  count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
  (SELECT round((sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
          / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1)), 9) FROM r) AS auc FROM s""")
def m17_binary(spark, d):
    m = mt.binary_metrics(_scored(spark, d), "label", "pred", "score")
    return m.select(F.round("accuracy", 9).alias("accuracy"), "tp", "fp", "tn", "fn", F.round("auc", 9).alias("auc"))


@query("m17_confusion_matrix", _SCORED + """
SELECT label AS actual, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1
FROM s GROUP BY label""")
def m17_confusion(spark, d):
    return mt.confusion_matrix(_scored(spark, d), "label", "pred", [0, 1])


@query("m18_classification_report", """
WITH x AS (SELECT o_orderpriority AS a,
  CASE WHEN o_totalprice < 100000 THEN '5-LOW' WHEN o_totalprice < 200000 THEN '4-NOT SPECIFIED'
       WHEN o_totalprice < 300000 THEN '3-MEDIUM' WHEN o_totalprice < 400000 THEN '2-HIGH' ELSE '1-URGENT' END AS p
  FROM orders),
c AS (SELECT cls, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
  SELECT a AS cls, 1 AS support, 0 AS predicted, CAST(a = p AS INTEGER) AS tp FROM x
  UNION ALL SELECT p, 0, 1, 0 FROM x) GROUP BY cls)
SELECT cls, coalesce(CASE WHEN predicted = 0 THEN NULL ELSE tp / predicted END, 0.0) AS precision,
       coalesce(CASE WHEN support = 0 THEN NULL ELSE tp / support END, 0.0) AS recall, CAST(support AS BIGINT) AS support,
       round(coalesce(CASE WHEN predicted = 0 OR support = 0 OR tp = 0 THEN NULL
         ELSE 2 * (tp / predicted) * (tp / support) / ((tp / predicted) + (tp / support)) END, 0.0), 9) AS f1
FROM c""")
def m18_report(spark, d):
    o = Tables(spark, d).orders
    p = F.when(F.col("o_totalprice") < 100000, "5-LOW").when(F.col("o_totalprice") < 200000, "4-NOT SPECIFIED") \
        .when(F.col("o_totalprice") < 300000, "3-MEDIUM").when(F.col("o_totalprice") < 400000, "2-HIGH").otherwise("1-URGENT")
    r = mt.classification_report(o.select(F.col("o_orderpriority").alias("a"), p.alias("p")), "a", "p")
    return r.withColumn("f1", F.round("f1", 9))


@query("m19_roc_curve", _SCORED + """,
g AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label <> 1) AS fp
      FROM s GROUP BY score)
SELECT threshold, round(sum(fp) OVER (ORDER BY threshold DESC) / sum(fp) OVER (), 9) AS fpr,
       round(sum(tp) OVER (ORDER BY threshold DESC) / sum(tp) OVER (), 9) AS tpr FROM g""")
def m19_roc(spark, d):
    r = mt.roc_curve(_scored(spark, d), "label", "score")
    return r.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


_REG_SQL = """WITH u AS (SELECT sum(l_extendedprice) / sum(l_quantity) AS up FROM lineitem),
r AS (SELECT l_orderkey, l_extendedprice AS label, l_quantity * up AS pred FROM lineitem, u)
"""


def _reg_pred(spark, d):
    li = Tables(spark, d).lineitem
    up = li.agg(F.sum("l_extendedprice") / F.sum("l_quantity")).scalar()
    return li.select("l_orderkey", F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * up).alias("pred"))


@query("m20_regression_metrics", _REG_SQL + """
SELECT round(avg(abs(label - pred)), 6) AS mae, round(avg((label - pred) ^ 2), 4) AS mse,
       round(sqrt(avg((label - pred) ^ 2)), 6) AS rmse, round(1 - avg((label - pred) ^ 2) / var_pop(label), 9) AS r2 FROM r""")
def m20_regmetrics(spark, d):
    m = mt.regression_metrics(_reg_pred(spark, d), "label", "pred")
    return m.select(F.round("mae", 6).alias("mae"), F.round("mse", 4).alias("mse"), F.round("rmse", 6).alias("rmse"),
                    F.round("r2", 9).alias("r2"))


@query("m21_real_vs_predicted", _REG_SQL + """
SELECT l_orderkey, label, round(pred, 6) AS pred, round(label - pred, 6) AS residual FROM r""")
def m21_residuals(spark, d):
    t = mt.residual_table(_reg_pred(spark, d), "label", "pred", keep=["l_orderkey"])
    return t.select("l_orderkey", "label", F.round("pred", 6).alias("pred"), F.round("residual", 6).alias("residual"))


@query("m22_score_band_report", _SCORED + """,
p AS (SELECT label, sample, least(score, 1.0) AS p_a, 1 - least(score, 1.0) AS p_b FROM s)
SELECT greatest(1, least(5, CAST(ceil(p_a / 0.2) AS INTEGER))) AS p_a_bin,
       greatest(1, least(5, CAST(ceil(p_b / 0.2) AS INTEGER))) AS p_b_bin, label, sample, count(*) AS n
FROM p GROUP BY ALL""")
def m22_report(spark, d):
    s = _scored(spark, d).select("label", "sample", F.least("score", F.lit(1.0)).alias("p_a"))
    s = s.withColumn("p_b", 1 - F.col("p_a"))
    return mt.score_report(s, ["p_a", "p_b"], "label", "sample")


@query("m23_balance_strategy_comparison")
def m23_balance(spark, d):
    """Logistic model on raw / over-sampled / under-sampled / SMOTE training data, one test set."""
    e = hash_split(_emb(spark, d).withColumn("label", (F.col("label") == 0).cast("double")), "vec_id", 0.3)
    tr, te = e.filter("sample = 'train'"), e.filter("sample = 'test'")
    cols = [f"e{i}" for i in range(64)]
    syn = fe.smote(tr, "vec_id", "label", 1.0, "embedding", k=5)
    syn = syn.select("vec_id", "label", *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])
    sets = {"raw": tr, "over": fe.oversample(tr, "label", 1.0), "under": fe.undersample(tr, "label"),
            "smote": tr.select("label", *cols).unionByName(syn.select("label", *cols))}
    ev = BinaryClassificationEvaluator(labelCol="label")
    rows = []
    for name, s in sets.items():
        m = LogisticRegression(maxIter=30).fit(md.with_features(s, cols))
        rows.append((name, float(s.count()), float(ev.evaluate(m.transform(md.with_features(te, cols))))))
    return spark.createDataFrame(rows, "strategy string, train_rows double, auc double")


@query("m24_replay_saved_pipeline")
def m24_replay(spark, d):
    """Fit preprocessing + model, save to shared storage, load, score new rows."""
    x = _orders_xy(spark, d)
    tr, new = x.filter(F.col("year") < 4), x.filter(F.col("year") >= 4)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=_OX, outputCol="features"), LogisticRegression(maxIter=20)])
    path = scratch_path(spark, "pipeline")
    md.save_model(pipe.fit(tr), path)
    return md.probability_of(md.load_model(path).transform(new)).select("o_orderkey", "prediction", "p1")


@query("l1_l2_index_assemble", """
WITH p AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS i
           FROM orders GROUP BY 1),
s AS (SELECT o_orderstatus, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS DOUBLE) AS i
      FROM orders GROUP BY 1)
SELECT o_orderkey, p.i AS o_orderpriority_idx, s.i AS o_orderstatus_idx
FROM orders JOIN p USING (o_orderpriority) JOIN s USING (o_orderstatus)""")
def l1_l2(spark, d):
    o = Tables(spark, d).orders
    stages = fe.index_strings(["o_orderpriority", "o_orderstatus"]) + [
        fe.assemble(["o_orderpriority_idx", "o_orderstatus_idx", "o_totalprice"])]
    return Pipeline(stages=stages).fit(o).transform(o).select("o_orderkey", "o_orderpriority_idx", "o_orderstatus_idx")


@query("l3_standard_scaling_ddof0", """
SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 9) AS l_quantity,
       round((l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER (), 9) AS l_tax FROM lineitem""")
def l3_standard(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    s = fe.standardize(li, ["l_quantity", "l_tax"])
    return s.select("l_orderkey", "l_linenumber", F.round("l_quantity", 9).alias("l_quantity"), F.round("l_tax", 9).alias("l_tax"))


@query("l4_minmax_and_inverse", """
SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 9) AS p_retailprice_s,
       round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ())
             * (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) + min(p_retailprice) OVER (), 6) AS p_retailprice_orig,
       CAST(0.0 AS DOUBLE) AS one_s FROM part""")
def l4_minmax(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_retailprice", F.lit(1.0).alias("one"))
    prm = fe.fit_minmax(p, ["p_retailprice", "one"])
    s = fe.apply_minmax(p, prm, suffix="_s")
    inv = fe.inverse_minmax(s, prm.select("p_retailprice"), scaled_suffix="_s")
    return inv.select("p_partkey", F.round("p_retailprice_s", 9).alias("p_retailprice_s"),
                      F.round("p_retailprice_orig", 6).alias("p_retailprice_orig"), "one_s")


@query("l5_dummies_drop_first", """
SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
""" + ", ".join(f"CAST(o_orderpriority = '{v}' AS INTEGER) AS \"o_orderpriority_{v}\"" for v in
                ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM orders")
def l5_dummies(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    lv = fe.fit_levels(o, ["o_orderstatus", "o_orderpriority"])
    return fe.dummies(o, lv, drop="first")


@query("l5_dummies_all_levels", "SELECT o_orderkey, " + ", ".join(
    f"CAST(o_orderstatus = '{v}' AS INTEGER) AS \"o_orderstatus_{v}\"" for v in "FOP")
    + ", CAST(o_totalprice > 100000 AS INTEGER) AS big_true FROM orders")
def l5_all(spark, d):
    """All levels of one column, and of a binary one the second alone."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") > 100000).alias("big"))
    wide = fe.dummies(o, fe.fit_levels(o, ["o_orderstatus"]))
    return fe.dummies(wide, {"big": ["false", "true"]}, drop="if_binary")


@query("l5_dummies_long", """
SELECT o_orderkey, 'o_orderpriority_' || o_orderpriority AS feature FROM orders WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT o_orderkey, 'o_custkey_' || o_custkey FROM orders WHERE o_custkey IS NOT NULL""")
def l5_long(spark, d):
    """Dummies of columns with any number of levels, as rows."""
    return fe.dummies_long(Tables(spark, d).orders, "o_orderkey", ["o_orderpriority", "o_custkey"])


@query("l6_l7_pca_variance_cut")
def l6_pca(spark, d):
    """Centre/scale + PCA; the number of components reaching 90% variance."""
    e = _emb(spark, d, 64)
    cols = [f"e{i}" for i in range(64)]
    m = fe.pca_fit(e, cols, variance=0.9)
    return fe.pca_transform(m, e, keep=["vec_id"])


@query("l8_pca_reconstruction", """
WITH x AS (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT true AS truncated, count(*) AS n, round(sum(s), 6) AS variance, 0.0::DOUBLE AS gap
FROM (SELECT i, var_samp(v) AS s FROM x GROUP BY i)""")
def l8_inverse(spark, d):
    """Rows rebuilt from the components that hold 90 % of the variance: what is lost is what those leave unexplained."""
    e = _emb(spark, d, 64)
    cols = [f"e{i}" for i in range(64)]
    m = fe.pca_fit(e, cols, variance=0.9, standardize_first=False)
    back = fe.pca_inverse(m, fe.pca_transform(m, e, keep=["vec_id"]), cols, keep=["vec_id"])
    lost = e.join(back.select("vec_id", *[F.col(c).alias(f"b_{c}") for c in cols]), "vec_id") \
        .select(sum(F.pow(F.col(c) - F.col(f"b_{c}"), 2) for c in cols).alias("lost")).agg(F.sum("lost").alias("lost"), (F.count("*") - 1).alias("df"))
    whole = e.agg(sum(F.var_samp(c) for c in cols).alias("variance"))
    kept = fe.pca_explained(m)
    gap = F.col("lost") / F.col("df") / F.col("variance") - (1 - sum(kept))
    return whole.join(lost).select(F.lit(len(kept) < 64).alias("truncated"), F.lit(64).cast("long").alias("n"), F.round("variance", 6).alias("variance"),
                                   (F.round(gap, 6) + 0.0).alias("gap"))


@query("l10_feature_spaces_all", """
WITH o AS (SELECT o_orderkey, o_totalprice AS a, dayofyear(o_orderdate)::DOUBLE AS b, o_orderpriority AS p, month(o_orderdate)::VARCHAR AS m,
                  (o_orderstatus = 'F')::INT AS y FROM orders),
s AS (SELECT min(a) AS la, max(a) AS ha, avg(a) AS ma, stddev_samp(a) AS sa, min(b) AS lb, max(b) AS hb, avg(b) AS mb, stddev_samp(b) AS sb, corr(a, b) AS r FROM o),
w AS (SELECT v, c, ln((greatest(n - e, 0.5) / sum(n - e) OVER (PARTITION BY v)) / (greatest(e, 0.5) / sum(e) OVER (PARTITION BY v))) AS woe FROM (
        SELECT 'p' AS v, p AS c, count(*) AS n, sum(y) AS e FROM o GROUP BY p UNION ALL SELECT 'm', m, count(*), sum(y) FROM o GROUP BY m)),
z AS (SELECT o_orderkey, (a - ma) / sa AS za, (b - mb) / sb AS zb, r FROM o, s)
SELECT o_orderkey, 'raw' AS space, round(a, 6) AS f1, round(b, 6) AS f2 FROM o
UNION ALL SELECT o_orderkey, 'minmax', round((a - la) / (ha - la), 6), round((b - lb) / (hb - lb), 6) FROM o, s
UNION ALL SELECT o_orderkey, 'standard', round(za, 6) + 0.0, round(zb, 6) + 0.0 FROM z
UNION ALL SELECT o_orderkey, 'pca', round(abs(za + sign(r) * zb) / sqrt(2), 6), round(abs(za - sign(r) * zb) / sqrt(2), 6) FROM z
UNION ALL SELECT o_orderkey, 'woe', round(x.woe, 6) + 0.0, round(y.woe, 6) + 0.0 FROM o JOIN w x ON x.v = 'p' AND x.c = o.p JOIN w y ON y.v = 'm' AND y.c = o.m""")
def l10_all(spark, d):
    """Orders in five feature spaces, by pipelines that were saved and loaded (components without their sign)."""
    from tadkit.operators import spaces as sp
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", F.dayofyear("o_orderdate").cast("double").alias("day"), "o_orderpriority",
                                       F.month("o_orderdate").cast("string").alias("month"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    path = scratch_path(spark, "spaces")
    sp.save_spaces(sp.fit_spaces(o, ["o_totalprice", "day"], ["o_orderpriority", "month"], "y", variance=1.0), path)
    t = sp.in_spaces(sp.load_spaces(path), o, "o_orderkey")
    v = [F.when(F.col("space") == "pca", F.abs(F.col("values")[i])).otherwise(F.col("values")[i]) for i in (0, 1)]
    return t.select("o_orderkey", "space", (F.round(v[0], 6) + 0.0).alias("f1"), (F.round(v[1], 6) + 0.0).alias("f2"))


@query("l9_l10_feature_spaces", """
WITH m AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS mu, stddev_pop(c_acctbal) AS sd FROM customer)
SELECT 'raw' AS space, round(avg(c_acctbal), 6) + 0.0 AS mean_acctbal FROM customer
UNION ALL SELECT 'minmax', round(avg((c_acctbal - lo) / (hi - lo)), 6) + 0.0 FROM customer, m
UNION ALL SELECT 'standard', round(avg((c_acctbal - mu) / sd), 6) + 0.0 FROM customer, m""")
def l10_spaces(spark, d):
    sp = fe.feature_spaces(Tables(spark, d).customer, "c_custkey", ["c_acctbal", "c_nationkey"])
    out = None
    for name, df in sp.items():
        t = df.select(F.lit(name).alias("space"), (F.round(F.avg("c_acctbal"), 6) + F.lit(0.0)).alias("mean_acctbal"))
        out = t if out is None else out.unionByName(t)
    return out


@query("l11_over_under_sampling", """
WITH o AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders), c AS (SELECT label, count(*) AS n FROM o GROUP BY 1)
SELECT 'under' AS strategy, label, min(n) OVER () AS n, min(n) OVER () AS distinct_rows, 0 AS foreign_rows FROM c""")
def l11_sampling(spark, d):
    """Size of each class after under-sampling, its different rows, and rows that are not of the table."""
    o = Tables(spark, d).orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    u = fe.undersample(o, "label")
    foreign = u.exceptAll(o).groupBy("label").agg(F.count(F.lit(1)).cast("int").alias("foreign_rows"))
    return u.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("distinct_rows")) \
        .join(foreign, "label", "left").select(F.lit("under").alias("strategy"), "label", "n", "distinct_rows",
                                               F.coalesce("foreign_rows", F.lit(0)).alias("foreign_rows"))


@query("l11_over_sampling")
def l11_over(spark, d):
    """Sizes of the classes after over-sampling the smaller one with replacement."""
    o = Tables(spark, d).orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    return fe.oversample(o, "label", 1).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("distinct_rows"))


@query("l12_smote_synthetic_rows", """
WITH e AS (SELECT vec_id, label = 0 AS minor, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
m AS (SELECT vec_id, x FROM e WHERE minor),
c AS (SELECT greatest(count(*) FILTER (WHERE NOT minor), count(*) FILTER (WHERE minor)) - count(*) FILTER (WHERE minor) AS less,
             count(*) FILTER (WHERE minor) AS n FROM e),
near AS (SELECT a.vec_id, list(b.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id)[1:5] AS nb
         FROM m a JOIN m b ON a.vec_id <> b.vec_id GROUP BY a.vec_id),
turn AS (SELECT vec_id, nb, row_number() OVER (ORDER BY ('0x' || substr(md5(vec_id || ':42'), 1, 8))::BIGINT, vec_id) AS r FROM near),
made AS (SELECT vec_id, nb, unnest(generate_series(1, less // n + CASE WHEN r <= less % n THEN 1 ELSE 0 END)) AS i FROM turn, c),
pick AS (SELECT vec_id, i, nb[(('0x' || substr(md5(vec_id || ':' || i || ':nb:42'), 1, 8))::BIGINT % len(nb) + 1)::INT] AS ref,
                ('0x' || substr(md5(vec_id || ':' || i || ':u:42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM made)
SELECT 'syn_' || pick.vec_id || '_' || i AS vec_id,
       list_transform(generate_series(1, len(a.x)), lambda j: a.x[j] + u * (b.x[j] - a.x[j])) AS embedding, 1.0::DOUBLE AS label
FROM pick JOIN m a ON a.vec_id = pick.vec_id JOIN m b ON b.vec_id = pick.ref""")
def l12_smote(spark, d):
    """Synthetic rows of the smaller class, as many as the other has more."""
    e = _emb(spark, d).withColumn("label", (F.col("label") == 0).cast("double"))
    return fe.smote(e, "vec_id", "label", 1.0, "embedding", k=5)


@query("k18_feature_importance_table")
def k18_importances(spark, d):
    """Importances of a tree ensemble and coefficients of a linear model, named."""
    x = md.with_features(_orders_xy(spark, d), _OX)
    rf = md.forest(n_trees=10, maxDepth=4).fit(x)
    lr = LogisticRegression(maxIter=20).fit(x)
    rows = [("forest", f, v) for f, v in md.coefficient_table(rf, _OX)] + \
           [("logistic", f, v) for f, v in md.coefficient_table(lr, _OX)]
    return spark.createDataFrame(rows, "model string, feature string, value double")

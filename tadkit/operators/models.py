"""Supervised learning (M1-M16, M23, M24) on ``pyspark.ml``.

Model fits are Spark ML estimators (distributed gradient / tree learners).
Where scikit-learn conventions differ, the parameter mapping is explicit
(``C`` -> ``regParam = 1 / (C * n)``).  Linear discriminant analysis is
built from one aggregate of class sums and a pooled scatter matrix.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.session import written


def with_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """array<float> embedding -> ml vector."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


# M1 / M2 -------------------------------------------------------------------
def linear_regression(reg: float = 0.0, l1_ratio: float = 0.0, **kw) -> LinearRegression:
    """OLS (reg=0), ridge (l1_ratio=0), lasso (1) or elastic net (between)."""
    return LinearRegression(regParam=reg, elasticNetParam=l1_ratio, **kw)


def coefficient_table(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Model coefficients / importances zipped with feature names."""
    if hasattr(model, "coefficients"):
        vals = model.coefficients.toArray()
        rows = [(n, float(v)) for n, v in zip(names, vals)]
        if hasattr(model, "intercept"):
            rows.append(("intercept", float(model.intercept)))
        return rows
    vals = model.featureImportances.toArray()
    return [(n, float(v)) for n, v in zip(names, vals)]


def coefficient_frame(spark, model, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(coefficient_table(model, names), "feature string, value double")


def regression_summary(model) -> dict:
    s = model.summary
    return {"r2": s.r2, "rmse": s.rootMeanSquaredError, "mae": s.meanAbsoluteError, "n": s.numInstances}


# M3 / M4 / M5 ----------------------------------------------------------------
def logistic(C: float | None = None, n: int | None = None, penalty: str = "l2", l1_ratio: float = 0.5,
             **kw) -> LogisticRegression:
    """scikit-learn style logistic regression: ``C`` maps to regParam = 1/(C n)."""
    reg = 0.0 if C is None else 1.0 / (C * max(n or 1, 1))
    en = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio, "none": 0.0}[penalty]
    return LogisticRegression(regParam=reg, elasticNetParam=en, **kw)


def linear_svm(reg: float = 0.0, **kw) -> LinearSVC:
    return LinearSVC(regParam=reg, **kw)


def _summed(rows: DataFrame, fn, size: int) -> np.ndarray:
    """Sum over all batches of the ``size`` numbers that ``fn`` gives for one (x, y); added in every
    partition, then in 64 groups."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += fn(b.column("x").flatten().to_numpy().reshape(b.num_rows, -1), b.column("y").to_numpy())
        yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    def add(key: tuple, t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, size).sum(axis=0)
        return pa.table({"v": pa.array([v.tolist()], pa.list_(pa.float64()))})
    parts = rows.mapInArrow(part, "v array<double>").groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("_b"))
    return np.sum([r.v for r in parts.applyInArrow(lambda key, t: add(key, t), "v array<double>").collect()] or [np.zeros(size)], axis=0)


def hinge_fit(df: DataFrame, label: str, cols: Sequence[str], alpha: float, l1_ratio: float = 0.0, tol: float = 1e-5, max_iter: int = 40) -> dict:
    """Linear classifier with hinge loss and an elastic net:
    mean(max(0, 1 - y (w x + b))) + alpha (l1_ratio |w|_1 + (1 - l1_ratio) / 2 |w|^2), b free.

    The hinge is smoothed over a width that shrinks to 1e-4 (which moves the
    objective by half of that at most).  Each proximal Newton step takes one pass for
    slope and curvature and one that tries all step lengths at once; the soft threshold is
    applied to the driver's few weights, so l1 gives exact zeros.  Labels are 0 and 1; rows
    with a null or NaN are dropped.  Returns coef, intercept, objective (unsmoothed) and passes.
    """
    p = len(cols)
    x = df.select(F.array(*[F.col(c).cast("double") for c in cols], F.lit(1.0)).alias("x"), (F.col(label).cast("double") * 2 - 1).alias("y"))
    x = written(x.filter(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))), "hinge")
    n = x.count()
    w, passes = np.zeros(p + 1), 0
    if not n:
        return {"coef": w[:p], "intercept": 0.0, "objective": 0.0, "passes": 0, "cols": list(cols)}
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)

    def smooth(z: np.ndarray, width: float) -> np.ndarray:
        return np.where(z >= width, z - width / 2, np.maximum(z, 0) ** 2 / (2 * width))

    def penalty(v: np.ndarray) -> float:
        return l1 * np.abs(v[:p]).sum() + l2 / 2 * (v[:p] ** 2).sum()

    def step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The weights that minimise the quadratic model plus the penalty, by coordinate descent."""
        v = w.copy()
        for _ in range(500):
            before = v.copy()
            for j in range(p + 1):
                slope, bend = g[j] + h[j] @ (v - w), h[j, j]
                if j == p:
                    v[j] -= slope / bend
                else:
                    to = bend * v[j] - slope
                    v[j] = np.sign(to) * max(abs(to) - l1, 0) / (bend + l2)
            if np.abs(v - before).max() <= 1e-10:
                break
        return v
    lengths = 0.5 ** np.arange(12)
    for width in (1.0, 0.1, 0.01, 1e-3, 1e-4):
        damp = 1.0                               # curvature of rows that may enter the bend
        for _ in range(max_iter):
            def bend(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                z = 1 - y * (x @ w)
                inner = x[(z > 0) & (z < width)]
                g = -(np.clip(z / width, 0, 1) * y) @ x
                return np.concatenate([[smooth(z, width).sum()], g, (inner.T @ inner / width).ravel()])
            t = _summed(x, bend, 1 + (p + 1) + (p + 1) ** 2) / n
            f, g, h = t[0] + penalty(w), t[1:p + 2], t[p + 2:].reshape(p + 1, p + 1) + damp * np.eye(p + 1)
            way = step(g, h) - w

            def tries(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                m, d = y * (x @ w), y * (x @ way)
                return np.array([smooth(1 - m - s * d, width).sum() for s in lengths])
            got = _summed(x, tries, len(lengths)) / n + np.array([penalty(w + s * way) for s in lengths])
            passes += 2
            best = int(got.argmin())
            if got[best] < f:
                w = w + lengths[best] * way
            if f - got[best] <= tol * max(width, 1e-2) and (damp <= 1 or damp > 1e6):
                break
            damp = max(damp / 10, 1e-9) if best == 0 and got[best] < f else damp * 4 if best > 2 else damp

    def hinge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.array([np.maximum(1 - y * (x @ w), 0).sum()])
    return {"coef": w[:p], "intercept": float(w[p]), "objective": float(_summed(x, hinge, 1)[0] / n + penalty(w)), "passes": passes + 1, "cols": list(cols)}


def hinge_predict(df: DataFrame, model: dict, out: str = "prediction") -> DataFrame:
    margin = sum((F.lit(float(c)) * F.col(n).cast("double") for c, n in zip(model["coef"], model["cols"])), F.lit(model["intercept"]))
    return df.withColumn(out, (margin > 0).cast("double"))


# M6 ------------------------------------------------------------------------
def gram_blocks(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Per class: n, the sums of the columns and their cross products (row by row).

    Each partition makes one matrix a class, batch by batch; these are added in two
    rounds of bounded groups.  Rows with a null label or column, or NaN, are dropped.
    """
    kind, p = dict(df.dtypes)[label], len(cols)
    x = df.select(F.col(label).alias("_k"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    x = x.filter(F.col("_k").isNotNull() & ~F.exists("_x", lambda v: v.isNull() | F.isnan(v)))
    schema = f"_k {kind}, n long, s array<double>, g array<double>"

    def rows(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"_k": list(held), "n": [h[0] for h in held.values()], "s": [h[1].tolist() for h in held.values()],
                                           "g": [h[2].ravel().tolist() for h in held.values()]}, schema=arrow)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            v = b.column("_x").flatten().to_numpy().reshape(-1, p)
            keys = np.array(b.column("_k").to_pylist(), dtype=object)
            for k in set(keys):
                m = v[keys == k]
                n, s, g = held.get(k, (0, 0.0, 0.0))
                held[k] = (n + len(m), s + m.sum(axis=0), g + m.T @ m)
        if held:
            yield rows(held)

    def add(key: tuple, t: pa.Table) -> pa.Table:
        s, g = (t.column(c).combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1).sum(axis=0) for c in ("s", "g"))
        return pa.Table.from_batches([rows({t.column("_k")[0].as_py(): (sum(t.column("n").to_pylist()), s, g)})])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    parts = x.mapInArrow(blocks, schema).withColumn("_b", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = parts.groupBy("_k", "_b").applyInArrow(lambda key, t: add(key, t), schema)
    return some.groupBy("_k").applyInArrow(lambda key, t: add(key, t), schema).withColumnRenamed("_k", label)


def lda_fit(df: DataFrame, label: str, cols: Sequence[str]) -> dict:
    """Linear discriminant analysis from the classes' ``gram_blocks``.

    Pooled within-class covariance and class means are then a p x p problem.
    Returns weights/intercepts for the linear scores and the projection."""
    p = len(cols)
    rows = gram_blocks(df, label, cols).collect()        # one row per class
    classes, means, ns = [], [], []
    W = np.zeros((p, p))
    N = 0
    for r in sorted(rows, key=lambda r: r[label]):
        n, s, C = r["n"], np.array(r["s"]), np.array(r["g"]).reshape(p, p)
        mu = s / n
        W += C - n * np.outer(mu, mu)
        classes.append(r[label])
        means.append(mu)
        ns.append(n)
        N += n
    K = len(classes)
    Sw = W / (N - K)
    Sinv = np.linalg.pinv(Sw)
    priors = np.array(ns) / N
    M = np.array(means)
    coef = M @ Sinv
    inter = -0.5 * np.einsum("ij,ij->i", coef, M) + np.log(priors)
    gm = priors @ M
    Sb = sum(ns[i] * np.outer(M[i] - gm, M[i] - gm) for i in range(K)) / N
    ev, vec = np.linalg.eig(Sinv @ Sb)
    order = np.argsort(-ev.real)
    scal = vec.real[:, order[: max(1, min(K - 1, p))]]
    return {"classes": classes, "coef": coef, "intercept": inter, "scalings": scal, "mean": gm, "cols": list(cols)}


def lda_predict(df: DataFrame, model: dict, out: str = "prediction") -> DataFrame:
    """Scores are linear column expressions; prediction = argmax score."""
    x = [F.col(c).cast("double") for c in model["cols"]]
    scores = []
    for k, cls in enumerate(model["classes"]):
        s = F.lit(float(model["intercept"][k]))
        for j, xi in enumerate(x):
            s = s + F.lit(float(model["coef"][k, j])) * xi
        scores.append(F.struct(s.alias("score"), F.lit(cls).alias("cls")))
    return df.withColumn(out, F.greatest(*scores)["cls"])


def lda_project(df: DataFrame, model: dict, prefix: str = "ld_") -> DataFrame:
    x = [F.col(c).cast("double") for c in model["cols"]]
    out = {}
    for d in range(model["scalings"].shape[1]):
        s = F.lit(0.0)
        for j, xi in enumerate(x):
            s = s + F.lit(float(model["scalings"][j, d])) * (xi - F.lit(float(model["mean"][j])))
        out[f"{prefix}{d + 1}"] = s
    return df.withColumns(out)


# M7 - M10 -------------------------------------------------------------------
def tree(max_depth: int = 5, **kw) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, **kw)


def forest(n_trees: int = 50, regression: bool = False, seed: int = 42, **kw):
    cls = RandomForestRegressor if regression else RandomForestClassifier
    return cls(numTrees=n_trees, seed=seed, **kw)


def boosted(max_iter: int = 20, seed: int = 42, **kw) -> GBTClassifier:
    return GBTClassifier(maxIter=max_iter, seed=seed, **kw)


def mlp(n_in: int, hidden: Sequence[int], n_out: int, seed: int = 42, **kw) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[n_in, *hidden, n_out], seed=seed, **kw)


# M11 -----------------------------------------------------------------------
def generalisation_table(spark, models: dict, samples: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """Accuracy and AUC (binary) of several fitted models on several samples."""
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", numBins=0)
    rows = []
    for mname, m in models.items():
        for sname, sdf in samples.items():
            pred = m.transform(sdf)
            a = acc.evaluate(pred)
            u = auc.evaluate(pred) if "rawPrediction" in pred.columns else float("nan")
            rows.append((mname, sname, float(a), float(u)))
    return spark.createDataFrame(rows, "model string, sample string, accuracy double, auc double")


# M13 / M14 / M15 / M16 -------------------------------------------------------
def grid_search(estimator, grid: dict, evaluator, folds: int = 3, parallelism: int = 4, seed: int = 42):
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(p, vals)
    return CrossValidator(estimator=estimator, estimatorParamMaps=b.build(), evaluator=evaluator,
                          numFolds=folds, parallelism=parallelism, seed=seed)


def random_search(estimator, space: dict, n_iter: int, evaluator, folds: int = 3, seed: int = 42,
                  parallelism: int = 4):
    """Sample ``n_iter`` parameter maps from ``space`` (lists are sampled uniformly)."""
    rng = random.Random(seed)
    maps = [{p: rng.choice(list(vals)) for p, vals in space.items()} for _ in range(n_iter)]
    return CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
                          parallelism=parallelism, seed=seed)


def cv_table(spark, cv_model) -> DataFrame:
    """Mean and std of the CV metric per parameter map."""
    rows = []
    for pm, m, s in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, cv_model.stdMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in pm.items()), float(m), float(s)))
    return spark.createDataFrame(rows, "params string, mean double, std double")


def pca_sweep(spark, df: DataFrame, cols: Sequence[str], label: str, ks: Sequence[int], make_clf,
              evaluator, seed: int = 42) -> DataFrame:
    """Fit scaler + PCA(k) + classifier for each k on a cached frame."""
    from pyspark.ml.feature import PCA, StandardScaler
    base = df.select(*cols, label).cache()
    train, test = base.randomSplit([0.7, 0.3], seed)
    rows = []
    for k in ks:
        pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_raw"),
                                StandardScaler(inputCol="_raw", outputCol="_std", withMean=True),
                                PCA(k=k, inputCol="_std", outputCol="features"), make_clf()])
        rows.append((int(k), float(evaluator.evaluate(pipe.fit(train).transform(test)))))
    base.unpersist()
    return spark.createDataFrame(rows, "k int, score double")


# M24 / A18 -----------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def probability_of(pred: DataFrame, cls_index: int = 1, out: str = "p1") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col("probability"))[cls_index])

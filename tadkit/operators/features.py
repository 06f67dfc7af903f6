"""Feature transformers.

Scalers and encoders are fitted by one aggregate into a small parameter table
(means, std, min/max, level lists) and applied as column expressions, which
keeps pandas/scikit-learn conventions (population std, constant column -> 0)
that Spark's own ``StandardScaler`` / ``MinMaxScaler`` do not follow.  The
``pyspark.ml`` stages are offered next to them for pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tadkit.operators.frame import balanced_sample
from tadkit.session import written


# L1 / L2 -------------------------------------------------------------------
def index_strings(cols: Sequence[str], suffix: str = "_idx", order: str = "frequencyDesc") -> list[StringIndexer]:
    return [StringIndexer(inputCol=c, outputCol=c + suffix, stringOrderType=order, handleInvalid="keep") for c in cols]


def assemble(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


# L3 ------------------------------------------------------------------------
def fit_standard(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> DataFrame:
    """One-row table with mean and std per column (ddof=0 like scikit-learn)."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    return df.agg(*[F.struct(F.avg(c).alias("mean"), sd(c).alias("std")).alias(c) for c in cols])


def apply_standard(df: DataFrame, params: DataFrame, with_mean: bool = True, with_std: bool = True,
                   suffix: str = "") -> DataFrame:
    out = {}
    for c in params.columns:
        p = params.select(c).scalar()
        x = F.col(c).cast("double")
        if with_mean:
            x = x - p["mean"]
        if with_std:
            x = x / F.when(p["std"] == 0, F.lit(1.0)).otherwise(p["std"])
        out[c + suffix] = x
    return df.withColumns(out)


def standardize(df: DataFrame, cols: Sequence[str], ddof: int = 0, suffix: str = "") -> DataFrame:
    return apply_standard(df, fit_standard(df, cols, ddof), suffix=suffix)


# L4 ------------------------------------------------------------------------
def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.struct(F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
                    for c in cols])


def apply_minmax(df: DataFrame, params: DataFrame, suffix: str = "", lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """(x - min) / (max - min) scaled to [lo, hi]; constant column -> lo."""
    out = {}
    for c in params.columns:
        p = params.select(c).scalar()
        rng = p["max"] - p["min"]
        z = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c).cast("double") - p["min"]) / rng)
        out[c + suffix] = z * (hi - lo) + lo
    return df.withColumns(out)


def inverse_minmax(df: DataFrame, params: DataFrame, scaled_suffix: str = "", suffix: str = "_orig") -> DataFrame:
    out = {}
    for c in params.columns:
        p = params.select(c).scalar()
        out[c + suffix] = F.col(c + scaled_suffix) * (p["max"] - p["min"]) + p["min"]
    return df.withColumns(out)


# L5 ------------------------------------------------------------------------
def fit_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct levels per column.  Each level becomes a column of the
    plan, so they come to the driver, however many there are."""
    row = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(c) for c in cols]).first()
    return {c: row[c] or [] for c in cols}


def dummies(df: DataFrame, levels: dict[str, list], drop: str | None = None, prefix_sep: str = "_",
            keep_original: bool = False) -> DataFrame:
    """Named 0/1 columns per level; ``drop``: None (all), 'first', 'if_binary'."""
    out = {}
    for c, lv in levels.items():
        use = list(lv)
        if drop == "first" or (drop == "if_binary" and len(lv) == 2):
            use = use[1:]
        for v in use:
            out[f"{c}{prefix_sep}{v}"] = (F.col(c).cast("string") == F.lit(v)).cast("int")
    res = df.withColumns(out)
    return res if keep_original else res.drop(*levels.keys())


def dummies_long(df: DataFrame, key: str, cols: Sequence[str], prefix_sep: str = "_") -> DataFrame:
    """L5 where levels are many: (key, feature) of every dummy that is 1, ``<column>_<level>``.

    No level list is fetched, so a column may have any number of them.  Null has no dummy.
    """
    from tadkit.operators.aggregate import melt
    long = melt(df, [key], cols, "_c", "_v").filter(F.col("_v").isNotNull())
    return long.select(key, F.concat("_c", F.lit(prefix_sep), "_v").alias("feature"))


# L6 / L7 / L8 ----------------------------------------------------------------
def pca_fit(df: DataFrame, cols: Sequence[str], k: int | None = None, variance: float | None = None,
            standardize_first: bool = True) -> PipelineModel:
    """Centre (and scale) then PCA.  With ``variance`` the number of
    components is the smallest k whose cumulative explained variance reaches
    it (fit once with all components, then cut)."""
    stages = [VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="skip"),
              StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=standardize_first)]
    full = Pipeline(stages=[*stages, PCA(k=len(cols), inputCol="_std", outputCol="_pc")]).fit(df)
    if k is None:
        ev = np.cumsum(full.stages[-1].explainedVariance.toArray())
        k = int(np.searchsorted(ev, variance - 1e-12) + 1) if variance is not None else len(cols)
    return Pipeline(stages=[*stages, PCA(k=k, inputCol="_std", outputCol="_pc")]).fit(df)


def pca_transform(model: PipelineModel, df: DataFrame, prefix: str = "cp_", keep: Sequence[str] = ()) -> DataFrame:
    k = model.stages[-1].getK()
    arr = vector_to_array(F.col("_pc"))
    return model.transform(df).select(*keep, *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)])


def pca_explained(model: PipelineModel) -> list[float]:
    return [float(x) for x in model.stages[-1].explainedVariance.toArray()]


def pca_inverse(model: PipelineModel, df: DataFrame, cols: Sequence[str], prefix: str = "cp_",
                keep: Sequence[str] = ()) -> DataFrame:
    """Reconstruction x ~ mean + std * (P z), as column expressions."""
    pc = model.stages[-1].pc.toArray()                 # p x k
    scaler = model.stages[1]
    mean = scaler.mean.toArray()
    std = scaler.std.toArray() if scaler.getWithStd() else np.ones(len(cols))
    k = pc.shape[1]
    # One array of all coordinates; the loadings are a literal of p x k numbers.
    z = F.array(*[F.col(f"{prefix}{i + 1}") for i in range(k)])
    rows = F.array(*[F.array(*[F.lit(float(v * s)) for v in r]) for r, s in zip(pc, std)])

    def back(z: Column) -> Column:
        dots = F.transform(rows, lambda r: F.aggregate(F.zip_with(r, z, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))
        return F.zip_with(dots, F.array(*[F.lit(float(m)) for m in mean]), lambda a, b: a + b)
    x = df.select(*keep, F.element_at(F.transform(F.array(z), back), 1).alias("_x"))
    return x.select(*keep, *[F.col("_x")[j].alias(c) for j, c in enumerate(cols)])


# L10 -----------------------------------------------------------------------
def feature_spaces(df: DataFrame, key: str, cols: Sequence[str]) -> dict[str, DataFrame]:
    """Parallel views of one dataset keyed by the unit id: raw, 0-1, standardised."""
    base = df.select(key, *cols)
    return {
        "raw": base,
        "minmax": apply_minmax(base, fit_minmax(base, cols)),
        "standard": standardize(base, cols),
    }


# L11 -----------------------------------------------------------------------
def oversample(df: DataFrame, label: str, minority, seed: int = 42) -> DataFrame:
    """Random over-sampling with replacement of the minority class up to the
    majority size (expected size; ``sample`` with replacement)."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    major = max(counts.values())
    minor = df.filter(F.col(label) == F.lit(minority))
    frac = major / counts[minority]
    extra = minor.sample(withReplacement=True, fraction=frac - 1.0, seed=seed) if frac > 1 else minor.limit(0)
    return df.unionByName(extra)


def undersample(df: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """Random under-sampling: exactly the minority-class size from every class."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    return balanced_sample(df, label, int(n), seed)


# L12 -----------------------------------------------------------------------
def smote(df: DataFrame, key: str, label: str, minority, vec: str, k: int = 5, seed: int = 42) -> DataFrame:
    """SMOTE up to balance: as many synthetic minority rows as the largest class has more.

    Each lies between a minority row and one of its k nearest among all minority
    rows (x + u * (nb - x)), found by ``tadkit.operators.metric.k_nearest``.  Rows
    take turns in the order of a hash of their key; neighbour and u are hashes
    too, so reruns agree.  Keys are ``syn_<key>_<turn>``.  Minority rows without key
    or vector count as rows but make none; with no other minority row there are none to make.
    """
    from tadkit.operators.frame import add_row_id
    from tadkit.operators.metric import k_nearest
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    less = counts.agg(F.max("n") - F.max(F.when(F.col(label) == F.lit(minority), F.col("n")))).first()[0] or 0
    mino = df.filter(F.col(label) == F.lit(minority)).select(F.col(key).alias("query_id"), F.col(vec).cast("array<double>").alias("_x"))
    mino = mino.filter("query_id is not null and _x is not null")

    def draw(*what) -> Column:
        return F.conv(F.substring(F.md5(F.concat_ws(":", *what, F.lit(seed))), 1, 8), 16, 10).cast("long")
    nb = k_nearest(mino, mino, "query_id", "_x", k, exclude_self=True)
    nb = written(nb.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ref_id"))), lambda s: s["ref_id"]).alias("_near")), "near")
    turns = add_row_id(nb.withColumn("_u", draw(F.col("query_id").cast("string"))), ["_u", "query_id"], alias="_id")
    n = max(1, nb.count())
    per = F.lit(less // n) + (F.col("_id") <= less % n).cast("long")
    turns = turns.withColumn("_i", F.explode(F.when(per > 0, F.sequence(F.lit(1).cast("long"), per))))
    own = F.col("query_id").cast("string"), F.col("_i").cast("string")
    pick = turns.select("query_id", "_i", F.element_at("_near", (draw(*own, F.lit("nb")) % F.size("_near") + 1).cast("int")).alias("_nb"),
                        (draw(*own, F.lit("u")) / F.lit(float(2 ** 32))).alias("_u"))
    j = pick.join(mino, "query_id").join(mino.select(F.col("query_id").alias("_nb"), F.col("_x").alias("_y")), "_nb")
    syn = F.zip_with("_x", "_y", lambda x, y: x + F.col("_u") * (y - x))
    return j.select(F.concat_ws("_", F.lit("syn"), *own).alias(key), syn.alias(vec), F.lit(minority).alias(label))

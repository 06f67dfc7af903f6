"""Cleaning and data-quality operators.

Fitted quantities (means, quantiles, fences, category maps) are computed by
one aggregate and referenced as scalar subqueries or small map tables, so a
cleaning step stays one lazy plan and never loops over rows on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tadkit.operators.aggregate import quantile_values


# J1 / J2 -------------------------------------------------------------------
def drop_rows(df: DataFrame, how: str = "any", thresh: int | None = None,
              subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, thresh=thresh, subset=list(subset) if subset else None)


def fill(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Type-aware fill: a string touches only string columns, a number only numbers."""
    return df.na.fill(value, subset=list(subset) if subset else None)


# J3 / J4 -------------------------------------------------------------------
def fit_fill_values(train: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """One-row table of fill values fitted on ``train`` (mean / median / mode)."""
    if strategy == "mean":
        return train.agg(*[F.avg(c).alias(c) for c in cols])
    spark = train.sparkSession
    if strategy == "median":
        qv = quantile_values(train, cols, [0.5])
        vals = [qv[(c, 0.5)] for c in cols]
    elif strategy == "mode":
        from tadkit.operators.aggregate import mode
        one = train.withColumn("_one", F.lit(1))
        vals = []
        for c in cols:
            r = mode(one, "_one", c, alias="m").first()
            vals.append(r["m"] if r else None)
    else:
        raise ValueError(strategy)
    types = dict(train.dtypes)
    return spark.createDataFrame([tuple(vals)], ", ".join(
        f"`{c}` {'double' if strategy == 'median' else types[c]}" for c in cols))


def apply_fill_values(df: DataFrame, fitted: DataFrame, cast: bool = True) -> DataFrame:
    """Replace nulls (and NaN) with the fitted values (scalar subqueries)."""
    out = {}
    dtypes = dict(df.dtypes)
    for c in fitted.columns:
        v = fitted.select(c).scalar()
        x = F.col(c)
        if dtypes[c] in ("double", "float"):
            x = F.when(F.isnan(x), None).otherwise(x)
        out[c] = F.coalesce(x, v.cast(dtypes[c]) if cast else v)
    return df.withColumns(out)


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    return apply_fill_values(df, fit_fill_values(df, cols, strategy))


# J5 ------------------------------------------------------------------------
def proportional_impute(df: DataFrame, col: str, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """Nulls of a categorical drawn from its observed distribution.

    The known rows, in the order of their categories, fill the positions
    0 .. n - 1.  Each null draws a position, and takes the category that starts
    last at or before it: a running maximum over the starts and the draws
    together, range-partitioned, so no join and no bound on categories.
    Without a known value nulls stay.  With a ``key`` draws depend on it and the seed alone.
    """
    from tadkit.operators.frame import cumulative_sum, key_draw
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    starts = cumulative_sum(counts, [], [col], ["_n"]).select((F.col("_n_cum") - F.col("_n")).alias("_at"), F.lit(0).alias("_draw"),
                                                              F.struct((F.col("_n_cum") - F.col("_n")).alias("s"), F.col(col).alias("c")).alias("_cat"))
    draws = df.filter(F.col(col).isNull()).withColumns({"_at": F.floor((F.rand(seed) if key is None else key_draw(key, seed)) * total), "_draw": F.lit(1)})
    both = draws.unionByName(starts, allowMissingColumns=True)
    filled = cumulative_sum(both, [], ["_at", "_draw"], [], maxes=["_cat"]).filter("_draw = 1") \
        .withColumn(col, F.col("_cat_cum.c")).select(df.columns)
    return df.filter(F.col(col).isNotNull()).unionByName(filled)


# J6 ------------------------------------------------------------------------
def model_impute(df: DataFrame, target: str, features: Sequence[str], max_iter: int = 50) -> DataFrame:
    """Fit a classifier on rows where ``target`` is known; predict the nulls."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
    known = df.filter(F.col(target).isNotNull())
    idx = StringIndexer(inputCol=target, outputCol="_y")
    model = Pipeline(stages=[
        idx, VectorAssembler(inputCols=list(features), outputCol="_f", handleInvalid="keep"),
        LogisticRegression(featuresCol="_f", labelCol="_y", predictionCol="_p", maxIter=max_iter)]).fit(known)
    labels = model.stages[0].labels
    pred = model.transform(df.filter(F.col(target).isNull()).withColumn(target, F.lit(labels[0])))
    pred = IndexToString(inputCol="_p", outputCol="_lab", labels=labels).transform(pred)
    filled = pred.withColumn(target, F.col("_lab")).select(*df.columns)
    return known.unionByName(filled)


# J8 ------------------------------------------------------------------------
def column_quality(df: DataFrame, cols: Sequence[str] | None = None, max_missing: float = 0.3) -> DataFrame:
    """Per column: missing share, whether it has one value at most (least =
    greatest), and the drop verdict of either, in one aggregate."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"d_{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.try_divide(F.col(f"m_{i}"), F.col("_n")).alias("missing_share"),
                             F.col(f"d_{i}").alias("single_value")) for i, c in enumerate(cols)])
    out = one.select(F.explode(arr).alias("r")).select("r.*")
    return out.withColumn("drop", (F.col("missing_share") >= max_missing) | F.col("single_value"))


def columns_to_drop(df: DataFrame, cols: Sequence[str] | None = None, max_missing: float = 0.3) -> list[str]:
    """Names flagged by ``column_quality`` (one small row per column to the driver)."""
    return [r["variable"] for r in column_quality(df, cols, max_missing).filter("drop").collect()]


# J9 ------------------------------------------------------------------------
def percentile_flags(df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99,
                     prefix: str = "per_", total: str = "outlier_count") -> DataFrame:
    """Flag values outside [q_low, q_high] per column; count flags per row."""
    qv = quantile_values(df, cols, [low, high])
    flags = {}
    for c in cols:
        lo, hi = F.lit(qv[(c, float(low))]), F.lit(qv[(c, float(high))])
        flags[prefix + c] = ((F.col(c) < lo) | (F.col(c) > hi)).cast("int")
    out = df.withColumns(flags)
    return out.withColumn(total, sum(F.coalesce(F.col(prefix + c), F.lit(0)) for c in cols))


# J10 -----------------------------------------------------------------------
def iqr_filter(df: DataFrame, cols: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """Sequential IQR filter: quartiles of each variable are taken on the rows
    that survived the previous variables (the source's semantics)."""
    out = df
    for c in cols:
        qv = quantile_values(out, [c], [0.25, 0.75])
        q1, q3 = qv[(c, 0.25)], qv[(c, 0.75)]
        iqr = q3 - q1
        out = out.filter((F.col(c) >= F.lit(q1 - alpha * iqr)) & (F.col(c) <= F.lit(q3 + alpha * iqr)))
    return out


# J11 -----------------------------------------------------------------------
def mean_iqr_filter(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Drop rows with any value outside mean +- k * IQR (fences from one pass)."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    qv = quantile_values(df, cols, [0.25, 0.75])
    cond = F.lit(True)
    for c in cols:
        iqr = qv[(c, 0.75)] - qv[(c, 0.25)]
        cond = cond & (F.col(c) >= F.lit(means[c] - k * iqr)) & (F.col(c) <= F.lit(means[c] + k * iqr))
    return df.filter(cond)


# J12 -----------------------------------------------------------------------
def zscore_filter(df: DataFrame, cols: Sequence[str], alpha: float = 3.0) -> DataFrame:
    """Keep rows with |x - mean| / std_pop < alpha for every column; a constant
    column has no outlier."""
    st = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])
    cond = F.lit(True)
    for c in cols:
        s = st.select(c).scalar()
        cond = cond & ((F.abs(F.try_divide(F.col(c) - s["m"], s["s"])) < alpha) | (F.col(c).isNotNull() & (s["s"] == 0)))
    return df.filter(cond)


# J13 / J14 -----------------------------------------------------------------
def rare_category_map(df: DataFrame, col: str, threshold: float = 0.05, other: str = "Otros",
                      remap_small_other: bool = True) -> DataFrame:
    """Fitted (value -> mapped) table for rare-category collapse.

    Shares below ``threshold`` become ``other``; when the collapsed share is
    itself below the threshold it goes to the most frequent category (ties ->
    smallest value).  Nulls are not counted (pandas ``value_counts``).
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    shares = counts.withColumn("share", F.col("_n") / total)
    rare_share = shares.agg(F.coalesce(F.sum(F.when(F.col("share") < threshold, F.col("share"))), F.lit(0.0))).scalar()
    top = counts.agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col)))).scalar()
    target = F.when(remap_small_other & (rare_share < threshold), top).otherwise(F.lit(other))
    return shares.select(F.col(col).alias("value"),
                         F.when(F.col("share") < threshold, target).otherwise(F.col(col)).alias("mapped"))


def apply_category_map(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Apply a fitted map (unseen values -> null, like ``Series.map``)."""
    m = mapping.select(F.col("value").alias("_val"), F.col("mapped").alias("_mapped"))
    return df.join(m, F.col(col) == F.col("_val"), "left").withColumn(out or f"n_{col}", F.col("_mapped")) \
        .drop("_val", "_mapped")


def keep_top_k_levels(df: DataFrame, col: str, k: int, other: str = "Other") -> Column:
    """J14 'keep all but the last levels': values outside the k most frequent -> other."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    keep = counts.orderBy(F.col("_n").desc(), F.col(col)).limit(k).agg(F.collect_list(col)).scalar()
    return F.when(F.array_contains(keep, F.col(col)), F.col(col)).otherwise(F.lit(other))


def min_count_levels(df: DataFrame, col: str, min_count_fraction: float, other: str = "Other") -> DataFrame:
    """J14 'count > n/200': levels with fewer rows than n * fraction -> other."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    n = counts.agg(F.sum("_n")).scalar()
    mp = counts.select(F.col(col).alias("value"),
                       F.when(F.col("_n") > n * min_count_fraction, F.col(col)).otherwise(F.lit(other)).alias("mapped"))
    return mp


# J15 -----------------------------------------------------------------------
def cap_levels(x, k: int, label: str | None = None) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.when(c >= k, F.lit(label or f"{k} or more")).otherwise(c.cast("string"))


# J16 -----------------------------------------------------------------------
def drop_key_violations(df: DataFrame, entity: str, unique_on: Sequence[str]) -> DataFrame:
    """Drop every row of entities that have two rows for one ``unique_on`` key."""
    bad = df.groupBy(entity, *unique_on).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(entity).distinct()
    return df.join(bad, entity, "left_anti")


# J17 -----------------------------------------------------------------------
def drop_invalid_codes(df: DataFrame, col: str, invalid: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(list(invalid)) | F.col(col).isNull())

"""Model evaluation tables (M17-M22) as DataFrame aggregates.

All metrics are computed from (label, prediction / score) columns with
Spark aggregates; AUC and ROC use exact rank statistics (ties averaged)
rather than the evaluator's binned curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.operators.frame import cumulative_sum
from tadkit.operators.windows import average_rank


# M17 -----------------------------------------------------------------------
def confusion_matrix(df: DataFrame, label: str, pred: str, levels: Sequence) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual")).agg(
        *[F.count_if(F.col(pred) == F.lit(v)).alias(f"pred_{v}") for v in levels])


def binary_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC = Mann-Whitney U / (n1 n0) with average ranks for ties."""
    r = average_rank(df.select(label, score), score, alias="_r")
    s = r.agg(F.sum(F.when(F.col(label) == 1, F.col("_r"))).alias("r1"),
              F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) != 1).alias("n0"))
    auc = (F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2) / (F.col("n1") * F.col("n0"))
    return s.select(auc.alias("auc"), "n1", "n0")


def binary_metrics(df: DataFrame, label: str, pred: str, score: str) -> DataFrame:
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                 F.count_if((F.col(label) == 1) & (F.col(pred) == 1)).alias("tp"),
                 F.count_if((F.col(label) == 0) & (F.col(pred) == 1)).alias("fp"),
                 F.count_if((F.col(label) == 0) & (F.col(pred) == 0)).alias("tn"),
                 F.count_if((F.col(label) == 1) & (F.col(pred) == 0)).alias("fn"))
    return acc.select("*", binary_auc(df, label, score).select("auc").scalar().alias("auc"))


# M18 -----------------------------------------------------------------------
def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision / recall / F1 / support per class, from one grouped count."""
    pairs = df.groupBy(F.col(label).cast("string").alias("a"), F.col(pred).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    tp = pairs.filter(F.col("a") == F.col("p")).select(F.col("a").alias("cls"), F.col("n").alias("tp"))
    sup = pairs.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("support"))
    predn = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    j = sup.join(predn, "cls", "full_outer").join(tp, "cls", "left").na.fill(0, ["tp", "support", "predicted"])
    prec = F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double"))
    out = j.select("cls", F.coalesce(prec, F.lit(0.0)).alias("precision"), F.coalesce(rec, F.lit(0.0)).alias("recall"),
                   "support")
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


# M19 -----------------------------------------------------------------------
def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at each distinct score, descending thresholds.

    Counts are grouped by distinct score first; the cumulative TP/FP run over
    a range-partitioned order (no single-task window)."""
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) != 1).alias("fp"))
    g = g.withColumn("_neg", -F.col("threshold"))
    cum = cumulative_sum(g, [], ["_neg"], ["tp", "fp"])
    p = g.agg(F.sum("tp")).scalar()
    n = g.agg(F.sum("fp")).scalar()
    return cum.select("threshold", (F.col("fp_cum") / n).alias("fpr"), (F.col("tp_cum") / p).alias("tpr"))


# M20 / M21 -------------------------------------------------------------------
def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    e = F.col(label) - F.col(pred)
    s = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(label).alias("_v"))
    return s.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("_v")).alias("r2"))


def residual_table(df: DataFrame, label: str, pred: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, label, pred, (F.col(label) - F.col(pred)).alias("residual"))


# M22 -----------------------------------------------------------------------
def score_report(df: DataFrame, prob_cols: Sequence[str], label: str, sample: str, width: float = 0.2) -> DataFrame:
    """Probabilities cut in ``width`` bins (right-closed, first bin closed),
    counted by bin of every model, target and sample."""
    nb = int(round(1 / width))
    bins = {}
    for c in prob_cols:
        b = F.greatest(F.lit(1), F.least(F.lit(nb), F.ceil(F.col(c) / width).cast("int")))
        bins[f"{c}_bin"] = b
    return df.withColumns(bins).groupBy(*bins.keys(), label, sample).agg(F.count(F.lit(1)).alias("n"))

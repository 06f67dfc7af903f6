"""Statistics, tests and feature selection.

Every statistic is reduced by Spark aggregates to a small table (one row per
variable, bin or group); only p-value special functions run as vectorised
pandas UDFs on those small tables, so no test pulls data to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tadkit.operators.aggregate import melt
from tadkit.operators.frame import cumulative_sum
from tadkit.operators.windows import average_rank


# ---------------------------------------------------------------------------
# Special functions (no SciPy in the runtime): small, vectorised helpers.
def chi2_sf(x: float, k: float) -> float:
    """Upper tail of the chi-square distribution = Q(k/2, x/2)."""
    if x is None or k is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if x <= 0:
        return 1.0
    return _gammaincc(k / 2.0, x / 2.0)


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma (series below a+1, Lentz CF above)."""
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(10000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def kolmogorov_sf(lam: float) -> float:
    """P(K > lam) for the limiting Kolmogorov distribution."""
    if lam <= 0:
        return 1.0
    if lam < 0.2:
        return 1.0
    s = 0.0
    for k in range(1, 101):
        t = 2 * (-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam)
        s += t
        if abs(t) < 1e-17:
            break
    return min(1.0, max(0.0, s))


def _norm_cdf(z):
    return 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))


def studentized_range_sf(q: float, k: int, df: float) -> float:
    """P(Q > q) for the studentized range (numerical double integral)."""
    if q <= 0:
        return 1.0
    z = np.linspace(-8, 8, 801)
    phi = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    dz = z[1] - z[0]

    def prange(w):
        inner = np.clip(_norm_cdf(z) - _norm_cdf(z - w), 0, 1) ** (k - 1)
        return k * np.sum(phi * inner) * dz

    if df > 5000:
        return float(max(0.0, 1 - prange(q)))
    # density of s = sqrt(chi2_df / df)
    s = np.linspace(1e-4, 4, 600)
    logf = (math.log(2) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2)
            + (df - 1) * np.log(s) - df * s * s / 2)
    f = np.exp(logf)
    ps = np.array([prange(q * si) for si in s])
    cdf = np.sum(f * ps) * (s[1] - s[0])
    return float(min(1.0, max(0.0, 1 - cdf)))


def _udf_double(fn):
    @F.pandas_udf(DoubleType())
    def apply(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*vals) for vals in zip(*cols)], dtype="float64")
    return apply


chi2_sf_col = _udf_double(lambda x, k: chi2_sf(float(x), float(k)) if pd.notna(x) else float("nan"))
kolmogorov_sf_col = _udf_double(lambda lam: kolmogorov_sf(float(lam)) if pd.notna(lam) else float("nan"))
tukey_sf_col = _udf_double(lambda q, k, d: studentized_range_sf(float(q), int(k), float(d)) if pd.notna(q) else float("nan"))


# ---------------------------------------------------------------------------
# K16 / K17 / K15 : binning
def quantile_edges(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Per column the distinct exact quantile edges at i / bins (``pd.qcut``
    with duplicates dropped); <= bins + 1 values per column."""
    from tadkit.operators.aggregate import quantile_values
    probs = [i / bins for i in range(bins + 1)]
    qv = quantile_values(df, cols, probs)
    out = {}
    for c in cols:
        vals = []
        for p in probs:
            v = qv[(c, float(p))]
            if v is not None and v not in vals:
                vals.append(float(v))
        out[c] = vals
    return out


def edges_literal(df: DataFrame, col: str, bins: int) -> Column:
    """Quantile edges of one column as a literal array (one small job)."""
    return F.array(*[F.lit(float(v)) for v in quantile_edges(df, [col], bins)[col]])


def bin_by_edges(x, edges: Column) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ... with the lowest edge included;
    returns the 1-based bin number (``pd.cut/qcut`` with include_lowest)."""
    c = F.col(x) if isinstance(x, str) else x
    below = F.size(F.filter(edges, lambda e: e < c))
    return F.when(c.isNull(), None).otherwise(F.greatest(F.lit(1), below))


def fixed_edges_bucket(x, edges: Sequence[float]) -> Column:
    """Bins of fixed edges, right-closed, lowest included; outside -> null."""
    c = F.col(x) if isinstance(x, str) else x
    arr = F.array(*[F.lit(float(e)) for e in edges])
    b = bin_by_edges(c, arr)
    return F.when((c < edges[0]) | (c > edges[-1]), None).otherwise(b)


def equal_width_labels(df: DataFrame, col: str, bins: int, missing: str = "MISSING", alias: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] labelled ``NN. min|max`` with the
    min/max of the values that fell in the bin; nulls -> MISSING."""
    x = F.col(col).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    b = F.when(x.isNull(), None).otherwise(
        F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins))))
    tagged = df.withColumn("_bin", b)
    ranges = tagged.filter(F.col("_bin").isNotNull()).groupBy("_bin").agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    lab = F.concat(F.lpad(F.col("_bin").cast("string"), 2, "0"), F.lit(". "), F.col("_mn").cast("string"),
                   F.lit("|"), F.col("_mx").cast("string"))
    ranges = ranges.select("_bin", lab.alias("_lab"))
    return tagged.join(ranges, "_bin", "left").withColumn(
        alias or f"d_{col}", F.coalesce(F.col("_lab"), F.lit(missing))).drop("_bin", "_lab")


# ---------------------------------------------------------------------------
# K1 - K4 : WoE / IV
def woe_table(df: DataFrame, target: str, cols: Sequence[str], bins: int = 20, binning: str = "quantile",
              orientation: str = "events/non", floor: float = 0.5, max_levels: int = 10,
              infinite_iv_to_zero: bool = False, missing: str | None = None) -> DataFrame:
    """One row per (variable, bin): n, events, shares, WoE and IV term.

    Numeric columns with more than ``max_levels`` distinct values are cut in
    quantile bins (duplicate edges dropped) or equal-width bins; other
    columns use their values.  ``orientation``: ``events/non`` gives
    ln(%events / %non-events) (K1), ``non/events`` the reverse (K2, K3).
    The 0.5 floor applies to both counts before the shares.  Nulls form no bin,
    unless ``missing`` names one for categories (K4).
    """
    dtypes = dict(df.dtypes)
    numeric = [c for c in cols if dtypes[c] in ("int", "bigint", "double", "float", "smallint")
               or dtypes[c].startswith("decimal")]
    # "more than max_levels distinct values?" -- a one-pass estimate settles
    # clear cases; exact counts only for columns near the threshold (cheap,
    # since their cardinality is small)
    est = df.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first() if numeric else {}
    near = [c for c in numeric if est[c] <= 2 * max_levels + 2]
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in near]).first() if near else {}
    binned = [c for c in numeric if (exact[c] if c in near else est[c]) > max_levels]
    # Bin edges are tiny (<= bins + 1 values per variable): like Spark's
    # QuantileDiscretizer splits they are fetched once and inlined as literals.
    if binned and binning == "quantile":
        row = quantile_edges(df, binned, bins)
        edge_cols = {c: F.array(*[F.lit(float(v)) for v in row[c]]) for c in binned}
    elif binned:
        row = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                       for c in binned]).first()
        edge_cols = {c: F.array(*[F.lit(row[c]["lo"]) + F.lit(float(i)) * (F.lit(row[c]["hi"]) - F.lit(row[c]["lo"]))
                                  / F.lit(float(bins)) for i in range(bins + 1)]) for c in binned}
    else:
        edge_cols = {}
    keyed = {}
    for c in cols:
        if c in edge_cols:
            keyed[c] = F.lpad(bin_by_edges(F.col(c).cast("double"), edge_cols[c]).cast("string"), 3, "0")
        else:
            keyed[c] = F.col(c).cast("string") if missing is None else F.coalesce(F.col(c).cast("string"), F.lit(missing))
    long = df.select(F.col(target).cast("int").alias("_y"), *[keyed[c].alias(c) for c in cols])
    long = melt(long, ["_y"], cols, "variable", "bin").filter(F.col("bin").isNotNull())
    g = long.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("events"))
    g = g.withColumn("non_events", F.col("n") - F.col("events"))
    tot = g.groupBy("variable").agg(F.sum("events").alias("_te"), F.sum("non_events").alias("_tn"))
    g = g.join(tot, "variable")
    pe = F.greatest(F.col("events").cast("double"), F.lit(floor)) / F.col("_te")
    pn = F.greatest(F.col("non_events").cast("double"), F.lit(floor)) / F.col("_tn")
    g = g.withColumn("pct_events", pe).withColumn("pct_non_events", pn)
    if orientation == "events/non":
        woe = F.log(F.col("pct_events") / F.col("pct_non_events"))
        iv = woe * (F.col("pct_events") - F.col("pct_non_events"))
    else:
        woe = F.log(F.col("pct_non_events") / F.col("pct_events"))
        iv = woe * (F.col("pct_non_events") - F.col("pct_events"))
    g = g.withColumn("woe", woe).withColumn("iv", iv)
    if infinite_iv_to_zero:
        g = g.withColumn("iv", F.when(F.isnan("iv") | (F.abs("iv") == float("inf")), 0.0).otherwise(F.col("iv")))
    if edge_cols:
        emap = F.create_map(*[x for c in edge_cols for x in (F.lit(c), edge_cols[c])])
        e = emap[F.col("variable")]
        idx = F.col("bin").cast("int")
        g = g.withColumn("lo", F.when(e.isNotNull(), F.element_at(e, idx))) \
             .withColumn("hi", F.when(e.isNotNull(), F.element_at(e, idx + 1)))
    else:
        g = g.withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
    return g.select("variable", "bin", "lo", "hi", "n", "events", "non_events", "pct_events", "pct_non_events", "woe", "iv")


def iv_summary(woe: DataFrame) -> DataFrame:
    """IV per variable with the usual strength bands (K9)."""
    return woe.groupBy("variable").agg(F.sum("iv").alias("iv")).withColumn("strength", iv_band("iv"))


# K9 -- fixed values: IV cut points and labels.
IV_BANDS = [(0.02, "useless"), (0.1, "weak"), (0.3, "medium"), (0.5, "strong")]


def iv_band(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    out = F.when(c < IV_BANDS[0][0], IV_BANDS[0][1])
    for (lo, _), (hi, lab) in zip(IV_BANDS, IV_BANDS[1:]):
        out = out.when((c >= lo) & (c < hi), lab)
    return out.when(c >= IV_BANDS[-1][0], "over-predictive")


def woe_encode(df: DataFrame, target: str, cols: Sequence[str], orientation: str = "non/events",
               floor: float = 0.5, suffix: str = "_woe") -> DataFrame:
    """K3: replace categories by their WoE through a fitted map table."""
    table = woe_table(df, target, cols, orientation=orientation, floor=floor, max_levels=1 << 30, missing="Missings")
    out = df
    for c in cols:
        m = table.filter(F.col("variable") == c).select(F.col("bin").alias("_b"), F.col("woe").alias(c + suffix))
        out = out.join(m, F.coalesce(F.col(c).cast("string"), F.lit("Missings")) == F.col("_b"), "left").drop("_b")
    return out


# ---------------------------------------------------------------------------
# K5 : two-sample KS
def ks_2samp(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """KS statistic D and asymptotic p-value per column of two samples."""
    la = melt(a.select(*cols), [], cols, "variable", "value", cast="double").withColumn("_s", F.lit(1))
    lb = melt(b.select(*cols), [], cols, "variable", "value", cast="double").withColumn("_s", F.lit(2))
    u = la.unionByName(lb).filter(F.col("value").isNotNull())
    g = u.groupBy("variable", "value").agg(F.count_if(F.col("_s") == 1).alias("c1"),
                                           F.count_if(F.col("_s") == 2).alias("c2"))
    cum = cumulative_sum(g, ["variable"], ["value"], ["c1", "c2"])
    tot = g.groupBy("variable").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    d = cum.join(tot, "variable").groupBy("variable", "n1", "n2").agg(
        F.max(F.abs(F.try_divide(F.col("c1_cum"), F.col("n1")) - F.try_divide(F.col("c2_cum"), F.col("n2")))).alias("ks"))
    en = F.sqrt(F.try_divide(F.col("n1") * F.col("n2"), F.col("n1") + F.col("n2")))
    return d.withColumn("p_value", kolmogorov_sf_col(en * F.col("ks"))).withColumn(
        "same_distribution", F.when(F.col("p_value") < 0.05, "No").otherwise("Yes"))


# K6 ------------------------------------------------------------------------
def chi2_shares(train: DataFrame, test: DataFrame, col: str, use_counts: bool = True) -> DataFrame:
    """Goodness of fit of test category counts against train shares.

    ``use_counts=False`` reproduces the source's use of relative frequencies
    (statistic without the factor n).  Null is no category."""
    train, test = train.filter(F.col(col).isNotNull()), test.filter(F.col(col).isNotNull())
    tr = train.groupBy(col).agg(F.count(F.lit(1)).alias("_a"))
    te = test.groupBy(col).agg(F.count(F.lit(1)).alias("_b"))
    j = tr.join(te, col, "full_outer").na.fill(0, ["_a", "_b"])
    na = j.agg(F.sum("_a")).scalar()
    nb = j.agg(F.sum("_b")).scalar()
    if use_counts:
        obs, exp = F.col("_b"), F.col("_a") / na * nb
    else:
        obs, exp = F.col("_b") / nb, F.col("_a") / na
    st = j.agg(F.sum(F.try_divide((obs - exp) * (obs - exp), exp)).alias("chi2"), (F.count(F.lit(1)) - 1).alias("dof"))
    return st.withColumn("p_value", chi2_sf_col("chi2", "dof"))


# K7 / K8 -------------------------------------------------------------------
def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (var1, var2, corr) for all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(arr).alias("r")).select("r.*")


def spearman_matrix(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """Pearson correlation of average ranks (ties averaged)."""
    ranked = df.select(row_id, *cols)
    for c in cols:
        r = average_rank(ranked.select(row_id, c), c, alias=f"_r_{c}").select(row_id, f"_r_{c}")
        ranked = ranked.join(r, row_id)
    ranked = ranked.select(row_id, *[F.col(f"_r_{c}").alias(c) for c in cols])
    return pearson_matrix(ranked, cols)


def target_correlation(df: DataFrame, target: str, cols: Sequence[str], min_abs: float = 0.1) -> DataFrame:
    """|corr(x, target)| sorted, with the K8 keep flag."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    out = melt(one, [], cols, "variable", "corr", cast="double")
    return out.withColumn("abs_corr", F.abs("corr")).withColumn("keep", F.col("abs_corr") >= min_abs)


# K10 -----------------------------------------------------------------------
def anova_f(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """One-way ANOVA F and p-value of each feature across classes."""
    long = melt(df.select(label, *cols), [label], cols, "variable", "x", cast="double").filter(F.col("x").isNotNull())
    g = long.groupBy("variable", label).agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"),
                                             F.sum(F.col("x") * F.col("x")).alias("ss"))
    t = g.groupBy("variable").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("S"),
                                  F.sum("ss").alias("SS"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("B"))
    ssb = F.col("B") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("B")
    f = (ssb / (F.col("k") - 1)) / (ssw / (F.col("N") - F.col("k")))
    return t.select("variable", f.alias("f_score"), (F.col("k") - 1).alias("df_between"),
                    (F.col("N") - F.col("k")).alias("df_within")).withColumn(
        "p_value", f_sf_col("f_score", "df_between", "df_within"))


def f_regression(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Univariate regression F = r^2 / (1 - r^2) * (n - 2)."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    long = melt(one, ["_n"], cols, "variable", "r", cast="double")
    f = F.col("r") * F.col("r") / (1 - F.col("r") * F.col("r")) * (F.col("_n") - 2)
    return long.select("variable", f.alias("f_score"))


def select_k_best(scores: DataFrame, k: int, score: str = "f_score") -> DataFrame:
    return scores.orderBy(F.col(score).desc(), "variable").limit(k)


def _f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution via the regularised incomplete beta."""
    if f is None or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    x = d2 / (d2 + d1 * f)
    return _betainc(d2 / 2.0, d1 / 2.0, x)


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbeta) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbeta) * _betacf(b, a, 1 - x) / b


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1 / d
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return h


f_sf_col = _udf_double(lambda f, a, b: _f_sf(float(f), float(a), float(b)) if pd.notna(f) else float("nan"))


# K11 -----------------------------------------------------------------------
def variance_threshold(df: DataFrame, cols: Sequence[str], threshold: float = 0.0, ddof: int = 0) -> DataFrame:
    """Per-column variance (population by default, like scikit-learn) and keep flag."""
    fn = F.var_pop if ddof == 0 else F.var_samp
    one = df.agg(*[fn(F.col(c).cast("double")).alias(c) for c in cols])
    long = melt(one, [], cols, "variable", "variance", cast="double")
    return long.withColumn("keep", F.col("variance") > threshold)


# K12 -----------------------------------------------------------------------
def quartimax(load: np.ndarray) -> np.ndarray:
    """Loadings on two components, rotated so that each variable loads on one as far as it can."""
    u, v = load[:, 0] ** 2 - load[:, 1] ** 2, 2 * load[:, 0] * load[:, 1]
    turn = np.arctan2(2 * (u * v).sum(), (u * u - v * v).sum()) / 4
    c, s = np.cos(turn), np.sin(turn)
    return load @ np.array([[c, -s], [s, c]])


def _r2_with_component(R: np.ndarray, var: int, cl: Sequence[int]) -> float:
    """Squared correlation of a variable with the first component of a cluster."""
    sub = R[np.ix_(cl, cl)]
    comp = np.linalg.eigh(sub)[1][:, -1]
    cov, spread = R[var, cl] @ comp, comp @ sub @ comp
    return float(cov * cov / spread) if spread > 0 else 0.0


def split_variables(R: np.ndarray, cl: Sequence[int]) -> list[list[int]] | None:
    """Two clusters of the variables ``cl`` of the correlation matrix ``R``; None if one would be empty."""
    w, v = np.linalg.eigh(R[np.ix_(cl, cl)])
    load = quartimax(v[:, [-1, -2]] * np.sqrt(np.maximum(w[[-1, -2]], 0)))
    side = (load[:, 1] ** 2 > load[:, 0] ** 2).astype(int)
    seen = set()
    while 0 < side.sum() < len(cl) and tuple(side) not in seen:      # a side that comes back would come back for ever
        seen.add(tuple(side))
        halves = [[x for x, s in zip(cl, side) if s == h] for h in (0, 1)]
        r2 = np.array([[_r2_with_component(R, x, h) for h in halves] for x in cl])
        side = np.where(np.isclose(r2[:, 0], r2[:, 1]), side, (r2[:, 1] > r2[:, 0]).astype(int))
    halves = [[x for x, s in zip(cl, side) if s == h] for h in (0, 1)]
    return halves if all(halves) else None


def varclus(df: DataFrame, cols: Sequence[str], max_eigen: float = 1.0, max_clusters: int | None = None) -> DataFrame:
    """Variable clustering: divisive splits on the second eigenvalue of the
    cluster correlation matrix.  The p x p correlation matrix is one Spark
    aggregate; the eigen-splits run on that small matrix.  The first two
    components of a cluster are rotated (quartimax), each variable goes to the one
    it loads on most, and then to the nearer of the two clusters' first
    components until none moves.  Output: variable,
    cluster, r2_own, r2_next, rs_ratio (= (1 - r2_own) / (1 - r2_next)) and
    whether it is the cluster's representative (lowest ratio)."""
    p = len(cols)
    pm = pearson_matrix(df, cols).collect()
    idx = {c: i for i, c in enumerate(cols)}
    R = np.eye(p)
    for r in pm:
        i, j = idx[r["var1"]], idx[r["var2"]]
        v = 0.0 if r["corr"] is None else r["corr"]
        R[i, j] = R[j, i] = v if i != j else 1.0
    clusters = [list(range(p))]
    while True:
        if max_clusters and len(clusters) >= max_clusters:
            break
        best, best_ev = None, max_eigen
        for ci, cl in enumerate(clusters):
            if len(cl) < 2:
                continue
            ev = np.linalg.eigvalsh(R[np.ix_(cl, cl)])
            if ev[-2] > best_ev:
                best, best_ev = ci, ev[-2]
        if best is None:
            break
        cl = clusters.pop(best)
        halves = split_variables(R, cl)
        if halves is None:
            clusters.append(cl)
            break
        clusters += halves

    def r2_with(var, cl):
        return _r2_with_component(R, var, cl)

    rows = []
    for ci, cl in enumerate(clusters):
        for var in cl:
            own = r2_with(var, cl)
            nxt = max([r2_with(var, o) for oi, o in enumerate(clusters) if oi != ci] or [0.0])
            ratio = (1 - own) / (1 - nxt) if nxt < 1 else float("inf")
            rows.append((cols[var], ci, own, nxt, ratio))
    out = df.sparkSession.createDataFrame(rows, "variable string, cluster int, r2_own double, r2_next double, rs_ratio double")
    w = Window.partitionBy("cluster").orderBy("rs_ratio", "variable")
    return out.withColumn("representative", F.row_number().over(w) == 1)


# K13 -----------------------------------------------------------------------
def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """H statistic (tie-corrected) and chi-square p-value with k - 1 dof; null if all values tie."""
    x = df.select(group, value).filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    r = average_rank(x, value, alias="_r")
    rs = r.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("R"))
    ties = x.groupBy(value).agg(F.count(F.lit(1)).alias("t")).agg(
        F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("T"))
    t = rs.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("R") * F.col("R") / F.col("n")).alias("Q"))
    N = F.col("N").cast("double")
    h = F.try_divide(F.try_divide(F.lit(12.0), N * (N + 1)) * F.col("Q") - 3 * (N + 1), 1 - F.try_divide(ties.scalar(), N * N * N - N))
    return t.select(h.alias("h"), (F.col("k") - 1).alias("dof")).withColumn("p_value", chi2_sf_col("h", "dof"))


# K14 -----------------------------------------------------------------------
def tukey_hsd(df: DataFrame, group: str, value: str) -> DataFrame:
    """Pairwise mean differences with the studentized-range statistic.

    Per-group n / mean / variance come from one aggregate; the pair table has
    k(k-1)/2 rows, which are the answer (k = number of groups)."""
    g = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group) \
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    t = g.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"))
    N, k, ssw = t.select("N").scalar(), t.select("k").scalar(), t.select("ssw").scalar()
    mse = F.try_divide(ssw, N - k)
    a = g.select(*[F.col(c).alias(f"{c}_1") for c in (group, "n", "mean")])
    b = g.select(*[F.col(c).alias(f"{c}_2") for c in (group, "n", "mean")])
    pairs = a.join(b, F.col(f"{group}_1") < F.col(f"{group}_2"))
    diff = F.col("mean_2") - F.col("mean_1")
    se = F.sqrt(mse / 2 * (1 / F.col("n_1") + 1 / F.col("n_2")))
    out = pairs.select(F.col(f"{group}_1").alias("group1"), F.col(f"{group}_2").alias("group2"),
                       diff.alias("meandiff"), F.try_divide(F.abs(diff), se).alias("q"))
    return out.withColumn("p_adj", tukey_sf_col("q", F.lit(k), F.lit(N - k))).withColumn("reject", F.col("p_adj") < 0.05)

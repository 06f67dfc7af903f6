"""Grouped aggregation operators (inventory D1-D30).

All functions are DataFrame -> DataFrame and lazy.  Group-level statistics
that pandas computes with ``transform`` are written as aggregate + join so a
hot key is handled by partial aggregation and AQE skew splitting instead of
one window partition holding the whole group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGG_FNS = {
    "count": lambda c: F.count(c),
    "sum": lambda c: F.sum(c),
    "mean": lambda c: F.avg(c),
    "avg": lambda c: F.avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "std": lambda c: F.stddev_samp(c),       # pandas .agg('std') is ddof=1
    "std_pop": lambda c: F.stddev_pop(c),
    "var": lambda c: F.var_samp(c),
    "median": lambda c: F.median(c),
    "nunique": lambda c: F.count_distinct(c),
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
    "kurtosis": lambda c: F.kurtosis(c),
    "skew": lambda c: F.skewness(c),
}


def _cols(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def drop_null_keys(df: DataFrame, by) -> DataFrame:
    """The group-by rule of the library: rows of a null key form no group."""
    for b in _cols(by):
        df = df.filter((F.col(b) if isinstance(b, str) else b).isNotNull())
    return df


# D1 / D2 -------------------------------------------------------------------
def global_agg(df: DataFrame, spec: dict[str, Sequence[str]]) -> DataFrame:
    """One-row frame ``{col: [fn, ...]}`` -> columns ``{col}_{fn}``."""
    return df.agg(*[AGG_FNS[f](c).alias(f"{c}_{f}") for c, fns in spec.items() for f in fns])


def group_agg(df: DataFrame, by, spec: dict[str, Sequence[str]],
              drop_nulls: bool = True) -> DataFrame:
    """pandas-style ``groupby(by).agg(spec)`` with flat ``{col}_{fn}`` names.

    pandas drops null group keys; ``drop_nulls`` keeps that rule.
    """
    by = _cols(by)
    if drop_nulls:
        df = drop_null_keys(df, by)
    return df.groupBy(*by).agg(*[AGG_FNS[f](c).alias(f"{c}_{f}")
                                 for c, fns in spec.items() for f in fns])


# D3 ------------------------------------------------------------------------
def agg_matrix(df: DataFrame, by, cols: Sequence[str], fns: Sequence[str],
               name: str = "{col}_{fn}") -> DataFrame:
    """Cross product columns x functions, names from a template.

    Grouped medians come from ``grouped_quantiles`` (no group is buffered);
    every other function is a partial-aggregated built-in.  Rows of a null
    key are dropped."""
    by = _cols(by)
    df = drop_null_keys(df, by)
    plain = [f for f in fns if f != "median"]
    out = [F.lit(1).alias("_any")] + [AGG_FNS[f](c).alias(name.format(col=c, fn=f)) for c in cols for f in plain]
    out = df.groupBy(*by).agg(*out) if by else df.agg(*out)
    if "median" in fns:
        for c in cols:
            alias = name.format(col=c, fn="median")
            med = grouped_quantiles(df, by, c, [0.5], alias=alias).drop("p")
            out = out.join(med, by, "left") if by else out.withColumn(alias, med.scalar())
    return out.select(*by, *[name.format(col=c, fn=f) for c in cols for f in fns])


# D4 ------------------------------------------------------------------------
def two_level_agg(df: DataFrame, outer, inner, inner_aggs: dict[str, Column],
                  outer_fns: Sequence[str] = ("count", "mean", "max", "min")) -> DataFrame:
    """Aggregate at (outer, inner), then summarise each measure per outer."""
    outer, inner = _cols(outer), _cols(inner)
    lvl1 = df.groupBy(*outer, *inner).agg(*[e.alias(n) for n, e in inner_aggs.items()])
    return agg_matrix(lvl1, outer, list(inner_aggs), outer_fns)


# D5 ------------------------------------------------------------------------
def argmax_entity(df: DataFrame, by, entity: str, metric: str, alias: str | None = None,
                  largest: bool = True) -> DataFrame:
    """Entity with the largest (smallest) metric per group; ties -> lowest entity."""
    by = _cols(by)
    m = F.col(metric)
    key = F.struct((-m if largest else m).alias("k"), F.col(entity).alias("e"))
    return df.filter(m.isNotNull()).groupBy(*by).agg(
        F.min_by(F.col(entity), key).alias(alias or f"{entity}_argmax_{metric}"))


# D6 ------------------------------------------------------------------------
def mode(df: DataFrame, by, col: str, alias: str | None = None,
         with_count: bool = False) -> DataFrame:
    """Most frequent non-null value per group; ties -> smallest value.

    Counts are combined map-side, so a hot group never materialises its rows.
    """
    by = _cols(by)
    counted = drop_null_keys(df.filter(F.col(col).isNotNull()), by).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    out = counted.groupBy(*by).agg(
        F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(alias or f"{col}_mode"),
        *([F.max("_n").alias(f"{alias or col}_mode_count")] if with_count else []))
    return out


# D7 / D8 / D10 -----------------------------------------------------------------
def pivot_agg(df: DataFrame, by, pivot_col: str, values: Sequence, measures: dict[str, Column],
              name: str = "{value}_{measure}", fill=None) -> DataFrame:
    """Pivot with a known value list and several named measures.

    ``measures`` maps measure name to an aggregate *over the value column
    expression* written with ``F.col('_v')`` placeholders is not needed: each
    measure is given as a function of a row mask, e.g.
    ``{"total": lambda m: F.sum(F.when(m, F.col("x")))}``.
    Conditional aggregation keeps it one pass / one shuffle.
    """
    by = _cols(by)
    exprs = []
    for v in values:
        mask = F.col(pivot_col) == F.lit(v)
        for mname, fn in measures.items():
            exprs.append(fn(mask).alias(name.format(value=v, measure=mname)))
    out = df.groupBy(*by).agg(*exprs)
    if fill is not None:
        out = out.na.fill(fill)
    return out


def pivot_count(df: DataFrame, by, col: str, values: Sequence, prefix: str | None = None,
                fill: int = 0) -> DataFrame:
    """Count rows per (by, value of col) as one column per value."""
    pre = "" if prefix == "" else f"{prefix if prefix is not None else col}_"
    return pivot_agg(df, by, col, values,
                     {"n": lambda m: F.count_if(m)}, name=pre + "{value}").na.fill(fill)


# D9 ------------------------------------------------------------------------
def melt(df: DataFrame, ids, cols: Sequence[str], var: str = "variable",
         value: str = "value", cast: str = "string") -> DataFrame:
    """Wide -> long with a single ``stack`` (no union, one scan)."""
    ids = _cols(ids)
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    return df.select(*ids, F.expr(f"stack({len(cols)}, {pairs}) AS (`{var}`, `{value}`)"))


def pivot_count_many(df: DataFrame, by, cols: Sequence[str], levels: dict[str, Sequence],
                     fill: int = 0) -> DataFrame:
    """Count-by-category for many columns with one shuffle.

    Instead of one pivot (one shuffle) per column, all columns are stacked
    long and counted once per (by, column, value); the wide layout is built
    from conditional sums of the small counted table.  ``levels`` gives the
    known value list per column (the output schema depends on it).
    """
    by = _cols(by)
    long = melt(df, by, cols, "_var", "_val").filter(F.col("_val").isNotNull())
    counted = long.groupBy(*by, "_var", "_val").agg(F.count(F.lit(1)).alias("_n"))
    exprs = []
    for c in cols:
        for v in levels[c]:
            m = (F.col("_var") == c) & (F.col("_val") == F.lit(str(v)))
            exprs.append(F.coalesce(F.sum(F.when(m, F.col("_n"))), F.lit(fill)).alias(f"{c}_{v}"))
    return counted.groupBy(*by).agg(*exprs)


# D11 -----------------------------------------------------------------------
def nunique(df: DataFrame, cols: Sequence[str], by=None, approx: bool = False) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    by = _cols(by)
    exprs = [fn(c).alias(f"{c}_nunique") for c in cols]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


# D12 / D13 / D14 -----------------------------------------------------------
def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Absolute and relative counts of each value (pandas ``value_counts``)."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()          # one-row scalar subquery
    return counts.select(col, "n", (F.col("n") / total).alias("share"))


def freq_table(df: DataFrame, col: str, order: str = "value") -> DataFrame:
    """Frequency table FA / FR / FAA / FRA in value order (or count order).

    The running sums go over the distinct values, range-partitioned.
    """
    from tadkit.operators.frame import cumulative_sum
    counts = value_counts(df, col, dropna=(order == "value"))
    # Descending frequency, nulls kept, value as tie-break
    c = counts.withColumn("_k1", F.col(col) if order == "value" else -F.col("n"))
    cum = cumulative_sum(c, [], ["_k1"] if order == "value" else ["_k1", col], ["n"])
    total = counts.agg(F.sum("n")).scalar()
    return cum.select(col, F.col("n").alias("fa"), F.col("share").alias("fr"), F.col("n_cum").alias("faa"),
                      (F.col("n_cum") / total).alias("fra"))


# D15 -----------------------------------------------------------------------
DESCRIBE_PCTS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


_SKETCH = 10_000             # cells that a column's values are first counted in
_FEW = 10_000                # cells of a part of them that is counted again


def _flip(bits: np.ndarray) -> np.ndarray:
    """The bits of doubles as whole numbers in the same order, and back."""
    return np.where(bits < 0, bits ^ np.int64(2 ** 63 - 1), bits)


def _cell_counts(x: DataFrame, spans: dict[str, list[tuple[int, int]]], cells: int) -> dict[str, pa.Table]:
    """By column, each span (lowest and highest ordered bits) cut into ``cells``: the rows of every cell that has some, with
    the lowest and highest bits there.  A task holds one such table of numbers a column, whatever it reads."""
    names = list(spans)
    lows = [np.array([lo for lo, _ in spans[c]], np.int64) for c in names]
    highs = [np.array([hi for _, hi in spans[c]], np.int64) for c in names]
    widths = [np.array([(hi - lo) // cells + 1 for lo, hi in spans[c]], np.uint64) for c in names]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(lo) * cells, np.int64) for lo in lows]
        least, most = [np.full(len(v), 2 ** 63 - 1) for v in n], [np.full(len(v), -2 ** 63) for v in n]
        for batch in batches:
            for c, (lo, hi, width) in enumerate(zip(lows, highs, widths)):
                v = batch.column(c).to_numpy(zero_copy_only=False)
                k = _flip((v[~np.isnan(v)] + 0.0).view(np.int64))
                s = np.searchsorted(lo, k, side="right") - 1
                inside = (s >= 0) & (k <= hi[s])
                k, s = k[inside], s[inside]
                cell = s * cells + ((k - lo[s]).view(np.uint64) // width[s]).astype(np.int64)
                n[c] += np.bincount(cell, minlength=len(n[c]))
                np.minimum.at(least[c], cell, k)
                np.maximum.at(most[c], cell, k)
        for c in range(len(names)):
            at = np.flatnonzero(n[c])
            for i in range(0, len(at), 10_000):
                part = at[i:i + 10_000]
                yield pa.record_batch([pa.array(np.full(len(part), c, np.int32)), *[pa.array(v) for v in (part, n[c][part], least[c][part], most[c][part])]],
                                      names=["c", "cell", "n", "low", "high"])
    t = x.select(*names).mapInArrow(count, "c int, cell long, n long, low long, high long").groupBy("c", "cell") \
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow().sort_by([("c", "ascending"), ("cell", "ascending")])
    return {name: t.filter(pc.equal(t["c"], c)) for c, name in enumerate(names)}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """Exact linear-interpolated quantiles ``{(col, p): value}`` in passes of bounded memory.

    The bits of doubles, ordered like them, are counted in ``_SKETCH`` equal cells between least and greatest; a cell
    that holds a wanted rank and more than one value is cut into ``_FEW`` between its own least and greatest, and so on.
    Two or three passes do for most columns, and nothing is sorted or shuffled but counts.  Same definition as
    pandas ``quantile`` / DuckDB ``quantile_cont``; null and NaN values are missing.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    names = [f"_x{i}" for i in range(len(cols))]
    if not probs or not names:
        return {}
    x = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(n) for c, n in zip(cols, names)])
    first = x.agg(*[f(n).alias(f"{n}_{k}") for n in names for k, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    total = {n: first[f"{n}_n"] for n in names}
    found: dict[tuple[str, int], float] = {}
    # Parts of a column that hold wanted ranks: lowest and highest bits, rows, rows below, ranks.
    parts: dict[str, list[tuple[int, int, int, int, list[int]]]] = {}
    for n in names:
        if total[n]:
            low, high = _flip(np.array([first[f"{n}_low"] + 0.0, first[f"{n}_high"] + 0.0]).view(np.int64)).tolist()
            parts[n] = [(low, high, total[n], 0, sorted({f((total[n] - 1) * p) for p in probs for f in (math.floor, math.ceil)}))]
    cells = _SKETCH
    while parts:
        counted = _cell_counts(x, {n: [(low, high) for low, high, *_ in held] for n, held in parts.items()}, cells)
        again: dict[str, list[tuple[int, int, int, int, list[int]]]] = {}
        for n, held in parts.items():
            cell, rows, lows, highs = (counted[n][c].to_numpy() for c in ("cell", "n", "low", "high"))
            for i, (_, _, size, below, ranks) in enumerate(held):
                at = slice(*np.searchsorted(cell, [i * cells, (i + 1) * cells]))
                ends = below + np.cumsum(rows[at])
                if not len(ends) or ends[-1] != below + size:
                    raise ValueError(f"{cols[names.index(n)]} has other rows in each pass")
                for j, rank in zip(np.searchsorted(ends, ranks, side="right"), ranks):
                    low, high, within = int(lows[at][j]), int(highs[at][j]), int(rows[at][j])
                    if low == high:
                        found[n, rank] = float(_flip(np.array([low])).view(np.float64)[0])
                    elif again.get(n) and again[n][-1][0] == low:
                        again[n][-1][4].append(rank)
                    else:
                        again.setdefault(n, []).append((low, high, within, int(ends[j]) - within, [rank]))
        parts, cells = again, _FEW
    out = {}
    for c, n in zip(cols, names):
        for p in probs:
            h = (total[n] - 1) * p
            lo = math.floor(h)
            x0, x1 = found.get((n, lo)), found.get((n, math.ceil(h)))
            out[c, p] = x0 if x0 == x1 else x0 + (h - lo) * (x1 - x0)
    return out


def grouped_quantiles(df: DataFrame, by, value: str, probs: Sequence[float], alias: str | None = None,
                      weight: str | None = None) -> DataFrame:
    """Exact interpolated quantiles per group as (by..., p, value), distributed.

    No group's values are ever buffered in one task: rows are counted per
    distinct (group, value) (``weight`` rows each, if given), running counts
    come from the range-partitioned ``cumulative_sum`` (a hot group spans
    several range partitions), and each distinct value is matched with its
    group's target ranks (n - 1) p by a join on the group key, which AQE's
    skew handling splits for a hot group.  Null group keys are dropped
    (pandas ``groupby``); null and NaN values are missing.
    """
    from tadkit.operators.frame import cumulative_sum
    by = _cols(by)
    alias = alias or value
    if not by:                                   # one group: the targets are a handful of literals
        q = exact_quantiles(df, [value], probs)
        return df.sparkSession.createDataFrame([(float(p), q[(value, float(p))]) for p in probs], f"p double, `{alias}` double")
    one = F.col(weight) if weight else F.lit(1)
    x = drop_null_keys(df, by).select(*by, F.col(value).cast("double").alias("_v"), one.cast("long").alias("_one"))
    counts = x.filter(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy(*by, "_v").agg(F.sum("_one").alias("_c"))
    cum = cumulative_sum(counts, by, ["_v"], ["_c"])
    n = counts.groupBy(*by).agg(F.sum("_c").alias("_n"))
    tg = n.select(*by, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")) \
        .withColumn("_h", (F.col("_n") - 1) * F.col("p")) \
        .withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h"))
    j = cum.join(tg, by)
    lo_in = (F.col("_lo") >= F.col("_c_cum") - F.col("_c")) & (F.col("_lo") < F.col("_c_cum"))
    hi_in = (F.col("_hi") >= F.col("_c_cum") - F.col("_c")) & (F.col("_hi") < F.col("_c_cum"))
    pick = j.filter(lo_in | hi_in).groupBy(*by, "p", "_h", "_lo").agg(
        F.max(F.when(lo_in, F.col("_v"))).alias("_x0"), F.max(F.when(hi_in, F.col("_v"))).alias("_x1"))
    return pick.select(*by, "p", (F.col("_x0") + (F.col("_h") - F.col("_lo")) * (F.col("_x1") - F.col("_x0"))).alias(alias))


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """Exact interpolated quantiles ``{(col, p): value}`` (null and NaN are
    missing; a column without values gives None)."""
    return exact_quantiles(df, list(cols), [float(p) for p in probs])


def describe(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = DESCRIBE_PCTS,
             exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """pandas ``describe(percentiles=...)`` as a long table.

    Moments come from one aggregate; ``exact`` quantiles come from
    ``quantile_values`` (distributed, linear interpolation = pandas), while
    ``exact=False`` uses the bounded-memory mergeable sketch.
    """
    exprs = []
    qv = quantile_values(df, cols, percentiles) if exact else None
    for c in cols:
        x = F.col(c).cast("double")
        q = (F.array(*[F.lit(qv[(c, float(p))]).cast("double") for p in percentiles]) if exact
             else F.percentile_approx(x, list(percentiles), accuracy))
        exprs.append(F.struct(F.count(x).alias("count"), F.avg(x).alias("mean"),
                              F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                              q.alias("q"), F.max(x).alias("max")).alias(c))
    one = df.agg(*exprs)
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("s")) for c in cols])).alias("r"))
    out = [F.col("r.variable").alias("variable"), F.col("r.s.count").alias("count"),
           F.col("r.s.mean").alias("mean"), F.col("r.s.std").alias("std"),
           F.col("r.s.min").alias("min")]
    for i, p in enumerate(percentiles):
        out.append(F.col("r.s.q")[i].alias(f"p{int(round(p * 100)):02d}"))
    out.append(F.col("r.s.max").alias("max"))
    return long.select(*out)


# D16 / D17 -----------------------------------------------------------------
def missing_zero_table(df: DataFrame, cols: Sequence[str] | None = None,
                       only_missing: bool = False) -> DataFrame:
    """Zeros, nulls, % null, zeros+nulls and % per column, in one aggregate."""
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    exprs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        is_num = dtypes[c] in numeric or dtypes[c].startswith("decimal")
        zero = F.count_if(F.col(c) == 0) if is_num else F.lit(0).cast("long")
        miss = F.count_if(F.col(c).isNull() | (F.isnan(F.col(c)) if dtypes[c] in ("double", "float") else F.lit(False)))
        exprs += [zero.alias(f"{c}__z"), miss.alias(f"{c}__m")]
    one = df.agg(*exprs)
    long = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"{c}__z").alias("zeros"), F.col(f"{c}__m").alias("missing"))
        for c in cols])).alias("r"))
    out = long.select(
        F.col("r.variable").alias("variable"), F.col("r.dtype").alias("dtype"),
        F.col("r.zeros").alias("zeros"), F.col("r.missing").alias("missing"),
        (100.0 * F.col("r.missing") / F.col("_n")).alias("pct_missing"),
        (F.col("r.zeros") + F.col("r.missing")).alias("zeros_missing"),
        (100.0 * (F.col("r.zeros") + F.col("r.missing")) / F.col("_n")).alias("pct_zeros_missing"))
    if only_missing:
        out = out.filter(F.col("missing") > 0)
    return out


def missing_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return missing_zero_table(df, cols).select("variable", (F.col("pct_missing") / 100).alias("missing_share"))


# D19 -----------------------------------------------------------------------
def mean_period_change(df: DataFrame, by, order: str, value: str, alias: str = "mean_change") -> DataFrame:
    """Average of x_t / x_{t-1} - 1 per group (first period has no change)."""
    from tadkit.operators.windows import lag_columns
    by = _cols(by)
    x = lag_columns(df, by, order, value, [1], prefix="_lag")
    chg = F.try_divide(F.col(value), F.col("_lag1")) - 1
    return x.select(*by, chg.alias("_chg")).groupBy(*by).agg(F.avg("_chg").alias(alias))


# D20 -----------------------------------------------------------------------
def share_of_group(df: DataFrame, by, value: str, alias: str = "share") -> DataFrame:
    """x / sum(x) over the group, as aggregate + join (skew-safe)."""
    by = _cols(by)
    tot = df.groupBy(*by).agg(F.sum(value).alias("_tot"))
    return df.join(tot, on=by, how="left").withColumn(
        alias, F.try_divide(F.col(value), F.col("_tot"))).drop("_tot")


# D21 -----------------------------------------------------------------------
def crosstab_share(df: DataFrame, row: str, col: str, values: Sequence, normalize: str = "columns") -> DataFrame:
    """Count cross-tab normalised by column totals (or by row totals)."""
    counted = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("_n"))
    key = col if normalize == "columns" else row
    counted = share_of_group(counted, [key], "_n", "_s")
    return counted.groupBy(row).agg(*[
        F.coalesce(F.sum(F.when(F.col(col) == F.lit(v), F.col("_s"))), F.lit(0.0)).alias(f"{col}_{v}")
        for v in values])


# D22 -----------------------------------------------------------------------
def first_last(df: DataFrame, by, order: str, value: str) -> DataFrame:
    by = _cols(by)
    return df.groupBy(*by).agg(F.min_by(value, order).alias(f"first_{value}"),
                               F.max_by(value, order).alias(f"last_{value}"))


# D24 -----------------------------------------------------------------------
def daily_counts(df: DataFrame, ts: str, by=None, alias: str = "n") -> DataFrame:
    by = _cols(by)
    return df.groupBy(*by, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias(alias))


# D25 -----------------------------------------------------------------------
def ordered_basket(df: DataFrame, by: str, order: str, item: str, alias: str = "items") -> DataFrame:
    """One row per entity: its items in time order (ties by item).

    A basket is one value, so an entity's items meet in one task by
    definition; entities without key form no basket."""
    return drop_null_keys(df, by).groupBy(by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda s: s[item]).alias(alias))


# D26 -----------------------------------------------------------------------
def shape_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """Mode (ties -> smallest), median, kurtosis (Fisher, population), skewness.

    Mode and median never buffer a group: the mode comes from value counts,
    the median from ``grouped_quantiles``."""
    by = _cols(by)
    mom = [F.kurtosis(col).alias(f"{col}_kurtosis"), F.skewness(col).alias(f"{col}_skew")]
    if not by:
        q = quantile_values(df, [col], [0.5])[(col, 0.5)]
        m = mode(df.withColumn("_one", F.lit(1)), "_one", col, alias=f"{col}_mode").first()
        return df.agg(F.lit(m[f"{col}_mode"] if m else None).alias(f"{col}_mode"), F.lit(q).alias(f"{col}_median"), *mom)
    med = grouped_quantiles(df, by, col, [0.5], alias=f"{col}_median").drop("p")
    base = drop_null_keys(df, by).groupBy(*by).agg(*mom).join(med, by, "left")
    return base.join(mode(df, by, col, alias=f"{col}_mode"), by, "left") \
        .select(*by, f"{col}_mode", f"{col}_median", f"{col}_kurtosis", f"{col}_skew")


# D27 -----------------------------------------------------------------------
def duplicate_keys(df: DataFrame, cols: Sequence[str] | None = None, alias: str = "n") -> DataFrame:
    cols = list(cols or df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(alias)).filter(F.col(alias) > 1)


# D28 -----------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bin counts over [min, max] (last bin closed, like numpy)."""
    x = F.col(col).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    b = F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins))
    b = F.when(lo == hi, F.lit(1)).otherwise(b)
    return (df.filter(F.col(col).isNotNull())
            .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (lo + (F.col("bin") - 1) * (hi - lo) / bins).alias("left"),
                    (lo + F.col("bin") * (hi - lo) / bins).alias("right"), "n"))


def box_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """Min, quartiles, max (per group, or global through ``quantile_values``)."""
    by = _cols(by)
    x = F.col(col).cast("double")
    if not by:
        q = quantile_values(df, [col], [0.25, 0.5, 0.75])
        return df.agg(F.min(x).alias("min"), F.lit(q[(col, 0.25)]).alias("q1"), F.lit(q[(col, 0.5)]).alias("median"),
                      F.lit(q[(col, 0.75)]).alias("q3"), F.max(x).alias("max"))
    q = grouped_quantiles(df, by, col, [0.25, 0.5, 0.75], alias="_q")
    wide = q.groupBy(*by).agg(*[F.max(F.when(F.col("p") == p, F.col("_q"))).alias(n)
                                for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    mm = drop_null_keys(df, by).groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"))
    return mm.join(wide, by, "left").select(*by, "min", "q1", "median", "q3", "max")


# D29 -----------------------------------------------------------------------
def archetypes(df: DataFrame, cluster: str, cols: Sequence[str], overall_label="overall") -> DataFrame:
    """Per-cluster means beside the overall mean (one row per cluster + total)."""
    per = df.groupBy(F.col(cluster).cast("string").alias(cluster)).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])
    tot = df.agg(F.lit(overall_label).alias(cluster), F.count(F.lit(1)).alias("n"),
                 *[F.avg(c).alias(c) for c in cols])
    return per.unionByName(tot)


# D30 -----------------------------------------------------------------------
def word_counts(df: DataFrame, tokens: str, by=None) -> DataFrame:
    by = _cols(by)
    return (df.select(*by, F.explode(tokens).alias("word"))
            .groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n")))


# D18 / D23 helpers -------------------------------------------------------------
def olap(df: DataFrame, dims: Iterable[str], measures: dict[str, Column], rollup: str | None = None) -> DataFrame:
    dims = list(dims)
    g = df.cube(*dims) if rollup == "cube" else df.rollup(*dims) if rollup == "rollup" else df.groupBy(*dims)
    return g.agg(*[e.alias(n) for n, e in measures.items()])


def ratio(num: Column | str, den: Column | str) -> Column:
    """Ratio of aggregates; 0 denominators give null (the source got NaN)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


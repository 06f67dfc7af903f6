"""Projection, filter, ordering, sampling and set operators (B, F, G).

Global orderings never use an unpartitioned window (that moves every row to
one task): dense ids come from a range-partitioned sort plus per-partition
offsets; per-key "keep first/last" is an aggregate (partial-combined, so a
hot key costs no more than any other); exact per-class samples draw from a
per-class threshold instead of sorting each class in one task.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tadkit.session import cut_lineage


def _cols(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


# B3 ------------------------------------------------------------------------
def clean_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Strip, lower-case, spaces and punctuation -> ``_``."""
    def fix(c: str) -> str:
        s = re.sub(r"[^0-9A-Za-z_]+", "_", c.strip()).strip("_")
        return s.lower() if lower else s
    return df.toDF(*[fix(c) for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def affix_names(df: DataFrame, prefix: str = "", suffix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else f"{prefix}{c}{suffix}" for c in df.columns])


# B4 / B5 -------------------------------------------------------------------
def drop_like(df: DataFrame, substr: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if substr in c])


def select_like(df: DataFrame, substr: str | None = None, prefix: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in df.columns if c in keep
            or (substr is not None and substr in c) or (prefix is not None and c.startswith(prefix))]
    return df.select(*cols)


# B10 -----------------------------------------------------------------------
def band(x, edges: Sequence[float], labels: Sequence[str], right: bool = True,
         include_lowest: bool = True) -> Column:
    """Numbers -> labels by edges; ``(a, b]`` like ``pd.cut`` (right=True)."""
    c = F.col(x) if isinstance(x, str) else x
    out = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        if right:
            cond = (c > lo) & (c <= hi)
            if include_lowest and i == 0:
                cond = (c >= lo) & (c <= hi)
        else:
            cond = (c >= lo) & (c < hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


# B11 / B12 -----------------------------------------------------------------
def recode(x, mapping: dict, default=None, keep_unmapped: bool = False) -> Column:
    """Small literal map lookup (``Series.map``); unmapped -> default / null."""
    c = F.col(x) if isinstance(x, str) else x
    mp = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    val = mp[c]
    if keep_unmapped:
        return F.coalesce(val, c.cast("string"))
    return val if default is None else F.coalesce(val, F.lit(default))


def recode_many(df: DataFrame, spec: dict[str, dict], default=None, suffix: str = "") -> DataFrame:
    """Many columns through shared catalogs in one projection (no joins)."""
    return df.withColumns({f"{c}{suffix}": recode(c, m, default) for c, m in spec.items()})


# B15 -----------------------------------------------------------------------
def add_row_id(df: DataFrame, order_by: Sequence, alias: str = "row_id",
               checkpoint: bool = True) -> DataFrame:
    """Dense 1..n id in a stated order, without a single-task window.

    1. range-partitioned sort (Spark samples the key to balance ranges, so a
       hot key value still spreads by the remaining sort columns);
    2. ``monotonically_increasing_id`` = (partition id << 33) + local index;
    3. rows per partition -> cumulative offsets (one row per partition, a
       proven bound, broadcast);
    4. id = offset + local index + 1.
    The sorted frame is reliably checkpointed so both uses see the same rows.
    """
    order = _cols(order_by)
    sorted_df = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        sorted_df = cut_lineage(sorted_df)
    pid = F.shiftright("_mid", 33)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted_df.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    return (sorted_df.withColumn("_pid", pid).withColumn("_loc", local)
            .join(F.broadcast(offsets), "_pid")          # one row per partition
            .withColumn(alias, F.col("_off") + F.col("_loc") + 1)
            .drop("_mid", "_pid", "_loc", "_off"))


# B19 -----------------------------------------------------------------------
def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, dtype, non-null count, null count."""
    cols = df.columns
    dtypes = dict(df.dtypes)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                             F.col(f"_nn{i}").alias("non_null")) for i, c in enumerate(cols)])
    return one.select("_n", F.explode(arr).alias("r")).select(
        "r.pos", "r.column", "r.dtype", "r.non_null", (F.col("_n") - F.col("r.non_null")).alias("nulls"))


def dtype_tally(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return spark.createDataFrame([(t,) for _, t in df.dtypes], "dtype string").groupBy("dtype").count()


# F3 / F4 / F5 / F6 / F7 ------------------------------------------------------
def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out where a scan has fewer partitions than there are cores (a few large row
    groups), for work that costs more than moving them.  Other scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def key_draw(key: Sequence[str], seed: int) -> Column:
    """A draw from [0, 1) that depends on the key and the seed alone: the same in every run, plan and engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))), 1, 8), 16, 10).cast("double") / 2.0 ** 32


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, key: Sequence[str] | None = None) -> DataFrame:
    """Each row with probability ``fraction``, by ``key_draw`` if a key is given (rows of one key stay together)."""
    if key is not None:
        return df.filter(key_draw(key, seed) < fraction)
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def balanced_sample(df: DataFrame, label: str, n: int, seed: int, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``min(n, class size)`` random rows per class.

    Each row draws hash(key, seed); a class keeps its n smallest draws.  The
    rank of a draw within its class is a distributed running count, so no
    class, however large, is sorted in one task.  Rows of a null label are a
    class.  Rows that agree in ``key`` are told apart by their other columns.
    """
    key = list(key or df.columns)
    rest = [c for c in df.columns if c not in key]
    x = df.withColumns({"_u": F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), "_one": F.lit(1)})
    if rest:
        x = x.withColumn("_v", F.xxhash64(*[F.col(c) for c in rest]))
    ranked = cumulative_sum(x, [label], ["_u", *(["_v"] if rest else [])], ["_one"])
    return ranked.filter(F.col("_one_cum") <= n).drop("_u", "_v", "_one", "_one_cum")


def hash_split(df: DataFrame, key: Sequence[str] | str, test_frac: float, seed: int = 42,
               col: str = "sample") -> DataFrame:
    """Stable train/test label from a hash of the key (F5/F6): same key, same side."""
    key = _cols(key)
    h = F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(10000))
    return df.withColumn(col, F.when(h < int(round(test_frac * 10000)), F.lit("test")).otherwise(F.lit("train")))


def random_split(df: DataFrame, weights: Sequence[float], seed: int, key: Sequence[str] | None = None) -> list[DataFrame]:
    """Parts of about the given weights, by ``key_draw`` if a key is given."""
    if key is None:
        return df.randomSplit(list(weights), seed)
    ends = [sum(weights[:i]) / sum(weights) for i in range(len(weights))] + [1.0]
    draw = key_draw(key, seed)
    return [df.filter((draw >= a) & (draw < b)) for a, b in zip(ends, ends[1:])]


def temporal_split(df: DataFrame, ts: str, test_frac: float, tie: Sequence[str] = ()) -> DataFrame:
    """the last ``test_frac`` of rows in time order are test (``iloc`` split)."""
    ided = add_row_id(df, [ts, *tie], alias="_rid")
    n = ided.agg(F.max("_rid")).scalar()
    cut = F.floor(n * F.lit(1 - test_frac))
    return ided.withColumn("sample", F.when(F.col("_rid") > cut, F.lit("test")).otherwise(F.lit("train"))).drop("_rid")


def last_periods_split(df: DataFrame, period: str, n_test: int) -> DataFrame:
    """F7 by periods: the last ``n_test`` distinct periods are test (null periods train)."""
    first = df.select(period).filter(F.col(period).isNotNull()).distinct().orderBy(F.col(period).desc()).limit(n_test).agg(F.min(period)).scalar()
    return df.withColumn("sample", F.when(F.col(period) >= first, F.lit("test")).otherwise(F.lit("train")))


# G ---------------------------------------------------------------------------
def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_keys(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """spine = distinct union of the key from several tables."""
    return union_all([f.select(key) for f in frames]).filter(F.col(key).isNotNull()).distinct()


def dedupe(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str | None = None,
           keep: str = "first") -> DataFrame:
    """One row per key, the first/last in ``order`` (ties: full-row order).

    Written as ``min_by``/``max_by`` of the whole row, an aggregate that is
    combined map-side, so a key holding a third of the table is no slower.
    """
    key = _cols(key)
    if order is None:
        return df.dropDuplicates(key)
    order = _cols(order)
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest])
    ordk = F.struct(*[F.col(c) for c in order], row)
    pick = F.min_by(row, ordk) if keep == "first" else F.max_by(row, ordk)
    return df.groupBy(*key).agg(pick.alias("_row")).select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def difference(a: DataFrame, b: DataFrame, keep_dups: bool = False) -> DataFrame:
    return a.exceptAll(b) if keep_dups else a.subtract(b)


def split_apply_union(df: DataFrame, cond: Column, fn_true, fn_false) -> DataFrame:
    """Treat the two sides of a predicate differently and re-append."""
    return fn_true(df.filter(cond)).unionByName(fn_false(df.filter(~cond | cond.isNull())))


# Running sums over a global order, without one-task windows ------------------
def cumulative_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str],
                   suffix: str = "_cum", maxes: Sequence[str] = ()) -> DataFrame:
    """Running sums of ``values`` (and running maxima of ``maxes``) per ``by``
    group in ``order`` (ties: row order).  A null key is a group like any other,
    so every row is kept.

    1. range-partition on (by, order) and sort inside partitions (a large
       group is cut across several range partitions);
    2. local running values per (partition, group);
    3. per (partition, group) totals -> offsets from earlier partitions of
       the same group (a group has at most #partitions such rows);
    4. running value = local combined with offset.
    """
    by, order, values, maxes = list(by), list(order), list(values), list(maxes)
    x = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_pid", F.spark_partition_id()))
    wl = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = x.withColumns({f"_l_{v}": F.sum(v).over(wl) for v in values} | {f"_l_{v}": F.max(v).over(wl) for v in maxes})
    tot = x.groupBy("_pid", *by).agg(*[F.sum(v).alias(f"_t_{v}") for v in values], *[F.max(v).alias(f"_t_{v}") for v in maxes])
    wo = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offs = tot.select(F.col("_pid").alias("_op"), *[F.col(b).alias(f"_ob{i}") for i, b in enumerate(by)],
                      *[F.sum(f"_t_{v}").over(wo).alias(f"_o_{v}") for v in values],
                      *[F.max(f"_t_{v}").over(wo).alias(f"_o_{v}") for v in maxes])
    on = F.col("_pid") == F.col("_op")
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"_ob{i}"))
    total = {f"{v}{suffix}": F.coalesce(F.col(f"_l_{v}") + F.col(f"_o_{v}"), F.col(f"_l_{v}"), F.col(f"_o_{v}")) for v in values}
    total |= {f"{v}{suffix}": F.greatest(F.col(f"_l_{v}"), F.col(f"_o_{v}")) for v in maxes}
    return local.join(offs, on).withColumns(total).drop(
        "_pid", "_op", *[f"_ob{i}" for i in range(len(by))], *[f"{t}{v}" for t in ("_l_", "_o_") for v in values + maxes])

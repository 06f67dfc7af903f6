"""Window and time-window operators.

Lags, running sums, ranks and look-back windows are built on
``cumulative_sum``, whose range partitions cut a heavy key into many tasks;
there is one path for all sizes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tadkit.functions.dates import WEEKDAY_LETTERS, epoch_micros
from tadkit.session import written

DAY_US = 86_400 * 1_000_000


def _cols(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


# E1 ------------------------------------------------------------------------
def top_k(df: DataFrame, by, order: Sequence[Column], k: int, rank_col: str = "rank",
          salt_buckets: int = 16, salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Top-k rows per group, exact, in two rounds.

    Round 1 ranks inside (group, salt) sub-groups and keeps k rows of each,
    round 2 ranks the <= k * salt_buckets survivors per group.  The global
    top-k is always among the survivors, and no task sorts a whole hot group.
    ``order`` must be a total order (add an id as the last key).
    """
    by = _cols(by)
    salt_src = [F.col(c) for c in (salt_cols or df.columns)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_src), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*by, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*by).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)


# E2 ------------------------------------------------------------------------
def top_k_packed(df: DataFrame, by, item_cols: Sequence[str], order: Sequence[Column], k: int,
                 pad_value=0) -> DataFrame:
    """Top-k per group packed as an array of structs, padded to length k."""
    by = _cols(by)
    ranked = top_k(df, by, order, k)
    packed = ranked.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", *item_cols))).alias("_a"))
    items = F.transform("_a", lambda s: F.struct(*[s[c].cast("double").alias(c) for c in item_cols]))
    pad = F.struct(*[F.lit(pad_value).cast("double").alias(c) for c in item_cols])
    return packed.select(*by, F.concat(items, F.array_repeat(pad, F.lit(k) - F.size("_a"))).alias("top"))


# E3 ------------------------------------------------------------------------
def running_sum(df: DataFrame, by, order: Sequence, value: str, alias: str = "running",
                share: bool = False) -> DataFrame:
    """Running sum per group in ``order`` (and its share of the group's sum).

    Every row is kept; rows of a null key get null."""
    from tadkit.operators.frame import cumulative_sum
    by, order = _cols(by), _cols(order)
    out = cumulative_sum(df, by, order, [value], suffix="__cum").withColumnRenamed(f"{value}__cum", alias)
    for b in by:
        out = out.withColumn(alias, F.when(F.col(b).isNotNull(), F.col(alias)))
    if share:
        total = df.groupBy(*by).agg(F.sum(value).alias("_tot")) if by else None
        if total is not None:
            out = out.join(total, by, "left").withColumn(
                alias + "_share", F.try_divide(F.col(alias).cast("double"), F.col("_tot").cast("double"))).drop("_tot")
        else:
            out = out.withColumn(alias + "_share", F.try_divide(F.col(alias).cast("double"), df.agg(F.sum(value)).scalar().cast("double")))
    return out


# Lags ---------------------------------------------------------------------------
def lag_columns(df: DataFrame, by: Sequence[str], order: Sequence, value: str, lags: Sequence[int],
                prefix: str = "lag") -> DataFrame:
    """Add ``{prefix}{i}`` = value i rows earlier in ``order`` within ``by``.

    ``order`` must be a total order.  Each row gets its position from a
    range-partitioned running count (a hot key is cut across partitions) and
    the lags come from one shuffle on (key, position), which spreads a hot key
    over all reducers.  Every row is kept; rows of a null key have null lags.
    """
    from tadkit.operators.frame import cumulative_sum
    by, order = list(by), _cols(order)
    ocols = [f"_o{i}" for i in range(len(order))]
    x = df.select("*", *[o.alias(n) if isinstance(o, Column) else F.col(o).alias(n) for o, n in zip(order, ocols)])
    pos = cumulative_sum(x.withColumn("_one", F.lit(1)), by, ocols, ["_one"]).withColumnRenamed("_one_cum", "_pos") \
        .drop("_one", *ocols)
    shifted = pos.select(*by, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.col("_pos") + i).alias("_pos"))
                                                   for i in lags])).alias("_s"), F.col(value).alias("_v")) \
        .select(*by, "_s.i", "_s._pos", "_v")
    wide = shifted.groupBy(*by, "_pos").agg(*[F.first(F.when(F.col("i") == i, F.col("_v")), ignorenulls=True)
                                               .alias(f"{prefix}{i}") for i in lags])
    return pos.join(wide, [*by, "_pos"], "left").drop("_pos")


# E4 ------------------------------------------------------------------------
def first_per_group(df: DataFrame, by, order: Sequence[str]) -> DataFrame:
    """First row per group in ``order`` (aggregate, not a window)."""
    from tadkit.operators.frame import dedupe
    return dedupe(df, by, order, keep="first")


# E6 ------------------------------------------------------------------------
def period_changes(df: DataFrame, by, order: str, value: str) -> DataFrame:
    """Change (x_t - x_{t-1}) / x_{t-1} and up/down flags per row.

    Flags keep the source's naming: ``inc`` is set when the previous value is
    greater than the current one, ``dec`` when it is smaller.
    """
    by = _cols(by)
    x = lag_columns(df, by, order, value, [1], prefix="_lag")
    prev = F.col("_lag1")
    return x.withColumns({
        "prev": prev,
        "chg": F.try_divide(F.col(value) - prev, prev),
    }).drop("_lag1").withColumns({
        "inc": (F.col("prev") > F.col(value)).cast("int"),
        "dec": (F.col("prev") < F.col(value)).cast("int"),
    })


# E7 / E8 / E9 / C8 -----------------------------------------------------------
# Sums over time windows are differences of two running sums, so their cost
# follows the rows, not rows times window length.  A row's own window ends
# where it stands, so one sweep over sorted range partitions gives most of them;
# what a heavy key has before a partition comes from ``interval_sums``, whose
# running sums cut it across partitions.  Values are summed as integers or
# decimals, which makes the differences exact.
_EXACT = "decimal(38,10)"
_SWEEP_ROWS = 100_000        # rows that a sweep takes at a time


def interval_sums(rows: DataFrame, anchors: DataFrame, sums: Sequence[str], closed: bool = False,
                  last: str | None = None) -> DataFrame:
    """Per anchor (_id, _k, _lo, _hi): sums of its key's ``rows`` (_k, _us, ...)
    with ``_lo <= _us < _hi`` (``<=`` if ``closed``), and the greatest ``last``
    value of all rows before the end.  Anchors without key or time give nothing.
    """
    from tadkit.operators.frame import cumulative_sum
    sums, maxes = list(sums), [last] if last else []
    types = dict(rows.dtypes)
    rows = rows.filter(F.col("_k").isNotNull() & F.col("_us").isNotNull())
    anchors = anchors.filter(F.col("_k").isNotNull() & F.col("_lo").isNotNull() & F.col("_hi").isNotNull())
    none = [F.lit(None).cast(types[c]).alias(c) for c in sums + maxes]
    id_type = dict(anchors.dtypes)["_id"]
    events = rows.select("_k", "_us", F.lit(1).alias("_o"), F.lit(None).cast(id_type).alias("_id"), F.lit(0).alias("_sign"), *sums, *maxes)
    for at, place, sign in (("_lo", 0, -1), ("_hi", 2 if closed else 0, 1)):
        events = events.unionByName(anchors.select("_k", F.col(at).alias("_us"), F.lit(place).alias("_o"), "_id", F.lit(sign).alias("_sign"), *none))
    cum = cumulative_sum(events, ["_k"], ["_us", "_o"], sums, maxes=maxes).filter("_sign <> 0")
    out = [F.sum(F.col("_sign") * F.coalesce(F.col(f"{c}_cum"), F.lit(0))).alias(c) for c in sums]
    return cum.groupBy("_id").agg(*out, *[F.max(F.when(F.col("_sign") == 1, F.col(f"{c}_cum"))).alias(c) for c in maxes])


def _window_rows(df: DataFrame, key: str, ts: str, value: str, row_id: str) -> DataFrame:
    """Rows with key, time and value; the value as whole units and ten-billionths, whose sums are exact."""
    base = df.select(F.col(key).alias("_k"), F.col(row_id).alias("_id"), epoch_micros(ts).alias("_us"), F.col(value).cast("double").alias("_v"),
                     F.hour(F.col(ts)).alias("_h"), F.weekday(F.col(ts)).alias("_d"))
    exact = F.col("_v").cast(_EXACT)
    return base.withColumns({"_si": F.floor(exact).cast("long"), "_sf": ((exact - F.floor(exact)) * 10 ** 10).cast("long")})


def _starts(t: np.ndarray, key: np.ndarray, at: np.ndarray, closed: bool = False) -> np.ndarray:
    """Position among rows (sorted by key and time ``t``) of time ``at`` of each row's key:
    that of its first row there or later, behind those at that time if ``closed``."""
    n = len(t)
    flag = np.concatenate([np.ones(n, np.int8), np.full(n, 2 if closed else 0, np.int8)])
    order = np.lexsort((flag, np.concatenate([t, at]), np.concatenate([key, key])))
    row = order < n
    place = np.empty(n, np.int64)
    place[order[~row] - n] = np.cumsum(row)[~row]
    return place


def _sweep(counts: bool, closed: bool):
    """One pass over a range partition sorted by key, time and value, in runs of Arrow
    batches.  Rows that later windows of the last key may still reach are carried over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        carried, fresh, start, done = None, [], None, False
        source = iter(batches)
        while not done:
            batch = next(source, None)
            done = batch is None
            if batch is not None:
                fresh.append(batch)
            old = carried.num_rows if carried is not None else 0
            if not fresh or (not done and sum(b.num_rows for b in fresh) < max(_SWEEP_ROWS, old)):
                continue
            new = pa.Table.from_batches(fresh)
            fresh = []
            x = pa.concat_tables([carried, new]) if old else new
            k = x.column("_k").combine_chunks()
            code = np.concatenate([[0], np.cumsum(pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False))]).astype(np.int64)
            us, lo, hi = (x.column(c).to_numpy() for c in ("_us", "_lo", "_hi"))
            if start is None:
                start = (k[0], us[0])
            i, j = _starts(us, code, lo), _starts(us, code, hi, closed)
            j = np.maximum(i, j)

            def total(v: np.ndarray) -> np.ndarray:
                c = np.concatenate([[0], np.cumsum(v)])
                return (c[j] - c[i])[old:]
            v = x.column("_v")
            known = pc.is_valid(v).to_numpy().astype(np.int64)
            some = (j > i)[old:]
            last = np.maximum(j - 1, 0)[old:]
            first = pc.equal(k, start[0]).to_numpy(zero_copy_only=False)[old:]
            # What lies before the partition is left to a second pass.
            late = first & (lo[old:] < start[1])
            until = np.minimum(hi[old:], start[1] - (1 if closed else 0))
            m = len(us) - old
            cols = {"_id": x.column("_id").combine_chunks()[old:], "_n": pa.array((j - i)[old:]), "_nv": pa.array(total(known)),
                    "_si": pa.array(total(x.column("_si").fill_null(0).to_numpy())), "_sf": pa.array(total(x.column("_sf").fill_null(0).to_numpy())),
                    "_us": pa.array(us[old:]), "_last_us": pa.array(us[last], mask=~some),
                    "_last_v": pc.if_else(pa.array(some), v.combine_chunks().take(pa.array(last)), pa.scalar(None, pa.float64())),
                    "_k": k[old:], "_lo": pa.array(lo[old:], mask=~late), "_hi": pa.array(until, mask=~late),
                    "_row": pa.array((part << 33) + number + np.arange(m))}
            if counts:
                hour, day = x.column("_h").to_numpy(), x.column("_d").to_numpy()
                both = np.stack([total(hour == h) for h in range(24)] + [total(day == d) for d in range(7)], axis=1).astype(np.int32)
                cols["_counts"] = pa.ListArray.from_arrays(pa.array(np.arange(0, 31 * m + 1, 31, dtype=np.int32)), pa.array(both.ravel()))
            number += m
            for b in pa.table(cols).to_batches(max_chunksize=10_000):
                yield b
            carried = x.slice(int(np.flatnonzero((code == code[-1]) & (us >= min(lo[-1], us[-1])))[0]))    # starts ascend
    return run


def _windows(base: DataFrame, closed: bool = False, counts: bool = False) -> DataFrame:
    """Per row of ``base`` with key and time: number of its key's rows with
    ``_lo <= _us < _hi`` (``<=`` if ``closed``), of those with a value, their sum,
    the last of them and, with ``counts``, how many fall on each hour and weekday.

    One sweep over range partitions.  Windows of a partition's first key that
    begin before the partition get what lies there from a second pass
    (``interval_sums``) over the keys that are cut by a partition's border.
    """
    k, ident = dict(base.dtypes)["_k"], dict(base.dtypes)["_id"]
    x = base.filter("_k is not null and _us is not null and _lo is not null and _hi is not null")
    schema = f"_id {ident}, _n long, _nv long, _si long, _sf long, _us long, _last_us long, _last_v double, _k {k}, _lo long, _hi long, _row long"
    cols = ["_k", "_us", "_lo", "_hi", "_v", "_id", "_si", "_sf", *(["_h", "_d"] if counts else [])]
    swept = x.select(*cols).repartitionByRange("_k", "_us").sortWithinPartitions("_k", "_us", "_v") \
        .mapInArrow(_sweep(counts, closed), schema + (", _counts array<int>" if counts else ""))
    swept = written(swept, "swept")
    late = swept.filter("_lo is not null")
    more = ["_n", "_nv", "_si", "_sf"]
    one = {"_n": F.lit(1).cast("long"), "_nv": F.col("_v").isNotNull().cast("long"), "_last": F.struct("_us", "_v")}
    if counts:
        one |= {f"_c{h}": (F.col("_h") == h).cast("long") for h in range(24)} | {f"_c{24 + d}": (F.col("_d") == d).cast("long") for d in range(7)}
    rows = x.join(late.select("_k").distinct(), "_k", "left_semi").withColumns(one)
    sums = [*more, *[f"_c{i}" for i in range(31)]] if counts else more
    before = interval_sums(rows, late.select(F.col("_row").alias("_id"), "_k", "_lo", "_hi"), sums, closed=closed, last="_last")
    before = before.toDF(*[f"{c}_b" for c in before.columns]).withColumnRenamed("_id_b", "_row")
    joined = late.join(before, "_row", "left")
    whole = [(F.col(c) + F.coalesce(f"{c}_b", F.lit(0))).alias(c) for c in more]
    reached = F.when((F.col("_n") == 0) & (F.col("_n_b") > 0), F.col("_last_b"))
    whole += [F.coalesce("_last_us", reached["_us"]).alias("_last_us"), F.when(F.col("_n") > 0, F.col("_last_v")).otherwise(reached["_v"]).alias("_last_v")]
    if counts:
        whole.append(F.array(*[(F.element_at("_counts", i + 1) + F.coalesce(f"_c{i}_b", F.lit(0))).cast("int") for i in range(31)]).alias("_counts"))
    names = ["_id", "_us", *more, "_last_us", "_last_v", *(["_counts"] if counts else [])]
    inside = swept.filter("_lo is null").select(*names)
    across = joined.select("_id", "_us", *whole).select(*names)
    return inside.unionByName(across)


def _swept_sum() -> Column:
    """The exact sum of the values of a window."""
    return F.when(F.col("_nv") > 0, (F.col("_si").cast(_EXACT) + F.col("_sf").cast("decimal(28,0)") / F.lit(10 ** 10).cast("decimal(11,0)")).cast(_EXACT).cast("double"))


def _with_the_rest(found: DataFrame, base: DataFrame) -> DataFrame:
    """Rows without key or time have empty windows."""
    rest = base.filter("_k is null or _us is null or _lo is null or _hi is null").select("_id", "_us", F.lit(0).cast("long").alias("_n"))
    return found.unionByName(rest, allowMissingColumns=True)


def lookback_features(df: DataFrame, key: str, ts: str, value: str, row_id: str,
                      days: int = 30, top_n: int = 3) -> DataFrame:
    """Per row: features of the same key's rows in ``[ts - days, ts)``.

    Output: row_id, num_op, value_mean, secs_since_last, value_last (max on
    ties of the last timestamp), hours_top (top_n most frequent hours, sorted
    by hour, ``|``-joined) and weekdays_top (top_n weekdays, sorted Monday
    first, as letters).  Frequency ties go to the smaller hour / weekday.
    Rows without key or time are kept, with num_op 0.  Values are summed at ten
    decimals and must lie within 64-bit integers.
    """
    base = _window_rows(df, key, ts, value, row_id)
    base = base.withColumns({"_lo": F.col("_us") - days * DAY_US, "_hi": F.col("_us")})
    x = _with_the_rest(_windows(base, counts=True), base)

    def top(first: int, n_levels: int, label=None) -> Column:
        arr = F.transform(F.slice("_counts", first + 1, n_levels), lambda c, i: F.struct((-c).alias("c"), i.alias("v")))
        kept = F.slice(F.array_sort(F.filter(arr, lambda s: s["c"] < 0)), 1, top_n)
        vals = F.array_sort(F.transform(kept, lambda s: s["v"]))
        if label is not None:
            vals = F.transform(vals, lambda v: F.element_at(label, v + 1))
        return F.coalesce(F.array_join(F.transform(vals, lambda v: v.cast("string")), "|"), F.lit(""))

    letters = F.array(*[F.lit(ch) for ch in WEEKDAY_LETTERS])
    return x.select(
        F.col("_id").alias(row_id), F.col("_n").alias("num_op"),
        F.try_divide(_swept_sum(), F.col("_nv")).alias("value_mean"),
        ((F.col("_us") - F.col("_last_us")) / 1e6).alias("secs_since_last"),
        F.col("_last_v").alias("value_last"),
        top(0, 24).alias("hours_top"), top(24, 7, letters).alias("weekdays_top"))


def lookback_agg(df: DataFrame, key: str, ts: str, value: str, row_id: str, days: int) -> DataFrame:
    """Count / sum / mean of the key's values in ``[ts - days, ts)`` per row."""
    base = _window_rows(df, key, ts, value, row_id)
    base = base.withColumns({"_lo": F.col("_us") - days * DAY_US, "_hi": F.col("_us")})
    x = _with_the_rest(_windows(base), base)
    total = _swept_sum()
    return x.select(F.col("_id").alias(row_id), F.col("_n").alias("n_prev"), total.alias("sum_prev"), (total / F.col("_nv")).alias("mean_prev"))


def year_ago_mean(df: DataFrame, key: str, ts: str, value: str, row_id: str,
                  days: int = 30, years: int = 1, alias: str = "value_mean_year_ago") -> DataFrame:
    """Mean of the key's values in [ts - years - days, ts - years] (both closed,
    calendar years: Feb 29 -> Feb 28)."""
    end = F.timestamp_micros("_us") - F.make_ym_interval(F.lit(years), F.lit(0))
    base = _window_rows(df, key, ts, value, row_id).withColumn("_hi", F.unix_micros(end))
    base = base.withColumn("_lo", F.col("_hi") - days * DAY_US)
    x = _with_the_rest(_windows(base, closed=True), base)
    return x.select(F.col("_id").alias(row_id), F.try_divide(_swept_sum(), F.col("_nv")).alias(alias))


# E10 / E11 -----------------------------------------------------------------
def anchor_windows(df: DataFrame, key: str, period: str, subs: Sequence[int]) -> DataFrame:
    """Replicate each row to every (anchor, sub) window containing it.

    A row of period m belongs to anchors m .. m + sub - 1 for each sub-window
    length, so one ``groupBy(key, anchor, sub)`` computes all windows at once.
    """
    def tag(s):
        return lambda a: F.struct(a.alias("anchor"), F.lit(s).alias("sub"))
    arr = F.flatten(F.array(*[F.transform(F.sequence(F.col(period), F.col(period) + s - 1), tag(s)) for s in subs]))
    return df.withColumn("_w", F.explode(arr)).select("*", "_w.anchor", "_w.sub").drop("_w")


def anchor_features(df: DataFrame, key: str, period: str, value: str, subs: Sequence[int] = (3, 6, 9, 12),
                    flags: Sequence[str] = (), scale: int = 10) -> DataFrame:
    """min/max/mean/median/std of ``value`` (+ mean of flags) per
    (key, anchor period) for every sub-window, pivoted by sub-window length.

    Rows are first reduced to one partial row per (key, period), and for the
    medians to one row per (key, period, value); only these are replicated to
    the windows.  Sums are exact at ``scale`` decimals.  Null keys are dropped.
    """
    from tadkit.operators.aggregate import grouped_quantiles
    df = df.filter(F.col(key).isNotNull() & F.col(period).isNotNull())
    v = F.col(value).cast("double")
    part = df.groupBy(key, period).agg(
        F.count(v).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum(v.cast(f"decimal(38,{scale})")).alias("_s"),
        F.avg(v).alias("_m"), F.var_pop(v).alias("_q"), *[F.count(f).alias(f"_c_{f}") for f in flags],
        *[F.sum(F.col(f).cast("double")).alias(f"_f_{f}") for f in flags])
    x = anchor_windows(part, key, period, subs)
    # Spread within the periods and of their means about the window's mean.
    x = x.join(x.groupBy(key, "anchor", "sub").agg(F.try_divide(F.sum("_s").cast("double"), F.sum("_n")).alias("_mean")), [key, "anchor", "sub"])
    spread = F.col("_n") * (F.col("_q") + F.pow(F.col("_m") - F.col("_mean"), 2))
    aggs = []
    for s in subs:
        m = F.col("sub") == s
        n = F.sum(F.when(m, F.col("_n")))
        aggs += [F.min(F.when(m, F.col("_lo"))).alias(f"{value}_min_{s}"), F.max(F.when(m, F.col("_hi"))).alias(f"{value}_max_{s}"),
                 F.try_divide(F.sum(F.when(m, F.col("_s"))).cast("double"), n).alias(f"{value}_mean_{s}"),
                 F.sqrt(F.when(n > 1, F.sum(F.when(m, spread)) / (n - 1))).alias(f"{value}_std_{s}")]
        aggs += [F.try_divide(F.sum(F.when(m, F.col(f"_f_{f}"))), F.sum(F.when(m, F.col(f"_c_{f}")))).alias(f"{f}_mean_{s}") for f in flags]
    out = x.groupBy(key, "anchor").agg(*aggs)
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, period, value).agg(F.count(F.lit(1)).alias("_rows"))
    med = grouped_quantiles(anchor_windows(counts, key, period, subs), [key, "anchor", "sub"], value, [0.5], alias="_med", weight="_rows")
    medw = med.groupBy(key, "anchor").agg(*[F.max(F.when(F.col("sub") == s, F.col("_med"))).alias(f"{value}_median_{s}") for s in subs])
    return out.join(medw, [key, "anchor"], "left")


def forward_target(df: DataFrame, key: str, period: str, order: str, value: str, horizon: int,
                   alias: str = "target") -> DataFrame:
    """Last ``value`` (by ``order``) in periods (anchor, anchor + horizon]."""
    arr = F.sequence(F.col(period) - horizon, F.col(period) - 1)
    x = df.withColumn("anchor", F.explode(arr))
    return x.groupBy(key, "anchor").agg(F.max_by(value, F.struct(order, value)).alias(alias))


# E12 -----------------------------------------------------------------------
def lag_frame(df: DataFrame, by, order: str, value: str, lags: int, prefix: str = "lag") -> DataFrame:
    """(x_{t-L} .. x_{t-1}) -> x_t rows; rows without a full history dropped."""
    by = _cols(by)
    out = lag_columns(df, by, order, value, list(range(1, lags + 1)), prefix=prefix)
    return out.filter(F.col(f"{prefix}{lags}").isNotNull())


# E13 -----------------------------------------------------------------------
def average_rank(df: DataFrame, value: str, alias: str = "avg_rank", by=None) -> DataFrame:
    """Ranks 1..n with ties averaged (pandas ``rank()``), per group or global.

    Rows are counted per distinct (group, value) first; running counts over
    a range-partitioned order give each value's last rank, and the average
    rank of a tie block is ``cum - (count - 1) / 2``.  No window holds a
    whole group, so a hot group costs the same as any other.  Every row is
    kept; null values and rows of a null key have no rank.
    """
    from tadkit.operators.frame import cumulative_sum
    by = _cols(by)
    known = F.col(value).isNotNull()
    for b in by:
        known = known & F.col(b).isNotNull()
    counts = df.filter(known).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    cum = cumulative_sum(counts, by, [value], ["_c"])
    ranks = cum.select(*by, value, (F.col("_c_cum") - (F.col("_c") - 1) / 2.0).alias(alias))
    return df.join(ranks, [*by, value], "left")

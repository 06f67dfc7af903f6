"""Join operators (inventory C1-C10).

The choice of a broadcast is left to AQE, which makes it from runtime
statistics (``spark.sql.autoBroadcastJoinThreshold``) and splits skewed
partitions of a sort-merge join.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


# C1
def assemble_tad(spine: DataFrame, parts: Sequence[DataFrame], key, fill=0) -> DataFrame:
    """Left-join pre-aggregated parts (one row per key each) onto a spine.

    Every part is already reduced to one row per key, so each join moves at
    most (#keys) rows; numeric gaps are filled with ``fill``.
    """
    keys = _keys(key)
    out = spine.select(*keys).dropDuplicates(keys)
    for p in parts:
        out = out.join(p, on=keys, how="left")
    if fill is not None:
        out = out.na.fill(fill)
    return out


# C2
def join_suffix(left: DataFrame, right: DataFrame, left_on, right_on=None, how: str = "inner",
                suffixes=("_x", "_y")) -> DataFrame:
    """pandas ``merge``: keys of different names, suffixes on colliding columns."""
    left_on = _keys(left_on)
    right_on = _keys(right_on or left_on)
    same = left_on == right_on
    lcols, rcols = set(left.columns), set(right.columns)
    clash = (lcols & rcols) - (set(left_on) if same else set())
    l2 = left.select(*[F.col(c).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    if same:
        return l2.join(r2, on=left_on, how=how)
    cond = [l2[a] == r2[b] for a, b in zip(left_on, right_on)]
    return l2.join(r2, on=cond, how=how)


# C4
def outer_join_all(frames: Sequence[DataFrame], on) -> DataFrame:
    """``reduce(merge(how='outer'))`` on a composite key."""
    keys = _keys(on)
    return functools.reduce(lambda a, b: a.join(b, on=keys, how="full_outer"), frames)


# C5
def last_wins_lookup(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One (key, value) per key: the row last in ``order`` wins."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def recode_join(df: DataFrame, col: str, mapping: DataFrame, key: str = "key", value: str = "value",
                out: str | None = None, default=None) -> DataFrame:
    """B11 at scale: map through a two-column table with a left join."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    res = df.join(m, df[col] == m["_k"], "left").drop("_k")
    v = F.col("_v") if default is None else F.coalesce(F.col("_v"), F.lit(default))
    return res.withColumn(out or col, v).drop("_v") if (out or col) != "_v" else res


# C6 / G5
def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right.select(*_keys(on)).distinct(), on=_keys(on), how="left_anti")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right.select(*_keys(on)), on=_keys(on), how="left_semi")


# C7
def calendar_dimension(df: DataFrame, date_col: str) -> DataFrame:
    """Distinct months of a date column with a dense month id 1..n.

    The distinct month list is tiny (bounded by the calendar span), so the
    single ordered window over it is cheap.
    """
    months = df.select(F.trunc(F.col(date_col).cast("date"), "month").alias("month")).distinct()
    return months.withColumn("id_month", F.dense_rank().over(Window.orderBy("month")))


def with_month_id(df: DataFrame, date_col: str) -> DataFrame:
    cal = calendar_dimension(df, date_col)
    # one row per calendar month of the data's span: bounded by the calendar
    return df.withColumn("month", F.trunc(F.col(date_col).cast("date"), "month")).join(
        F.broadcast(cal), "month", "left")

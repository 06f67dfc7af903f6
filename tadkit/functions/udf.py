"""User-defined function surfaces.

Built-in expressions come first; where Python is needed it runs as Arrow
batches (``pandas_udf``), never row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


# I1 / I2 -------------------------------------------------------------------
def vectorized(fn: Callable[..., pd.Series], return_type: DataType | str) -> Callable[..., Column]:
    """Wrap a pandas Series -> Series function as an Arrow-batched UDF."""
    return F.pandas_udf(fn, returnType=return_type)


# I3 ------------------------------------------------------------------------
def mean_of_lag_ratio(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, alias: str) -> DataFrame:
    """A custom group aggregate (mean of x_t / x_{t-1} - 1) expressed with
    built-ins, so it is partial-aggregated instead of gathering the group."""
    from tadkit.operators.windows import lag_columns
    x = lag_columns(df, list(by), list(order), value, [1], prefix="_lag")
    r = F.try_divide(F.col(value), F.col("_lag1")) - 1
    return x.select(*by, r.alias("_r")).groupBy(*by).agg(F.avg("_r").alias(alias))


# I4 ------------------------------------------------------------------------
def struct_udf(fn: Callable[[pd.Series], pd.DataFrame], schema: str) -> Callable[..., Column]:
    """Series -> DataFrame function as a struct-returning pandas UDF."""
    return F.pandas_udf(fn, returnType=schema)


# I5 ------------------------------------------------------------------------
def per_group_frame(df: DataFrame, by: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What ``groupBy(by).applyInPandas(fn)`` gives: the function sees a whole group, so
    ``by`` must be a key whose groups stay small as the data grow (a customer,
    a document), not one that divides the table in a few parts.

    Groups come to Python many in a batch, sorted by key, and are cut there, so a group of a few
    rows costs no batch of its own.  Integers and flags come without nulls, which are marked
    beside them: nulls in one group do not change the types another one has.
    """
    first = Window.partitionBy(*by).orderBy(F.lit(0))
    x = df.withColumn("_first", F.row_number().over(first) == 1)
    marked = [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "boolean")]
    x = x.select("_first", *[F.coalesce(c, F.lit(0).cast(t)).alias(c) if c in marked else F.col(f"`{c}`") for c, t in df.dtypes],
                 *[F.col(c).isNull().alias(f"_null_{c}") for c in marked])
    columns = df.columns

    def results(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        starts = np.append(np.flatnonzero(rows["_first"]), len(rows))
        nulls = {c: n for c in marked if (n := rows[f"_null_{c}"].to_numpy(bool)).any()}
        rows = rows[columns]
        same: list[pd.DataFrame] = []                 # results of the same types
        for a, b in zip(starts, starts[1:]):
            g = rows.iloc[a:b].copy()
            g.index = pd.RangeIndex(b - a)
            for c, n in nulls.items():
                if n[a:b].any():
                    g[c] = g[c].astype(object if g[c].dtype == bool else float).mask(n[a:b], None)
            out = fn(g)
            if same and list(out.dtypes) != list(same[0].dtypes):
                yield pd.concat(same, ignore_index=True)
                same = []
            same.append(out)
        if same:
            yield pd.concat(same, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []                 # the group that may go on
        for b in batches:
            at = np.flatnonzero(b["_first"])
            if len(at):
                ended = [*held, b.iloc[:at[-1]]]
                if sum(map(len, ended)):
                    yield from results(pd.concat(ended, ignore_index=True))
                held = []
                b = b.iloc[at[-1]:]
            held.append(b)
        if held:
            yield from results(pd.concat(held, ignore_index=True))
    return x.mapInPandas(run, schema)

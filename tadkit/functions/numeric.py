"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money_sum(x, scale: int = 4, precision: int = 18) -> Column:
    """Order-independent sum of money-like doubles.

    Summing through DECIMAL is exact, so the result does not depend on how
    the rows were partitioned (double addition is not associative); the
    result is returned as double.
    """
    return F.sum(_c(x).cast(f"decimal({precision},{scale})")).cast("double")


def safe_div(a, b) -> Column:
    """a / b with 0 or null denominators -> null (pandas gives NaN/inf)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def inf_to_null(x) -> Column:
    """+-inf and NaN -> null."""
    c = _c(x).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def row_total(cols: Sequence, fill: float = 0) -> Column:
    """Sum across columns, nulls as ``fill`` (pandas ``sum(axis=1)``)."""
    acc = None
    for c in cols:
        term = F.coalesce(_c(c), F.lit(fill))
        acc = term if acc is None else acc + term
    return acc


def pairwise_ratios(cols: Sequence[str], fmt: str = "{a}_over_{b}") -> list[Column]:
    """Ratio of every ordered pair (a, b) with a before b, 0-safe."""
    out = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            out.append(safe_div(a, b).alias(fmt.format(a=a, b=b)))
    return out


# H24 -- fixed values: Earth radius in kilometres and miles used by the source.
EARTH_RADIUS = {"Kilometers": 6371.0, "Miles": 3956.0}


def haversine(lat1, lat2, lon1, lon2, units: str = "Kilometers") -> Column:
    """Great-circle distance; argument order (lat1, lat2, lon1, lon2)."""
    r = EARTH_RADIUS[units]
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * r) * F.asin(F.sqrt(a))


def clip_low(x, low: float = 0.0) -> Column:
    """Negative scaled values -> 0."""
    return F.greatest(_c(x), F.lit(low))


def log1p_safe(x) -> Column:
    return F.when(_c(x) > -1, F.log1p(_c(x)))


def rnd(x, digits: int = 6) -> Column:
    return F.round(_c(x).cast("double"), digits)

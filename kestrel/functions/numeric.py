"""Numeric and array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import DEFAULT_RISK_WEIGHT, RISK_WEIGHTS, RMS_EPSILON, RMS_TARGET


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_int(c: Column | str, default: int = 0) -> Column:
    """To number or null, null -> default, then to int (truncating)."""
    as_double = _col(c).cast("string").try_cast(T.DoubleType())
    return F.coalesce(as_double, F.lit(float(default))).cast("long")


def pct(x: Column, decimals: int = 1) -> Column:
    """Percentage rounded half to even, as Python's round does."""
    return F.bround(x, decimals)


def risk_weight(status: Column | str) -> Column:
    """Exact, case-sensitive status -> weight; anything else the default."""
    status = _col(status)
    expr = None
    for word, weight in RISK_WEIGHTS.items():
        expr = (F.when(status == word, F.lit(weight)) if expr is None
                else expr.when(status == word, F.lit(weight)))
    return expr.otherwise(F.lit(DEFAULT_RISK_WEIGHT))


def rms_normalise(arr: Column | str, target: float = RMS_TARGET, eps: float = RMS_EPSILON) -> Column:
    """Scale an array so its root-mean-square is ``target`` (in double)."""
    arr = F.transform(_col(arr), lambda x: x.cast("double"))
    sum_sq = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x)
    rms = F.sqrt(sum_sq / F.size(arr)) + F.lit(eps)
    return F.transform(arr, lambda x: x * F.lit(target) / rms)


def nan_to_null(c: Column | str) -> Column:
    """NaN -> null (for JSON payloads, which must not carry NaN)."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)
